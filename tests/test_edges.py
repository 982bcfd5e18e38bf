"""Edge fixtures: literal rows for the cases the test tables do not contain."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from helpers import session_rows, ts
from loadcast.config import FULL, ONE_MONTH, PEAK_COLUMNS, RunConfig
from loadcast.functions.calendar import calendar_columns, is_federal_holiday
from loadcast.functions.labels import load_label
from loadcast.functions.timegrid import FIVE_MINUTES, floor_ts, ntz
from loadcast.operators.gapfill import time_grid
from loadcast.operators.lags import lag_features, rolling_daily_mean
from loadcast.operators.rollup import five_min_rollup, hourly_peak
from loadcast.plans.scoring import horizon
from loadcast.session import scratch_path
from loadcast.sources.sessions import clean_sessions, read_sessions_checked, read_sessions_csv


def test_cleaning_drops_header_rows_and_null_servers(spark):
    df = session_rows(spark, [{"ServerIP": "IPs", "TotalLoad": 1.0}, {"ServerIP": None, "TotalLoad": 2.0},
                              {"ServerIP": "1.1.1.1", "TotalLoad": 3.0}])
    assert [r.TotalLoad for r in clean_sessions(df).collect()] == [3.0]


def test_permissive_csv_read(spark):
    path = scratch_path(spark, "edge-csv")
    os.makedirs(path)
    lines = [
        "web,2016-06-01 00:00:12,2016-06-01 00:01:00,3,1.5,A,1,x,1,2,3,4,5,6,7.5,10.0.0.1,1.2.3.4",
        "web,2016-06-01 00:00:13",                                   # too few fields
        "web,2016-06-01 00:00:14,,3,1.5,A,1,x,1,2,3,4,5,6,abc,10.0.0.1,1.2.3.4",  # non-numeric load
        "TrafficType,SessionStart,SessionEnd,a,b,c,d,e,f,g,h,i,j,k,TotalLoad,IPs,ClientIP",  # header
    ]
    with open(f"{path}/part-0.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    rows = read_sessions_csv(spark, path).orderBy("SessionStart").collect()
    assert len(rows) == 4
    good = [r for r in rows if r.TotalLoad == 7.5][0]
    assert good.SessionStart == ts("2016-06-01 00:00:12") and good.ConcurrentConnectionCounts == 3
    short = [r for r in rows if r.SessionStart == ts("2016-06-01 00:00:13")][0]
    assert short.TotalLoad is None and short.ServerIP is None
    bad = [r for r in rows if r.SessionStart == ts("2016-06-01 00:00:14")][0]
    assert bad.TotalLoad is None and bad.SessionEnd is None and bad.ServerIP == "10.0.0.1"
    assert clean_sessions(read_sessions_csv(spark, path)).count() == 2


def test_label_bounds(spark):
    df = spark.createDataFrame([(None,), (100.0,), (100.01,), (500.0,), (500.01,)], "x double")
    got = [r[0] for r in df.select(load_label(F.col("x"), 100.0, 500.0)).collect()]
    assert got == [1, 1, 2, 2, 3]


def test_tied_peak_takes_earliest_bucket(spark):
    df = session_rows(spark, [
        {"ServerIP": "s", "SessionStart": ts("2016-06-01 10:20:00"), "TotalLoad": 5.0, "MbytesTransferred": 2.0},
        {"ServerIP": "s", "SessionStart": ts("2016-06-01 10:05:00"), "TotalLoad": 5.0, "MbytesTransferred": 1.0},
        {"ServerIP": "s", "SessionStart": ts("2016-06-01 10:50:00"), "TotalLoad": 4.0, "MbytesTransferred": 9.0},
    ])
    r = hourly_peak(five_min_rollup(df)).collect()
    assert len(r) == 1 and r[0].peakLoad == 5.0 and r[0].peakBytes == 1.0
    assert r[0].key == "s_2016-06-01 10:00:00"


def test_null_load_counts_as_zero_peak(spark):
    df = session_rows(spark, [{"ServerIP": "s", "SessionStart": ts("2016-06-01 10:20:00"), "TotalLoad": None}])
    r = hourly_peak(five_min_rollup(df)).collect()
    assert r[0].peakLoad == 0.0


def test_observed_against_calendar_lags(spark):
    rows = [("s", ts(f"2016-06-0{1 + h // 24} {h % 24:02d}:00:00"), float(h + 1)) for h in (0, 1, 50)]
    df = spark.createDataFrame(rows, "ServerIP string, SessionStartHourTime timestamp_ntz, peakLoad double")
    obs = {r.peakLoad: r for r in lag_features(df, "observed").collect()}
    cal = {r.peakLoad: r for r in lag_features(df, "calendar").collect()}
    assert obs[51.0].peakLoadLag48 is None and obs[51.0].peakLoadLag49 is None
    assert cal[51.0].peakLoadLag48 is None           # hour 2 does not exist
    assert cal[51.0].peakLoadLag49 == 2.0            # hour 1
    assert cal[51.0].peakLoadLag50 == 1.0            # hour 0


def test_rolling_frame_skips_two_days_and_averages_seven(spark):
    rows = [("s", ts(f"2016-06-{d + 1:02d} 00:00:00"), float(d)) for d in range(12)]
    cols = ", ".join(f"{c} double" for c in ["peakBytesDaily", "peakLoad1Daily", "peakLoad2Daily", "peakLoad3Daily",
                                               "peakLoad4Daily", "peakLoad5Daily", "peakLoadSecureDaily"])
    df = spark.createDataFrame([r + (0.0,) * 7 for r in rows],
                               f"ServerIP string, SessionStartDay timestamp_ntz, peakLoadDaily double, {cols}")
    for mode in ("observed", "calendar"):
        got = [r.peakLoadDailyLag2Win7 for r in rolling_daily_mean(df, mode).orderBy("SessionStartDay").collect()]
        assert got[:3] == [None, None, None]
        assert got[3] == 0.0 and got[4] == 0.5           # partial frames
        assert got[9] == sum(range(0, 7)) / 7            # full from the tenth row
        assert got[11] == sum(range(2, 9)) / 7


@pytest.mark.parametrize("day,expected", [
    ("2010-12-24", True), ("2010-12-31", True), ("2011-12-26", True), ("2010-07-05", True),
    ("2010-12-25", False), ("2011-01-01", False), ("2020-06-19", False), ("2021-06-18", True),
    ("2024-01-01", True), ("2024-01-15", True), ("2016-05-30", True), ("2016-11-24", True),
])
def test_holiday_rules(spark, day, expected):
    df = spark.createDataFrame([(date.fromisoformat(day),)], "d date")
    assert df.select(is_federal_holiday(F.col("d"))).first()[0] is expected


def test_holidays_equal_pandas_calendar(spark):
    from pandas.tseries.holiday import USFederalHolidayCalendar
    expected = {d.date() for d in USFederalHolidayCalendar().holidays(start="1990-01-01", end="2035-12-31")}
    days = spark.sql("SELECT explode(sequence(DATE'1990-01-01', DATE'2035-12-31')) AS d")
    got = {r.d for r in days.where(is_federal_holiday(F.col("d"))).collect()}
    assert got == expected


def test_hour_flags_and_iso_week(spark):
    hours = [5, 6, 8, 9, 10, 18, 19]
    df = spark.createDataFrame([(ts(f"2016-01-01 {h:02d}:00:00"),) for h in hours] + [(None,)], "t timestamp_ntz")
    cols = calendar_columns("t", "2016-01-01 00:00:00")
    rows = df.select(cols["hourofday"].alias("h"), cols["BusinessHour"].alias("b"), cols["Morning"].alias("m"),
                     cols["weekofyear"].alias("w")).collect()
    got = {r.h: (r.b, r.m) for r in rows}
    assert got == {5: (0, 0), 6: (0, 1), 8: (1, 1), 9: (1, 1), 10: (1, 0), 18: (1, 0), 19: (0, 0), None: (0, 0)}
    assert {r.w for r in rows if r.h is not None} == {53}


def test_floor_keeps_null_and_ignores_session_zone(spark):
    df = spark.createDataFrame([(ts("2024-03-10 02:34:56"),), (None,)], "t timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(floor_ts("t", 3600)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [ts("2024-03-10 02:00:00"), None]


@pytest.mark.parametrize("cfg,points", [(ONE_MONTH, 8641), (FULL, 788545)])
def test_five_minute_grid_size(spark, cfg: RunConfig, points):
    b = spark.range(1).select(ntz(cfg.train_begin).alias("b"), ntz(cfg.train_end).alias("e"))
    g = time_grid(b, "b", "e", FIVE_MINUTES)
    assert g.count() == points
    assert g.distinct().count() == points


def test_score_horizon():
    h = horizon("2016-07-01 00:00:00")
    assert h == {"score_begin": "2016-07-01 00:00:00", "score_end": "2016-07-02 23:59:59",
                 "feature_begin": "2016-05-31 13:30:01", "feature_end": "2016-06-30 23:59:59"}


def test_glob_scan_over_partitioned_folders(spark):
    """Session files laid out as year/month/container/part (S2), read with one glob."""
    base = scratch_path(spark, "edge-glob")
    rows = {"2016/05/a/0": "10.0.0.1", "2016/06/a/0": "10.0.0.2", "2016/06/b/3": "10.0.0.3",
            "2015/06/c/0": "10.0.0.4"}
    for sub, server in rows.items():
        os.makedirs(f"{base}/{sub}")
        with open(f"{base}/{sub}/request.csv", "w") as f:
            f.write(f"web,2016-06-01 00:00:12,,1,1.0,A,1,x,0,0,0,0,0,0,2.0,{server},1.2.3.4\n")
    got = read_sessions_csv(spark, f"{base}/201[0-9]/0[5-6]/[a,b]/[0-6]/request.csv")
    assert sorted(r.ServerIP for r in got.collect()) == ["10.0.0.1", "10.0.0.2", "10.0.0.3"]


def test_month_crossing_score_window_reads_two_months(spark):
    """Scoring 2016-07-01 needs 2016-05-31 13:00 .. 2016-06-30 23:00: May and June only."""
    from loadcast.plans import scoring as SC
    hours = spark.sql("""SELECT explode(sequence(TIMESTAMP_NTZ'2016-04-20 00:00:00', TIMESTAMP_NTZ'2016-07-10 00:00:00',
                                            INTERVAL 1 HOUR)) AS SessionStartHourTime""")
    hourly = hours.select(F.lit("s1").alias("ServerIP"), "SessionStartHourTime",
                          *[F.lit(1.0).alias(c) for c in ["peakLoad", "peakBytes", "peakLoad1", "peakLoad2",
                                                          "peakLoad3", "peakLoad4", "peakLoad5", "peakLoadSecure"]])
    hourly = hourly.withColumn("key", F.lit("k"))
    hp, dp = scratch_path(spark, "mc-h"), scratch_path(spark, "mc-d")
    SC.write_statistics(hourly, hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, "2016-07-01 00:00:00")
    got = hs.agg(F.min("SessionStartHourTime"), F.max("SessionStartHourTime"), F.count(F.lit(1))).first()
    assert got[0] == ts("2016-05-31 13:00:00") and got[1] == ts("2016-06-30 23:00:00")
    assert got[2] == 11 + 30 * 24
    assert {(r.year, r.month) for r in hs.select("year", "month").distinct().collect()} == {(2016, 5), (2016, 6)}
    assert ds.count() == 31
    cfg = ONE_MONTH.with_(train_begin="2016-04-20 00:00:00")
    feats = SC.score_features(hs, cfg)
    assert feats.count() == 48
    assert feats.where(F.col("peakLoadLag730") != 1.0).count() == 0   # every lag lands in the window
    assert feats.where(F.col("peakLoadDailyLag2Win7") != 1.0).count() == 0


def test_server_filter_list_and_semi_join_agree(spark):
    from loadcast.queries import sessions
    from loadcast.sources.sessions import filter_servers
    s = sessions(spark, "/root/testdata/sf0.001")
    wanted = ["10.0.0.1", "10.0.0.6"]
    by_list = filter_servers(s, wanted)
    by_join = filter_servers(s, spark.createDataFrame([(w,) for w in wanted] * 2, "ServerIP string"))
    assert by_list.count() > 0
    assert by_list.exceptAll(by_join).count() == 0 and by_join.exceptAll(by_list).count() == 0


def hours_of(spark, first, last, value=1.0):
    hours = spark.sql(f"SELECT explode(sequence(TIMESTAMP_NTZ'{first}', TIMESTAMP_NTZ'{last}', INTERVAL 1 HOUR)) "
                      "AS SessionStartHourTime")
    return hours.select(F.lit("k").alias("key"), F.lit("s1").alias("ServerIP"), "SessionStartHourTime",
                        *[F.lit(value).alias(c) for c in PEAK_COLUMNS])


def test_two_batches_inside_one_month_lose_no_hour(spark):
    from loadcast.plans import scoring as SC
    hp, dp = scratch_path(spark, "two-h"), scratch_path(spark, "two-d")
    SC.write_statistics(hours_of(spark, "2016-05-30 00:00:00", "2016-06-20 11:00:00"), hp, dp)
    SC.write_statistics(hours_of(spark, "2016-06-20 12:00:00", "2016-06-30 23:00:00", 3.0), hp, dp)
    june = spark.read.parquet(hp).where("month = 6")
    assert june.count() == 720 and june.select("SessionStartHourTime").distinct().count() == 720
    days = {r.SessionStartDay.day: r.peakLoadDaily for r in spark.read.parquet(dp).where("month = 6").collect()}
    assert len(days) == 30 and days[19] == 1.0 and days[20] == 2.0 and days[21] == 3.0
    assert spark.read.parquet(dp).where("month = 5").count() == 2
    SC.write_statistics(hours_of(spark, "2016-06-01 00:00:00", "2016-06-01 23:00:00", 9.0), hp, dp)  # corrected day
    june = spark.read.parquet(hp).where("month = 6")
    assert june.count() == 720 and june.where("peakLoad = 9").count() == 24
    SC.write_statistics(hours_of(spark, "2016-06-01 00:00:00", "2016-06-01 23:00:00").limit(0), hp, dp)
    assert spark.read.parquet(hp).where("month = 6").count() == 720


def test_a_server_without_statistics_gets_its_hours(spark):
    from loadcast.plans import scoring as SC
    hp, dp = scratch_path(spark, "req-h"), scratch_path(spark, "req-d")
    SC.write_statistics(hours_of(spark, "2016-06-01 00:00:00", "2016-06-30 23:00:00"), hp, dp)
    cfg = ONE_MONTH.with_(score_begin="2016-07-01 00:00:00")
    feats = SC.features_for_scoring(spark, cfg, hp, dp, ["s1", "new"])
    assert {r.ServerIP: r["count"] for r in feats.groupBy("ServerIP").count().collect()} == {"s1": 48, "new": 48}
    new = feats.where("ServerIP = 'new'")
    assert new.where("peakLoadLag48 <> 0 OR peakLoadDailyLag2Win7 <> 0").count() == 0
    assert SC.features_for_scoring(spark, cfg, hp, dp).count() == 48


def test_times_in_any_usual_form_are_read(spark):
    from loadcast.sources.sessions import read_sessions_text, unparsed_times
    path = scratch_path(spark, "edge-times")
    os.makedirs(path)
    forms = ["2016-06-01 00:00:12", "2016-06-01T00:00:12", "2016-06-01 00:00", "2016-06-01T00:00:12.250", "2016-06-01",
             "first of June", ""]
    with open(f"{path}/part-0.csv", "w") as f:
        for t in forms:
            f.write(f"web,{t},,1,1.0,A,1,x,0,0,0,0,0,0,2.0,10.0.0.1,1.2.3.4\n")
        f.write("TrafficType,SessionStart,SessionEnd,a,b,c,d,e,f,g,h,i,j,k,TotalLoad,IPs,ClientIP\n")
    got = [r.SessionStart for r in read_sessions_csv(spark, path).collect()]
    assert got[:5] == [ts("2016-06-01 00:00:12"), ts("2016-06-01 00:00:12"), ts("2016-06-01 00:00:00"),
                       ts("2016-06-01 00:00:12").replace(microsecond=250000), ts("2016-06-01 00:00:00")]
    assert got[5:] == [None, None, None]
    lost = {r.metric: r.n for r in unparsed_times(read_sessions_text(spark, path)).collect()}
    assert lost == {"unparsed_SessionStart": 1, "unparsed_SessionEnd": 0}
    own = scratch_path(spark, "edge-times-own")
    os.makedirs(own)
    with open(f"{own}/part-0.csv", "w") as f:
        f.write("web,01.06.2016 00:05,2016-06-01 00:06:00,1,1.0,A,1,x,0,0,0,0,0,0,2.0,10.0.0.1,1.2.3.4\n")
    row = read_sessions_csv(spark, own, "dd.MM.yyyy HH:mm").first()
    assert row.SessionStart == ts("2016-06-01 00:05:00") and row.SessionEnd == ts("2016-06-01 00:06:00")


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from loadcast.session import checkpoint_root
    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getConf=lambda: conf, master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))


def test_malformed_lines_are_rejected_with_file_and_reason(spark):
    path = scratch_path(spark, "edge-rejects")
    os.makedirs(path)
    good = "web,2016-06-01 00:00:12,2016-06-01 00:01:00,3,1.5,A,1,x,1,2,3,4,5,6,7.5,10.0.0.1,1.2.3.4"
    lines = {"a.csv": [good, "web,2016-06-01 00:00:13", good.replace("7.5", "abc"), good.replace("7.5", "")],
             "b.csv": ["TrafficType,SessionStart,SessionEnd,a,b,c,d,e,f,g,h,i,j,k,TotalLoad,IPs,ClientIP", good.replace(",3,", ",3x,"),
                       good.replace("2016-06-01 00:00:12", "yesterday"), good.replace("7.5", "Infinity"), good + ",more"]}
    for name, text in lines.items():
        with open(f"{path}/{name}", "w") as f:
            f.write("\n".join(text) + "\n")
    rows, rejects = read_sessions_checked(spark, path)
    found = sorted((r.file.rsplit("/", 1)[1], r.line, r.reason) for r in rejects.collect())
    a, b = lines["a.csv"], lines["b.csv"]
    assert found == sorted([("a.csv", a[1], "number of fields"), ("a.csv", a[2], "TotalLoad: not a number"),
                            ("b.csv", b[1], "ConcurrentConnectionCounts: not a number"), ("b.csv", b[2], "SessionStart: not a time"),
                            ("b.csv", b[3], "TotalLoad: not a number"), ("b.csv", b[4], "number of fields")])
    kept = clean_sessions(rows)
    assert sorted((r.TotalLoad for r in kept.collect()), key=str) == [7.5, None]
    assert kept.columns == clean_sessions(read_sessions_csv(spark, path)).columns
    assert five_min_rollup(kept).first().NumSession == 2  # also where few columns are read
