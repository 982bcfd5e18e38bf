"""Properties over the test tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_BIG, SF_MID
from helpers import canon
from loadcast.config import EVENTS, LAG_COLUMNS, ROLLING_COLUMNS
from loadcast.functions.timegrid import FIVE_MINUTES, HOUR, floor_ts
from loadcast.operators.lags import join_daily_lags, hour_features, lag_features, rolling_daily_mean
from loadcast.operators.rollup import daily_mean, five_min_rollup, hourly_peak, with_day
from loadcast.plans import features as FT
from loadcast.plans import scoring as SC
from loadcast.queries import hourly, rounded, sessions
from loadcast.session import scratch_path


@pytest.fixture(scope="module")
def sess(spark):
    return sessions(spark, SF_MID)


def test_rollup_has_one_row_per_server_bucket(sess):
    roll = five_min_rollup(sess)
    distinct = sess.select("ServerIP", floor_ts("SessionStart", FIVE_MINUTES)).distinct().count()
    assert roll.count() == distinct


def test_rollup_preserves_sums(sess):
    raw = sess.groupBy("ServerIP").agg(F.sum("TotalLoad").alias("a"), F.count(F.lit(1)).alias("n"))
    roll = five_min_rollup(sess).groupBy("ServerIP").agg(F.sum("SumTotalLoad").alias("b"),
                                                        F.sum("NumSession").alias("m"))
    for r in raw.join(roll, "ServerIP").collect():
        assert r.n == r.m and abs(r.a - r.b) < 1e-6


def test_peak_is_at_most_the_hourly_sum(sess):
    h = hourly_peak(five_min_rollup(sess))
    sums = sess.groupBy("ServerIP", floor_ts("SessionStart", HOUR).alias("SessionStartHourTime")) \
        .agg(F.sum("TotalLoad").alias("s"))
    bad = h.join(sums, ["ServerIP", "SessionStartHourTime"]).where(F.col("peakLoad") > F.col("s") + 1e-9)
    assert bad.count() == 0


def test_calendar_lag_is_value_i_hours_back(spark):
    h = hourly(spark, SF_MID)
    lagged = lag_features(h, "calendar")
    back = h.select("ServerIP", F.col("SessionStartHourTime").alias("t0"), F.col("peakLoad").alias("v"))
    for i, c in [(48, "peakLoadLag48"), (168, "peakLoadLag168")]:
        j = lagged.join(back, (lagged.ServerIP == back.ServerIP) &
                        (back.t0 == F.timestamp_add("HOUR", F.lit(-i), lagged.SessionStartHourTime)), "left")
        assert j.where(~F.col(c).eqNullSafe(F.col("v"))).count() == 0


def test_observed_and_calendar_agree_without_gaps(spark):
    h = hourly(spark, SF_BIG)  # every server-hour exists at this scale
    assert h.count() == 8 * 720
    a = lag_features(h, "observed").select("key", *LAG_COLUMNS)
    b = lag_features(h, "calendar").select("key", *LAG_COLUMNS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode", ["observed", "calendar"])
def test_window_rolling_equals_join_rolling(spark, mode):
    h = with_day(hourly(spark, SF_MID))
    via_join = join_daily_lags(h, rolling_daily_mean(daily_mean(h), mode)).select("key", *ROLLING_COLUMNS)
    via_window = hour_features(h, mode).select("key", *ROLLING_COLUMNS)
    rows_a = [tuple(r) for r in via_join.collect()]
    rows_b = [tuple(r) for r in via_window.collect()]
    cols = via_join.columns
    assert canon(cols, rows_a) == canon(cols, rows_b)


def test_train_and_score_features_agree(spark):
    cfg = EVENTS
    feats = FT.hourly_features(sessions(spark, SF_MID), cfg)
    hp, dp = scratch_path(spark, "t-hs"), scratch_path(spark, "t-ds")
    SC.write_statistics(with_day(hourly(spark, SF_MID)), hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    scored = SC.score_features(hs, cfg)
    cols = LAG_COLUMNS + ROLLING_COLUMNS + ["linearTrend", "dayofweek", "year", "month", "weekofyear",
                                            "dayofmonth", "hourofday", "Holiday", "BusinessHour", "Morning"]
    both = scored.select("key", *cols).join(feats.select("key", *[F.col(c).alias("t_" + c) for c in cols]), "key")
    assert both.count() > 0
    for c in cols:
        diff = both.where(~F.col(c).eqNullSafe(F.col("t_" + c)))
        if c in LAG_COLUMNS + ROLLING_COLUMNS + ["linearTrend"]:
            diff = both.where(F.abs(F.col(c) - F.col("t_" + c)) > 1e-9)
        assert diff.count() == 0, c


@pytest.mark.parametrize("mode", ["calendar", "observed"])
def test_chunked_windows_equal_windows_over_the_whole_history(spark, mode):
    """Gappy history of two servers over some 400 days, in chunks of one halo and of four."""
    import random
    from datetime import datetime, timedelta
    from loadcast.config import PEAK_COLUMNS
    from loadcast.operators.lags import lags_within, rolling_within
    r = random.Random(3)
    hours = [(s, datetime(2014, 12, 1) + timedelta(hours=h)) for s, share in (("a", .9), ("b", .08)) for h in range(400 * 24)
             if r.random() < share and not 3000 < h < 4500]
    df = spark.createDataFrame([(s, t, *[float(r.randrange(1000)) for _ in PEAK_COLUMNS]) for s, t in hours],
                               "ServerIP string, SessionStartHourTime timestamp_ntz, " + ", ".join(f"{c} double" for c in PEAK_COLUMNS))
    df = with_day(df)
    whole = df.withColumn("_day", F.dense_rank().over(Window.partitionBy("ServerIP").orderBy("SessionStartDay")))
    by = ["ServerIP"]
    want = rolling_within(lags_within(whole, mode, by), mode, by).drop("_day")
    expected = sorted(map(str, rounded(want).collect()))
    assert sum("Lag730=None" not in x for x in expected) > 3000 or mode == "calendar"
    for halos in (1, 4):
        got = hour_features(df, mode, chunk_halos=halos).select(*want.columns)
        assert sorted(map(str, rounded(got).collect())) == expected
