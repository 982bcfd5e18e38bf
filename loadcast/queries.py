"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole test tables (``events`` as the session log, ``lineitem`` for
the long history). ``ORACLE`` holds the DuckDB SQL of each query that has one. Doubles
in the output are rounded half-up to six decimals, and the SQL rounds the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle as O
from .config import (DAILY_COLUMNS, FIVE_MIN_SUMS, INDEX_COLUMNS, INDEXED_COLUMNS, LAG_COLUMNS, PEAK_COLUMNS,
                     EVENTS, EVENTS_CUTS, LINEITEM, SESSION_COLUMNS, ROLLING_COLUMNS, SCALED_COLUMNS, SUM_COLUMNS, RunConfig)
from .functions.calendar import add_calendar, calendar_columns, is_federal_holiday
from .functions.labels import drop_null_keys, fill_numeric, load_label
from .functions.timegrid import DAY, FIVE_MINUTES, HOUR, floor_ts, horizon_columns, ntz
from .operators.encode import (fit_features, fit_indexers, index_rows, one_hot_long, prepare_for_index, scaled_columns,
                               vector_entries)
from .operators.gapfill import fill_gaps, gap_fill, grid_outer_join, server_grid, time_grid
from .operators.lags import join_daily_lags, lag_features, rolling_daily_mean
from .operators.model import add_label, classification_metrics, split_column
from .operators.rollup import daily_mean, five_min_rollup, hourly_peak, row_key, with_day
from .plans import features as FT
from .plans import scoring as SC
from .plans import statistics as ST
from .plans import training as TR
from .session import scratch_path
from .streaming.score_stream import score_files_once
from .sources.sessions import (WRITE_TIMESTAMP_FORMAT, clean_sessions, filter_servers, read_sessions_checked, read_sessions_csv,
                               read_sessions_text, sessions_from_events, sessions_from_lineitem,
                               unparsed_times, write_sessions_csv)
from .sources.records import read_records, write_records
from .sources.views import floor_sql, register_views
from .sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


# ---- helpers ------------------------------------------------------------------------------

def round_double_sql(name: str) -> str:
    """Half-up rounding to ``oracle.R`` decimals."""
    return f"round(`{name}` + {O.HALF_WAY!r}D, {O.R}) AS `{name}`"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded for comparison with the SQL oracle (which rounds the same way)."""
    return df.selectExpr(*[round_double_sql(f.name) if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
                           for f in df.schema.fields])


def sessions(spark, d) -> DataFrame:
    return clean_sessions(sessions_from_events(table(spark, d, "events")))


def hourly(spark, d) -> DataFrame:
    return hourly_peak(five_min_rollup(sessions(spark, d)))


def hourly_with_day(spark, d) -> DataFrame:
    return with_day(hourly(spark, d))


def staged_hourly(spark, d) -> DataFrame:
    """Hourly peaks written once to the shared folder, for queries that use them twice
    (the sessions are then scanned and aggregated once)."""
    path = scratch_path(spark, "hourly")
    with_day(hourly(spark, d)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bounds_row(spark, begin: str, end: str) -> DataFrame:
    return spark.range(1).select(ntz(begin).alias("b"), ntz(end).alias("e"))


def doubles(names: list[str], dbl: set[str] | None = None) -> list[tuple[str, bool]]:
    """(name, is_double) pairs for ``O.final``; by default every non-key column is double."""
    keys = {"key", "ServerIP", "SessionStartHourTime", "SessionStartDay", "SessionStartFiveMin",
            "NumSession", "Time", "split", "label", "date", "dayofweek"}
    return [(n, (n in dbl) if dbl is not None else (n not in keys)) for n in names]


REG: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | Callable[[RunConfig], str] | None = None):
    def deco(fn: Query) -> Query:
        REG[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- S1-S3, P1, P3: session log -----------------------------------------------------------

@register("csv_roundtrip", O.with_([("raw_sessions", O.RAW_SESSIONS)],
                                   O.final(O.session_cols(), "raw_sessions")))
def q_csv_roundtrip(spark, d):
    """Session log written as headerless CSV and read back with the declared schema."""
    path = scratch_path(spark, "sessions-csv")
    write_sessions_csv(sessions_from_events(table(spark, d, "events")), path)
    return rounded(read_sessions_csv(spark, path))


@register("csv_glob", O.with_([("raw_sessions", O.RAW_SESSIONS)], O.final(O.session_cols(), "raw_sessions")))
def q_csv_glob(spark, d):
    """The session log as several CSV folders, read back through one glob pattern."""
    path = scratch_path(spark, "sessions-folders")
    log = sessions_from_events(table(spark, d, "events"))
    write_sessions_csv(log, path, folder=F.dayofmonth("SessionStart") % 5)
    return rounded(read_sessions_csv(spark, f"{path}/folder=*/part-*"))


@register("clean_sessions", O.with_([("raw_sessions", O.RAW_SESSIONS), ("sessions", O.SESSIONS)],
                                    O.final(O.session_cols(), "sessions")))
def q_clean_sessions(spark, d):
    return rounded(sessions(spark, d))


# The reference's debug mode: the pipeline restricted to a list of servers.
DEBUG_SERVERS = ["10.0.0.1", "10.0.0.6"]

_ROLLUP_COLS = ["ServerIP", "SessionStartFiveMin", "SumTotalLoad", "NumSession"] + SUM_COLUMNS[1:]


@register("filter_servers", O.with_(
    O.base_ctes()[:2] + [("picked", "SELECT * FROM sessions WHERE ServerIP IN ('10.0.0.1', '10.0.0.6')"),
                         ("rollup", O.rollup_sql("picked"))],
    O.final(doubles(_ROLLUP_COLS), "rollup")))
def q_filter_servers(spark, d):
    return rounded(five_min_rollup(filter_servers(sessions(spark, d), DEBUG_SERVERS)))


# ---- T3, G1, G2, G3: buckets and rollups --------------------------------------------------

@register("floor_buckets", """
SELECT event_id, ts AS SessionStart, time_bucket(INTERVAL '5 minutes', ts) AS SessionStartFiveMin,
       date_trunc('hour', ts) AS SessionStartHourTime, date_trunc('day', ts) AS SessionStartDay
FROM events""")
def q_floor_buckets(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", F.col("ts").alias("SessionStart"),
                     floor_ts("ts", FIVE_MINUTES).alias("SessionStartFiveMin"),
                     floor_ts("ts", HOUR).alias("SessionStartHourTime"),
                     floor_ts("ts", DAY).alias("SessionStartDay"))


@register("five_min_rollup", O.with_(O.base_ctes()[:3], O.final(doubles(_ROLLUP_COLS), "rollup")))
def q_five_min_rollup(spark, d):
    return rounded(five_min_rollup(sessions(spark, d)))


@register("sql_five_min_rollup", O.with_(O.base_ctes()[:3], O.final(doubles(_ROLLUP_COLS), "rollup")))
def q_sql_five_min_rollup(spark, d):
    """The five-minute rollup written in Spark SQL over a temp view (S12)."""
    register_views(spark, sessions(spark, d), prefix="lc_")
    sums = ", ".join(f"sum({src}) AS {name}" for name, src in FIVE_MIN_SUMS[1:])
    return rounded(spark.sql(f"""
        SELECT ServerIP, {floor_sql('SessionStart', FIVE_MINUTES)} AS SessionStartFiveMin,
               sum(TotalLoad) AS SumTotalLoad, count(*) AS NumSession, {sums}
        FROM lc_sessions GROUP BY 1, 2"""))


@register("sql_views", O.with_(O.base_ctes() + [("daily", O.daily_sql())], f"""
SELECT s.ServerIP, s.sessions, f.buckets, f.counted, {O.r6('h.peak')} AS peak, {O.r6('dm.mean')} AS mean
FROM (SELECT ServerIP, count(*) AS sessions FROM sessions GROUP BY 1) s
JOIN (SELECT ServerIP, count(*) AS buckets, CAST(sum(NumSession) AS BIGINT) AS counted FROM rollup GROUP BY 1) f USING (ServerIP)
JOIN (SELECT ServerIP, max(peakLoad) AS peak FROM hourly GROUP BY 1) h USING (ServerIP)
JOIN (SELECT ServerIP, avg(peakLoadDaily) AS mean FROM daily GROUP BY 1) dm USING (ServerIP)"""))
def q_sql_views(spark, d):
    """All four temp views in one Spark SQL query (S12), over a staged session log."""
    path = scratch_path(spark, "sessions")
    sessions(spark, d).write.parquet(path)
    register_views(spark, spark.read.parquet(path), prefix="lc4_")
    return rounded(spark.sql("""
        SELECT s.ServerIP, s.sessions, f.buckets, f.counted, h.peak, dm.mean
        FROM (SELECT ServerIP, count(*) AS sessions FROM lc4_sessions GROUP BY 1) s
        JOIN (SELECT ServerIP, count(*) AS buckets, sum(NumSession) AS counted FROM lc4_five_min GROUP BY 1) f USING (ServerIP)
        JOIN (SELECT ServerIP, max(peakLoad) AS peak FROM lc4_hourly_peak GROUP BY 1) h USING (ServerIP)
        JOIN (SELECT ServerIP, avg(peakLoadDaily) AS mean FROM lc4_daily_mean GROUP BY 1) dm USING (ServerIP)"""))


_HOURLY_COLS = ["key", "ServerIP", "SessionStartHourTime"] + PEAK_COLUMNS


@register("hourly_peak", O.with_(O.base_ctes(), O.final(doubles(_HOURLY_COLS), "hourly")))
def q_hourly_peak(spark, d):
    return rounded(hourly(spark, d))


_DAILY_COLS = ["ServerIP", "SessionStartDay"] + DAILY_COLUMNS


@register("daily_mean_peak", O.with_(O.base_ctes() + [("daily", O.daily_sql())],
                                     O.final(doubles(_DAILY_COLS), "daily")))
def q_daily_mean_peak(spark, d):
    return rounded(daily_mean(hourly_with_day(spark, d)))


@register("row_key", O.with_(O.base_ctes()[:3], """
SELECT ServerIP, SessionStartFiveMin,
       ServerIP || '_' || CAST(date_trunc('hour', SessionStartFiveMin) AS VARCHAR) AS key
FROM rollup"""))
def q_row_key(spark, d):
    r = five_min_rollup(sessions(spark, d))
    r = r.withColumn("hour", floor_ts("SessionStartFiveMin", HOUR))
    return r.select("ServerIP", "SessionStartFiveMin", row_key("ServerIP", "hour").alias("key"))


# ---- T1, T2, J1, J4, J5: grids -------------------------------------------------------------

@register("time_grid", """
SELECT unnest(generate_series(time_bucket(INTERVAL '5 minutes', min(ts)),
                              time_bucket(INTERVAL '5 minutes', max(ts)) + INTERVAL 5 MINUTE,
                              INTERVAL 5 MINUTE)) AS Time
FROM events""")
def q_time_grid(spark, d):
    """Five-minute grid spanning the data (ends floored, one bucket past the end)."""
    b = table(spark, d, "events").agg(F.min("ts").alias("b"), F.max("ts").alias("e"))
    return time_grid(b, "b", "e", FIVE_MINUTES)


def _cfg_grid_sql(cfg: RunConfig, step: str, floor: str) -> str:
    return (f"SELECT unnest(generate_series({floor.format(f'TIMESTAMP {chr(39)}{cfg.train_begin}{chr(39)}')}, "
            f"{floor.format(f'TIMESTAMP {chr(39)}{cfg.train_end}{chr(39)}')} + INTERVAL {step}, "
            f"INTERVAL {step})) AS ts")


@register("grid_outer_join", O.with_(O.base_ctes()[:3] + [
    ("grid", _cfg_grid_sql(EVENTS, "5 MINUTE", "time_bucket(INTERVAL '5 minutes', {})"))],
    O.final([("Time", False)] + doubles(_ROLLUP_COLS),
            "(SELECT g.ts AS Time, r.* FROM grid g FULL OUTER JOIN rollup r ON g.ts = r.SessionStartFiveMin)")))
def q_grid_outer_join(spark, d):
    cfg = EVENTS
    grid = time_grid(bounds_row(spark, cfg.train_begin, cfg.train_end), "b", "e", FIVE_MINUTES)
    return rounded(grid_outer_join(grid, five_min_rollup(sessions(spark, d))))


@register("gap_fill_hourly", O.with_(O.base_ctes() + [
    ("grid", _cfg_grid_sql(EVENTS, "1 HOUR", "date_trunc('hour', {})")),
    ("servers", "SELECT DISTINCT ServerIP FROM hourly")],
    O.final([("ServerIP", False), ("SessionStartHourTime", False)] + doubles(PEAK_COLUMNS), """(
  SELECT s.ServerIP, g.ts AS SessionStartHourTime, h.* EXCLUDE (key, ServerIP, SessionStartHourTime)
  FROM servers s CROSS JOIN grid g
  LEFT JOIN hourly h ON h.ServerIP = s.ServerIP AND h.SessionStartHourTime = g.ts)""")))
def q_gap_fill_hourly(spark, d):
    """Every server x every hour of the run range, peaks NULL where the hour had no data."""
    cfg = EVENTS
    return rounded(fill_gaps(hourly(spark, d).drop("key"), ntz(cfg.train_begin), ntz(cfg.train_end), HOUR,
                             "SessionStartHourTime"))


@register("gap_fill_daily", O.with_(O.base_ctes() + [
    ("daily", O.daily_sql()),
    ("grid", _cfg_grid_sql(EVENTS, "1 DAY", "date_trunc('day', {})")),
    ("servers", "SELECT DISTINCT ServerIP FROM hourly")],
    O.final([("ServerIP", False), ("SessionStartDay", False)] + doubles(DAILY_COLUMNS), """(
  SELECT s.ServerIP, g.ts AS SessionStartDay, dl.* EXCLUDE (ServerIP, SessionStartDay)
  FROM servers s CROSS JOIN grid g
  LEFT JOIN daily dl ON dl.ServerIP = s.ServerIP AND dl.SessionStartDay = g.ts)""")))
def q_gap_fill_daily(spark, d):
    cfg = EVENTS
    return rounded(fill_gaps(daily_mean(hourly_with_day(spark, d)), ntz(cfg.train_begin), ntz(cfg.train_end), DAY,
                             "SessionStartDay"))


@register("gap_fill_grid", O.with_(O.base_ctes() + [
    ("grid", _cfg_grid_sql(EVENTS, "1 HOUR", "date_trunc('hour', {})"))],
    O.final([("ServerIP", False), ("SessionStartHourTime", False)] + doubles(PEAK_COLUMNS), """(
  SELECT s.ServerIP, g.ts AS SessionStartHourTime, h.* EXCLUDE (key, ServerIP, SessionStartHourTime)
  FROM (SELECT unnest(['10.0.0.1', '10.0.0.6', '10.9.9.9']) AS ServerIP) s CROSS JOIN grid g
  LEFT JOIN hourly h ON h.ServerIP = s.ServerIP AND h.SessionStartHourTime = g.ts)""")))
def q_gap_fill_grid(spark, d):
    """Named servers, one of them without data, x every hour: a grid of its own, joined (J4)."""
    cfg = EVENTS
    named = spark.createDataFrame([(s,) for s in REQUESTED], "ServerIP string")
    grid = server_grid(named, ntz(cfg.train_begin), ntz(cfg.train_end), HOUR, out="SessionStartHourTime")
    return rounded(gap_fill(grid, hourly(spark, d).drop("key"), ["ServerIP", "SessionStartHourTime"]))


# ---- W1-W3, J2: rolling means and lags ------------------------------------------------------

_ROLL_COLS = _DAILY_COLS + ROLLING_COLUMNS


@register("rolling_daily_mean", O.with_(O.base_ctes() + [("daily", O.daily_sql()),
                                                         ("rolling", O.rolling_sql("daily", "observed"))],
                                        O.final(doubles(_ROLL_COLS), "rolling")))
def q_rolling_daily_mean(spark, d):
    """Rolling mean over the observed days -9 .. -3 of each server (the training ETL's rows)."""
    return rounded(rolling_daily_mean(daily_mean(hourly_with_day(spark, d)), "observed"))


@register("rolling_daily_calendar", O.with_(O.base_ctes() + [("daily", O.daily_sql()),
                                                             ("rolling", O.rolling_sql("daily", "calendar"))],
                                            O.final(doubles(_ROLL_COLS), "rolling")))
def q_rolling_daily_calendar(spark, d):
    """Rolling mean over the calendar days d-9 .. d-3 (what scoring sees on its day grid)."""
    return rounded(rolling_daily_mean(daily_mean(hourly_with_day(spark, d)), "calendar"))


_LAG_OUT = ["key", "ServerIP", "SessionStartHourTime", "peakLoad"] + LAG_COLUMNS


@register("lag_observed", O.with_(O.base_ctes() + [("lagged", O.lags_sql("hourly", "observed"))],
                                  O.final(doubles(_LAG_OUT), "lagged")))
def q_lag_observed(spark, d):
    return rounded(lag_features(hourly_with_day(spark, d), "observed").select(*_LAG_OUT))


@register("lag_calendar", O.with_(O.base_ctes() + [("lagged", O.lags_sql("hourly", "calendar"))],
                                  O.final(doubles(_LAG_OUT), "lagged")))
def q_lag_calendar(spark, d):
    return rounded(lag_features(hourly_with_day(spark, d), "calendar").select(*_LAG_OUT))


_EARLIER = "2023-12-25 00:00:00"  # a grid that begins before the data has hours without any server


@register("null_fill", O.with_(O.base_ctes() + [
    ("lagged", O.lags_sql("hourly", "observed")),
    ("grid", _cfg_grid_sql(EVENTS.with_(train_begin=_EARLIER), "1 HOUR", "date_trunc('hour', {})")),
    ("all_hours", "SELECT g.ts AS Time, l.* FROM grid g FULL OUTER JOIN lagged l ON g.ts = l.SessionStartHourTime")],
    O.final([("Time", False)] + doubles(_LAG_OUT), "(SELECT Time, key, ServerIP, SessionStartHourTime, peakLoad, "
            + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in LAG_COLUMNS)
            + " FROM all_hours WHERE ServerIP IS NOT NULL AND SessionStartHourTime IS NOT NULL)")))
def q_null_fill(spark, d):
    """Observed lags on a grid of hours, NULL lags -> 0; the grid's hours without a server go."""
    lagged = lag_features(hourly_with_day(spark, d), "observed").select(*_LAG_OUT)
    grid = time_grid(bounds_row(spark, _EARLIER, EVENTS.train_end), "b", "e", HOUR)
    rows = grid_outer_join(grid, lagged, ts="SessionStartHourTime")
    return rounded(fill_numeric(drop_null_keys(rows, ["ServerIP", "SessionStartHourTime"]), LAG_COLUMNS, 0)
                   .select("Time", *_LAG_OUT))


_J2_COLS = ["key", "ServerIP", "SessionStartHourTime", "SessionStartDay", "peakLoad"] + ROLLING_COLUMNS


@register("hourly_with_daily_lags", O.with_(O.base_ctes() + [
    ("daily", O.daily_sql()), ("rolling", O.rolling_sql("daily", "observed"))],
    O.final(doubles(_J2_COLS), f"""(
  SELECT h.key, h.ServerIP, h.SessionStartHourTime, date_trunc('day', h.SessionStartHourTime) AS SessionStartDay,
         h.peakLoad, {', '.join('r.' + c for c in ROLLING_COLUMNS)}
  FROM hourly h LEFT JOIN rolling r
    ON r.ServerIP = h.ServerIP AND r.SessionStartDay = date_trunc('day', h.SessionStartHourTime))""")))
def q_hourly_with_daily_lags(spark, d):
    h = staged_hourly(spark, d)
    rolling = rolling_daily_mean(daily_mean(h), "observed")
    return rounded(join_daily_lags(h, rolling).select(*_J2_COLS))


# ---- F1-F10, J7: calendar ------------------------------------------------------------------

_CAL = ["year", "month", "weekofyear", "dayofmonth", "hourofday", "dayofweek", "linearTrend", "date",
        "Holiday", "BusinessHour", "Morning"]


@register("calendar_features", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT key, {O.calendar_select('SessionStartHourTime', cfg.train_begin)}
FROM hourly"""))
def q_calendar_features(spark, d):
    return rounded(add_calendar(hourly(spark, d), "SessionStartHourTime", EVENTS.train_begin)
                   .select("key", *_CAL))


@register("linear_trend", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT key, {O.r6(f"coalesce((epoch(SessionStartHourTime) - epoch(TIMESTAMP '{cfg.train_begin}')) / {O.SECONDS_PER_YEAR}, 0.0)")} AS linearTrend
FROM hourly"""))
def q_linear_trend(spark, d):
    cols = calendar_columns("SessionStartHourTime", EVENTS.train_begin)
    return rounded(hourly(spark, d).select("key", cols["linearTrend"].alias("linearTrend")))


@register("holiday_dim", f"""
SELECT CAST(dt AS DATE) AS date FROM (
  SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS dt FROM lineitem)
WHERE {O.holiday_sql('CAST(dt AS DATE)')}""")
def q_holiday_dim(spark, d):
    """Observed US federal holidays over the date range of the long history (lineitem)."""
    li = table(spark, d, "lineitem").agg(F.min("l_shipdate").alias("b"), F.max("l_shipdate").alias("e"))
    days = li.select(F.explode(F.sequence(F.to_date("b"), F.to_date("e"))).alias("date"))
    return days.where(is_federal_holiday(F.col("date")))


@register("holiday_flag", O.with_([("sessions", O.LINEITEM_SESSIONS), ("rollup", O.rollup_sql()),
                                   ("hourly", O.hourly_sql())], f"""
SELECT key, ServerIP, SessionStartHourTime,
       CAST({O.holiday_sql('CAST(SessionStartHourTime AS DATE)')} AS INTEGER) AS Holiday
FROM hourly"""))
def q_holiday_flag(spark, d):
    """Holiday flag on the hourly peaks of the long history (lineitem as session log)."""
    h = hourly_peak(five_min_rollup(sessions_from_lineitem(table(spark, d, "lineitem"))))
    return h.select("key", "ServerIP", "SessionStartHourTime",
                    is_federal_holiday(F.to_date("SessionStartHourTime")).cast("int").alias("Holiday"))


# ---- P5, P12, G4, G5: labels and splits -----------------------------------------------------

@register("load_label", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT key, {O.r6('peakLoad')} AS peakLoad, {O.label_sql('peakLoad', cfg)} AS label FROM hourly"""))
def q_load_label(spark, d):
    return rounded(add_label(hourly(spark, d), EVENTS).select("key", "peakLoad", "label"))


def _split_sql(cfg: RunConfig, t: str) -> str:
    return f"CASE WHEN {t} < TIMESTAMP '{cfg.test_split_start}' THEN 'train' ELSE 'test' END"


@register("train_test_split", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT key, SessionStartHourTime, {_split_sql(cfg, 'SessionStartHourTime')} AS split FROM hourly"""))
def q_train_test_split(spark, d):
    return hourly(spark, d).select("key", "SessionStartHourTime", split_column(EVENTS).alias("split"))


def _cuts_ctes() -> list[tuple[str, str]]:
    return O.base_ctes() + [O.cuts_cte(EVENTS_CUTS)]


@register("label_cuts", O.with_(_cuts_ctes(), f"SELECT {O.rnd('low', 'low')}, {O.rnd('high', 'high')} FROM cuts"))
def q_label_cuts(spark, d):
    """Label cuts from the data: exact percentiles of the train split's peak load."""
    cfg = TR.with_cuts(staged_hourly(spark, d), EVENTS_CUTS)
    return rounded(spark.createDataFrame([(cfg.low, cfg.high)], "low double, high double"))


@register("label_distribution", O.with_(_cuts_ctes(), f"""
SELECT {_split_sql(EVENTS_CUTS, 'SessionStartHourTime')} AS split, {O.label_sql('peakLoad', EVENTS_CUTS)} AS label,
       count(*) AS n
FROM hourly GROUP BY ALL"""))
def q_label_distribution(spark, d):
    """Rows of each class and split, with cuts from the train split."""
    h = staged_hourly(spark, d)
    return (TR.labelled(h, TR.with_cuts(h, EVENTS_CUTS))
            .groupBy("split", "label").agg(F.count(F.lit(1)).alias("n")))


@register("row_counts", lambda cfg: O.with_(O.base_ctes() + [("daily", O.daily_sql())], f"""
SELECT 'sessions' AS metric, count(*) AS n FROM raw_sessions
UNION ALL SELECT 'clean_sessions', count(*) FROM sessions
UNION ALL SELECT 'five_min_rows', count(*) FROM rollup
UNION ALL SELECT 'hourly_rows', count(*) FROM hourly
UNION ALL SELECT 'server_days', count(*) FROM daily
UNION ALL SELECT 'servers', count(DISTINCT ServerIP) FROM hourly
UNION ALL SELECT 'train_rows', count(*) FROM hourly WHERE SessionStartHourTime < TIMESTAMP '{cfg.test_split_start}'
UNION ALL SELECT 'test_rows', count(*) FROM hourly WHERE SessionStartHourTime >= TIMESTAMP '{cfg.test_split_start}'"""))
def q_row_counts(spark, d):
    """Size of each stage, one (metric, n) row per count."""
    return FT.row_counts(sessions_from_events(table(spark, d, "events")), EVENTS)


@register("unparsed_times", """
SELECT 'unparsed_SessionStart' AS metric, count(*) AS n FROM events WHERE event_id % 13 = 0 AND event_id % 97 <> 0
UNION ALL SELECT 'unparsed_SessionEnd', 0""")
def q_unparsed_times(spark, d):
    """CSV rows whose times are in several forms, one of them none: the lost ones are counted."""
    path = scratch_path(spark, "sessions-times")
    ts, number = F.col("ts"), F.col("event_id")
    forms = (F.when(number % 13 == 0, F.concat(F.lit("day "), F.date_format(ts, "D")))
             .when(number % 3 == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
             .when(number % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm"))
             .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    log = sessions_from_events(table(spark, d, "events"), SessionStart=forms)
    log.write.option("timestampNTZFormat", WRITE_TIMESTAMP_FORMAT).csv(path)
    return unparsed_times(read_sessions_text(spark, path))


def _planted_log(spark, d) -> str:
    """The session log as CSV, with lines cut short, numbers and times that are none."""
    path = scratch_path(spark, "sessions-planted")
    log = sessions_from_events(table(spark, d, "events"), SessionStart=F.col("ts"))
    number = F.regexp_extract("ClientIP", r"([0-9]+)$", 1).cast("int") * 24 + F.hour("SessionStart")
    own = {"TotalLoad": F.when(number % 11 == 1, F.lit("n/a")), "SessionEnd": F.when(number % 11 == 2, F.lit("25:00")),
           "MbytesTransferred": F.when(number % 11 == 3, F.lit("")).when(number % 11 == 4, F.lit("NaN"))}
    fields = [F.coalesce(own.get(c, F.lit(None)), F.col(c).cast("string"), F.lit("")) for c in SESSION_COLUMNS]
    fields = F.array(*fields)
    lines = F.when(number % 11 == 0, F.slice(fields, 1, 4)).otherwise(fields)
    log.select(F.array_join(lines, ",").alias("value")).write.text(path)
    return path


# How the planted lines of an event are numbered, in SQL; header lines hold no reject.
_PLANTED = [("raw_sessions", O.RAW_SESSIONS), ("planted", """
SELECT *, (CAST(regexp_extract(ClientIP, '([0-9]+)$', 1) AS INTEGER) * 24 + hour(SessionStart)) % 11 AS kind FROM raw_sessions""")]


@register("malformed_lines", O.with_(_PLANTED, """
SELECT TrafficType, SessionStart, CASE kind WHEN 0 THEN 'number of fields' WHEN 1 THEN 'TotalLoad: not a number'
       WHEN 2 THEN 'SessionEnd: not a time' ELSE 'MbytesTransferred: not a number' END AS reason
FROM planted WHERE kind = 0 OR (kind IN (1, 2, 4) AND ServerIP IS DISTINCT FROM 'IPs')"""))
def q_malformed_lines(spark, d):
    """Rejected lines with their reason: cut short, numbers and times that are none."""
    _, rejects = read_sessions_checked(spark, _planted_log(spark, d))
    field = lambda i: F.split_part("line", F.lit(","), F.lit(i))
    return rejects.select(field(1).alias("TrafficType"), field(2).cast("timestamp_ntz").alias("SessionStart"), "reason")


@register("malformed_rollup", O.with_(_PLANTED + [("sessions", """
SELECT * REPLACE (CASE WHEN kind <> 3 THEN MbytesTransferred END AS MbytesTransferred) FROM planted
WHERE kind NOT IN (0, 1, 2, 4) AND ServerIP IS NOT NULL AND ServerIP <> 'IPs'"""), ("rollup", O.rollup_sql())],
    O.final(doubles(_ROLLUP_COLS), "rollup")))
def q_malformed_rollup(spark, d):
    """Five-minute sums of the lines that are none of the rejects; empty fields count as missing."""
    log, _ = read_sessions_checked(spark, _planted_log(spark, d))
    return rounded(five_min_rollup(clean_sessions(log)))


# ---- M1-M7, S4, S7: the feature table -------------------------------------------------------

_FT_COLS = (FT.HOUR_KEYS + PEAK_COLUMNS + ["year", "month", "weekofyear", "dayofmonth", "hourofday",
                                          "dayofweek", "SessionStartDay", "linearTrend", "date", "Holiday",
                                          "BusinessHour", "Morning"] + INDEXED_COLUMNS + SCALED_COLUMNS)
_INT_KEYS = {"year", "month", "weekofyear", "dayofmonth", "hourofday", "Holiday", "BusinessHour", "Morning"}


def _ft_final(cols: list[str]) -> str:
    return O.final([(c, c in set(PEAK_COLUMNS + INDEXED_COLUMNS + SCALED_COLUMNS + ["linearTrend"]))
                    for c in cols], "scaled")


def _ft_sql(cfg: RunConfig, cols: list[str], source: str = "events") -> str:
    return O.with_(O.features_ctes(cfg, source) + O.index_ctes("features") +
                   [("scaled", f"SELECT *, {O.scaled_select()} FROM indexed")], _ft_final(cols))


def _features(spark, d, hourly_=None):
    """(config, features, encoders), from the sessions or from hourly peaks at hand."""
    cfg = EVENTS
    raw = None if hourly_ is not None else sessions(spark, d)
    feats = FT.stage_hourly_features(spark, raw, cfg, scratch_path(spark, "hourly-features"), hourly_)
    return cfg, feats, fit_features(FT.fit_rows(feats, cfg), cfg.handle_invalid)


@register("feature_table", lambda cfg: _ft_sql(cfg, _FT_COLS))
def q_feature_table(spark, d):
    """The training feature table, written as parquet and read back (vector columns left out)."""
    cfg = EVENTS
    _, table_ = FT.build_feature_table(spark, sessions(spark, d), cfg, scratch_path(spark, "feature-table"))
    return rounded(table_.select(*_FT_COLS))


# Encoders fitted on the train split only; levels first met in the test split are kept as one
# extra index.
TRAIN_FIT = EVENTS.with_(fit_on="train", handle_invalid="keep")


def _train_fit_sql(cfg: RunConfig) -> str:
    ctes = O.features_ctes(cfg) + [("train_rows", f"SELECT * FROM features WHERE SessionStartHourTime < "
                                                  f"TIMESTAMP '{cfg.test_split_start}'")]
    ctes += O.index_ctes("features", levels_from="train_rows", unseen=True)
    devs = ", ".join(f"coalesce(stddev_samp({c}), 0) AS sd_{i}" for i, c in enumerate(O.SCALED_INPUTS))
    ctes.append(("devs", f"SELECT {devs} FROM train_rows"))
    scaled = ", ".join(f"CASE WHEN sd_{i} = 0 THEN 0.0 ELSE {c} / sd_{i} END AS {s}"
                       for i, (c, s) in enumerate(zip(O.SCALED_INPUTS, SCALED_COLUMNS)))
    ctes.append(("scaled", f"SELECT i.*, {scaled} FROM indexed i, devs"))
    return O.with_(ctes, _ft_final(_FT_COLS))


@register("feature_table_train_fit", _train_fit_sql(TRAIN_FIT))
def q_feature_table_train_fit(spark, d):
    """The feature table with indexer and scaler fitted on the train split only."""
    _, table_ = FT.build_feature_table(spark, sessions(spark, d), TRAIN_FIT, scratch_path(spark, "feature-table"))
    return rounded(table_.select(*_FT_COLS))


def lineitem_sessions(spark, d) -> DataFrame:
    return clean_sessions(sessions_from_lineitem(table(spark, d, "lineitem")))


_LONG_COLS = (FT.HOUR_KEYS + PEAK_COLUMNS + ["year", "month", "weekofyear", "dayofmonth", "hourofday",
                                            "dayofweek", "SessionStartDay", "linearTrend", "date", "Holiday",
                                            "BusinessHour", "Morning"] + ROLLING_COLUMNS + LAG_COLUMNS)


@register("long_history_features", O.with_(O.features_ctes(LINEITEM, "lineitem"),
                                           O.final([(c, c in set(PEAK_COLUMNS + ROLLING_COLUMNS + LAG_COLUMNS
                                                                 + ["linearTrend"])) for c in _LONG_COLS],
                                                   "features")))
def q_long_history_features(spark, d):
    """Seven years of daily history (lineitem): hourly features with lags and rolling means
    over observed rows, as the original training ETL built them (lag 730 is populated)."""
    return rounded(FT.hourly_features(lineitem_sessions(spark, d), LINEITEM).select(*_LONG_COLS))


@register("long_history_feature_table", _ft_sql(LINEITEM, _FT_COLS, "lineitem"))
def q_long_history_feature_table(spark, d):
    """Feature table of the long history: multi-level year, month and week indexes."""
    _, table_ = FT.build_feature_table(spark, lineitem_sessions(spark, d), LINEITEM,
                                       scratch_path(spark, "feature-table-long"))
    return rounded(table_.select(*_FT_COLS))


@register("string_index", lambda cfg: _ft_sql(cfg, ["key"] + INDEXED_COLUMNS))
def q_string_index(spark, d):
    _, feats, fm = _features(spark, d)
    return fm.index(feats).select("key", *INDEXED_COLUMNS)


@register("string_index_wide", lambda cfg: _ft_sql(cfg, ["key"] + INDEXED_COLUMNS))
def q_string_index_wide(spark, d):
    """The same indexes where columns of more than four levels are joined from their tables."""
    feats = FT.stage_hourly_features(spark, sessions(spark, d), EVENTS, scratch_path(spark, "hourly-features"))
    return index_rows(prepare_for_index(feats), fit_indexers(prepare_for_index(feats), narrow=4)).select("key", *INDEXED_COLUMNS)


@register("scale_lags", lambda cfg: _ft_sql(cfg, ["key"] + SCALED_COLUMNS))
def q_scale_lags(spark, d):
    _, feats, fm = _features(spark, d)
    return rounded(scaled_columns(fm.transform(feats)).select("key", *SCALED_COLUMNS))


def _one_hot_sql(cfg: RunConfig) -> str:
    parts = [f"SELECT key, '{c}_indexed' AS feature, CAST({c}_indexed AS INTEGER) AS position, 1.0 AS value "
             f"FROM indexed WHERE (SELECT max(levels) FROM lv_{c}) >= 2 "
             f"AND {c}_indexed < (SELECT max(levels) FROM lv_{c}) - 1" for c in INDEX_COLUMNS]
    return O.with_(O.features_ctes(cfg) + O.index_ctes("features"), "\nUNION ALL\n".join(parts))


@register("one_hot", _one_hot_sql)
def q_one_hot(spark, d):
    """One-hot vectors in long form: (key, feature, position, 1.0) for each set slot."""
    _, feats, fm = _features(spark, d)
    return one_hot_long(fm.index(feats), fm)


def _feature_vector_sql(cfg: RunConfig) -> str:
    """Slots in order: trend, the index-only columns (fewer than two levels), the one-hot slots
    of the others (levels - 1 each), the scaled lags; non-zero slots only."""
    levels = {c: f"(SELECT max(levels) FROM lv_{c})" for c in INDEX_COLUMNS}
    only = {c: f"CASE WHEN {n} < 2 THEN 1 ELSE 0 END" for c, n in levels.items()}
    slots = {c: f"CASE WHEN {n} >= 2 THEN {n} - 1 ELSE 0 END" for c, n in levels.items()}
    plus = lambda terms: " + ".join(["1", *terms])
    parts = ["SELECT key, 0 AS position, linearTrend AS value FROM scaled"]
    for i, c in enumerate(INDEX_COLUMNS):
        before = INDEX_COLUMNS[:i]
        parts.append(f"SELECT key, {plus(only[x] for x in before)}, {c}_indexed FROM scaled WHERE {levels[c]} < 2")
        parts.append(f"SELECT key, {plus([*only.values(), *(slots[x] for x in before)])} + {c}_indexed, 1.0 "
                     f"FROM scaled WHERE {levels[c]} >= 2 AND {c}_indexed < {levels[c]} - 1")
    for i, c in enumerate(SCALED_COLUMNS):
        parts.append(f"SELECT key, {plus([*only.values(), *slots.values()])} + {i}, {c} FROM scaled")
    return O.with_(O.features_ctes(cfg) + O.index_ctes("features") +
                   [("scaled", f"SELECT *, {O.scaled_select()} FROM indexed"), ("slots", "\nUNION ALL\n".join(parts))],
                   f"SELECT key, CAST(position AS INTEGER) AS position, {O.rnd('value', 'value')} FROM slots WHERE value <> 0")


@register("feature_vector", _feature_vector_sql)
def q_feature_vector(spark, d):
    """Assembled model input per server-hour: every non-zero slot with its position and value."""
    _, feats, fm = _features(spark, d)
    return rounded(vector_entries(fm.transform(feats)))


# ---- M8-M10, S9-S11: model ------------------------------------------------------------------

def _trained(spark, d, hourly_=None):
    raw = None if hourly_ is not None else sessions(spark, d)
    fm, table_ = FT.build_feature_table(spark, raw, EVENTS_CUTS, scratch_path(spark, "feature-table"), hourly_)
    cfg = TR.with_cuts(table_, EVENTS_CUTS)
    model, rf = TR.train(table_, fm, cfg)
    return cfg, fm, table_, model, rf


# A forest must be right on its own train split more often, by this share, than the most
# frequent class is, and predict each class that has so many rows there.
FIT_MARGIN, CLASS_ROWS = 0.1, 20


def fit_checks(pred: DataFrame) -> tuple[bool, bool]:
    """(beats the majority class, predicts every class) on the train split of predictions."""
    cells = (pred.where("split = 'train'").groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
             .collect())  # at most a row for each pair of classes
    rows = {}
    for c in cells:
        rows[c.label] = rows.get(c.label, 0) + c.n
    right = sum(c.n for c in cells if c.label == c.prediction)
    total = sum(rows.values())
    wanted = {label for label, n in rows.items() if n >= CLASS_ROWS}
    return (right / total >= max(rows.values()) / total + FIT_MARGIN), wanted <= {c.prediction for c in cells}


@register("rf_train", O.with_(_cuts_ctes(), f"""
SELECT key, ServerIP, SessionStartHourTime, {_split_sql(EVENTS_CUTS, 'SessionStartHourTime')} AS split,
       {O.label_sql('peakLoad', EVENTS_CUTS)} AS label, TRUE AS beats_majority, TRUE AS predicts_every_class
FROM hourly"""))
def q_rf_train(spark, d):
    """Fit the forest on the train split; every row of both splits with its class, and whether the
    forest learned: right more often than the most frequent class, and predicting every class."""
    cfg, fm, table_, model, rf = _trained(spark, d)
    path = scratch_path(spark, "predictions")
    TR.predictions(table_, rf, fm, cfg).write.parquet(path)
    pred = spark.read.parquet(path)
    beats, every = fit_checks(pred)
    return pred.select("key", "ServerIP", "SessionStartHourTime", "split", "label",
                       F.lit(beats).alias("beats_majority"), F.lit(every).alias("predicts_every_class"))


_METRIC_SQL = {
    "accuracy": "sum(tp) / max(total)",
    "weightedPrecision": "sum(label_n / total * prec)",
    "weightedRecall": "sum(label_n / total * rec)",
    "f1": "sum(label_n / total * CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END)",
}


@register("rf_metrics", O.with_(_cuts_ctes(), f"""
SELECT split, count(*) AS n_rows, count(DISTINCT label) AS n_classes, TRUE AS accuracy, TRUE AS "weightedPrecision",
       TRUE AS "weightedRecall", TRUE AS f1
FROM (SELECT {_split_sql(EVENTS_CUTS, 'SessionStartHourTime')} AS split,
             {O.label_sql('peakLoad', EVENTS_CUTS)} AS label FROM hourly)
GROUP BY split"""))
def q_rf_metrics(spark, d):
    """The forest's metrics on each split: rows, classes, and whether each metric equals that
    of Spark's own evaluator to nine decimals."""
    cfg, fm, table_, model, rf = _trained(spark, d)
    path = scratch_path(spark, "predictions")
    TR.predictions(table_, rf, fm, cfg).withColumn("label", F.col("label").cast("double")).write.parquet(path)
    pred = spark.read.parquet(path)
    theirs = spark.createDataFrame(
        [(split, *[MulticlassClassificationEvaluator(metricName=m).evaluate(pred.where(F.col("split") == split))
                   for m in _METRIC_SQL]) for split in ("train", "test")],
        "split string, " + ", ".join(f"spark_{m} double" for m in _METRIC_SQL))
    sizes = pred.groupBy("split").agg(F.count("*").alias("n_rows"), F.count_distinct("label").alias("n_classes"))
    return (TR.evaluate(pred).join(theirs, "split").join(sizes, "split")
            .select("split", "n_rows", "n_classes",
                    *[(F.abs(F.col(m) - F.col(f"spark_{m}")) < 1e-9).alias(m) for m in _METRIC_SQL]))


@register("classifier_metrics", lambda cfg: O.with_(O.features_ctes(cfg) + [("pred", f"""
SELECT {_split_sql(cfg, 'SessionStartHourTime')} AS split, CAST({O.label_sql('peakLoad', cfg)} AS DOUBLE) AS y,
       CAST({O.label_sql('peakLoadLag48', cfg)} AS DOUBLE) AS p
FROM features"""), ("cells", "SELECT split, y, p, count(*) AS n FROM pred GROUP BY 1, 2, 3"),
    ("lab", "SELECT split, y, sum(n) AS label_n FROM cells GROUP BY 1, 2"),
    ("prd", "SELECT split, p, sum(n) AS pred_n FROM cells GROUP BY 1, 2"),
    ("tot", "SELECT split, sum(n) AS total FROM cells GROUP BY 1"),
    ("per", """
SELECT l.split, l.y, l.label_n, t.total,
       coalesce(c.n / pr.pred_n, 0.0) AS prec, coalesce(c.n / l.label_n, 0.0) AS rec, coalesce(c.n, 0) AS tp
FROM lab l JOIN tot t ON t.split = l.split
LEFT JOIN cells c ON c.split = l.split AND c.y = l.y AND c.p = l.y
LEFT JOIN prd pr ON pr.split = l.split AND pr.p = l.y""")], """
SELECT split, """ + ", ".join(O.rnd(e, n) for n, e in _METRIC_SQL.items()) + """
FROM per GROUP BY split"""))
def q_classifier_metrics(spark, d):
    """Metrics per split from the confusion matrix. The prediction here is a fixed rule
    (the load class of the 48-hour lag), so SQL can check the metric arithmetic; the
    forest's own metrics use the same function (see tests)."""
    cfg = EVENTS
    feats = FT.hourly_features(sessions(spark, d), cfg)
    pred = feats.select(split_column(cfg).alias("split"),
                        load_label(F.col("peakLoad"), cfg.low, cfg.high).alias("label"),
                        load_label(F.col("peakLoadLag48"), cfg.low, cfg.high).alias("prediction"))
    return rounded(classification_metrics(pred, ["split"]))


def _agreement(a: DataFrame, b: DataFrame) -> DataFrame:
    """Server-hours that either side predicts, and whether both predict the same."""
    keys = ["ServerIP", "SessionStartHourTime"]
    other = b.select(*keys, F.col("prediction").alias("other"))
    return a.join(other, keys, "full").select(*keys, F.coalesce(F.col("prediction") == F.col("other"), F.lit(False))
                                              .alias("agree"))


@register("model_roundtrip", O.with_(O.base_ctes(), "SELECT ServerIP, SessionStartHourTime, TRUE AS agree FROM hourly"))
def q_model_roundtrip(spark, d):
    """Save the scoring pipeline and run info, load both, and score all rows with the model at
    hand and the loaded one."""
    h = staged_hourly(spark, d)
    cfg, fm, table_, model, rf = _trained(spark, d, h)
    path = scratch_path(spark, "model")
    TR.save_model(spark, model, fm, cfg, path)
    loaded, info = TR.load_model(spark, path)
    if TR.config_from_info(info) != cfg:
        raise ValueError(f"stored run info differs: {info}")
    feats = FT.features_of_hours(h, cfg)
    return _agreement(SC.score_batch(model, feats), SC.score_batch(loaded, feats))


# ---- S5, S6, S8, U1, P2, P4, T4, M10, M11, S13: statistics and scoring ------------------------

_HSTATS_COLS = _HOURLY_COLS + ["year", "month", "dayofmonth", "hourofday"]


def _stats_paths(spark, d, hourly_=None):
    hp, dp = scratch_path(spark, "hourly-stats"), scratch_path(spark, "daily-stats")
    SC.write_statistics(with_day(hourly(spark, d)) if hourly_ is None else hourly_, hp, dp)
    return hp, dp


def _hstats_sql_select() -> str:
    return ", ".join([O.rnd(c, c) if c in PEAK_COLUMNS else c for c in _HOURLY_COLS]) + \
        ", CAST(year(SessionStartHourTime) AS INTEGER) AS year, CAST(month(SessionStartHourTime) AS INTEGER) AS month, " \
        "CAST(dayofmonth(SessionStartHourTime) AS INTEGER) AS dayofmonth, CAST(hour(SessionStartHourTime) AS INTEGER) AS hourofday"


@register("hourly_stats", O.with_(O.base_ctes(), f"SELECT {_hstats_sql_select()} FROM hourly"))
def q_hourly_stats(spark, d):
    """Hourly statistics written partitioned by (year, month) and read back."""
    hp, _ = _stats_paths(spark, d)
    return rounded(spark.read.parquet(hp).select(*_HSTATS_COLS))


@register("daily_stats", O.with_(O.base_ctes() + [("daily", O.daily_sql())],
                                 "SELECT " + ", ".join(O.rnd(c, c) if c in DAILY_COLUMNS else c
                                                       for c in _DAILY_COLS)
                                 + ", CAST(year(SessionStartDay) AS INTEGER) AS year, "
                                   "CAST(month(SessionStartDay) AS INTEGER) AS month FROM daily"))
def q_daily_stats(spark, d):
    _, dp = _stats_paths(spark, d)
    return rounded(spark.read.parquet(dp).select(*_DAILY_COLS, "year", "month"))


def _horizon(cfg: RunConfig) -> dict[str, str]:
    """Bounds of the scoring horizon as SQL, written out."""
    begin = f"TIMESTAMP '{cfg.score_begin}'"
    return {"score_begin": begin, "score_end": f"({begin} + INTERVAL 172799 SECOND)",
            "feature_begin": f"({begin} - INTERVAL 2629799 SECOND)", "feature_end": f"({begin} - INTERVAL 1 SECOND)"}


@register("stats_for_score", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT {_hstats_sql_select()} FROM hourly
WHERE SessionStartHourTime BETWEEN date_trunc('hour', {_horizon(cfg)['feature_begin']})
                               AND {_horizon(cfg)['feature_end']}"""))
def q_stats_for_score(spark, d):
    """Hourly statistics of the scoring feature window, read from its months only."""
    cfg = EVENTS
    hp, dp = _stats_paths(spark, d)
    hs, _ = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    return rounded(hs.select(*_HSTATS_COLS))


@register("stats_for_servers", lambda cfg: O.with_(O.base_ctes(), f"""
SELECT {_hstats_sql_select()} FROM hourly
WHERE ServerIP IN ('10.0.0.1', '10.0.0.6')
  AND SessionStartHourTime BETWEEN date_trunc('hour', {_horizon(cfg)['feature_begin']}) AND {_horizon(cfg)['feature_end']}"""))
def q_stats_for_servers(spark, d):
    """Statistics of chosen servers only (P2)."""
    hp, dp = _stats_paths(spark, d)
    hs, _ = SC.stats_for_score(spark, hp, dp, EVENTS.score_begin, DEBUG_SERVERS)
    return rounded(hs.select(*_HSTATS_COLS))


# A window over the end of January and all of February, out of 84 stored months.
TWO_MONTHS = LINEITEM.with_(score_begin="1998-03-01 00:00:00")


@register("stats_two_months", O.with_(O.base_ctes("lineitem"), f"""
SELECT {_hstats_sql_select()} FROM hourly
WHERE SessionStartHourTime BETWEEN date_trunc('hour', {_horizon(TWO_MONTHS)['feature_begin']})
                               AND {_horizon(TWO_MONTHS)['feature_end']}"""))
def q_stats_two_months(spark, d):
    """A window that crosses a month boundary, read from a store of many months (S8, U1)."""
    hp, dp = scratch_path(spark, "hourly-stats"), scratch_path(spark, "daily-stats")
    SC.write_statistics(with_day(hourly_peak(five_min_rollup(lineitem_sessions(spark, d)))), hp, dp)
    hs, _ = SC.stats_for_score(spark, hp, dp, TWO_MONTHS.score_begin)
    return rounded(hs.select(*_HSTATS_COLS))


@register("stats_merge", O.with_(O.base_ctes(), f"SELECT {_hstats_sql_select()} FROM hourly"))
def q_stats_merge(spark, d):
    """The statistics written in three batches that each cover a part of the month, one of
    them twice: no hour is lost and none is doubled."""
    h = staged_hourly(spark, d)
    hp, dp = scratch_path(spark, "hourly-stats"), scratch_path(spark, "daily-stats")
    day = F.dayofmonth("SessionStartHourTime")
    for part in (day <= 10, day > 20, (day > 10) & (day <= 20), day <= 10):
        SC.write_statistics(h.where(part), hp, dp)
    return rounded(spark.read.parquet(hp).select(*_HSTATS_COLS))


def _late_store(spark, d) -> str:
    """A store of four batches that split every hour, one of them sent twice, one after the
    others were compacted."""
    store = scratch_path(spark, "stats-store")
    log = sessions(spark, d)
    # the service grade is the event number modulo 3, HTTP1 modulo 2
    odd = (F.col("ServiceGrade") == "0") & (F.col("HTTP1") == "1")
    parts = {"a": F.col("ServiceGrade") == "1", "b": F.col("ServiceGrade") == "2",
             "c": (F.col("ServiceGrade") == "0") & ~odd, "d": odd}
    for name in "aba":
        ST.add_batch(log.where(parts[name]), store, name)
    ST.compact(spark, store)
    for name in "cbd":
        ST.add_batch(log.where(parts[name]), store, name)
    return store


@register("stats_late_sessions", O.with_(O.base_ctes(), f"SELECT {_hstats_sql_select()} FROM hourly"))
def q_stats_late_sessions(spark, d):
    """Hourly statistics after batches that split every hour, one sent twice: those of one batch."""
    return rounded(spark.read.parquet(f"{_late_store(spark, d)}/hourly").select(*_HSTATS_COLS))


@register("stats_late_daily", O.with_(O.base_ctes() + [("daily", O.daily_sql())],
                                      "SELECT " + ", ".join(O.rnd(c, c) if c in DAILY_COLUMNS else c for c in _DAILY_COLS)
                                      + " FROM daily"))
def q_stats_late_daily(spark, d):
    """The daily means after the same batches."""
    return rounded(spark.read.parquet(f"{_late_store(spark, d)}/daily").select(*_DAILY_COLS))


@register("score_horizon", """
SELECT score_begin,
       score_begin + INTERVAL 172799 SECOND AS score_end,
       score_begin - INTERVAL 2629799 SECOND AS feature_begin,
       score_begin - INTERVAL 1 SECOND AS feature_end
FROM (SELECT DISTINCT date_trunc('day', ts) AS score_begin FROM events)""")
def q_score_horizon(spark, d):
    """Horizon bounds for scoring from the start of each day of the data (a backtest grid)."""
    days = table(spark, d, "events").select(floor_ts("ts", DAY).alias("score_begin")).distinct()
    return days.select(*[c.alias(n) for n, c in horizon_columns(F.col("score_begin")).items()])


_SCORE_DOUBLES = set(LAG_COLUMNS + ROLLING_COLUMNS + ["linearTrend"])


def _score_sql(cfg: RunConfig) -> str:
    return O.with_(_score_ctes(cfg), O.final([(c, c in _SCORE_DOUBLES) for c in SC.SCORE_FEATURE_COLUMNS],
                                              "scored"))


def _score_ctes(cfg: RunConfig, servers: str = "SELECT DISTINCT ServerIP FROM hs") -> list[tuple[str, str]]:
    h = _horizon(cfg)
    fb, fe, sb, se = h["feature_begin"], h["feature_end"], h["score_begin"], h["score_end"]
    ctes = O.base_ctes() + [
        ("hs", f"""SELECT * FROM hourly WHERE SessionStartHourTime BETWEEN date_trunc('hour', {fb})
                   AND {fe}"""),
        ("ds0", O.daily_sql("hourly")),
        ("ds", f"""SELECT * FROM ds0 WHERE SessionStartDay BETWEEN date_trunc('day', {fb})
                   AND {fe}"""),
        ("servers", servers),
        ("hgrid", f"""SELECT s.ServerIP, g.t AS SessionStartHourTime, h.peakLoad
FROM servers s CROSS JOIN (SELECT unnest(generate_series(date_trunc('hour', {fb}),
     date_trunc('hour', {se}) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS t) g
LEFT JOIN hs h ON h.ServerIP = s.ServerIP AND h.SessionStartHourTime = g.t"""),
        ("hlag", O.lags_sql("hgrid", "calendar")),
        ("dgrid", f"""SELECT s.ServerIP, g.t AS SessionStartDay, {', '.join('d.' + c for c in DAILY_COLUMNS)}
FROM servers s CROSS JOIN (SELECT unnest(generate_series(date_trunc('day', {fb}),
     date_trunc('day', {se}) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS t) g
LEFT JOIN ds d ON d.ServerIP = s.ServerIP AND d.SessionStartDay = g.t"""),
        ("droll", O.rolling_sql("dgrid", "calendar")),
        ("scored", f"""
SELECT h.ServerIP || '_' || CAST(h.SessionStartHourTime AS VARCHAR) AS key, h.ServerIP, h.SessionStartHourTime,
       {', '.join(f'coalesce(h.{c}, 0.0) AS {c}' for c in LAG_COLUMNS)},
       {', '.join(f'coalesce(r.{c}, 0.0) AS {c}' for c in ROLLING_COLUMNS)},
       {O.calendar_select('h.SessionStartHourTime', cfg.train_begin)}
FROM hlag h LEFT JOIN droll r
  ON r.ServerIP = h.ServerIP AND r.SessionStartDay = date_trunc('day', h.SessionStartHourTime)
WHERE h.SessionStartHourTime BETWEEN {sb} AND {se}"""),
    ]
    return ctes


def _score_features(spark, d, hourly_=None):
    hp, dp = _stats_paths(spark, d, hourly_)
    return EVENTS, SC.features_for_scoring(spark, EVENTS, hp, dp)


@register("score_features", _score_sql)
def q_score_features(spark, d):
    """48-hour feature rows for every server, from the stored statistics."""
    return rounded(_score_features(spark, d)[1])


REQUESTED = ["10.0.0.1", "10.0.0.6", "10.9.9.9"]  # the last has no statistics


@register("score_requested_servers", lambda cfg: O.with_(
    _score_ctes(cfg, "SELECT unnest(['10.0.0.1', '10.0.0.6', '10.9.9.9']) AS ServerIP"),
    O.final([(c, c in _SCORE_DOUBLES) for c in SC.SCORE_FEATURE_COLUMNS], "scored")))
def q_score_requested_servers(spark, d):
    """Feature rows of a list of servers, one of them without any history."""
    hp, dp = _stats_paths(spark, d)
    return rounded(SC.features_for_scoring(spark, EVENTS, hp, dp, REQUESTED))


def _backtest_sql(cfg: RunConfig) -> str:
    """Each origin sees only hours before itself: inner joins on hour < score_begin."""
    lags = ", ".join(f"coalesce(max(h.peakLoad) FILTER (h.SessionStartHourTime = p.t - INTERVAL {i} HOUR), 0.0) AS {c}"
                     for i, c in zip(O.HOURLY_LAGS, LAG_COLUMNS))
    means = ", ".join(f"avg({c}) AS {c}" for c in PEAK_COLUMNS)
    rolls = ", ".join(f"coalesce(avg(d.{p}), 0.0) AS {r}" for p, r in zip(PEAK_COLUMNS, ROLLING_COLUMNS))
    window = "INTERVAL 2629799 SECOND"
    return O.with_(O.base_ctes() + [
        ("origins", "SELECT DISTINCT date_trunc('day', ts) AS o FROM events"),
        ("before", f"""SELECT o, h.* FROM origins JOIN hourly h ON h.SessionStartHourTime < o
                   AND h.SessionStartHourTime >= date_trunc('hour', o - {window})"""),
        ("points", """SELECT o, ServerIP, unnest(generate_series(o, o + INTERVAL 47 HOUR, INTERVAL 1 HOUR)) AS t
                      FROM (SELECT DISTINCT o, ServerIP FROM before)"""),
        ("lagged", f"""SELECT p.o, p.ServerIP, p.t, {lags} FROM points p LEFT JOIN before h
                       ON h.o = p.o AND h.ServerIP = p.ServerIP AND h.SessionStartHourTime <= p.t - INTERVAL 48 HOUR
                       GROUP BY ALL"""),
        ("days", f"SELECT o, ServerIP, CAST(SessionStartHourTime AS DATE) AS day, {means} FROM before GROUP BY ALL"),
        ("rolled", f"""SELECT p.o, p.ServerIP, p.t, {rolls} FROM points p LEFT JOIN days d
                       ON d.o = p.o AND d.ServerIP = p.ServerIP
                       AND d.day BETWEEN CAST(p.t AS DATE) - 9 AND CAST(p.t AS DATE) - 3 GROUP BY ALL"""),
        ("scored", f"""SELECT l.o AS score_begin, l.ServerIP || '_' || CAST(l.t AS VARCHAR) AS key, l.ServerIP,
                              l.t AS SessionStartHourTime, {', '.join('l.' + c for c in LAG_COLUMNS)},
                              {', '.join('r.' + c for c in ROLLING_COLUMNS)}, {O.calendar_select('l.t', cfg.train_begin)}
                       FROM lagged l JOIN rolled r ON r.o = l.o AND r.ServerIP = l.ServerIP AND r.t = l.t""")],
        O.final([("score_begin", False)] + [(c, c in _SCORE_DOUBLES) for c in SC.SCORE_FEATURE_COLUMNS], "scored"))


@register("score_backtest", _backtest_sql)
def q_score_backtest(spark, d):
    """The scoring features of every day of the data as an origin, each from the hours before it."""
    days = table(spark, d, "events").agg(F.min("ts").alias("b"), F.max("ts").alias("e")).first()
    return rounded(SC.score_backtest(hourly(spark, d), EVENTS, f"{days.b:%Y-%m-%d} 00:00:00", f"{days.e:%Y-%m-%d} 00:00:00"))


@register("json_roundtrip", _score_sql)
def q_json_roundtrip(spark, d):
    """Scoring feature records written as JSON lines and read back with their schema."""
    _, feats = _score_features(spark, d)
    path = scratch_path(spark, "score-features-json")
    write_records(feats, path)
    return rounded(read_records(spark, path, feats.schema))


def _scored_and_seen(cfg: RunConfig) -> tuple[list[tuple[str, str]], str]:
    """CTEs up to ``scored``, and whether its row ``s`` holds only levels met in training."""
    ctes = O.features_ctes(cfg)
    names = {n for n, _ in ctes}
    ctes += [(n, q) for n, q in _score_ctes(cfg) if n not in names]
    seen = " AND ".join(f"CAST(s.{c} AS VARCHAR) IN (SELECT CAST({c} AS VARCHAR) FROM features)"
                        for c in INDEX_COLUMNS)
    return ctes, seen


def _coverage_sql(cfg: RunConfig) -> str:
    ctes, seen = _scored_and_seen(cfg)
    return O.with_(ctes, f"""
SELECT 'feature_rows' AS metric, count(*) AS n FROM scored
UNION ALL SELECT 'scored_rows', count(*) FROM scored s WHERE {seen}
UNION ALL SELECT 'skipped_rows', count(*) FROM scored s WHERE NOT ({seen})""")


def _scored_sql(flag: str) -> Callable[[RunConfig], str]:
    def sql(cfg: RunConfig) -> str:
        ctes, seen = _scored_and_seen(cfg)
        return O.with_(ctes, f"SELECT ServerIP, SessionStartHourTime, TRUE AS {flag} FROM scored s WHERE {seen}")
    return sql


@register("score_coverage", _coverage_sql)
def q_score_coverage(spark, d):
    """How many 48-hour feature rows the model scores and how many it skips because a
    categorical value was not seen when the indexer was fitted."""
    h = staged_hourly(spark, d)
    _, feats, fm = _features(spark, d, h)
    _, scored = _score_features(spark, d, h)
    return SC.score_coverage(fm.indexers, scored)


def _score_batch_sql(cfg: RunConfig) -> str:
    ctes, seen = _scored_and_seen(cfg)
    return O.with_(ctes, f"""
SELECT s.ServerIP, s.SessionStartHourTime, CASE WHEN h.key IS NOT NULL THEN TRUE END AS agrees, TRUE AS several_classes
FROM scored s LEFT JOIN hourly h ON h.key = s.key WHERE {seen}""")


@register("score_batch", _score_batch_sql)
def q_score_batch(spark, d):
    """The 48 scored hours of every server. Where the hour has data, whether its prediction is that
    of the forest on the feature table's row; whether several classes are predicted."""
    h = staged_hourly(spark, d)
    cfg, fm, table_, model, rf = _trained(spark, d, h)
    _, feats = _score_features(spark, d, h)
    path = scratch_path(spark, "scored")
    SC.score_batch(model, feats).write.parquet(path)
    scored = spark.read.parquet(path)
    several = scored.agg(F.count_distinct("prediction")).first()[0] > 1
    theirs = TR.predictions(table_, rf, fm, cfg).where("split = 'test'").select(
        "ServerIP", "SessionStartHourTime", F.col("prediction").alias("theirs"))
    return scored.join(theirs, ["ServerIP", "SessionStartHourTime"], "left").select(
        "ServerIP", "SessionStartHourTime", (F.col("prediction") == F.col("theirs")).alias("agrees"),
        F.lit(several).alias("several_classes"))


@register("score_stream", _scored_sql("agree"))
def q_score_stream(spark, d):
    """The same scoring, run as a Structured Streaming query over arriving feature files,
    against the batch predictions."""
    h = staged_hourly(spark, d)
    cfg, fm, table_, model, rf = _trained(spark, d, h)
    _, feats = _score_features(spark, d, h)
    path = scratch_path(spark, "score-features")
    feats.write.parquet(path)
    feats = spark.read.parquet(path)
    return _agreement(score_files_once(spark, model, feats), SC.score_batch(model, feats))


def queries() -> dict[str, Query]:
    return dict(REG)


def oracle_sql(cfg: RunConfig = EVENTS) -> dict[str, str]:
    return {k: (v(cfg) if callable(v) else v) for k, v in ORACLE.items()}
