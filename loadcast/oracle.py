"""DuckDB SQL for every query with a relational equivalent (the correctness oracle).

The SQL states each result in plain SQL over the pre-registered test tables. It shares the
fixed names and values of ``config`` (column spellings, offsets) with
the Spark code, and no logic. Doubles are rounded to 6 places on both sides, because sums and
means in a different order differ in the last bits.
"""

from __future__ import annotations

from .config import (DAILY_COLUMNS, FIVE_MIN_SUMS, HOURLY_LAGS, INDEX_COLUMNS, LAG_COLUMNS,
                     PEAK_COLUMNS, PEAK_MEASURES, ROLLING_COLUMNS, ROLLING_LAG_DAYS,
                     ROLLING_WINDOW_DAYS, SCALED_COLUMNS, SCALED_INPUTS, SESSION_COLUMNS,
                     SECONDS_PER_YEAR, RunConfig)

R = 6  # decimal places of every compared double
# Two engines add the same doubles in a different order, so a value exactly half-way between
# two rounded ones can come out a last bit low in one of them. Both sides add HALF_WAY first,
# far below the compared digits and above that noise.
HALF_WAY = 1e-9


def r6(expr: str) -> str:
    """Round as Spark's ``round`` does (half away from zero on the decimal value; DuckDB's
    ``round`` on a double works on the binary value instead)."""
    return f"CAST(round(CAST(({expr}) + {HALF_WAY} AS DECIMAL(38, 18)), {R}) AS DOUBLE)"


def rnd(expr: str, alias: str) -> str:
    return f"{r6(expr)} AS {alias}"


def with_(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{s}\n)" for n, s in ctes) + "\n" + body


# ---- session log from `events` ------------------------------------------------------

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_SUB = ["click", "purchase", "error", "signup", "view"]

RAW_SESSIONS = f"""
SELECT event_type AS TrafficType,
       ts AS SessionStart,
       ts + to_seconds({_K}) AS SessionEnd,
       {_K} AS ConcurrentConnectionCounts,
       value * {_K} / 100 AS MbytesTransferred,
       CAST(event_id % 3 AS VARCHAR) AS ServiceGrade,
       CAST(event_id % 2 AS VARCHAR) AS HTTP1,
       CAST(user_id % 3 AS VARCHAR) AS ServerType,
       CASE WHEN event_type = 'click' THEN value ELSE 0.0 END AS SubService_1_Load,
       CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS SubSerivce_2_Load,
       CASE WHEN event_type = 'error' THEN value ELSE 0.0 END AS SubSerivce_3_Load,
       CASE WHEN event_type = 'signup' THEN value ELSE 0.0 END AS SubSerivce_4_Load,
       CASE WHEN event_type = 'view' THEN value ELSE 0.0 END AS SubSerivce_5_Load,
       CASE WHEN {_K} % 2 = 0 THEN value ELSE 0.0 END AS SecureBytes_Load,
       value AS TotalLoad,
       CASE WHEN event_id % 97 = 0 THEN 'IPs' WHEN event_id % 89 = 0 THEN NULL
            ELSE '10.0.0.' || CAST(user_id % 8 AS VARCHAR) END AS ServerIP,
       '172.16.0.' || CAST(user_id AS VARCHAR) AS ClientIP
FROM events"""

SESSIONS = "SELECT * FROM raw_sessions WHERE ServerIP IS NOT NULL AND ServerIP <> 'IPs'"

LINEITEM_SESSIONS = """
SELECT l_shipdate AS SessionStart, l_quantity AS TotalLoad, l_extendedprice AS MbytesTransferred,
       0.0 AS SubService_1_Load, 0.0 AS SubSerivce_2_Load, 0.0 AS SubSerivce_3_Load,
       0.0 AS SubSerivce_4_Load, 0.0 AS SubSerivce_5_Load, 0.0 AS SecureBytes_Load,
       '10.1.0.' || CAST(l_suppkey % 4 AS VARCHAR) AS ServerIP
FROM lineitem"""


def rollup_sql(src: str = "sessions") -> str:
    sums = [f"sum({s}) AS {n}" for n, s in FIVE_MIN_SUMS]
    sums.insert(1, "count(*) AS NumSession")
    return f"""
SELECT ServerIP, time_bucket(INTERVAL '5 minutes', SessionStart) AS SessionStartFiveMin,
       {', '.join(sums)}
FROM {src} GROUP BY 1, 2"""


def hourly_sql(src: str = "rollup") -> str:
    ms = ", ".join(f"{s} AS {p}" for p, s in PEAK_MEASURES[1:])
    return f"""
SELECT CAST(ServerIP || '_' || CAST(hr AS VARCHAR) AS VARCHAR) AS key, ServerIP, hr AS SessionStartHourTime,
       peakLoad, {', '.join(PEAK_COLUMNS[1:])}
FROM (
  SELECT ServerIP, date_trunc('hour', SessionStartFiveMin) AS hr,
         coalesce(SumTotalLoad, 0.0) AS peakLoad, {ms},
         row_number() OVER (PARTITION BY ServerIP, date_trunc('hour', SessionStartFiveMin)
                            ORDER BY coalesce(SumTotalLoad, 0.0) DESC, SessionStartFiveMin ASC) AS rn
  FROM {src} WHERE ServerIP IS NOT NULL AND SessionStartFiveMin IS NOT NULL
) WHERE rn = 1"""


def daily_sql(src: str = "hourly") -> str:
    avgs = ", ".join(f"avg({p}) AS {d}" for p, d in zip(PEAK_COLUMNS, DAILY_COLUMNS))
    return f"""
SELECT ServerIP, date_trunc('day', SessionStartHourTime) AS SessionStartDay, {avgs}
FROM {src} GROUP BY 1, 2"""


_LO = ROLLING_LAG_DAYS + ROLLING_WINDOW_DAYS
_HI = ROLLING_LAG_DAYS + 1


def rolling_sql(src: str = "daily", mode: str = "observed") -> str:
    if mode == "observed":
        frame = f"ORDER BY SessionStartDay ROWS BETWEEN {_LO} PRECEDING AND {_HI} PRECEDING"
    else:
        frame = (f"ORDER BY SessionStartDay RANGE BETWEEN INTERVAL {_LO} DAYS PRECEDING "
                 f"AND INTERVAL {_HI} DAYS PRECEDING")
    cols = ", ".join(f"avg({d}) OVER (PARTITION BY ServerIP {frame}) AS {r}"
                     for d, r in zip(DAILY_COLUMNS, ROLLING_COLUMNS))
    return f"SELECT *, {cols} FROM {src}"


def lags_sql(src: str = "hourly", mode: str = "calendar") -> str:
    if mode == "observed":
        cols = [f"lag(peakLoad, {i}) OVER (PARTITION BY ServerIP ORDER BY SessionStartHourTime) AS {c}"
                for i, c in zip(HOURLY_LAGS, LAG_COLUMNS)]
    else:
        cols = [f"max(peakLoad) OVER (PARTITION BY ServerIP ORDER BY SessionStartHourTime RANGE BETWEEN "
                f"INTERVAL {i} HOURS PRECEDING AND INTERVAL {i} HOURS PRECEDING) AS {c}"
                for i, c in zip(HOURLY_LAGS, LAG_COLUMNS)]
    return f"SELECT *, {', '.join(cols)} FROM {src}"


# ---- calendar ---------------------------------------------------------------------------

def holiday_sql(d: str) -> str:
    """Boolean SQL: date expression ``d`` is an observed US federal holiday. The rules are those of
    5 U.S.C. 6103, written out: days moved off a weekend, and the n-th weekday of a month."""
    monthday = "month({0}) * 100 + dayofmonth({0})"
    on_its_day, saturday_after, sunday_before = (monthday.format(x) for x in (f"({d})", f"({d} + 1)", f"({d} - 1)"))
    dates = "(101, 704, 1111, 1225)"  # New Year, Independence, Veterans, Christmas
    return f"""coalesce(
      (isodow({d}) < 6 AND {on_its_day} IN {dates}) OR (isodow({d}) = 5 AND {saturday_after} IN {dates})
      OR (isodow({d}) = 1 AND {sunday_before} IN {dates})
      OR ({d} >= DATE '2021-06-18' AND ((isodow({d}) < 6 AND {on_its_day} = 619)
          OR (isodow({d}) = 5 AND {saturday_after} = 619) OR (isodow({d}) = 1 AND {sunday_before} = 619)))
      OR (isodow({d}) = 1 AND (
            (month({d}) IN (1, 2) AND dayofmonth({d}) BETWEEN 15 AND 21)
            OR (month({d}) = 5 AND dayofmonth({d}) > 24)
            OR (month({d}) = 9 AND dayofmonth({d}) < 8)
            OR (month({d}) = 10 AND dayofmonth({d}) BETWEEN 8 AND 14)))
      OR (isodow({d}) = 4 AND month({d}) = 11 AND dayofmonth({d}) BETWEEN 22 AND 28), false)"""


def calendar_select(t: str, begin: str) -> str:
    d = f"CAST({t} AS DATE)"
    return f"""CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month,
       CAST(weekofyear({t}) AS INTEGER) AS weekofyear, CAST(dayofmonth({t}) AS INTEGER) AS dayofmonth,
       CAST(hour({t}) AS INTEGER) AS hourofday, dayname({t}) AS dayofweek,
       {r6(f"coalesce((epoch({t}) - epoch(TIMESTAMP '{begin}')) / {SECONDS_PER_YEAR}, 0.0)")} AS linearTrend,
       {d} AS date,
       CAST({holiday_sql(d)} AS INTEGER) AS Holiday,
       CASE WHEN hour({t}) BETWEEN 8 AND 18 THEN 1 ELSE 0 END AS BusinessHour,
       CASE WHEN hour({t}) BETWEEN 6 AND 9 THEN 1 ELSE 0 END AS Morning"""


def label_sql(x: str, cfg: RunConfig) -> str:
    low, high = ("(SELECT low FROM cuts)", "(SELECT high FROM cuts)") if cfg.label_quantiles else (cfg.low, cfg.high)
    return f"CASE WHEN {x} IS NULL OR {x} <= {low} THEN 1 WHEN {x} <= {high} THEN 2 ELSE 3 END"


def cuts_cte(cfg: RunConfig) -> tuple[str, str]:
    """``cuts`` (low, high): nearest-rank percentiles of the train split's peak load."""
    at = [f"max(CASE WHEN rank = greatest(1, ceil(round({q!r} * n, 9))) THEN peakLoad END) AS {name}"
          for q, name in zip(cfg.label_quantiles, ("low", "high"))]
    return "cuts", f"""
SELECT {', '.join(at)} FROM (
  SELECT peakLoad, row_number() OVER (ORDER BY peakLoad) AS rank, count(*) OVER () AS n
  FROM hourly WHERE SessionStartHourTime < TIMESTAMP '{cfg.test_split_start}')"""


# ---- the feature table ------------------------------------------------------------------

def base_ctes(source: str = "events") -> list[tuple[str, str]]:
    """Session log (from ``events`` or ``lineitem``) -> five-minute rollup -> hourly peaks."""
    raw = RAW_SESSIONS if source == "events" else LINEITEM_SESSIONS
    return [("raw_sessions", raw), ("sessions", SESSIONS), ("rollup", rollup_sql()),
            ("hourly", hourly_sql())]


def features_ctes(cfg: RunConfig, source: str = "events") -> list[tuple[str, str]]:
    """Hourly features in the run's lag mode, NULL lags as 0."""
    mode = cfg.lag_mode
    fill = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in ROLLING_COLUMNS + LAG_COLUMNS)
    return base_ctes(source) + [
        ("daily", daily_sql()),
        ("rolling", rolling_sql("daily", mode)),
        ("lagged", lags_sql("hourly", mode)),
        ("feats", f"""
SELECT l.key, l.ServerIP, l.SessionStartHourTime, {', '.join('l.' + p for p in PEAK_COLUMNS)},
       {calendar_select('l.SessionStartHourTime', cfg.train_begin)},
       date_trunc('day', l.SessionStartHourTime) AS SessionStartDay,
       {', '.join('r.' + c for c in ROLLING_COLUMNS)}, {', '.join('l.' + c for c in LAG_COLUMNS)}
FROM lagged l LEFT JOIN rolling r
  ON r.ServerIP = l.ServerIP AND r.SessionStartDay = date_trunc('day', l.SessionStartHourTime)"""),
        ("features", f"SELECT * EXCLUDE ({', '.join(ROLLING_COLUMNS + LAG_COLUMNS)}), {fill} FROM feats"),
    ]


def index_ctes(src: str = "features", levels_from: str | None = None, unseen: bool = False) -> list[tuple[str, str]]:
    """Frequency rank of each categorical value (ties by the value as text), 0-based. With
    ``unseen``, a value that ``levels_from`` doesn't hold gets the number of its levels."""
    out = []
    for c in INDEX_COLUMNS:
        out.append((f"lv_{c}", f"""
SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v ASC) - 1 AS DOUBLE) AS i,
       count(*) OVER () AS levels
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {levels_from or src} GROUP BY 1)"""))
    kind = "LEFT JOIN" if unseen else "JOIN"
    joins = " ".join(f"{kind} lv_{c} ON lv_{c}.v = CAST(f.{c} AS VARCHAR)" for c in INDEX_COLUMNS)
    idx = ", ".join((f"coalesce(lv_{c}.i, (SELECT CAST(max(levels) AS DOUBLE) FROM lv_{c}))" if unseen else f"lv_{c}.i")
                    + f" AS {c}_indexed" for c in INDEX_COLUMNS)
    out.append(("indexed", f"SELECT f.*, {idx} FROM {src} f {joins}"))
    return out


def scaled_select(src_alias: str = "") -> str:
    p = src_alias
    return ", ".join(
        f"CASE WHEN coalesce(stddev_samp({p}{c}) OVER (), 0) = 0 THEN 0.0 "
        f"ELSE {p}{c} / stddev_samp({p}{c}) OVER () END AS {s}"
        for c, s in zip(SCALED_INPUTS, SCALED_COLUMNS))


def final(cols: list[tuple[str, bool]], src: str) -> str:
    """SELECT list with doubles rounded: cols = [(name, is_double)]."""
    sel = ", ".join(rnd(n, n) if dbl else n for n, dbl in cols)
    return f"SELECT {sel} FROM {src}"


SESSION_DOUBLES = {"MbytesTransferred", "SubService_1_Load", "SubSerivce_2_Load", "SubSerivce_3_Load",
                   "SubSerivce_4_Load", "SubSerivce_5_Load", "SecureBytes_Load", "TotalLoad"}


def session_cols() -> list[tuple[str, bool]]:
    return [(c, c in SESSION_DOUBLES) for c in SESSION_COLUMNS]
