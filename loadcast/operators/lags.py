"""Hourly lags and rolling daily means, per server.

Two modes:

* ``calendar``: lag i at hour t is the value at t - i hours, NULL when that hour has no
  row; the rolling mean averages the daily means of days d-9 .. d-3 that exist. Both are
  RANGE frames (interval offsets on the hour, a day number for the days), so no
  gap-filled grid and no join are needed.
* ``observed``: lag i is i rows back and the rolling mean spans rows -9 .. -3, counting
  only hours and days that have data (what the original training ETL computed).

``lag_features``, ``rolling_daily_mean`` and ``hour_features`` work on histories of any length:
their windows run on overlapping chunks of each server's history (``operators.chunks``), of days
in calendar mode and of row numbers in observed mode. ``lags_within``, ``rolling_within`` and
``daily_rolling_within`` are the windows alone, for rows that are partitioned already: the
chunks here, and the 32 days of a server that scoring looks at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (DAILY_COLUMNS, HOURLY_LAGS, LAG_COLUMNS, LAGGED_MEASURE, PEAK_COLUMNS,
                      ROLLING_COLUMNS, ROLLING_LAG_DAYS, ROLLING_WINDOW_DAYS)
from ..functions.timegrid import DAY, bucket_index, floor_ts
from .chunks import numbered, windows_by_chunk

MODES = ("calendar", "observed")

# How far windows look back: the longest lag in whole days or in rows; the days of the rolling
# mean. 730 rows hold more than the ten days (240 rows at most) that the rolling mean needs whole.
LAG_DAYS = -(-max(HOURLY_LAGS) // 24)
LAG_ROWS = max(HOURLY_LAGS)
ROLLING_DAYS = ROLLING_LAG_DAYS + ROLLING_WINDOW_DAYS
assert LAG_DAYS > ROLLING_DAYS and LAG_ROWS >= 24 * (ROLLING_DAYS + 1)

CHUNK_HALOS = 4  # a chunk's length in halos: a quarter of the rows is copied


def _check(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")


# ---- histories of any length ------------------------------------------------------------------

def lag_features(hourly: DataFrame, mode: str = "calendar", server: str = "ServerIP",
                 ts: str = "SessionStartHourTime", measure: str = LAGGED_MEASURE,
                 chunk_halos: int = CHUNK_HALOS) -> DataFrame:
    """Adds ``peakLoadLag<i>`` for the fixed lag offsets."""
    return _by_chunk(hourly, mode, server, ts, chunk_halos, lambda rows, by: lags_within(rows, mode, by, ts, measure))


def hour_features(hourly: DataFrame, mode: str = "calendar", server: str = "ServerIP",
                  day: str = "SessionStartDay", ts: str = "SessionStartHourTime",
                  chunk_halos: int = CHUNK_HALOS) -> DataFrame:
    """Adds the lags and the rolling daily means, on the same chunks."""
    def windows(rows: DataFrame, by: list[str]) -> DataFrame:
        # Lags first: they are ordered by (server, chunk, hour); the day windows then sort once
        # by day number.
        return rolling_within(lags_within(rows, mode, by, ts), mode, by, day, ts)

    return _by_chunk(hourly, mode, server, ts, chunk_halos, windows, day)


def _by_chunk(hourly, mode, server, ts, chunk_halos, windows, day=None) -> DataFrame:
    _check(mode)
    if mode == "calendar":
        return windows_by_chunk(hourly, server, bucket_index(ts, DAY), chunk_halos * LAG_DAYS, LAG_DAYS, windows)
    if day is None:
        hourly, day = hourly.withColumn("_of_day", floor_ts(ts, DAY)), "_of_day"
    rows = numbered(hourly, server, ts, day, chunk_halos * LAG_DAYS)
    out = windows_by_chunk(rows, server, F.col("_row"), chunk_halos * LAG_ROWS, LAG_ROWS, windows)
    return out.drop("_row", "_day", "_of_day")


def rolling_daily_mean(daily: DataFrame, mode: str = "calendar", server: str = "ServerIP",
                       day: str = "SessionStartDay", chunk_halos: int = CHUNK_HALOS) -> DataFrame:
    """Adds ``<x>DailyLag2Win7``: mean of the 7 daily values before the 2 skipped days."""
    _check(mode)
    windows = lambda rows, by: daily_rolling_within(rows, mode, by, day)
    if mode == "calendar":
        return windows_by_chunk(daily, server, bucket_index(day, DAY), chunk_halos * LAG_DAYS, ROLLING_DAYS, windows)
    rows = numbered(daily, server, day, day, chunk_halos * LAG_DAYS)
    return windows_by_chunk(rows, server, F.col("_row"), chunk_halos * LAG_DAYS, ROLLING_DAYS, windows).drop("_row", "_day")


# ---- windows on partitioned rows --------------------------------------------------------------

def lags_within(hourly: DataFrame, mode: str, by: list[str], ts: str = "SessionStartHourTime",
                measure: str = LAGGED_MEASURE) -> DataFrame:
    """The lags of rows partitioned by ``by``, in one window pass."""
    if mode == "observed":
        w = Window.partitionBy(*by).orderBy(ts)
        return hourly.withColumns({c: F.lag(measure, i).over(w) for i, c in zip(HOURLY_LAGS, LAG_COLUMNS)})
    # An interval RANGE frame on the hour itself: the window is ordered by (server, hour).
    keys = ", ".join(f"`{c}`" for c in by)
    return hourly.withColumns({c: F.expr(
        f"max(`{measure}`) OVER (PARTITION BY {keys} ORDER BY `{ts}` RANGE BETWEEN "
        f"INTERVAL {i} HOURS PRECEDING AND INTERVAL {i} HOURS PRECEDING)") for i, c in zip(HOURLY_LAGS, LAG_COLUMNS)})


def daily_rolling_within(daily: DataFrame, mode: str, by: list[str], day: str = "SessionStartDay") -> DataFrame:
    """The rolling means of daily rows partitioned by ``by``."""
    lo, hi = -ROLLING_DAYS, -(ROLLING_LAG_DAYS + 1)
    w = Window.partitionBy(*by)
    w = w.orderBy(day).rowsBetween(lo, hi) if mode == "observed" else w.orderBy(bucket_index(day, DAY)).rangeBetween(lo, hi)
    return daily.withColumns({r: F.avg(d).over(w) for d, r in zip(DAILY_COLUMNS, ROLLING_COLUMNS)})


def rolling_within(hourly: DataFrame, mode: str, by: list[str], day: str = "SessionStartDay",
                   ts: str = "SessionStartHourTime") -> DataFrame:
    """Rolling daily means computed straight on hourly rows: no daily table, no join.

    Same result as ``daily_mean`` -> ``rolling_daily_mean`` -> ``join_daily_lags``. The
    daily mean is a window over the rows of the same day number; it is kept on the first hour
    of each day only, and a second window averages those over the day frame (``avg`` skips the
    NULLs of the other hours). Both windows share one sort. In observed mode the day number is
    ``_day``, of the days that have rows.
    """
    # The day number is materialised once, so both windows order by the same column.
    hourly = hourly.withColumn("_dayidx", F.col("_day") if mode == "observed" else bucket_index(day, DAY))
    days = Window.partitionBy(*by).orderBy("_dayidx")
    by_day = days.rangeBetween(0, 0)
    # rows without a peak (hours that are only scored) are no part of a day
    first = F.col(PEAK_COLUMNS[0]).isNotNull() & (
        F.col(ts) == F.min(F.when(F.col(PEAK_COLUMNS[0]).isNotNull(), F.col(ts))).over(by_day))
    marked = hourly.withColumns({f"_{d}": F.when(first, F.avg(p).over(by_day))
                                 for p, d in zip(PEAK_COLUMNS, DAILY_COLUMNS)})
    w = days.rangeBetween(-ROLLING_DAYS, -(ROLLING_LAG_DAYS + 1))
    out = marked.withColumns({r: F.avg(f"_{d}").over(w) for d, r in zip(DAILY_COLUMNS, ROLLING_COLUMNS)})
    return out.drop(*[f"_{d}" for d in DAILY_COLUMNS], "_dayidx")


def join_daily_lags(hourly: DataFrame, rolling: DataFrame, server: str = "ServerIP",
                    day: str = "SessionStartDay") -> DataFrame:
    """Left join of the rolling daily means onto hourly rows, on (server, day)."""
    r = rolling.select(F.col(server).alias(server), F.col(day).alias(day), *ROLLING_COLUMNS)
    return hourly.join(r, [server, day], "left")
