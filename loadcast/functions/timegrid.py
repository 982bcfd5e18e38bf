"""Epoch-aligned buckets, regular time grids and the scoring horizon (all timestamp_ntz).

No expression here depends on the session time zone: ``unix_timestamp`` of a
timestamp_ntz reads the wall clock as UTC, and ``timestamp_add`` on a timestamp_ntz
adds plain seconds.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FEATURE_WINDOW_SECONDS, SCORE_HOURS

FIVE_MINUTES = 300
HOUR = 3600
DAY = 86400


def ntz(value: str) -> Column:
    """A timestamp_ntz literal from ``yyyy-MM-dd HH:mm:ss``."""
    return F.expr(f"TIMESTAMP_NTZ'{value}'")


EPOCH = "1970-01-01 00:00:00"


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of a timestamp_ntz wall clock (bigint)."""
    return F.unix_timestamp(F.col(ts) if isinstance(ts, str) else ts)


def from_epoch_seconds(secs: Column) -> Column:
    return F.timestamp_add("SECOND", secs, ntz(EPOCH))


def floor_ts(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned bucket of ``seconds`` that holds ``ts``; NULL stays NULL."""
    s = epoch_seconds(ts)
    return from_epoch_seconds(s - F.pmod(s, F.lit(seconds)))


def bucket_index(ts: Column | str, seconds: int) -> Column:
    """Bucket number since the epoch (bigint); consecutive buckets differ by one."""
    s = epoch_seconds(ts)
    return F.floor(s / F.lit(seconds)).cast("long")


def add_seconds(ts: Column, seconds) -> Column:
    return F.timestamp_add("SECOND", seconds if isinstance(seconds, Column) else F.lit(seconds), ts)


def grid_bounds(begin: Column, end: Column, seconds: int) -> tuple[Column, Column]:
    """Grid ends: both floored, and one bucket past the end, inclusive."""
    return floor_ts(begin, seconds), add_seconds(floor_ts(end, seconds), seconds)


def grid_points(begin: Column, end: Column, seconds: int) -> Column:
    """Array of bucket starts covering [begin, end] plus one bucket (see ``grid_bounds``)."""
    lo, hi = grid_bounds(begin, end, seconds)
    return F.sequence(lo, hi, F.make_dt_interval(secs=F.lit(seconds)))


# Seconds from the first scored hour to the bounds of the horizon: 48 hours are scored,
# features come from the 365.25/12 days before (both ends inclusive, to the second).
HORIZON_OFFSETS = {
    "score_begin": 0,
    "score_end": SCORE_HOURS * HOUR - 1,
    "feature_begin": 1 - FEATURE_WINDOW_SECONDS,
    "feature_end": -1,
}


def horizon_columns(score_begin: Column) -> dict[str, Column]:
    """The bounds of the scoring horizon that begins at ``score_begin``."""
    return {name: add_seconds(score_begin, offset) for name, offset in HORIZON_OFFSETS.items()}


def horizon(score_begin: str) -> dict[str, str]:
    """The same bounds as literals, for partition filters that are made on the driver."""
    return {name: shift(score_begin, offset) for name, offset in HORIZON_OFFSETS.items()}


def shift(ts: str, seconds: float) -> str:
    """A ``yyyy-MM-dd HH:mm:ss`` literal moved by ``seconds``."""
    fmt = "%Y-%m-%d %H:%M:%S"
    return (datetime.strptime(ts, fmt) + timedelta(seconds=seconds)).strftime(fmt)
