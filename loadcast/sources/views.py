"""Temp views for SQL users: the session log and its rollups under fixed names.

``spark.sql`` over these views plans exactly like the DataFrame functions (same
Catalyst plan); they are registered lazily, nothing is computed or cached here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.rollup import daily_mean, five_min_rollup, hourly_peak, with_day

# Epoch-aligned bucket start of a timestamp_ntz column, in SQL (zone-free, NULL-preserving).
FLOOR_SQL = ("timestampadd(SECOND, unix_timestamp({c}) - pmod(unix_timestamp({c}), {n}), "
             "TIMESTAMP_NTZ'1970-01-01 00:00:00')")


def floor_sql(col: str, seconds: int) -> str:
    return FLOOR_SQL.format(c=col, n=seconds)


def register_views(spark: SparkSession, sessions: DataFrame, prefix: str = "") -> list[str]:
    """Register ``sessions``, ``five_min``, ``hourly_peak`` and ``daily_mean`` views."""
    hourly = with_day(hourly_peak(five_min_rollup(sessions)))
    views = {"sessions": sessions, "five_min": five_min_rollup(sessions),
             "hourly_peak": hourly, "daily_mean": daily_mean(hourly)}
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in views]
