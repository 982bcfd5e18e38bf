"""Hourly and daily statistics tables for scoring, partitioned by (year, month).

Readers select months with a predicate on the partition columns: the folders are listed,
and only the one or two months that cover a scoring window are read.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timegrid import ntz
from ..session import scratch_path

PARTITION_COLUMNS = ["year", "month"]

# A reader that wants a few servers skips row groups by their Bloom filter, and pages of the
# others by the column index, as rows are sorted by server.
SKIP_OPTIONS = {"parquet.bloom.filter.enabled#ServerIP": "true", "parquet.page.row.count.limit": "2000",
                "parquet.block.size": str(16 << 20)}


def hourly_stats(hourly: DataFrame) -> DataFrame:
    """Hourly peaks with the calendar columns they are stored and filtered by."""
    t = F.col("SessionStartHourTime")
    return hourly.withColumns({"year": F.year(t), "month": F.month(t),
                               "dayofmonth": F.dayofmonth(t), "hourofday": F.hour(t)})


def daily_stats(daily: DataFrame) -> DataFrame:
    """Daily means with their partition columns."""
    t = F.col("SessionStartDay")
    return daily.withColumns({"year": F.year(t), "month": F.month(t)})


def stored_stats(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.format(form).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def months_of(stats: DataFrame) -> list[tuple[int, int]]:
    """The (year, month) pairs present: a dozen for each year of a batch."""
    return [(r["year"], r["month"]) for r in stats.select(*PARTITION_COLUMNS).distinct().collect()]


def of_months(stats: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of the given months (a filter on the partition columns)."""
    return stats.where((F.col("year") * 100 + F.col("month")).isin([y * 100 + m for y, m in months]))


def write_stats(stats: DataFrame, path: str, keys: list[str]) -> list[tuple[int, int]]:
    """Merge ``stats`` into the table at ``path``: rows with the same ``keys`` are replaced,
    all others stay, also those of the months that ``stats`` covers in part. Returns the
    months written. A row replaces another whole: batches that share an hour go through
    ``plans.statistics``, which adds them up.

    Files are sorted by ``keys``, the server first, and hold a Bloom filter of servers, so that
    a filter on servers skips most of a month's pages.

    The merged months are staged in the shared folder, as a table can't be overwritten
    while it is read. ``rebalance`` gives a month as many tasks and files as its size needs.
    """
    spark = stats.sparkSession
    months = months_of(stats)
    old = stored_stats(spark, path)
    if old is not None and months:
        staged = scratch_path(spark, "stats-merge")
        kept = of_months(old, months).select(*stats.columns).join(stats.select(*keys), keys, "left_anti")
        stats.unionByName(kept).write.parquet(staged)
        stats = spark.read.schema(stats.schema).parquet(staged)
    (stats.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS, *keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**SKIP_OPTIONS)
     .partitionBy(*PARTITION_COLUMNS).parquet(path))
    return months


def _months(begin: datetime, end: datetime) -> list[tuple[int, int]]:
    out, y, m = [], begin.year, begin.month
    while (y, m) <= (end.year, end.month):
        out.append((y, m))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def month_predicate(begin: str, end: str) -> F.Column:
    """Partition filter for the months that overlap [begin, end]."""
    fmt = "%Y-%m-%d %H:%M:%S"
    months = _months(datetime.strptime(begin, fmt), datetime.strptime(end, fmt))
    ym = F.col("year") * 100 + F.col("month")
    return ym.isin([y * 100 + m for y, m in months])


def read_stats(spark: SparkSession, path: str, begin: str, end: str, ts: str) -> DataFrame:
    """Rows of a statistics table with ``begin <= ts <= end``, reading only their months."""
    return (spark.read.parquet(path)
            .where(month_predicate(begin, end))
            .where(F.col(ts).between(ntz(begin), ntz(end))))
