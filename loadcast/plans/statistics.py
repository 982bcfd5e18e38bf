"""Statistics that keep up with late and part-hour session logs.

A store keeps mergeable state: the five-minute sums of every batch, partitioned by
(year, month, batch). Sums of different batches add up whatever hours they share, so batches
may split an hour, arrive late or out of order. The hourly peaks and daily means that scoring
reads are derived from the added-up sums, for the days that a batch touches and no others.

``<store>/partials``  five-minute sums per batch
``<store>/ledger``    what counts: one JSON file per commit
``<store>/hourly``, ``<store>/daily``  derived tables, as ``sources.stats_store`` writes them

A batch is known by its id. It counts from the commit of its ledger file, which is a single
rename, and once: sent again it changes nothing. Sums that were written without a commit (a job
that died) are never read, and are replaced when the batch is sent again. A batch whose commit
was followed by a crash is derived when it is sent again. ``compact`` adds up the batches of a
month into one. ``take_in`` makes a batch of the files that no earlier batch has read.

One writer at a time; readers of ``hourly`` and ``daily`` need no ledger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SUM_COLUMNS
from ..functions.timegrid import ntz
from ..operators.rollup import daily_mean, five_min_rollup, hourly_peak, merge_rollups, with_day
from ..session import scratch_path
from ..sources.stats_store import PARTITION_COLUMNS, daily_stats, hourly_stats, of_months, stored_stats, write_stats

MONTH_BATCH = [*PARTITION_COLUMNS, "batch"]
PARTIAL_SCHEMA = T.StructType(
    [T.StructField("ServerIP", T.StringType()), T.StructField("SessionStartFiveMin", T.TimestampNTZType()),
     T.StructField("SumTotalLoad", T.DoubleType()), T.StructField("NumSession", T.LongType())]
    + [T.StructField(c, T.DoubleType()) for c in SUM_COLUMNS if c != "SumTotalLoad"]
    + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()), T.StructField("batch", T.StringType())])

# kind: "batch" (known), "month" (its sums of that month count), "dropped" (no longer),
# "derived" (hourly and daily hold it), "file" (it has read that file)
LEDGER_SCHEMA = "kind string, batch string, year int, month int, path string, size bigint, modified string"


def ledger(spark: SparkSession, store: str) -> DataFrame:
    """All commits of the store; empty before the first."""
    if stored_stats(spark, f"{store}/ledger", "text") is None:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(f"{store}/ledger")


def _commit(entries: DataFrame, store: str) -> None:
    entries.coalesce(1).write.mode("append").json(f"{store}/ledger")


def _entries(spark: SparkSession, kind: str, batch: str, months: list[tuple[int, int]] | None = None) -> DataFrame:
    rows = [(kind, batch, y, m, None, None, None) for y, m in months or [(None, None)]]
    return spark.createDataFrame(rows, LEDGER_SCHEMA)


def live_partials(spark: SparkSession, store: str) -> DataFrame:
    """Five-minute sums of all batches that count."""
    log = ledger(spark, store)
    months = log.where("kind = 'month'").select(*MONTH_BATCH).distinct()
    live = months.join(log.where("kind = 'dropped'").select(*MONTH_BATCH), MONTH_BATCH, "left_anti")
    partials = spark.read.schema(PARTIAL_SCHEMA).parquet(f"{store}/partials")
    return partials.join(live, MONTH_BATCH, "left_semi")


def _write_partials(rollup: DataFrame, store: str, batch: str) -> list[tuple[int, int]]:
    """The batch's sums, in place of what an uncommitted attempt has left; the months written."""
    spark = rollup.sparkSession
    t = F.col("SessionStartFiveMin")
    rows = (rollup.where(F.col("ServerIP").isNotNull() & t.isNotNull())
            .withColumns({"year": F.year(t), "month": F.month(t), "batch": F.lit(batch)}))
    staged = scratch_path(spark, "partials")
    rows.select(*[f.name for f in PARTIAL_SCHEMA]).write.parquet(staged)
    rows = spark.read.schema(PARTIAL_SCHEMA).parquet(staged)
    months = [(r.year, r.month) for r in rows.select(*PARTITION_COLUMNS).distinct().collect()]
    (rows.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(*MONTH_BATCH, "ServerIP", "SessionStartFiveMin")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH_BATCH).parquet(f"{store}/partials"))
    return months


def _derive(spark: SparkSession, store: str, batch: str) -> None:
    """Hourly peaks and daily means of the days that the batch touches, from all batches."""
    partials = live_partials(spark, store)
    day = F.to_date("SessionStartFiveMin")
    own = spark.read.schema(PARTIAL_SCHEMA).parquet(f"{store}/partials").where(F.col("batch") == batch)
    days = [r.day for r in own.select(day.alias("day")).distinct().collect()]  # days of the calendar
    if days:
        touched = of_months(partials, sorted({(d.year, d.month) for d in days})).where(
            F.col("SessionStartFiveMin").between(_midnight(min(days)), _midnight(max(days), "23:59:59")) & day.isin(days))
        staged = scratch_path(spark, "derived")
        hourly_stats(hourly_peak(merge_rollups(touched))).write.parquet(staged)
        hourly = spark.read.parquet(staged)
        write_stats(hourly, f"{store}/hourly", ["ServerIP", "SessionStartHourTime"])
        write_stats(daily_stats(daily_mean(with_day(hourly))), f"{store}/daily", ["ServerIP", "SessionStartDay"])
    _commit(_entries(spark, "derived", batch), store)


def _midnight(day: date, time: str = "00:00:00") -> F.Column:
    return ntz(f"{day:%Y-%m-%d} {time}")


def add_batch(sessions: DataFrame, store: str, batch: str, files: DataFrame | None = None) -> bool:
    """Add a batch of sessions to the store, once; whether it was new. ``files`` (path, size,
    modified) are noted as read by it, in the same commit."""
    spark = sessions.sparkSession
    known = {r.kind for r in ledger(spark, store).where(F.col("batch") == batch).select("kind").distinct().collect()}
    if "batch" not in known:
        months = _write_partials(five_min_rollup(sessions), store, batch)
        entries = _entries(spark, "batch", batch)
        if months:
            entries = entries.unionByName(_entries(spark, "month", batch, months))
        if files is not None:
            named = files.select(F.lit("file").alias("kind"), F.lit(batch).alias("batch"), "path", "size", "modified")
            entries = entries.unionByName(named, allowMissingColumns=True)
        _commit(entries, store)
    if "derived" not in known:
        _derive(spark, store, batch)
    return "batch" not in known


def compact(spark: SparkSession, store: str) -> list[tuple[int, int]]:
    """Add up the batches of every month that has several into one; the months done. The derived
    tables stay as they are, and the old batches stay known."""
    if stored_stats(spark, f"{store}/ledger", "text") is None:
        return []
    live = live_partials(spark, store).select(*MONTH_BATCH).distinct()
    several = live.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    months = sorted((r.year, r.month) for r in several.collect())
    if months:
        batch = f"compact-{uuid.uuid4().hex}"
        old = of_months(live, months).select(*MONTH_BATCH).collect()  # a row per batch and month
        _write_partials(merge_rollups(of_months(live_partials(spark, store), months)), store, batch)
        dropped = spark.createDataFrame([("dropped", r.batch, r.year, r.month, None, None, None) for r in old], LEDGER_SCHEMA)
        _commit(_entries(spark, "batch", batch).unionByName(_entries(spark, "month", batch, months))
                .unionByName(_entries(spark, "derived", batch)).unionByName(dropped), store)
    return months


# ---- files ----------------------------------------------------------------------------------

def list_files(spark: SparkSession, patterns: list[str]) -> DataFrame:
    """path, size and time of change of the files of some globs; no file is opened."""
    found = spark.read.format("binaryFile").load(patterns)
    return found.select("path", F.col("length").alias("size"), F.col("modificationTime").cast("string").alias("modified"))


def take_in(spark: SparkSession, store: str, patterns: list[str],
            read: Callable[[SparkSession, list[str]], DataFrame]) -> int:
    """Add the sessions of the files that no batch has read yet; how many files these are. A
    known file that has changed is an error, as what it gave can't be taken out again."""
    known = ledger(spark, store).where("kind = 'file'").select("path", F.col("size").alias("old_size"),
                                                               F.col("modified").alias("old_modified"), "batch")
    files = list_files(spark, patterns).join(known, "path", "left").collect()  # the list Spark plans a scan from
    changed = sorted(f.path for f in files if f.batch is not None and (f.size, f.modified) != (f.old_size, f.old_modified))
    if changed:
        raise ValueError(f"files read earlier have changed: {changed[:5]}")
    new = sorted((f.path, f.size, f.modified) for f in files if f.batch is None)
    # a batch that was committed but not derived yet is found again by its id
    for batch in _underived(spark, store):
        _derive(spark, store, batch)
    if new:
        batch = "files-" + hashlib.sha256(repr(new).encode()).hexdigest()[:32]
        add_batch(read(spark, [path for path, _, _ in new]), store, batch,
                  spark.createDataFrame(new, "path string, size bigint, modified string"))
    return len(new)


def _underived(spark: SparkSession, store: str) -> list[str]:
    log = ledger(spark, store)
    done = log.where("kind = 'derived'").select("batch")
    return [r.batch for r in log.where("kind = 'batch'").select("batch").join(done, "batch", "left_anti").collect()]
