"""Bounded-overlap partitioning: windows over a long history in many tasks per server.

A window partitioned by server runs in as many tasks as there are servers. Here each server's
rows are dealt into chunks of consecutive positions, and a chunk also receives the ``halo``
positions before it, as far back as its windows look. Windows run per (server, chunk) and the
halo's rows, which belong to the chunk before, are dropped. With chunks of four halos a quarter of
the rows is copied, and no task holds more than ``size + halo`` positions of a server.

Positions are hours or days of the clock, or row and day numbers per server. Row numbers come
from two passes: rows per (server, chunk of time), then their running sum, a row's number being
its chunk's offset plus its place in the chunk. No task sees a server whole but for one row per
chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import DAY, bucket_index
from ..session import scratch_path

CHUNK, OWN = "_chunk", "_own"


def windows_by_chunk(df: DataFrame, server: str, position: Column, size: int, halo: int,
                     apply: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """``apply(rows, partition columns)`` on overlapping chunks of ``size`` positions (at least
    ``halo``), for the rows each chunk owns. ``apply``'s windows may look back ``halo`` positions."""
    if size < halo:
        raise ValueError("a chunk must be at least as long as its halo")
    own = F.floor(position / F.lit(size))
    last = F.floor((position + F.lit(halo)) / F.lit(size))  # the chunk whose halo the row is in
    # rows without a position have a chunk of their own
    chunks = F.when(own.isNull() | (own == last), F.array(own)).otherwise(F.array(own, last))
    rows = df.withColumn(OWN, own).withColumn(CHUNK, F.explode(chunks))
    out = apply(rows.repartition(server, CHUNK), [server, CHUNK])
    return out.where(F.col(OWN).eqNullSafe(F.col(CHUNK))).drop(OWN, CHUNK)


def numbered(df: DataFrame, server: str, order: str, days: str, chunk_days: int) -> DataFrame:
    """``df`` with ``_row``, the number of a row within its server by ``order`` (one row per value),
    and ``_day``, the number of its day (``days``) among those that have rows; both from 1.

    The rows are staged, as they are read twice."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    df.write.parquet(path)
    df = spark.read.schema(df.schema).parquet(path)
    chunk = F.floor(bucket_index(days, DAY) / F.lit(chunk_days))
    # a day is counted in the chunk it lies in; its rows meet in one place first
    per_day = df.groupBy(server, chunk.alias(CHUNK), F.col(days).alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    counts = per_day.groupBy(server, CHUNK).agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_days"))
    before = Window.partitionBy(server).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(server).alias("_s"), F.col(CHUNK).alias("_c"),
                            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"),
                            F.coalesce(F.sum("_days").over(before), F.lit(0)).alias("_days"))
    in_chunk = Window.partitionBy(server, CHUNK)
    rows = df.withColumn(CHUNK, chunk).withColumns({"_row": F.row_number().over(in_chunk.orderBy(order)),
                                                    "_day": F.dense_rank().over(in_chunk.orderBy(days))})
    same = rows[server].eqNullSafe(offsets["_s"]) & rows[CHUNK].eqNullSafe(offsets["_c"])
    return (rows.join(offsets, same).withColumns({"_row": F.col("_row") + F.col("_rows"), "_day": F.col("_day") + F.col("_days")})
            .drop("_s", "_c", "_rows", "_days", CHUNK))
