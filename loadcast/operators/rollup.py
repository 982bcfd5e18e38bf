"""Five-minute sums, hourly peak (arg-max) and daily means per server.

Scale notes. The five-minute rollup is the one aggregation over raw sessions: it runs as
a partial (map-side) hash aggregate before its shuffle on (server, bucket), so the shuffle
carries at most one row per server, bucket and map task whatever the raw volume, and a
hot server is spread over all of its buckets. Everything after it is bounded by
servers x time buckets, not by the number of sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DAILY_COLUMNS, FIVE_MIN_SUMS, PEAK_COLUMNS, PEAK_MEASURES
from ..functions.timegrid import DAY, FIVE_MINUTES, HOUR, epoch_seconds, floor_ts


def _rollup_exprs():
    aggs = [F.sum(src).alias(name) for name, src in FIVE_MIN_SUMS]
    aggs.insert(1, F.count(F.lit(1)).alias("NumSession"))
    return floor_ts("SessionStart", FIVE_MINUTES).alias("SessionStartFiveMin"), aggs


def five_min_rollup(sessions: DataFrame) -> DataFrame:
    """Per server and five-minute bucket: sum of the eight load measures and count(*)."""
    bucket, aggs = _rollup_exprs()
    return sessions.groupBy("ServerIP", bucket).agg(*aggs)


def merge_rollups(partials: DataFrame) -> DataFrame:
    """Five-minute sums of parts of a session log, added up: the rollup of the whole log. A sum
    is NULL only if it is in every part."""
    sums = ["SumTotalLoad", "NumSession", *[name for name, _ in FIVE_MIN_SUMS[1:]]]
    return partials.groupBy("ServerIP", "SessionStartFiveMin").agg(*[F.sum(c).alias(c) for c in sums])


def row_key(server: str, ts: str) -> F.Column:
    """``<server>_<yyyy-MM-dd HH:mm:ss>`` (NULL when either part is NULL)."""
    return F.concat(F.col(server), F.lit("_"), F.col(ts).cast("string"))


def hourly_peak(rollup: DataFrame) -> DataFrame:
    """Per server and hour, the five-minute row with the largest total load.

    A NULL total counts as 0 and ties go to the earliest bucket. The whole winning row is
    taken with one ``max_by`` on a (load, -bucket) ordering, so all measures come from the
    same bucket. Each group holds at most 12 buckets. Rows without a server or hour are
    dropped here.
    """
    keep, hour, best, out = _peak_exprs()
    # dealt by hour first: the arg-max then sorts once, not on both sides of its shuffle
    rows = rollup.where(keep).withColumn("SessionStartHourTime", hour).repartition("ServerIP", "SessionStartHourTime")
    return rows.groupBy("ServerIP", "SessionStartHourTime").agg(best).select(*out)


def _peak_exprs():
    load = F.coalesce(F.col("SumTotalLoad"), F.lit(0.0))
    order = F.struct(load.alias("l"), (-epoch_seconds("SessionStartFiveMin")).alias("t"))
    row = F.struct(load.alias("peakLoad"),
                   *[F.col(src).alias(name) for name, src in PEAK_MEASURES[1:]])
    keep = F.col("ServerIP").isNotNull() & F.col("SessionStartFiveMin").isNotNull()
    hour = floor_ts("SessionStartFiveMin", HOUR)
    out = [row_key("ServerIP", "SessionStartHourTime").alias("key"), F.col("ServerIP"),
           F.col("SessionStartHourTime"), *[F.col("p." + c).alias(c) for c in PEAK_COLUMNS]]
    return keep, hour, F.max_by(row, order).alias("p"), out


def with_day(hourly: DataFrame, ts: str = "SessionStartHourTime") -> DataFrame:
    return hourly.withColumn("SessionStartDay", floor_ts(ts, DAY))


def daily_mean(hourly: DataFrame) -> DataFrame:
    """Per server and day, the mean of each hourly peak measure."""
    if "SessionStartDay" not in hourly.columns:
        hourly = with_day(hourly)
    return (hourly.groupBy("ServerIP", "SessionStartDay")
            .agg(*[F.avg(p).alias(d) for p, d in zip(PEAK_COLUMNS, DAILY_COLUMNS)]))
