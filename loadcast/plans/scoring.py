"""Statistics for scoring, 48-hour feature batch and batch prediction, for any set of servers.

The scorer appends the 48 hours to score to each server's stored hours and runs the same
lag, rolling-mean and calendar code over them as training does, on one partitioning by
server, so a server-hour gets the same features on both paths.
"""

from __future__ import annotations

import functools
import operator
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import LAG_COLUMNS, PEAK_COLUMNS, ROLLING_COLUMNS, SCORE_HOURS, RunConfig
from ..functions.calendar import add_calendar
from ..functions.labels import fill_numeric
from ..functions.timegrid import (DAY, HOUR, bucket_index, epoch_seconds, floor_ts, from_epoch_seconds, horizon, ntz,
                                  shift)
from ..operators.chunks import CHUNK, OWN, windows_by_chunk
from ..operators.encode import index_rows, level_numbers, prepare_for_index
from ..operators.lags import CHUNK_HALOS, LAG_DAYS, lags_within, rolling_within
from ..operators.levels import LevelIndexer
from ..operators.rollup import daily_mean, row_key, with_day
from ..session import scratch_path
from ..sources.sessions import filter_servers
from ..sources.stats_store import daily_stats, hourly_stats, of_months, read_stats, write_stats

SCORE_FEATURE_COLUMNS = (["key", "ServerIP", "SessionStartHourTime"] + LAG_COLUMNS + ROLLING_COLUMNS
                         + ["linearTrend", "dayofweek", "year", "month", "weekofyear", "dayofmonth",
                            "hourofday", "Holiday", "BusinessHour", "Morning"])


def write_statistics(hourly: DataFrame, hourly_path: str, daily_path: str) -> None:
    """Hourly peaks and their daily means, stored by (year, month).

    Both tables are merged into what is stored. The batch is staged first, so the sessions
    are aggregated once; the daily means are computed from the stored hours of the months
    that the batch touches, and of no others.
    """
    spark = hourly.sparkSession
    path = scratch_path(spark, "stats-batch")
    hourly_stats(hourly.drop("SessionStartDay")).write.parquet(path)
    months = write_stats(spark.read.parquet(path), hourly_path, ["ServerIP", "SessionStartHourTime"])
    if months:
        stored = of_months(spark.read.parquet(hourly_path), months).select(
            "ServerIP", "SessionStartHourTime", *PEAK_COLUMNS)
        write_stats(daily_stats(daily_mean(with_day(stored))), daily_path, ["ServerIP", "SessionStartDay"])


def stats_for_score(spark: SparkSession, hourly_path: str, daily_path: str, score_begin: str,
                    servers=None) -> tuple[DataFrame, DataFrame]:
    """Statistics rows inside the feature window, read from their months only."""
    h = horizon(score_begin)
    # The first, partial hour and day of the window count too.
    hs = read_stats(spark, hourly_path, _floor(h["feature_begin"], HOUR), h["feature_end"],
                    "SessionStartHourTime")
    ds = read_stats(spark, daily_path, _floor(h["feature_begin"], DAY), h["feature_end"],
                    "SessionStartDay")
    if servers is not None:
        hs, ds = filter_servers(hs, servers), filter_servers(ds, servers)
    return hs, ds


def _floor(ts: str, seconds: int) -> str:
    t = datetime.strptime(ts, "%Y-%m-%d %H:%M:%S")
    secs = int((t - datetime(1970, 1, 1)).total_seconds())
    return shift("1970-01-01 00:00:00", secs - secs % seconds)


def score_features(hs: DataFrame, cfg: RunConfig, servers: DataFrame | None = None) -> DataFrame:
    """Feature rows for the 48 scored hours of every server in ``servers`` (a DataFrame of
    ``ServerIP``), whether or not it has statistics; by default of every server in ``hs``.

    ``hs`` is read once and shuffled once, by server. The first, partial day of the window
    lies before every rolling frame, so daily means of the window's hours are the stored ones.
    """
    h = horizon(cfg.score_begin)
    begin, end = ntz(h["score_begin"]), ntz(h["score_end"])
    hour = F.col("SessionStartHourTime")
    ahead = F.sequence(begin, floor_ts(end, HOUR), F.make_dt_interval(hours=F.lit(1)))
    rows = hs.where(hour < begin).select("ServerIP", "SessionStartHourTime", *PEAK_COLUMNS)
    if servers is not None:
        scored = servers.select("ServerIP").distinct().select("ServerIP", F.explode(ahead).alias("SessionStartHourTime"))
        rows = rows.unionByName(scored, allowMissingColumns=True).repartition("ServerIP")
    else:
        # each server's first row also brings the hours to score; explode keeps the partitioning
        first = F.row_number().over(Window.partitionBy("ServerIP").orderBy("SessionStartHourTime")) == 1
        own = F.array(hour)
        rows = rows.repartition("ServerIP").withColumn("_hour", F.when(first, F.concat(own, ahead)).otherwise(own))
        rows = rows.withColumn("SessionStartHourTime", F.explode("_hour")).drop("_hour")
        rows = rows.withColumns({c: F.when(hour < begin, F.col(c)) for c in PEAK_COLUMNS})
    by = ["ServerIP"]  # the window is a month long
    out = rolling_within(lags_within(with_day(rows), "calendar", by), "calendar", by).where(hour >= begin)
    out = add_calendar(out, "SessionStartHourTime", cfg.train_begin)
    out = out.withColumn("key", row_key("ServerIP", "SessionStartHourTime"))
    out = fill_numeric(out, LAG_COLUMNS + ROLLING_COLUMNS + ["linearTrend"], 0)
    return out.select(*SCORE_FEATURE_COLUMNS)


def score_backtest(hourly: DataFrame, cfg: RunConfig, first: str, last: str, every: int = DAY) -> DataFrame:
    """Feature rows as ``score_features`` would have given them at many past moments: for each origin
    ``first``, ``first + every`` .. ``last`` (seconds) and each server with an hour in the window
    before it, the 48 hours from the origin, with the column ``score_begin``.

    One scan and one shuffle, whatever the number of origins: a server's hours are dealt into
    chunks that overlap by the window, and an origin is scored in its own chunk. It is brought up by
    the server's last hour before it, so once. All lags and rolling days end 48 hours and two days
    before a scored hour, that is before its origin, so that the windows over all hours see none
    that the origin could not have seen; lags and days of the window's length reach no further back
    than it.
    """
    h = horizon(first)
    t, begin = F.col("SessionStartHourTime"), epoch_seconds(ntz(first))
    reach = int((datetime.fromisoformat(first) - datetime.fromisoformat(_floor(h["feature_begin"], HOUR))).total_seconds())
    steps = F.floor((epoch_seconds(ntz(last)) - begin) / F.lit(every))
    size = CHUNK_HALOS * LAG_DAYS

    def apply(rows: DataFrame, by: list[str]) -> DataFrame:
        following = F.lead(epoch_seconds(t)).over(Window.partitionBy(*by).orderBy(t))
        chunk_end = (F.col(CHUNK) + 1) * F.lit(size * DAY) - 1
        # origins after this hour, up to the next hour, within the window and the chunk
        rows = rows.withColumn("_until", F.least(F.coalesce(following, chunk_end), epoch_seconds(t) + F.lit(reach), chunk_end))
        chunk_begin = F.col(CHUNK) * F.lit(size * DAY)
        low = F.greatest(F.floor((epoch_seconds(t) - begin) / F.lit(every)) + 1, F.lit(0),
                         F.ceil((chunk_begin - begin) / F.lit(every)))
        high = F.least(F.floor((F.col("_until") - begin) / F.lit(every)), steps)
        rows = rows.withColumn("_origins", F.when(low <= high, F.transform(
            F.sequence(low, high), lambda i: begin + i * F.lit(every))).otherwise(F.array().cast("array<bigint>")))
        # the row itself, and each origin's hours
        hours = F.flatten(F.transform("_origins", lambda o: F.transform(
            F.sequence(F.lit(0), F.lit(SCORE_HOURS - 1)), lambda k: F.struct(o.alias("o"), (o + k * HOUR).alias("t")))))
        own = F.array(F.struct(F.lit(None).cast("bigint").alias("o"), epoch_seconds(t).alias("t")))
        rows = rows.withColumn("_at", F.explode(F.concat(own, hours))).drop("_origins", "_until")
        scored = F.col("_at.o").isNotNull()
        rows = rows.withColumns({"score_begin": from_epoch_seconds(F.col("_at.o")),
                                 "SessionStartHourTime": from_epoch_seconds(F.col("_at.t")),
                                 OWN: F.when(scored, F.col(CHUNK)).otherwise(F.col(OWN)),
                                 **{c: F.when(~scored, F.col(c)) for c in PEAK_COLUMNS}}).drop("_at")
        return rolling_within(lags_within(with_day(rows), "calendar", by), "calendar", by)

    rows = hourly.select("ServerIP", "SessionStartHourTime", *PEAK_COLUMNS)
    out = windows_by_chunk(rows, "ServerIP", bucket_index("SessionStartHourTime", DAY), size, LAG_DAYS, apply)
    out = add_calendar(out.where(F.col("score_begin").isNotNull()), "SessionStartHourTime", cfg.train_begin)
    out = out.withColumn("key", row_key("ServerIP", "SessionStartHourTime"))
    out = fill_numeric(out, LAG_COLUMNS + ROLLING_COLUMNS + ["linearTrend"], 0)
    return out.select("score_begin", *SCORE_FEATURE_COLUMNS)


def score_batch(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Predicted load class per server-hour (rows with unseen levels are skipped)."""
    return model.transform(prepare_for_index(features)).select("ServerIP", "SessionStartHourTime", "prediction")


def server_frame(spark: SparkSession, servers) -> DataFrame | None:
    """A list of servers, or a DataFrame that holds ``ServerIP``, as a DataFrame."""
    if servers is None or isinstance(servers, DataFrame):
        return servers
    return spark.createDataFrame([(s,) for s in servers], "ServerIP string")


def features_for_scoring(spark: SparkSession, cfg: RunConfig, hourly_path: str, daily_path: str,
                         servers=None) -> DataFrame:
    """Feature rows from the stored statistics, for the given servers or for all stored ones."""
    hs, _ = stats_for_score(spark, hourly_path, daily_path, cfg.score_begin, servers)
    return score_features(hs, cfg, server_frame(spark, servers))


def run_scoring(spark: SparkSession, model: PipelineModel, cfg: RunConfig, hourly_path: str,
                daily_path: str, servers=None) -> tuple[DataFrame, DataFrame]:
    """(predictions, coverage) for the 48 hours from ``cfg.score_begin`` of the given servers
    (a list or a one-column DataFrame of ``ServerIP``), or of every server in the statistics.
    Coverage counts the rows asked for, scored, and skipped for an unseen level."""
    feats = features_for_scoring(spark, cfg, hourly_path, daily_path, servers)
    path = scratch_path(spark, "score-features")
    feats.write.parquet(path)
    feats = spark.read.parquet(path)
    indexers = [s for s in model.stages if isinstance(s, (StringIndexerModel, LevelIndexer))]
    return score_batch(model, feats), score_coverage(indexers, feats)


def score_coverage(indexers: list, features: DataFrame) -> DataFrame:
    """(metric, n): feature rows, rows the model scores, rows it skips for an unseen level
    (none when the indexers keep unseen levels).

    One pass: copies of the fitted indexers that keep unseen values map them to the extra
    index past the levels; a row is skipped when any of its columns gets that index."""
    strict = indexers[0].getHandleInvalid() != "keep"
    keep = [i.copy({i.handleInvalid: "keep"}) for i in indexers]
    idx = index_rows(prepare_for_index(features), keep)
    unseen = functools.reduce(operator.or_, [F.col(c) >= F.lit(float(n)) for c, n in level_numbers(keep).items()])
    counts = idx.agg(F.count(F.lit(1)).alias("feature_rows"),
                     F.count(F.when(~unseen | F.lit(not strict), 1)).alias("scored_rows"),
                     F.count(F.when(unseen & F.lit(strict), 1)).alias("skipped_rows"))
    return counts.unpivot([], counts.columns, "metric", "n")
