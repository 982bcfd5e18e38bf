"""Training feature table: sessions -> hourly peaks -> calendar, rolling and lag features
-> indexed, one-hot and scaled columns, written as parquet.

Physical plan, by design: one shuffle on (server, five-minute bucket) with a map-side
partial aggregate, one on (server, hour) for the hourly arg-max, and one on (server, chunk of
time), where the daily means, the rolling means and the lags all run. The number of tasks
grows with the history, not only with the number of servers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import (HEADER_SERVER_VALUE, INDEXED_COLUMNS, LAG_COLUMNS, PEAK_COLUMNS, ROLLING_COLUMNS,
                      SCALED_COLUMNS, RunConfig)
from ..functions.calendar import add_calendar
from ..functions.labels import fill_numeric
from ..functions.timegrid import DAY, HOUR, floor_ts, ntz
from ..operators.encode import FeatureModel, fit_features, scaled_columns
from ..operators.lags import hour_features
from ..operators.model import train_test
from ..operators.rollup import five_min_rollup, hourly_peak, with_day

HOUR_KEYS = ["key", "ServerIP", "SessionStartHourTime"]
CALENDAR_OUT = ["year", "month", "weekofyear", "dayofmonth", "hourofday", "dayofweek",
                "SessionStartDay", "linearTrend", "date", "Holiday", "BusinessHour", "Morning"]
HOURLY_FEATURE_COLUMNS = HOUR_KEYS + PEAK_COLUMNS + CALENDAR_OUT + ROLLING_COLUMNS + LAG_COLUMNS


def hourly_features(sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """One row per observed server-hour with calendar, rolling and lag features."""
    return features_of_hours(with_day(hourly_peak(five_min_rollup(sessions))), cfg)


def features_of_hours(hourly: DataFrame, cfg: RunConfig) -> DataFrame:
    """The same from hourly peaks (with their day).

    NULL lags (no history yet) become 0, as they are model inputs.
    """
    feats = hour_features(hourly, cfg.lag_mode)
    feats = add_calendar(feats, "SessionStartHourTime", cfg.train_begin)
    feats = fill_numeric(feats, ROLLING_COLUMNS + LAG_COLUMNS, 0)
    return feats.select(*HOURLY_FEATURE_COLUMNS)


def fit_rows(features: DataFrame, cfg: RunConfig) -> DataFrame:
    """Rows the indexer and scaler learn from: all rows (as the original ETL) or train only."""
    return features if cfg.fit_on == "all" else train_test(features, cfg)[0]


def encode_features(features: DataFrame, model: FeatureModel) -> DataFrame:
    """Indexed, one-hot and scaled columns; the raw lag inputs are replaced by scaled ones."""
    out = scaled_columns(model.transform(features))
    keep = [c for c in features.columns if c not in ROLLING_COLUMNS + LAG_COLUMNS]
    vectors = [c + "_encoded" for c in model.encoded]
    return out.select(*keep, *INDEXED_COLUMNS, *vectors, *SCALED_COLUMNS)


def stage_hourly_features(spark: SparkSession, sessions: DataFrame | None, cfg: RunConfig, path: str,
                          hourly: DataFrame | None = None) -> DataFrame:
    """Compute the hourly features once, from sessions or from hourly peaks at hand, and keep
    them as parquet in the shared folder.

    The fits (indexer, scaler) and the final write each read this table instead of
    recomputing from the raw sessions; it also cuts the lineage, so a lost executor
    costs re-reading a file split rather than re-aggregating the sessions.
    """
    feats = hourly_features(sessions, cfg) if hourly is None else features_of_hours(hourly, cfg)
    feats.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def row_counts(raw_sessions: DataFrame, cfg: RunConfig) -> DataFrame:
    """(metric, n) for the size of each stage, in one pass over the session log.

    Cleaning drops rows by server, a grouping key, so it commutes with the rollup; counts are
    kept per server-hour, then per server-day, then per server, each a sum of the one before.
    """
    split = F.col("hour") < ntz(cfg.test_split_start)
    roll = five_min_rollup(raw_sessions)
    clean = F.col("ServerIP").isNotNull() & (F.col("ServerIP") != HEADER_SERVER_VALUE)
    hours = roll.groupBy("ServerIP", floor_ts("SessionStartFiveMin", HOUR).alias("hour")).agg(
        F.sum("NumSession").alias("sessions"), F.count(F.lit(1)).alias("five_min_rows"))
    timed = F.col("hour").isNotNull()
    days = hours.groupBy("ServerIP", floor_ts("hour", DAY).alias("day")).agg(
        F.sum("sessions").alias("sessions"), F.sum("five_min_rows").alias("five_min_rows"),
        F.count_if(timed).alias("hourly_rows"), F.count_if(split).alias("train_rows"), F.count_if(~split).alias("test_rows"))
    servers = days.groupBy("ServerIP").agg(
        *[F.sum(c).alias(c) for c in ("sessions", "five_min_rows", "hourly_rows", "train_rows", "test_rows")],
        F.count("day").alias("server_days"))
    kept = lambda c: F.coalesce(F.sum(F.when(clean, F.col(c))), F.lit(0))
    total = servers.agg(
        F.coalesce(F.sum("sessions"), F.lit(0)).alias("sessions"), kept("sessions").alias("clean_sessions"),
        F.count_if(clean & (F.col("hourly_rows") > 0)).alias("servers"),
        *[kept(c).alias(c) for c in ("five_min_rows", "hourly_rows", "server_days", "train_rows", "test_rows")])
    return total.unpivot([], total.columns, "metric", "n")


def build_feature_table(spark: SparkSession, sessions: DataFrame | None, cfg: RunConfig, path: str,
                        hourly: DataFrame | None = None) -> tuple[FeatureModel, DataFrame]:
    """Fit the encoders, write the feature table to ``path`` and read it back."""
    feats = stage_hourly_features(spark, sessions, cfg, path + "-hourly", hourly)
    model = fit_features(fit_rows(feats, cfg), cfg.handle_invalid)
    encode_features(feats, model).write.mode("overwrite").parquet(path)
    return model, spark.read.parquet(path)
