"""Frequency indexes as tables: levels ranked and joined by Spark, for columns of any width.

The levels of all columns are counted in one pass in long form (column, value, n). Their rank, by
falling count and then by name, is distributed: rows are dealt into ranges of (column, -n, value),
each knows its place in its range, and the running sum of the ranges' sizes makes it a rank. No task
and no driver holds the levels of a wide column; rows get their index by a join.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

ROWS_PER_RANGE = 500_000


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, group: str, order: list[F.Column]) -> DataFrame:
    """``rows`` with ``rank``, from 0, within ``group`` by ``order`` (which tells rows apart)."""
    spark = rows.sparkSession
    rows = _stored(rows, "rank-rows")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_RANGE))
    by = [F.col(group), *order]
    # number of the range and place within it, in one number
    placed = _stored(rows.repartitionByRange(ranges, *by).sortWithinPartitions(*by)
                     .withColumn("_at", F.monotonically_increasing_id()), "rank-placed")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(group, "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (placed.withColumn("_part", part).join(shifts, [group, "_part"])
            .withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift"))


def level_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n, index) of every level: index 0 is the most frequent, ties go by the value
    as text; stored. NULL is no level."""
    values = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = (df.select(F.explode(values).alias("l")).where("l.value IS NOT NULL")
              .groupBy("l.column", "l.value").agg(F.count(F.lit(1)).alias("n")))
    out = ranked(counts, "column", [F.col("n").desc(), F.col("value")])
    return _stored(out.select("column", "value", "n", F.col("rank").cast("double").alias("index")), "levels")


class LevelIndexer(Transformer, HasInputCol, HasOutputCol, HasHandleInvalid, DefaultParamsReadable, DefaultParamsWritable):
    """Index of a column by its table of levels (value, index), joined; a value that is no level is
    skipped, kept as the index ``size``, or an error."""

    table = Param(Params._dummy(), "table", "parquet table of value and index", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of levels", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="skip", table=None, size=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def levels(self) -> int:
        return self.getOrDefault(self.size)

    def with_params(self, **params) -> "LevelIndexer":
        return self.copy({getattr(self, k): v for k, v in params.items()})

    def _transform(self, df: DataFrame) -> DataFrame:
        out, mode = self.getOutputCol(), self.getHandleInvalid()
        levels = df.sparkSession.read.parquet(self.getOrDefault(self.table)).select(
            F.col("value").alias(f"{out}_value"), F.col("index").alias(out))
        rows = df.join(levels, F.col(self.getInputCol()).cast("string") == F.col(f"{out}_value"),
                       "inner" if mode == "skip" else "left").drop(f"{out}_value")
        if mode == "skip":
            return rows
        unseen = (F.lit(float(self.levels())) if mode == "keep"
                  else F.raise_error(F.concat(F.lit(f"{self.getInputCol()}: unseen level "), F.col(self.getInputCol()).cast("string"))))
        return rows.withColumn(out, F.coalesce(out, unseen.cast("double")))
