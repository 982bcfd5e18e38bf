"""JSON-lines records: scoring features in, predictions out (distributed, no driver copy)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines, one record per row, written by the tasks."""
    df.write.mode("overwrite").option("timestampNTZFormat", TIMESTAMP_FORMAT).json(path)


def read_records(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read records with a declared schema (no inference pass; unknown fields ignored)."""
    return (spark.read.schema(schema).option("mode", "PERMISSIVE")
            .option("timestampNTZFormat", TIMESTAMP_FORMAT).json(path))
