"""Access to the parquet test tables.

The tables the pipeline reads have declared schemas: the scan then needs no footer-reading
job to infer one (a job per read, over every file, on a large dataset).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
              "props STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a test-data folder."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
