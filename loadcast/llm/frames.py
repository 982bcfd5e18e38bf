"""Shared Spark helpers of the operators: table access, staging, bucket counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows (of bounded size) that one hash bucket is planned to hold: its task's state stays
# within some tens of megabytes whatever the input.
ROWS_PER_BUCKET = 200_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir`` (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder of ``spark.checkpoint.dir`` and read again: cuts
    the lineage with a copy that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_count(spark: SparkSession, rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Hash buckets for ``rows`` rows: at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_bucket))


def map_keyed(rows: DataFrame, key: str, run: Callable, schema: str) -> DataFrame:
    """``rows.mapInPandas(run, schema)`` with the bigint column ``key`` carried as text: pandas holds
    a batch's integers as doubles when one of them is null, and those lose digits above 2 ** 53.
    ``run`` passes ``key`` on as it gets it."""
    fields = schema.split(", ")
    fields[fields.index(f"{key} bigint")] = f"{key} string"
    out = rows.withColumn(key, F.col(key).cast("string")).mapInPandas(run, ", ".join(fields))
    return out.withColumn(key, F.col(key).cast("bigint"))


def free_name(base: str, taken: list[str]) -> str:
    """``base``, or a longer name that no column in ``taken`` has."""
    while base.lower() in {c.lower() for c in taken}:
        base += "_"
    return base


def pick_rows(docs: DataFrame, picks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``picks`` (id, digest of the whole text, n_keep) names, one row for
    each. Names with one row, nearly all, are a semi-join; rows of the same id and text are reduced
    to one in a second, separate branch, so that the other texts are moved once."""
    mine, theirs = free_name("text_digest", docs.columns), free_name("pick_digest", docs.columns)
    pick_id = free_name("pick_id", docs.columns)
    picks = picks.select(F.col("id").alias(pick_id), F.col("digest").alias(theirs), "n_keep")
    tagged = docs.withColumn(mine, F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)))

    def staying(which: DataFrame) -> DataFrame:
        which = which.select(pick_id, theirs)
        return tagged.join(which, F.col("doc_id").eqNullSafe(F.col(pick_id)) & (F.col(mine) == F.col(theirs)), "left_semi")

    once, repeated = staying(picks.where("n_keep = 1")), picks.where("n_keep > 1")
    if repeated.isEmpty():
        return once.drop(mine)
    return once.unionByName(staying(repeated).dropDuplicates(["doc_id", mine])).drop(mine)


def attach_by_group(rows: DataFrame, key: str, salt: str, decisions: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``decisions`` (one row per ``key``), without gathering a
    hot key: each (key, salt) that occurs gets its own copy of the decision, so a key's
    rows spread over as many reducers as it has salts."""
    parts = rows.select(key, salt).distinct()
    return rows.join(parts.join(decisions, key), [key, salt])
