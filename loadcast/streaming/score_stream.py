"""Scoring as a Structured Streaming query.

Feature records (JSON lines, one file per request batch) land in an input folder; the
query scores every new file with the fitted pipeline and appends the predictions as
parquet. It is stateless, so each micro-batch is independent; the checkpoint folder makes
restarts exactly-once with respect to the input files.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.encode import prepare_for_index
from ..session import scratch_path
from ..sources.records import TIMESTAMP_FORMAT, write_records


def prediction_stream(spark: SparkSession, model: PipelineModel, in_dir: str, schema: StructType,
                      max_files_per_trigger: int = 100) -> DataFrame:
    """Streaming DataFrame of (ServerIP, SessionStartHourTime, prediction)."""
    records = (spark.readStream.schema(schema)
               .option("timestampNTZFormat", TIMESTAMP_FORMAT)
               .option("maxFilesPerTrigger", max_files_per_trigger)
               .json(in_dir))
    return model.transform(prepare_for_index(records)).select("ServerIP", "SessionStartHourTime", "prediction")


def start_scoring(spark: SparkSession, model: PipelineModel, in_dir: str, out_dir: str,
                  checkpoint: str, schema: StructType, available_now: bool = False):
    """Start the query: continuous micro-batches, or one drain of what is there now."""
    w = (prediction_stream(spark, model, in_dir, schema).writeStream
         .format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def score_files_once(spark: SparkSession, model: PipelineModel, features: DataFrame) -> DataFrame:
    """Write ``features`` as request files, drain them through the streaming scorer and
    return the predictions it wrote."""
    base = scratch_path(spark, "score-stream")
    write_records(features, f"{base}/in")
    q = start_scoring(spark, model, f"{base}/in", f"{base}/out", f"{base}/checkpoint",
                      features.schema, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out")
