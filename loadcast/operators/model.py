"""Label, chronological split, random forest and classification metrics."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import RF_MAX_DEPTH, RF_NUM_TREES, RF_SEED, RunConfig
from ..functions.labels import load_label
from ..functions.timegrid import ntz

METRICS = ["accuracy", "weightedPrecision", "weightedRecall", "f1"]


def add_label(df: DataFrame, cfg: RunConfig, load: str = "peakLoad") -> DataFrame:
    """Adds ``label``: the load class (1, 2, 3) of ``load`` under the run's thresholds."""
    return df.withColumn("label", load_label(F.col(load), cfg.low, cfg.high))


def split_column(cfg: RunConfig, ts: str = "SessionStartHourTime") -> F.Column:
    """"train" before the run's split start, "test" from it on."""
    return F.when(F.col(ts) < ntz(cfg.test_split_start), F.lit("train")).otherwise(F.lit("test"))


def train_test(df: DataFrame, cfg: RunConfig, ts: str = "SessionStartHourTime"):
    """Rows before the split start train; rows from it on test."""
    start = ntz(cfg.test_split_start)
    return df.where(F.col(ts) < start), df.where(F.col(ts) >= start)


def forest(features: str = "features", label: str = "label") -> RandomForestClassifier:
    """100 trees, depth 8, gini, 32 bins, seed 42. Node ids are cached between levels
    (checkpointed every 10 iterations to the shared folder), so deep trees do not
    re-route every row from the root at each level; the fitted trees are the same."""
    return RandomForestClassifier(numTrees=RF_NUM_TREES, maxDepth=RF_MAX_DEPTH, seed=RF_SEED,
                                  impurity="gini", maxBins=32, cacheNodeIds=True, checkpointInterval=10,
                                  featuresCol=features, labelCol=label)


def fit_forest(train: DataFrame) -> RandomForestClassificationModel:
    return forest().fit(train)


def evaluator_metrics(pred: DataFrame, label: str = "label") -> dict[str, float]:
    """The four metrics from ``MulticlassClassificationEvaluator`` (one job each)."""
    ev = MulticlassClassificationEvaluator(predictionCol="prediction", labelCol=label)
    return {m: ev.evaluate(pred, {ev.metricName: m}) for m in METRICS}


def classification_metrics(pred: DataFrame, group: list[str] | None = None,
                           label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and label-frequency-weighted precision, recall and F1 per group.

    Same definitions as ``MulticlassClassificationEvaluator``. One aggregation reduces the
    predictions to confusion cells (group, label, prediction, n); windows over those few
    cells give each class's label and prediction counts; one more aggregation sums the
    diagonal. A class with no correct prediction has precision, recall and F1 of 0, so it
    adds nothing to the weighted sums and needs no row of its own.
    """
    g = list(group or [])
    cells = (pred.groupBy(*g, F.col(label).cast("double").alias("y"),
                          F.col(prediction).cast("double").alias("p"))
             .agg(F.count(F.lit(1)).alias("n")))
    by_g = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    cells = cells.withColumns({
        "total": F.sum("n").over(by_g),
        "label_n": F.sum("n").over(Window.partitionBy(*g, "y")),
        "pred_n": F.sum("n").over(Window.partitionBy(*g, "p")),
    })
    hit = F.col("y") == F.col("p")
    prec, rec = F.col("n") / F.col("pred_n"), F.col("n") / F.col("label_n")
    w = F.col("label_n") / F.col("total")
    f1 = 2 * prec * rec / (prec + rec)
    zero = F.lit(0.0)
    return cells.groupBy(*g).agg(
        (F.sum(F.when(hit, F.col("n")).otherwise(0)) / F.first("total")).alias("accuracy"),
        F.sum(F.when(hit, w * prec).otherwise(zero)).alias("weightedPrecision"),
        F.sum(F.when(hit, w * rec).otherwise(zero)).alias("weightedRecall"),
        F.sum(F.when(hit, w * f1).otherwise(zero)).alias("f1"))
