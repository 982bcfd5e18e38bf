"""Label, split, fit the forest, evaluate, and save/load the whole scoring model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SCALED_COLUMNS, RunConfig
from ..operators.encode import FEATURES, FeatureModel
from ..operators.levels import LevelIndexer
from ..operators.model import add_label, classification_metrics, fit_forest, split_column, train_test
from ..operators.quantiles import order_statistics


def table_assembler(fm: FeatureModel) -> VectorAssembler:
    """Feature vector from the stored table; equal to the one the scoring pipeline builds."""
    cols = ["linearTrend"] + fm.only_indexed + [c + "_encoded" for c in fm.encoded] + SCALED_COLUMNS
    return VectorAssembler(inputCols=cols, outputCol=FEATURES)


def with_cuts(table: DataFrame, cfg: RunConfig) -> RunConfig:
    """``cfg`` with the label cuts of its ``label_quantiles``, exact percentiles of the peak load over
    the train split of a stored table; ``cfg`` itself if it has fixed cuts."""
    if cfg.label_quantiles is None:
        return cfg
    low, high = order_statistics(train_test(table, cfg)[0], "peakLoad", list(cfg.label_quantiles))
    if low is None:
        raise ValueError("the train split has no rows to take label cuts from")
    return cfg.with_(low=low, high=high)


def labelled(table: DataFrame, cfg: RunConfig) -> DataFrame:
    """Adds the load class ``label`` and the ``split`` ("train" / "test")."""
    return add_label(table, cfg).withColumn("split", split_column(cfg))


def train(table: DataFrame, fm: FeatureModel, cfg: RunConfig):
    """Fit the forest on the train split. Returns (scoring PipelineModel, forest)."""
    data = table_assembler(fm).transform(labelled(table, cfg))
    rf = fit_forest(train_test(data, cfg)[0].select("features", "label"))
    return PipelineModel(stages=fm.stages() + [rf]), rf


def predictions(table: DataFrame, rf, fm: FeatureModel, cfg: RunConfig) -> DataFrame:
    """Forest predictions for every row of the feature table, with its split and label."""
    data = table_assembler(fm).transform(labelled(table, cfg))
    return rf.transform(data).select("key", "ServerIP", "SessionStartHourTime", "split", "label",
                                     F.col("prediction"))


def evaluate(pred: DataFrame) -> DataFrame:
    """Accuracy, weighted precision, weighted recall and F1 per split."""
    return classification_metrics(pred, ["split"])


# ---- persistence: the fitted pipeline plus a one-row run-info dataset -------------------

INFO_SCHEMA = ("trainBegin string, trainEnd string, testSplitStart string, low double, high double, lagMode string, "
               "fitOn string, handleInvalid string, scoreBegin string, dataFile string, duration string, "
               "labelQuantiles array<double>, columnOnlyIndexed array<string>, columnForEncode array<string>")


def save_model(spark: SparkSession, model: PipelineModel, fm: FeatureModel, cfg: RunConfig, path: str,
               data_file: str | None = None) -> None:
    """``path/pipeline``: the fitted stages; ``path/info``: run config, data path, duration and
    column lists (one JSON row)."""
    stages = [_own_levels(spark, s, path) for s in model.stages]
    PipelineModel(stages=stages).write().overwrite().save(f"{path}/pipeline")
    info = {"trainBegin": cfg.train_begin, "trainEnd": cfg.train_end,
            "testSplitStart": cfg.test_split_start, "low": cfg.low, "high": cfg.high,
            "lagMode": cfg.lag_mode, "fitOn": cfg.fit_on, "handleInvalid": cfg.handle_invalid,
            "scoreBegin": cfg.score_begin or "", "dataFile": data_file or "", "duration": cfg.duration,
            "labelQuantiles": list(cfg.label_quantiles or []), "columnOnlyIndexed": fm.only_indexed, "columnForEncode": fm.encoded}
    spark.createDataFrame([info], INFO_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/info")


def _own_levels(spark: SparkSession, stage, path: str):
    """An indexer of a wide column with its table of levels stored beside the model."""
    if not isinstance(stage, LevelIndexer):
        return stage
    own, table = f"{path}/levels/{stage.getInputCol()}", stage.getOrDefault(stage.table)
    if table != own:
        spark.read.parquet(table).write.mode("overwrite").parquet(own)
    return stage.with_params(table=own)


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    """Inverse of ``save_model``: (pipeline, run info dict)."""
    info = spark.read.schema(INFO_SCHEMA).json(f"{path}/info").first().asDict()
    return PipelineModel.load(f"{path}/pipeline"), info


def config_from_info(info: dict) -> RunConfig:
    """The run config that was stored with a model or with encoders."""
    return RunConfig(info["trainBegin"], info["trainEnd"], info["testSplitStart"], low=info["low"], high=info["high"],
                     score_begin=info.get("scoreBegin") or None, lag_mode=info["lagMode"],
                     fit_on=info.get("fitOn", "all"), handle_invalid=info.get("handleInvalid", "skip"),
                     label_quantiles=tuple(info.get("labelQuantiles") or []) or None)


def save_features(spark: SparkSession, fm: FeatureModel, cfg: RunConfig, path: str,
                  data_file: str | None = None) -> None:
    """The fitted encoders (indexer, encoder, scaler) and their column lists."""
    save_model(spark, fm.pipeline(), fm, cfg, path, data_file)


def load_features(spark: SparkSession, path: str) -> tuple[FeatureModel, dict]:
    """Inverse of ``save_features``."""
    from pyspark.ml.feature import OneHotEncoderModel, StandardScalerModel, StringIndexerModel
    pipe, info = load_model(spark, path)
    stages = pipe.stages
    indexers = [s for s in stages if isinstance(s, (StringIndexerModel, LevelIndexer))]
    encoder = next((s for s in stages if isinstance(s, OneHotEncoderModel)), None)
    scaler = next(s for s in stages if isinstance(s, StandardScalerModel))
    fm = FeatureModel(indexers, encoder, scaler, list(info["columnOnlyIndexed"]), list(info["columnForEncode"]))
    return fm, info


def train_from_table(spark: SparkSession, table: DataFrame, fm: FeatureModel, cfg: RunConfig,
                     model_path: str, data_file: str | None = None) -> DataFrame:
    """Forest on a stored feature table; model saved; metrics per split returned."""
    cfg = with_cuts(table, cfg)
    model, rf = train(table, fm, cfg)
    save_model(spark, model, fm, cfg, model_path, data_file)
    return evaluate(predictions(table, rf, fm, cfg))


def run_training(spark: SparkSession, sessions: DataFrame, cfg: RunConfig, feature_path: str,
                 model_path: str, data_file: str | None = None) -> DataFrame:
    """Feature table -> forest -> metrics per split; model and run info saved.

    Returns the metrics (one row per split)."""
    from .features import build_feature_table
    fm, table = build_feature_table(spark, sessions, cfg, feature_path)
    return train_from_table(spark, table, fm, cfg, model_path, data_file)
