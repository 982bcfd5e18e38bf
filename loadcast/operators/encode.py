"""Frequency indexing, one-hot encoding, scaling and assembly of the feature vector.

The levels of all ten categorical columns are counted and ranked in a single pass (``levels``);
``StandardScaler`` fits in one summary pass. Columns with fewer than two levels stay as
plain indexes (the encoder cannot take them), the others are one-hot encoded with the
last level dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (OneHotEncoder, OneHotEncoderModel, StandardScaler,
                                StandardScalerModel, StringIndexerModel,
                                VectorAssembler, VectorSizeHint)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (FLAG_COLUMNS, CALENDAR_INT_COLUMNS, INDEX_COLUMNS, INDEXED_COLUMNS,
                      SCALED_COLUMNS, SCALED_INPUTS)
from ..functions.labels import fill_numeric
from ..session import scratch_path
from .levels import LevelIndexer, level_table

LAG_VECTOR = "lagFeatures"
SCALED_VECTOR = "scaledFeatures"
FEATURES = "features"


def prepare_for_index(df: DataFrame) -> DataFrame:
    """NULL lags and numeric categorical values -> 0, so neither assembly nor indexing fails."""
    return fill_numeric(df, SCALED_INPUTS + CALENDAR_INT_COLUMNS + FLAG_COLUMNS + ["linearTrend"], 0)


NARROW = 10_000  # levels of a column that a model keeps as a list


def fit_indexers(df: DataFrame, handle_invalid: str = "skip", narrow: int = NARROW) -> list[StringIndexerModel | LevelIndexer]:
    """One indexer a column: levels by descending frequency, ties alphabetical (numbers compare as
    strings). A column of at most ``narrow`` levels keeps them as a list, a wider one as a table,
    which never leaves Spark."""
    table = level_table(df, INDEX_COLUMNS)
    sizes = {r.column: r.n for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    lists: dict[str, list[str]] = {c: [] for c in INDEX_COLUMNS if sizes.get(c, 0) <= narrow}
    for r in table.where(F.col("column").isin(list(lists))).orderBy("column", "index").collect():  # at most narrow a column
        lists[r.column].append(r.value)
    out = []
    for c in INDEX_COLUMNS:
        names = {"inputCol": c, "outputCol": c + "_indexed", "handleInvalid": handle_invalid}
        if c in lists:
            out.append(StringIndexerModel.from_labels(lists[c], **names))
        else:
            path = scratch_path(df.sparkSession, "level-index")
            table.where(F.col("column") == c).select("value", "index").write.parquet(path)
            out.append(LevelIndexer(**names, table=path, size=sizes[c]))
    return out


def level_numbers(indexers: list) -> dict[str, int]:
    """Levels of every indexed column."""
    return {i.getOutputCol(): i.levels() if isinstance(i, LevelIndexer) else len(i.labels) for i in indexers}


def index_rows(df: DataFrame, indexers: list) -> DataFrame:
    for stage in indexers:
        df = stage.transform(df)
    return df


def split_by_levels(indexers: list) -> tuple[list[str], list[str]]:
    """(index-only columns, columns to encode), by their number of fitted levels."""
    only, encode = [], []
    for col, levels in level_numbers(indexers).items():
        (encode if levels >= 2 else only).append(col)
    return only, encode


def fit_encoder(indexed: DataFrame, encode: list[str], handle_invalid: str = "skip") -> OneHotEncoderModel | None:
    """One-hot with the last level dropped. Only when the indexer keeps unseen levels (as
    an extra index) does the encoder keep them too, as an all-zero vector."""
    if not encode:
        return None
    return OneHotEncoder(inputCols=encode, outputCols=[c + "_encoded" for c in encode], dropLast=True,
                         handleInvalid="keep" if handle_invalid == "keep" else "error").fit(indexed)


def lag_assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=SCALED_INPUTS, outputCol=LAG_VECTOR)


def fit_scaler(assembled: DataFrame) -> StandardScalerModel:
    """Divide by the sample standard deviation, no centring (a constant column -> 0)."""
    return StandardScaler(inputCol=LAG_VECTOR, outputCol=SCALED_VECTOR,
                          withStd=True, withMean=False).fit(assembled)


def feature_inputs(only: list[str], encode: list[str]) -> list[str]:
    """Model inputs: trend, index-only columns, one-hot vectors, then the scaled lags."""
    return ["linearTrend"] + only + [c + "_encoded" for c in encode] + [SCALED_VECTOR]


@dataclass
class FeatureModel:
    """Fitted encoding stages and the column lists the model input depends on."""

    indexers: list[StringIndexerModel | LevelIndexer]
    encoder: OneHotEncoderModel | None
    scaler: StandardScalerModel
    only_indexed: list[str]
    encoded: list[str]

    def index(self, df: DataFrame) -> DataFrame:
        """The index columns."""
        return index_rows(prepare_for_index(df), self.indexers)

    def stages(self) -> list:
        st = list(self.indexers)
        if self.encoder is not None:
            st.append(self.encoder)
        # The size hint lets the final assembly run on streaming input as well.
        st += [lag_assembler(), self.scaler,
               VectorSizeHint(inputCol=SCALED_VECTOR, size=len(SCALED_INPUTS), handleInvalid="error"),
               VectorAssembler(inputCols=feature_inputs(self.only_indexed, self.encoded),
                               outputCol=FEATURES)]
        return st

    def pipeline(self) -> PipelineModel:
        return PipelineModel(stages=self.stages())

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline().transform(prepare_for_index(df))


def fit_features(fit_rows: DataFrame, handle_invalid: str = "skip", narrow: int = NARROW) -> FeatureModel:
    """Fit indexer, encoder and scaler on ``fit_rows``."""
    rows = prepare_for_index(fit_rows)
    indexers = fit_indexers(rows, handle_invalid, narrow)
    only, encode = split_by_levels(indexers)
    indexed = index_rows(rows, indexers)
    encoder = fit_encoder(indexed, encode, handle_invalid)
    scaler = fit_scaler(lag_assembler().transform(indexed))
    return FeatureModel(indexers, encoder, scaler, only, encode)


def scaled_columns(df: DataFrame, vector: str = SCALED_VECTOR) -> DataFrame:
    """Unpack the scaled vector into one double column per lag: ``scaled<lag>``."""
    arr = vector_to_array(F.col(vector))
    return df.withColumns({name: arr[i] for i, name in enumerate(SCALED_COLUMNS)})


def one_hot_long(indexed: DataFrame, model: FeatureModel, key: str = "key") -> DataFrame:
    """Long form of the one-hot encoding: (key, feature, position, value) for each set slot.

    A value's slot is its index; the last level has none. Taken from the index columns, so a
    row makes one entry per feature however many levels there are."""
    levels = level_numbers(model.indexers)
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("int").alias("position"),
                                 F.lit(levels[c] - 1).alias("last")) for c in model.encoded])
    return (indexed.select(F.col(key), F.explode(entries).alias("e")).where("e.position < e.last")
            .select(F.col(key), "e.feature", "e.position", F.lit(1.0).alias("value")))


def vector_entries(df: DataFrame, vector: str = FEATURES, key: str = "key") -> DataFrame:
    """(key, position, value) of the non-zero slots of a vector column, sparse or dense."""
    v = F.unwrap_udt(F.col(vector))
    sparse = F.arrays_zip(v["indices"].alias("position"), v["values"].alias("value"))
    dense = F.transform(v["values"], lambda x, i: F.struct(i.alias("position"), x.alias("value")))
    entries = F.when(v["type"] == 0, sparse).otherwise(dense)
    return (df.select(F.col(key), F.explode(entries).alias("e")).where("e.value <> 0")
            .select(F.col(key), "e.position", "e.value"))
