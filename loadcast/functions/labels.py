"""Load label and null handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def load_label(load: Column, low: float, high: float) -> Column:
    """1 when NULL or <= low, 2 when <= high, else 3."""
    return (F.when(load.isNull() | (load <= F.lit(low)), F.lit(1))
            .when(load <= F.lit(high), F.lit(2))
            .otherwise(F.lit(3)))


def fill_numeric(df: DataFrame, columns: list[str], value=0) -> DataFrame:
    """Replace NULL by ``value`` in the numeric columns among ``columns``; others untouched."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = {c: F.coalesce(F.col(c), F.lit(value).cast(types[c]))
            for c in columns if c in types and isinstance(types[c], NumericType)}
    return df.withColumns(cols) if cols else df


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.na.drop(subset=keys)
