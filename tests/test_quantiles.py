"""Exact order statistics, label cuts from the data, and checks that a bad fit fails."""

import math
import random
import sys

import pytest
from pyspark.sql import functions as F

from conftest import SF_BIG, SF_MID, SF_SMALL
from loadcast.config import EVENTS_CUTS
from loadcast.operators.quantiles import order_statistics
from loadcast.plans import training as TR
from loadcast.queries import fit_checks, queries

R = random.Random(5)
FRACTIONS = [0.0, 0.001, 0.25, 1 / 3, 0.5, 2 / 3, 0.999, 1.0]
COLUMNS = {
    "uniform": [R.random() for _ in range(5000)],
    "skewed": [math.exp(R.gauss(0, 30)) for _ in range(3000)],
    "ties": [float(R.randrange(3)) for _ in range(1000)],
    "one": [7.5],
    "same": [-2.0] * 50,
    "wide": [-sys.float_info.max, sys.float_info.max, 0.0, 5e-324, -5e-324, 1e300, float("inf"), float("-inf")],
    "close": [1.0, 1.0 + 2 ** -52, 1.0 + 2 ** -51, 1.0] * 10,
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_order_statistics_are_values_of_their_rank(spark, name):
    values = COLUMNS[name]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(3)
    most = sys.float_info.max
    ranked = sorted(min(max(v, -most), most) for v in values)
    want = [ranked[max(1, math.ceil(round(q * len(ranked), 9))) - 1] for q in FRACTIONS]
    assert order_statistics(df, "x", FRACTIONS) == want


def test_no_values(spark):
    assert order_statistics(spark.createDataFrame([(None,)], "x double"), "x", [0.5, 0.9]) == [None, None]


@pytest.mark.parametrize("folder", [SF_SMALL, SF_MID, SF_BIG])
def test_every_class_has_rows_in_both_splits(spark, folder):
    rows = queries()["label_distribution"](spark, folder).collect()
    assert {(r.split, r.label) for r in rows} == {(s, c) for s in ("train", "test") for c in (1, 2, 3)}
    assert min(r.n for r in rows) >= 5


def test_a_constant_forest_fails_the_checks(spark):
    rows = [("train", label, float(guess)) for label, n in ((1, 40), (2, 30), (3, 30)) for guess in [1] * n]
    constant = spark.createDataFrame(rows, "split string, label int, prediction double")
    assert fit_checks(constant) == (False, False)
    assert fit_checks(constant.withColumn("prediction", F.col("label").cast("double"))) == (True, True)


def test_cuts_are_stored_with_the_model(spark):
    from loadcast.session import scratch_path
    from pyspark.ml import PipelineModel
    cfg = EVENTS_CUTS.with_(low=1.25, high=2.5)

    class Columns:
        only_indexed, encoded = ["year"], []

    path = scratch_path(spark, "info")
    TR.save_model(spark, PipelineModel(stages=[]), Columns, cfg, path)
    assert TR.config_from_info(TR.load_model(spark, path)[1]) == cfg
