"""Frequency indexes as tables: wide columns, persistence, unseen levels."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadcast.config import EVENTS_CUTS, INDEXED_COLUMNS
from loadcast.operators import encode as E
from loadcast.operators.levels import LevelIndexer, level_table
from loadcast.plans import features as FT
from loadcast.plans import training as TR
from loadcast.queries import sessions
from loadcast.session import scratch_path


def test_a_column_of_many_levels_is_ranked_without_the_driver(spark):
    """400,000 levels and a hot one: ranks equal those of one window."""
    rows = spark.range(900_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") * 7919 % 400_009).cast("string")))
        .alias("ServerIP"), (F.col("id") % 2).alias("flag"))
    got = level_table(rows, ["ServerIP", "flag"])
    counts = rows.groupBy(F.col("ServerIP").alias("value")).agg(F.count("*").alias("n"))
    want = counts.withColumn("want", F.row_number().over(Window.orderBy(F.col("n").desc(), "value")) - 1)
    both = got.where("column = 'ServerIP'").join(want, ["value", "n"], "full")
    assert both.where("index IS DISTINCT FROM CAST(want AS DOUBLE)").isEmpty() and both.count() > 390_000
    assert [(r["value"], r["index"]) for r in got.where("column = 'flag'").orderBy("index").collect()] == [("0", 0.0), ("1", 1.0)]


@pytest.fixture(scope="module")
def feats(spark):
    return FT.stage_hourly_features(spark, sessions(spark, SF_SMALL), EVENTS_CUTS, scratch_path(spark, "lv-feats"))


def test_tables_and_lists_give_the_same_features(spark, feats):
    lists, tables = E.fit_features(feats), E.fit_features(feats, narrow=4)
    assert sum(isinstance(i, LevelIndexer) for i in tables.indexers) >= 4
    assert (lists.only_indexed, lists.encoded) == (tables.only_indexed, tables.encoded)
    a, b = (E.vector_entries(m.transform(feats)) for m in (lists, tables))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    a, b = (E.one_hot_long(m.index(feats), m) for m in (lists, tables))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_tables_are_stored_with_the_model(spark, feats):
    fm = E.fit_features(feats, narrow=4)
    path = scratch_path(spark, "lv-model")
    TR.save_features(spark, fm, EVENTS_CUTS.with_(low=1.0, high=2.0), path)
    loaded, _ = TR.load_features(spark, path)
    stored = [i for i in loaded.indexers if isinstance(i, LevelIndexer)]
    assert stored and all(i.getOrDefault(i.table).startswith(path) for i in stored)
    assert loaded.index(feats).select("key", *INDEXED_COLUMNS).exceptAll(fm.index(feats).select("key", *INDEXED_COLUMNS)).isEmpty()
    TR.save_features(spark, loaded, EVENTS_CUTS.with_(low=1.0, high=2.0), path)  # onto itself
    assert isinstance(TR.load_model(spark, path)[0], PipelineModel)


def test_unseen_levels(spark):
    path = scratch_path(spark, "lv")
    spark.createDataFrame([("a", 0.0), ("b", 1.0)], "value string, index double").write.parquet(path)
    rows = spark.createDataFrame([("a",), ("x",), (None,)], "v string")

    def run(mode):
        out = LevelIndexer(inputCol="v", outputCol="i", handleInvalid=mode, table=path, size=2).transform(rows)
        return sorted((str(r.v), r.i) for r in out.collect())

    assert run("skip") == [("a", 0.0)]
    assert run("keep") == [("None", 2.0), ("a", 0.0), ("x", 2.0)]
    with pytest.raises(Exception, match="unseen level"):
        run("error")
