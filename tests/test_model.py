"""Encoding, forest, metrics, persistence and the streaming scorer."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadcast.operators.encode import fit_features, level_numbers, split_by_levels
from loadcast.operators.model import classification_metrics, evaluator_metrics
from loadcast.plans import features as FT
from loadcast.plans import scoring as SC
from loadcast.plans import training as TR
from loadcast.config import EVENTS
from loadcast.queries import hourly, sessions
from loadcast.session import scratch_path
from loadcast.streaming.score_stream import score_files_once


@pytest.fixture(scope="module")
def trained(spark):
    cfg = EVENTS
    fm, table = FT.build_feature_table(spark, sessions(spark, SF_SMALL), cfg, scratch_path(spark, "t-ft"))
    model, rf = TR.train(table, fm, cfg)
    return cfg, fm, table, model, rf


def test_indexer_ties_are_alphabetical_and_single_levels_stay_indexed(spark):
    df = spark.createDataFrame([("b", 10, 1), ("a", 9, 1), ("a", 10, 1), ("b", 9, 1)],
                               "dayofweek string, hourofday int, year int")
    from loadcast.config import INDEX_COLUMNS
    for c in INDEX_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0) if c != "ServerIP" else F.lit("s"))
    from loadcast.config import SCALED_INPUTS
    df = df.withColumns({c: F.lit(1.0) for c in SCALED_INPUTS}).withColumn("linearTrend", F.lit(0.0))
    fm = fit_features(df)
    labels = dict(zip(INDEX_COLUMNS, [i.labels for i in fm.indexers]))
    assert labels["dayofweek"] == ["a", "b"]
    assert labels["hourofday"] == ["10", "9"]          # numbers compare as text
    only, enc = split_by_levels(fm.indexers)
    assert "year_indexed" in only and "dayofweek_indexed" in enc
    # constant lag columns scale to 0
    out = FT.scaled_columns(fm.transform(df)).select("scaledpeakLoadLag48").distinct().collect()
    assert [r[0] for r in out] == [0.0]


def test_unseen_level_is_skipped(spark):
    from loadcast.config import INDEX_COLUMNS, SCALED_INPUTS
    base = spark.createDataFrame([("x",), ("y",)], "ServerIP string")
    for c in INDEX_COLUMNS:
        if c != "ServerIP":
            base = base.withColumn(c, F.lit("Monday") if c == "dayofweek" else F.lit(1))
    base = base.withColumns({c: F.lit(1.0) for c in SCALED_INPUTS}).withColumn("linearTrend", F.lit(0.0))
    fm = fit_features(base)
    new = base.withColumn("ServerIP", F.lit("z"))
    assert fm.transform(new).count() == 0


def test_vector_size(trained):
    cfg, fm, table, model, rf = trained
    levels = level_numbers(fm.indexers)
    expected = 1 + len(fm.only_indexed) + sum(levels[c] - 1 for c in fm.encoded) + 20
    assert rf.numFeatures == expected


def test_same_seed_same_predictions(spark, trained):
    cfg, fm, table, model, rf = trained
    model2, rf2 = TR.train(table, fm, cfg)
    a = TR.predictions(table, rf, fm, cfg).select("key", "prediction")
    b = TR.predictions(table, rf2, fm, cfg).select("key", "prediction")
    assert a.exceptAll(b).count() == 0


def test_evaluator_equals_confusion_matrix_metrics(spark, trained):
    cfg, fm, table, model, rf = trained
    pred = TR.predictions(table, rf, fm, cfg)
    ours = {r.split: r for r in classification_metrics(pred, ["split"]).collect()}
    for split in ("train", "test"):
        ev = evaluator_metrics(pred.where(F.col("split") == split))
        for m, v in ev.items():
            assert abs(getattr(ours[split], m) - v) < 1e-9, (split, m)


def test_save_load_and_stream_give_same_predictions(spark, trained):
    cfg, fm, table, model, rf = trained
    path = scratch_path(spark, "t-model")
    TR.save_model(spark, model, fm, cfg, path)
    loaded, info = TR.load_model(spark, path)
    assert info["columnForEncode"] == fm.encoded
    hp, dp = scratch_path(spark, "t-hs"), scratch_path(spark, "t-ds")
    SC.write_statistics(FT.with_day(hourly(spark, SF_SMALL)), hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    feats = SC.score_features(hs, cfg)
    a = SC.score_batch(model, feats)
    b = SC.score_batch(loaded, feats)
    c = score_files_once(spark, model, feats)
    assert a.count() == 8 * 48
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(c.select(*a.columns)).count() == 0


def test_fit_on_train_and_keep_unseen_levels(spark):
    """fit_on='train' with handle_invalid='keep': the test days' unseen day-of-month levels
    are kept (all-zero one-hot) instead of being skipped."""
    cfg = EVENTS.with_(fit_on="train", handle_invalid="keep")
    feats = FT.hourly_features(sessions(spark, SF_SMALL), cfg)
    fm = fit_features(FT.fit_rows(feats, cfg), cfg.handle_invalid)
    out = fm.transform(feats)
    assert out.count() == feats.count()
    skip = fit_features(FT.fit_rows(feats, cfg), "skip").transform(feats)
    test_rows = feats.where(F.col("SessionStartHourTime") >= F.lit(cfg.test_split_start).cast("timestamp_ntz"))
    assert skip.count() == feats.count() - test_rows.count()


def test_score_coverage_counts_what_skip_drops(spark):
    """Indexer fitted on the train split only: the scored days (29th, 30th) are unseen
    day-of-month levels, so every 48-hour row is skipped, and coverage says so."""
    cfg = EVENTS.with_(fit_on="train")
    feats = FT.hourly_features(sessions(spark, SF_SMALL), cfg)
    fm = fit_features(FT.fit_rows(feats, cfg), "skip")
    hp, dp = scratch_path(spark, "cov-hs"), scratch_path(spark, "cov-ds")
    SC.write_statistics(FT.with_day(hourly(spark, SF_SMALL)), hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    scored = SC.score_features(hs, cfg)
    cov = {r.metric: r.n for r in SC.score_coverage(fm.indexers, scored).collect()}
    kept = fm.transform(scored).count()
    assert cov["feature_rows"] == scored.count() == 8 * 48
    assert cov["scored_rows"] == kept == 0
    assert cov["skipped_rows"] == 8 * 48


def test_stream_restart_scores_each_file_once(spark, trained):
    """Two request batches arrive; the scorer is restarted on the same checkpoint between
    them. Every feature row is scored exactly once."""
    from loadcast.sources.records import write_records
    from loadcast.streaming.score_stream import start_scoring
    cfg, fm, table, model, rf = trained
    hp, dp = scratch_path(spark, "st-hs"), scratch_path(spark, "st-ds")
    SC.write_statistics(FT.with_day(hourly(spark, SF_SMALL)), hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    feats = SC.score_features(hs, cfg)
    base = scratch_path(spark, "st")
    first = feats.where(F.col("ServerIP").isin("10.0.0.1", "10.0.0.2"))
    second = feats.where(~F.col("ServerIP").isin("10.0.0.1", "10.0.0.2"))
    write_records(first, f"{base}/in/batch1")
    q = start_scoring(spark, model, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", feats.schema, available_now=True)
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/out").count() == first.count()
    write_records(second, f"{base}/in/batch2")
    q = start_scoring(spark, model, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", feats.schema, available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == feats.count() == 8 * 48
    assert out.select("ServerIP", "SessionStartHourTime").distinct().count() == out.count()
