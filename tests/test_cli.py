"""The command-line steps end to end on CSV session files."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from loadcast import cli
from loadcast.plans.training import config_from_info, load_model
from loadcast.session import scratch_path
from loadcast.sources.records import read_records
from loadcast.sources.sessions import sessions_from_events, write_sessions_csv
from loadcast.sources.tables import table


def test_train_stats_score(spark):
    base = scratch_path(spark, "cli")
    ev = sessions_from_events(table(spark, SF_SMALL, "events"))
    write_sessions_csv(ev.where(F.dayofmonth("SessionStart") <= 15), f"{base}/data/2024/01/a/0")
    write_sessions_csv(ev.where(F.dayofmonth("SessionStart") > 15), f"{base}/data/2024/01/b/1")
    glob = f"{base}/data/20[0-9][0-9]/*/[a,b]/[0-6]/*.csv"
    rng = ["--train-begin", "2024-01-01 00:00:00", "--train-end", "2024-01-30 23:59:59",
           "--test-split-start", "2024-01-29 00:00:00", "--low", "24", "--high", "60"]
    cli.main(["train", "--sessions", glob, *rng, "--out", f"{base}/run"], spark=spark)
    metrics = spark.read.parquet(f"{base}/run/metrics").collect()
    assert {r.split for r in metrics} == {"train", "test"}
    cli.main(["stats", "--sessions", glob, "--out", f"{base}/stats", "--rejects", f"{base}/rejects", "--compact"], spark=spark)
    cli.main(["stats", "--sessions", glob, "--out", f"{base}/stats"], spark=spark)  # nothing new
    assert spark.read.parquet(f"{base}/rejects").count() == 0
    cli.main(["score", "--stats", f"{base}/stats", "--model", f"{base}/run/model",
              "--score-begin", "2024-01-29 00:00:00", "--servers", "10.0.0.1,10.0.0.2,10.9.9.9",
              "--out", f"{base}/pred"], spark=spark)
    pred = spark.read.parquet(f"{base}/pred")
    assert pred.count() == 2 * 48
    assert {r.ServerIP for r in pred.select("ServerIP").distinct().collect()} == {"10.0.0.1", "10.0.0.2"}
    # the server that training never met is reported, not lost
    coverage = {r.metric: r.n for r in spark.read.parquet(f"{base}/pred-coverage").collect()}
    assert coverage == {"feature_rows": 3 * 48, "scored_rows": 2 * 48, "skipped_rows": 48}
    # the stored run info is what scoring runs with
    _, info = load_model(spark, f"{base}/run/model")
    cfg = config_from_info(info)
    assert (cfg.train_begin, cfg.low, cfg.high) == ("2024-01-01 00:00:00", 24.0, 60.0)
    assert info["dataFile"] == glob and info["duration"] == "ONE_MONTH" and info["handleInvalid"] == "skip"
    # predictions as JSON lines read back unchanged
    cli.main(["score", "--stats", f"{base}/stats", "--model", f"{base}/run/model", "--json",
              "--score-begin", "2024-01-29 00:00:00", "--servers", "10.0.0.1,10.0.0.2",
              "--out", f"{base}/pred-json"], spark=spark)
    back = read_records(spark, f"{base}/pred-json", pred.schema)
    assert back.exceptAll(pred).count() == 0 and back.count() == pred.count()


def test_scoring_keeps_unseen_levels_when_asked_to(spark):
    base = scratch_path(spark, "cli3")
    ev = sessions_from_events(table(spark, SF_SMALL, "events"))
    write_sessions_csv(ev, f"{base}/data")
    rng = ["--train-begin", "2024-01-01 00:00:00", "--train-end", "2024-01-30 23:59:59", "--test-split-start",
           "2024-01-29 00:00:00", "--low", "24", "--high", "60", "--handle-invalid", "keep", "--fit-on", "train"]
    cli.main(["train", "--sessions", f"{base}/data/*.csv", *rng, "--out", f"{base}/run"], spark=spark)
    cli.main(["stats", "--sessions", f"{base}/data/*.csv", "--out", f"{base}/stats"], spark=spark)
    cli.main(["score", "--stats", f"{base}/stats", "--model", f"{base}/run/model", "--score-begin",
              "2024-02-01 00:00:00", "--servers", "10.0.0.1,10.9.9.9", "--out", f"{base}/pred"], spark=spark)
    assert spark.read.parquet(f"{base}/pred").count() == 2 * 48


def test_features_then_train(spark):
    """The two-step flow: features (table + encoders), then training from them."""
    base = scratch_path(spark, "cli2")
    ev = sessions_from_events(table(spark, SF_SMALL, "events"))
    write_sessions_csv(ev, f"{base}/data/2024/01/a/0")
    rng = ["--train-begin", "2024-01-01 00:00:00", "--train-end", "2024-01-30 23:59:59",
           "--test-split-start", "2024-01-29 00:00:00", "--low", "24", "--high", "60"]
    cli.main(["features", "--sessions", f"{base}/data/*/*/*/*/*.csv", *rng, "--out", f"{base}/feat"], spark=spark)
    cli.main(["train", "--features", f"{base}/feat", "--out", f"{base}/run"], spark=spark)
    one_step = f"{base}/run1"
    cli.main(["train", "--sessions", f"{base}/data/*/*/*/*/*.csv", *rng, "--out", one_step], spark=spark)
    a = spark.read.parquet(f"{base}/run/metrics")
    b = spark.read.parquet(f"{one_step}/metrics")
    assert a.count() == 2 and a.exceptAll(b).count() == 0
