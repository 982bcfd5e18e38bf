"""Physical plan shape: shuffles, pushdown, no Python in the plan."""

import re

import pytest

from conftest import SF_SMALL
from loadcast.plans import features as FT
from loadcast.plans import scoring as SC
from loadcast.config import EVENTS
from loadcast.queries import hourly, queries, sessions
from loadcast.session import scratch_path


# These train a forest; their plans are covered by the executions test below.
MODEL_QUERIES = {"rf_train", "rf_metrics", "model_roundtrip", "score_batch", "score_stream"}


def formatted(df) -> str:
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def exchanges(p: str) -> list[str]:
    """Exchange nodes of the plan tree (the part before the node details)."""
    tree = p.split("\n\n")[0]
    return [l for l in tree.splitlines() if re.search(r"Exchange \(\d+\)", l)]


def test_feature_plan_has_three_shuffles(spark):
    # One on (server, 5-minute bucket) below the partial aggregate, one on (server, hour) for the
    # arg-max, one on (server, chunk); daily means, rolling means and lags add none.
    p = formatted(FT.hourly_features(sessions(spark, SF_SMALL), EVENTS))
    assert len(exchanges(p)) == 3, p


def test_rollup_aggregates_before_the_shuffle(spark):
    from loadcast.operators.rollup import five_min_rollup
    p = formatted(five_min_rollup(sessions(spark, SF_SMALL)))
    assert "partial_sum" in p
    assert p.index("partial_sum") > p.index("Exchange")   # partial aggregate sits below the exchange


def test_scan_reads_only_used_columns(spark):
    from loadcast.operators.rollup import five_min_rollup
    from loadcast.queries import lineitem_sessions
    p = formatted(five_min_rollup(lineitem_sessions(spark, SF_SMALL)))
    rs = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert not [c for c in ("l_orderkey", "l_tax", "l_discount", "l_returnflag") if c in rs]
    assert [c for c in ("l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate") if c in rs]


def test_stats_read_prunes_partitions(spark):
    cfg = EVENTS
    hp, dp = scratch_path(spark, "p-hs"), scratch_path(spark, "p-ds")
    SC.write_statistics(FT.with_day(hourly(spark, SF_SMALL)), hp, dp)
    hs, ds = SC.stats_for_score(spark, hp, dp, cfg.score_begin)
    p = formatted(hs)
    assert "PartitionFilters: [" in p and "year" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in p and "SessionStartHourTime" in p.split("PushedFilters: [")[1].split("]")[0]


@pytest.fixture(scope="module")
def relational_plans(spark):
    return {name: formatted(fn(spark, SF_SMALL)) for name, fn in queries().items() if name not in MODEL_QUERIES}


def test_no_python_udfs_in_relational_queries(relational_plans):
    for name, p in relational_plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|InPandas|InArrow", p), name


def test_each_query_scans_its_raw_table_once(relational_plans):
    """No query's plan reads a raw table twice (queries that use an intermediate twice read it
    from a staged table)."""
    for name, p in relational_plans.items():
        raw = [l for l in re.findall(r"Location: InMemoryFileIndex \[file:([^\]]+)\]", p)
               if l.startswith("/root/testdata")]
        assert len(raw) <= 1, (name, raw)


def test_hot_server_is_spread_by_the_rollup_shuffle(spark):
    """One server with a third of all sessions: the rollup shuffles on (server, bucket),
    so the hot server's rows land in every partition and no partition is dominated."""
    from pyspark.sql import functions as F
    from conftest import SF_MID
    from loadcast.operators.rollup import five_min_rollup
    s = sessions(spark, SF_MID)
    s = s.withColumn("ServerIP", F.when(F.col("ServiceGrade") == "0", F.lit("hot")).otherwise(F.col("ServerIP")))
    share = s.agg(F.avg((F.col("ServerIP") == "hot").cast("double"))).first()[0]
    assert 0.3 < share < 0.37
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (five_min_rollup(s).withColumn("pid", F.spark_partition_id())
                 .groupBy("pid").agg(F.count(F.lit(1)).alias("n"),
                                     F.sum((F.col("ServerIP") == "hot").cast("int")).alias("hot"))
                 .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    total = sum(r.n for r in parts)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(parts) == n_parts and all(r.hot > 0 for r in parts)
    assert max(r.n for r in parts) / total < 2.0 / n_parts


def test_feature_plan_sorts(spark):
    """Calendar mode: one sort for the hourly arg-max, one for the lag window, and one shared by
    the per-day and rolling windows."""
    p = formatted(FT.hourly_features(sessions(spark, SF_SMALL), EVENTS))
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"Sort \(\d+\)", tree)) == 3, tree


@pytest.mark.parametrize("mode", ["calendar", "observed"])
def test_one_server_keeps_many_tasks_busy(spark, mode):
    """Five years of one server: the windows' rows lie in several tasks, none with a third."""
    from pyspark.sql import functions as F
    from loadcast.config import PEAK_COLUMNS
    from loadcast.operators.lags import hour_features
    hours = spark.range(0, 5 * 8766, 2).select(
        F.lit("s").alias("ServerIP"), F.expr("timestampadd(HOUR, id, TIMESTAMP_NTZ'2010-01-01 00:00:00')").alias("SessionStartHourTime"),
        *[F.col("id").cast("double").alias(c) for c in PEAK_COLUMNS])
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = hour_features(FT.with_day(hours), mode)
        tasks = [r.n for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(tasks) == hours.count() and len(tasks) >= 5 and max(tasks) < sum(tasks) / 3, tasks


@pytest.mark.parametrize("name", ["rf_train", "model_roundtrip", "score_coverage", "score_batch", "score_stream",
                                  "score_features", "row_counts", "daily_stats", "feature_table"])
def test_the_raw_log_is_read_by_one_execution(spark, name):
    """All executions of a query together, staging writes and fits included, read the raw log once."""
    store = spark._jsparkSession.sharedState().statusStore()
    known = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    queries()[name](spark, SF_SMALL).write.format("noop").mode("overwrite").save()
    done = store.executionsList()
    plans = [done.apply(i).physicalPlanDescription() for i in range(done.size())
             if done.apply(i).executionId() not in known]
    assert plans
    raw = [p for p in plans if re.search(r"InMemoryFileIndex \[file:/root/testdata", p)]
    assert len(raw) <= 1, (name, len(raw))


def test_scoring_features_read_the_statistics_once_without_a_join(spark):
    hp, dp = scratch_path(spark, "p-hs"), scratch_path(spark, "p-ds")
    SC.write_statistics(FT.with_day(hourly(spark, SF_SMALL)), hp, dp)
    hs, _ = SC.stats_for_score(spark, hp, dp, EVENTS.score_begin)
    p = formatted(SC.score_features(hs, EVENTS))
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 1, tree
    assert "Join" not in tree and len(exchanges(p)) == 1, tree
    named = spark.createDataFrame([("10.0.0.1",), ("new",)], "ServerIP string")
    tree = formatted(SC.score_features(hs, EVENTS, named)).split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 1 and "Join" not in tree, tree


def test_statistics_are_written_in_tasks_by_size(spark):
    """The write rebalances months: AQE splits a large one, where a plain repartition would not."""
    from loadcast.sources.stats_store import hourly_stats, write_stats
    store = spark._jsparkSession.sharedState().statusStore()
    write_stats(hourly_stats(hourly(spark, SF_SMALL)), scratch_path(spark, "p-reb"), ["ServerIP", "SessionStartHourTime"])
    done = store.executionsList()
    assert any("REBALANCE_PARTITIONS" in done.apply(i).physicalPlanDescription() for i in range(done.size()))
