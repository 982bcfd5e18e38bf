"""The statistics store: batches that share hours, repeated batches, crashes, files read once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import session_rows
from loadcast.operators.rollup import daily_mean, five_min_rollup, hourly_peak, with_day
from loadcast.plans import statistics as ST
from loadcast.session import scratch_path
from loadcast.sources.sessions import clean_sessions, read_sessions_csv, write_sessions_csv
from loadcast.sources.stats_store import hourly_stats, write_stats

START = datetime(2016, 5, 30)


def log(spark, n=400, seed=1):
    """Sessions of three servers over four days that cross a month, several to an hour."""
    r = random.Random(seed)
    return session_rows(spark, [{"ServerIP": f"s{r.randrange(3)}", "TotalLoad": float(r.randrange(100)),
                                 "SessionStart": START + timedelta(minutes=r.randrange(4 * 1440)),
                                 "MbytesTransferred": None if r.random() < .1 else 1.0, "ClientIP": str(i)}
                                for i in range(n)])


def rows(df):
    return sorted(map(str, df.select("ServerIP", *sorted(set(df.columns) - {"ServerIP", "year", "month", "dayofmonth", "hourofday"}))
                      .collect()))


def assert_equal_to_one_batch(spark, store, sessions):
    hourly = hourly_peak(five_min_rollup(sessions))
    assert rows(spark.read.parquet(f"{store}/hourly")) == rows(hourly)
    assert rows(spark.read.parquet(f"{store}/daily")) == rows(daily_mean(with_day(hourly)))


def files_of(spark, store):
    return sorted(r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                  .load(store).select("path").collect())


def parts(sessions, n):
    return [sessions.where(F.col("ClientIP").cast("int") % n == k) for k in range(n)]


def test_batches_that_split_hours_equal_one_batch(spark):
    store, sessions = scratch_path(spark, "store"), log(spark)
    for k, part in enumerate(parts(sessions, 4)):
        assert ST.add_batch(part, store, f"00{k}")
    assert_equal_to_one_batch(spark, store, sessions)
    before = files_of(spark, store)
    assert not ST.add_batch(parts(sessions, 4)[1], store, "001")  # sent twice
    assert files_of(spark, store) == before


def test_compaction_keeps_the_sums_and_the_batches_known(spark):
    store, sessions = scratch_path(spark, "store"), log(spark)
    assert ST.compact(spark, store) == []
    a, b, c = parts(sessions, 3)
    ST.add_batch(a, store, "a")
    ST.add_batch(b, store, "b")
    assert ST.compact(spark, store) == [(2016, 5), (2016, 6)]
    assert ST.compact(spark, store) == []
    assert not ST.add_batch(a, store, "a")
    ST.add_batch(c, store, "c")
    assert_equal_to_one_batch(spark, store, sessions)
    assert ST.live_partials(spark, store).select("batch").distinct().count() == 2


def test_a_job_that_dies_before_its_commit_does_not_count(spark, monkeypatch):
    store, sessions = scratch_path(spark, "store"), log(spark)
    a, b = parts(sessions, 2)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(ST, "_commit", dies)
        with pytest.raises(RuntimeError):
            ST.add_batch(sessions.where("ServerIP = 's0'"), store, "a")
    ST.add_batch(b, store, "b")
    assert_equal_to_one_batch(spark, store, b)
    ST.add_batch(a, store, "a")  # sent again, with other rows
    assert_equal_to_one_batch(spark, store, sessions)


def test_a_batch_committed_but_not_derived_is_derived_when_sent_again(spark, monkeypatch):
    store, sessions = scratch_path(spark, "store"), log(spark)
    a, b = parts(sessions, 2)
    ST.add_batch(a, store, "a")
    with monkeypatch.context() as m:
        m.setattr(ST, "_derive", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ST.add_batch(b, store, "b")
    assert not ST.add_batch(b, store, "b")
    assert_equal_to_one_batch(spark, store, sessions)


def test_empty_batches_and_rows_without_server_or_time(spark):
    store, sessions = scratch_path(spark, "store"), log(spark, 50)
    odd = session_rows(spark, [{"ServerIP": None, "TotalLoad": 1.0, "SessionStart": START}, {"ServerIP": "s1", "TotalLoad": 1.0}])
    assert ST.add_batch(odd, store, "odd") and not ST.add_batch(odd, store, "odd")
    ST.add_batch(sessions.unionByName(odd), store, "x'y/z=1")
    assert_equal_to_one_batch(spark, store, sessions)


def test_each_file_of_a_growing_glob_is_read_once(spark):
    folder, store = scratch_path(spark, "logs"), scratch_path(spark, "store")
    seen, sessions = [], log(spark)

    def read(spark, paths):
        seen.extend(paths)
        return clean_sessions(read_sessions_csv(spark, paths))

    a, b = parts(sessions, 2)
    write_sessions_csv(a.repartition(2), f"{folder}/day1")
    assert ST.take_in(spark, store, [f"{folder}/*/part-*"], read) == 2
    write_sessions_csv(b.repartition(3), f"{folder}/day2")
    assert ST.take_in(spark, store, [f"{folder}/*/part-*"], read) == 3
    assert ST.take_in(spark, store, [f"{folder}/*/part-*"], read) == 0
    assert len(seen) == len(set(seen)) == 5
    assert_equal_to_one_batch(spark, store, clean_sessions(read_sessions_csv(spark, f"{folder}/*/part-*")))
    path = seen[0].removeprefix("file:")
    with open(path, "a") as f:
        f.write(open(path).readline())
    with pytest.raises(ValueError, match="changed"):
        ST.take_in(spark, store, [f"{folder}/*/part-*"], read)


def test_one_server_is_read_from_a_small_part_of_a_month(spark):
    """Sorted files, a Bloom filter and page indexes: the scan gives few rows of other servers."""
    path = scratch_path(spark, "skip")
    hours = spark.range(720).select(F.expr("timestampadd(HOUR, id, TIMESTAMP_NTZ'2016-06-01 00:00:00')").alias("SessionStartHourTime"))
    wide = hours.crossJoin(spark.range(200).select(F.concat(F.lit("10.0.0."), "id").alias("ServerIP")))
    write_stats(hourly_stats(wide.withColumn("peakLoad", F.rand(1))), path, ["ServerIP", "SessionStartHourTime"])
    one = spark.read.parquet(path).where("ServerIP = '10.0.0.77'")
    assert len(one.collect()) == 720
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().apply("numOutputRows").value()
    assert read <= 0.05 * 200 * 720, read
