"""Join-free gap fill and many scoring origins in one pass."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadcast.config import EVENTS, PEAK_COLUMNS
from loadcast.functions.timegrid import DAY, HOUR, ntz
from loadcast.operators.gapfill import fill_gaps, gap_fill, server_grid
from loadcast.plans import scoring as SC
from loadcast.queries import rounded
from loadcast.session import scratch_path
from test_plans import exchanges, formatted


def history(spark, share=.2, days=330, seed=2):
    """Gappy hours of three servers; the second falls silent for two months, the third begins late."""
    r = random.Random(seed)
    rows = [(s, datetime(2014, 11, 20) + timedelta(hours=h), *[float(r.randrange(1000)) for _ in PEAK_COLUMNS])
            for s in "abc" for h in range(days * 24)
            if r.random() < share and not (s == "b" and 2000 < h < 3500) and not (s == "c" and h < 4000)]
    path = scratch_path(spark, "history")
    spark.createDataFrame(rows, "ServerIP string, SessionStartHourTime timestamp_ntz, "
                          + ", ".join(f"{c} double" for c in PEAK_COLUMNS)).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted(map(str, rounded(df).collect()))


@pytest.mark.parametrize("begin, end", [("2014-12-01 05:10:00", "2015-01-10 07:00:00"), ("2014-01-01 00:00:00", "2014-02-01 00:00:00"),
                                        ("2016-01-01 00:00:00", "2016-01-03 00:00:00"), ("2014-11-20 00:00:00", "2015-11-01 00:00:00")])
def test_filled_gaps_equal_the_grid_join(spark, begin, end):
    facts = history(spark, .02)
    grid = server_grid(facts.select("ServerIP").distinct(), ntz(begin), ntz(end), HOUR, out="SessionStartHourTime")
    want = gap_fill(grid, facts, ["ServerIP", "SessionStartHourTime"]).select(*facts.columns)
    got = fill_gaps(facts, ntz(begin), ntz(end), HOUR, "SessionStartHourTime")
    assert got.columns == facts.columns and rows(got) == rows(want)


def test_filling_gaps_takes_one_shuffle_and_no_join(spark):
    p = formatted(fill_gaps(history(spark, .02), ntz("2014-12-01 00:00:00"), ntz("2015-01-01 00:00:00"), HOUR, "SessionStartHourTime"))
    assert len(exchanges(p)) == 1 and "Join" not in p.split("\n\n")[0], p


@pytest.mark.parametrize("first, every", [("2014-11-25 00:00:00", 7 * DAY), ("2014-12-30 05:00:00", 31 * DAY + 7 * HOUR)])
def test_every_origin_scores_as_on_its_day(spark, first, every):
    """The backtest equals ``score_features`` on the hours before each origin, in every chunk."""
    hours = history(spark)
    got = SC.score_backtest(hours, EVENTS, first, "2015-10-10 00:00:00", every)
    begin, origins = datetime.fromisoformat(first), []
    while begin <= datetime(2015, 10, 10):
        origins.append(begin)
        begin += timedelta(seconds=every)
    found = {o: [] for o in origins}
    for r in rounded(got).collect():
        found[r.score_begin].append(str(r.asDict() | {"score_begin": None}))
    for o in origins[::max(1, len(origins) // 5)]:
        window = SC.horizon(f"{o}")["feature_begin"]
        seen = hours.where((F.col("SessionStartHourTime") < F.lit(o).cast("timestamp_ntz"))
                           & (F.col("SessionStartHourTime") >= ntz(SC._floor(window, HOUR))))
        want = rounded(SC.score_features(seen, EVENTS.with_(score_begin=f"{o}")))
        assert sorted(found[o]) == sorted(str({"score_begin": None} | r.asDict()) for r in want.collect()), o
    assert sum(map(bool, found.values())) == len(origins)


def test_later_sessions_never_change_an_earlier_origin(spark):
    hours = history(spark)
    cut = datetime(2015, 3, 1)
    early = F.col("score_begin") <= F.lit(cut).cast("timestamp_ntz")
    first, last = "2014-12-01 00:00:00", "2015-04-01 00:00:00"
    before = hours.where(F.col("SessionStartHourTime") < F.lit(cut).cast("timestamp_ntz"))
    assert (rows(SC.score_backtest(hours, EVENTS, first, last, 3 * DAY).where(early))
            == rows(SC.score_backtest(before, EVENTS, first, last, 3 * DAY).where(early)))


def test_the_backtest_takes_one_scan_and_one_shuffle(spark):
    p = formatted(SC.score_backtest(history(spark), EVENTS, "2014-12-01 00:00:00", "2015-04-01 00:00:00"))
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 1 and len(exchanges(p)) == 1 and "Join" not in tree, tree
