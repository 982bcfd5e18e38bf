import duckdb
import pytest
from pyspark.sql import functions as F

from loadcast.llm import host_reputation as H

PAGES = "page_id bigint, url string, html string"


def frame(spark, urls):
    return spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)


def test_urls_and_rules(spark):
    urls = ["http://EXAMPLE.org/es/1?q", "https://a.example.org/en/12#x", "ftp://x.org/", "http://x.org", "http://b.com/fr/",
            "http://com/de/1", "http://notexample.org/es/", "http://É.com/de/", None, "no scheme", "://h?p/q", "a://b://c/d"]
    none = spark.createDataFrame([], "page_id bigint, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in H.judge(frame(spark, urls), none).collect()}
    assert got == {0: ("example.org", "/es/1", "example.org/es/", "block"), 1: ("a.example.org", "/en/12", "example.org/en/1", "block"),
                   2: ("x.org", "/", "org/", "allow"), 3: ("x.org", "", None, "allow"), 4: ("b.com", "/fr/", "com/fr/", "allow"),
                   5: ("com", "/de/1", "com/de/", "block"), 6: ("notexample.org", "/es/", "org/", "allow"),
                   7: ("É.com", "/de/", "com/de/", "block"), 8: ("", "", None, "allow"), 9: ("", "", None, "allow"),
                   10: ("h", "", None, "allow"), 11: ("b:", "//c/d", None, "allow")}


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "b.co.uk", "co.uk", "x.y.com", "y.com", "com", ""]
    rows = spark.createDataFrame([(h,) for h in hosts], "h string").select(
        "h", H.domain_of(F.col("h")).alias("d"), H.suffix_of(F.col("h")).alias("s")).collect()
    assert [(r.d, r.s) for r in rows] == [("b.co.uk", "co.uk"), ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("y.com", "com"),
                                          ("y.com", "com"), ("com", "com"), ("", "")]


@pytest.fixture(scope="module")
def bad_host(spark):
    urls = [f"http://bad{i % 2}.evil.net/p/{i}" for i in range(80)] + [f"http://h{i % 9}.good.net/p/{i}" for i in range(300)]
    urls += ["http://new.evil.net/p/1", "http://one.good.net/p/1", None]
    pages = frame(spark, urls)
    outcomes = [(i, 1) for i in range(80)] + [(i, int(i % 10 == 0)) for i in range(80, 380)] + [(381, 1), (None, 1), (5, None)]
    return pages.repartition(3), spark.createDataFrame(outcomes, "page_id bigint, bad int")


def test_shrinkage(spark, bad_host):
    got = {(r.host): r for r in H.judge(*bad_host, rules=[]).collect()}
    assert got["bad0.evil.net"].verdict == got["bad1.evil.net"].verdict == "block"
    assert got["h0.good.net"].verdict == "allow"
    assert got["one.good.net"].verdict == "allow"  # a single bad page is not enough evidence
    assert got["one.good.net"].bad_mean < 0.6
    assert got["new.evil.net"].bad_mean > 0.5 > got[""].bad_mean  # a host without outcomes: its domain's share


def test_posterior_is_the_beta_binomial_one(spark, bad_host):
    rows = {r.host: r for r in H.judge(*bad_host, rules=[]).collect()}
    for r in rows.values():
        assert r.bad_lower <= r.bad_mean <= 1 and r.bad_mean >= 0


def test_sql_form(spark):
    pages = frame(spark, [f"http://{'b' if i % 3 else 'c'}{i % 5}.site{i % 4}.net/en/{i}" for i in range(200)] + [None, "x"])
    labels = spark.createDataFrame([(i, int(i % 7 > 0), int(i % 4 == 0)) for i in range(200)] + [(None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    con.register("labels", labels.toPandas())
    got = H.judge(pages, H.outcomes_from_labels(pages, labels)).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(H.oracle()).fetchall(), key=str)
    assert {"block", "allow"} == {r.verdict for r in got}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id bigint, bad int")
    assert H.judge(frame(spark, []), none).count() == 0
