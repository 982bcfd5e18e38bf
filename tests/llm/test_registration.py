import duckdb
import pytest

from conftest import SF_SMALL
from loadcast.llm import queries as Q
from compare_llm import same


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    same(Q.queries()[name](spark, SF_SMALL), con, Q.oracle_sql()[name])


@pytest.mark.parametrize("name, key", [("op2_language_id", "page_id"), ("op3_streaming_bpe", "doc_id"),
                                       ("op8_weighted_minhash", "doc_id"), ("op9_toxicity", "doc_id"),
                                       ("op10_license_scan", "doc_id"), ("op13_merkle_manifest", "doc_id")])
def test_one_row_for_each_input_row(spark, name, key):
    table = "pages" if key == "page_id" else "documents"
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_SMALL}/{table}.parquet").select(key).collect())
    assert sorted(r[key] for r in Q.queries()[name](spark, SF_SMALL).collect()) == want
