"""Every query with an oracle matches DuckDB on the same parquet tables (sf0.001)."""

import pytest

from conftest import SF_SMALL
from helpers import same_result
from loadcast import queries as Q

ORACLE = Q.oracle_sql()
# Model fits are covered in test_model.py; here the relational queries.
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = Q.queries()[name](spark, SF_SMALL)
    assert same_result(df, con, ORACLE[name]), name


def test_every_query_is_registered_with_entry():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = set(Q.queries()) - set(Q.oracle_sql())
    assert rows_only == set()


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["key", "ServerIP", "SessionStartHourTime"]
