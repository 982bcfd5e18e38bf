import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
SF_BIG = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from loadcast.session import build_session
    ckpt = tempfile.mkdtemp(prefix="loadcast-test-ckpt-")
    s = build_session("local[4]", app="loadcast-tests", shuffle_partitions=4,
                      conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def connect(sf_dir):
        con = duckdb.connect()
        for t in ("events", "lineitem"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return connect
