"""Shared test helpers: session-log rows from literals, result comparison."""

import math
from datetime import datetime

from pyspark.sql import functions as F

from loadcast.config import SESSION_COLUMNS
from loadcast.sources.sessions import SESSION_SCHEMA


def ts(s: str) -> datetime:
    return datetime.strptime(s, "%Y-%m-%d %H:%M:%S")


def session_rows(spark, rows):
    """rows: dicts with any of the session columns; the others are NULL."""
    full = [tuple(r.get(c) for c in SESSION_COLUMNS) for r in rows]
    return spark.createDataFrame(full, SESSION_SCHEMA)


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def same_result(df, con, sql):
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    return canon(df.columns, srows) == canon(dcols, drows)


def col_values(df, c):
    return [r[0] for r in df.select(F.col(c)).collect()]
