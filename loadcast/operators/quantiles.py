"""Exact order statistics of a distributed column.

The value of rank k is found by narrowing an interval: each round counts the rows of its cells
(one aggregation with at most ``CELLS`` groups a rank, partial before the shuffle), goes into the cell
that holds the rank, and shrinks to the least and largest value that lie in it. A cell of one value
ends the search, so equal values, however many, cost no more. No value list is gathered and
nothing is sampled: the result is a value of the column, the same for any partitioning.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1024


def order_statistics(df: DataFrame, column: str, fractions: list[float]) -> list[float | None]:
    """For each fraction q the value of rank ceil(q * n), at least 1, among the n values of a numeric
    column (nearest-rank percentiles). NULL and NaN are left out, infinite values count as the largest
    double; without values all are None.

    ``df`` is read once per round (two to four rounds on usual data): pass a stored table."""
    x = F.col(column).cast("double")
    most = F.lit(sys.float_info.max)
    values = df.where(x.isNotNull() & ~F.isnan(x)).select(F.greatest(F.least(x, most), -most).alias("x"))
    ends = values.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if not ends.n:
        return [None] * len(fractions)
    # rank within [lo, hi], for every fraction; equal searches are made once
    open_ = {q: (max(1, math.ceil(round(q * ends.n, 9))), ends.lo, ends.hi) for q in fractions}
    found: dict[float, float] = {}
    while open_:
        for q in [q for q, (_, lo, hi) in open_.items() if lo == hi]:
            found[q] = open_.pop(q)[1]
        spans = sorted({(lo, hi) for _, lo, hi in open_.values()})
        if not spans:
            break
        cells = _cells(values, spans)
        for q, (rank, lo, hi) in open_.items():
            open_[q] = _narrowed(rank, cells[spans.index((lo, hi))])
    return [found[q] for q in fractions]


def _cells(values: DataFrame, spans: list[tuple[float, float]]) -> list[list]:
    """Of each span, its non-empty cells in order, with rows, least and largest value."""
    x = F.col("x")

    def cell(lo: float, hi: float) -> F.Column:
        width = hi - lo  # of doubles: may be infinite, never 0
        share = (x - F.lit(lo)) / F.lit(width) if math.isfinite(width) else (x / 2 - lo / 2) / F.lit(hi / 2 - lo / 2)
        return F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).cast("int")

    inside = [F.when(x.between(lo, hi), F.struct(F.lit(i).alias("span"), cell(lo, hi).alias("cell")))
              for i, (lo, hi) in enumerate(spans)]
    rows = (values.select("x", F.explode(F.filter(F.array(*inside), lambda s: s.isNotNull())).alias("at"))
            .groupBy("at.span", "at.cell").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    return [sorted((r.cell, r.n, r.lo, r.hi) for r in rows if r.span == i) for i in range(len(spans))]


def _narrowed(rank: int, cells: list) -> tuple[int, float, float]:
    for _, n, lo, hi in cells:
        if rank <= n:
            return rank, lo, hi
        rank -= n
    raise AssertionError("the rank lies in one of the cells")
