"""Approximate nearest neighbours by collision counting over query-centred windows.

Vectors are scaled to length one, so the nearest by cosine is the nearest by distance. There
are ``PROJECTIONS`` random directions; a block of vectors keeps its projections on each as one
sorted array. A query looks up its own place in every array and opens a window around it
(virtual rehashing: the half width is multiplied by ``GROWTH`` each round, no new hash is made);
the vectors that enter a window collide once. A vector with at least ``COLLISIONS`` collisions
is verified: its exact cosine in double precision. A search ends when the half width reaches
``STOP`` times the distance of the k-th best verified vector. A vector at exactly that distance
has then collided in each direction with probability 0.706, and passed the threshold of 40 in 64
with probability 0.94. README gives the recall measured against brute force.

One search covers the whole table in two steps that carry a query's bound:

1. Rows go to the cell of their nearest pivot, and cells to blocks of some ``BLOCK_ROWS`` rows, so
   a hot cell is many blocks. A query grows its windows in one block of its own cell. Its k-th best
   there bounds the half width that it needs anywhere.
2. Every block states the least and largest projection on each direction. A window that ends
   before them holds none of the block's rows, so a block that fewer than ``COLLISIONS`` of a
   query's windows reach has no vector to verify, and the query is not sent there: nothing is
   lost by that. Queries go to the other blocks with their bound and count collisions in one
   round. Blocks are copied once for each ``QUERY_ROWS`` queries that come.

The work follows how far the data can be told apart: of clustered vectors a query meets the blocks
of its cluster, of vectors without any structure it meets all of them. Pivots are drawn from the
``PIVOT_LENGTHS`` most frequent vector lengths, at most ``MAX_PIVOTS`` and ``PIVOT_VALUES``
numbers for each; they only decide which rows share a block. All rows are indexed.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
take no part, as queries or as candidates; vectors of different length are not compared; very
small or large ones are scaled by a power of two first, which leaves the cosine as it is; of
repeated rows with one vec_id all are candidates of other queries, and the query runs once,
for the first by content; ties go to the smaller vec_id; with fewer candidates than k all are
returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import stage

K = 5
PROJECTIONS = 64
COLLISIONS = 40
GROWTH = 1.25
FIRST = 0.3  # half width of the first round, on the unit sphere
STOP = 1.05
BLOCK_ROWS = 4096
QUERY_ROWS = 2048
BOUND_ROWS = 1024  # blocks whose bounds are looked up together
PIVOT_LENGTHS, MAX_PIVOTS, PIVOT_VALUES = 8, 1024, 1 << 16
SLACK = 1e-9  # rounding of projections
SEED = 11

BLOCK = ["dim", "cell", "part"]


def directions(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, dim])).standard_normal((PROJECTIONS, dim))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component near one."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -power[:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


class BlockIndex:
    """Sorted projections of one block of vectors (rows of ``vectors``, any length but zero)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, scaled(vectors)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))
        self.axes = directions(vectors.shape[1])
        projected = np.ascontiguousarray(((self.vectors / self.norms[:, None]) @ self.axes.T).T)
        self.order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, self.order, axis=1)

    def cosines(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Row by row, so that equal vectors get equal cosines wherever they stand."""
        norm = np.sqrt((query * query).sum())
        return (self.vectors[rows] * query).sum(axis=1) / (self.norms[rows] * norm)

    def best(self, rows: np.ndarray, cosine: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k best, nearest first, ties to the smaller id."""
        if len(rows) > 4 * k:  # all that can be among the k best, ties included
            least = np.partition(cosine, len(rows) - k)[len(rows) - k]
            rows, cosine = rows[cosine >= least], cosine[cosine >= least]
        order = np.lexsort((self.ids[rows], -cosine))[:k]
        return rows[order], cosine[order]

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, cosines, vectors verified) of the k best found, nearest first, by windows that
        grow until the k-th best bounds them."""
        n = len(self.ids)
        query = scaled(query[None])[0]
        center = self.axes @ (query / np.sqrt((query * query).sum()))
        low = np.array([np.searchsorted(s, c) for s, c in zip(self.sorted, center)])
        high = low.copy()
        counts = np.zeros(n, np.int64)
        done = self.ids == query_id
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        verified, half = 0, FIRST
        while True:
            entered = []
            for j in range(PROJECTIONS):
                a = min(np.searchsorted(self.sorted[j], center[j] - half), low[j])
                b = max(np.searchsorted(self.sorted[j], center[j] + half, side="right"), high[j])
                entered += [self.order[j, a:low[j]], self.order[j, high[j]:b]]
                low[j], high[j] = a, b
            counts += np.bincount(np.concatenate(entered), minlength=n)
            rows = np.flatnonzero((counts >= COLLISIONS) & ~done)
            if len(rows):
                done[rows] = True
                verified += len(rows)
                found, scores = self.best(np.concatenate([found, rows]),
                                          np.concatenate([scores, self.cosines(rows, query)]), k)
            enough = half_width(scores, k)
            if done.all() or half >= enough:
                return self.ids[found], scores, verified
            half = min(half * GROWTH, enough)

    def search_within(self, query_ids: np.ndarray, queries: np.ndarray, halves: np.ndarray,
                      k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
        """(query id, ids, cosines, vectors verified) of the k best of each query among the vectors
        that collide often enough in windows of a given half width."""
        n = len(self.ids)
        queries = scaled(queries)
        centers = unit(queries) @ self.axes.T
        low = np.stack([np.searchsorted(s, c - halves) for s, c in zip(self.sorted, centers.T)])
        high = np.stack([np.searchsorted(s, c + halves, side="right") for s, c in zip(self.sorted, centers.T)])
        for i, query_id in enumerate(query_ids.tolist()):
            # a window of more than half the array is counted by what it leaves out
            inside, outside, wide = [], [], 0
            for order, a, b in zip(self.order, low[:, i].tolist(), high[:, i].tolist()):
                if 2 * (b - a) <= n:
                    inside.append(order[a:b])
                else:
                    outside += [order[:a], order[b:]]
                    wide += 1
            counts = np.full(n, wide)
            if inside:
                counts += np.bincount(np.concatenate(inside), minlength=n)
            if outside:
                counts -= np.bincount(np.concatenate(outside), minlength=n)
            rows = np.flatnonzero((counts >= COLLISIONS) & (self.ids != query_id))
            best, cosine = self.best(rows, self.cosines(rows, queries[i]), k)
            yield query_id, self.ids[best], cosine, len(rows)


def half_width(scores: np.ndarray, k: int) -> float:
    """Half width at which a search with these best cosines ends."""
    return max(FIRST, STOP * np.sqrt(max(2 - 2 * scores[-1], 0.0))) if len(scores) == k else np.inf


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ok & F.exists(vector, lambda x: x != 0)


def _pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """Pivots of the most frequent vector lengths: rows of least hash, one for each block."""
    sizes = (rows.groupBy("dim").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK_ROWS)
             .orderBy(F.desc("n"), "dim").limit(PIVOT_LENGTHS).collect())
    out = {}
    for dim, n in sizes:
        count = min(-(-n // BLOCK_ROWS), MAX_PIVOTS, PIVOT_VALUES // dim)
        if count > 1:
            drawn = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "vec"), "vec_id").limit(count)
            out[dim] = np.unique(unit(matrix(drawn.select("vec").toPandas()["vec"])), axis=0)
    return out


def _place(pivots) -> callable:
    """Cell of each row, and a number that deals rows of a cell, repeated ones too, over its blocks."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, seen = TaskContext.get().partitionId(), 0
        for pdf in batches:
            cell = np.zeros(len(pdf), np.int32)
            dims = pdf["dim"].to_numpy()
            for dim in np.unique(dims).tolist():
                if dim in pivots.value:
                    at = np.flatnonzero(dims == dim)
                    cell[at] = np.argmax(unit(matrix(pdf["vec"].iloc[at])) @ pivots.value[dim].T, axis=1)
            deal = (np.int64(task) << 40) + np.arange(seen, seen + len(pdf))
            seen += len(pdf)
            yield pdf.assign(cell=cell, deal=deal)
    return run


HOME = ("is_bound boolean, dim int, cell int, part int, query_id bigint, vec_id bigint, score double, verified bigint, "
        "low array<double>, high array<double>")


def _search_home(k: int) -> callable:
    """Step 1 in one block: neighbours of its own queries, and the bounds of its projections."""
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        block = [int(x) for x in key]
        if not len(vectors):
            return pd.DataFrame(columns=[c.split()[0] for c in HOME.split(", ")])
        index = BlockIndex(vectors["vec_id"].to_numpy(np.int64), matrix(vectors["vec"]))
        out = [(True, *block, 0, 0, 0.0, 0, index.sorted[:, 0], index.sorted[:, -1])]
        for query_id, query in zip(queries["query_id"].tolist(), queries["vec"]):
            ids, scores, verified = index.search(query_id, np.asarray(query, np.float64), k)
            out += [(False, *block, query_id, int(i), float(s), verified, None, None) for i, s in zip(ids, scores)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in HOME.split(", ")])
    return run


REACHED = ["dim", "cell", "part", "query_id", "vec", "half"]


def _reach(key, queries: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
    """Blocks, other than its own, that enough windows of a query reach."""
    if not len(queries) or not len(bounds):
        return pd.DataFrame(columns=REACHED)
    vecs = matrix(queries["vec"])
    centers = unit(vecs) @ directions(vecs.shape[1]).T
    half = queries["half"].to_numpy()[:, None] + SLACK
    out = []
    for cell, part, low, high in zip(bounds["cell"].tolist(), bounds["part"].tolist(), bounds["low"], bounds["high"]):
        reached = ((centers + half >= low) & (centers - half <= high)).sum(axis=1) >= COLLISIONS
        home = (queries["cell"].to_numpy() == cell) & (queries["part"].to_numpy() == part)
        at = np.flatnonzero(reached & ~home)
        if len(at):
            out.append(pd.DataFrame({"dim": int(key[0]), "cell": cell, "part": part,
                                     "query_id": queries["query_id"].to_numpy()[at],
                                     "vec": queries["vec"].to_numpy()[at], "half": half[at, 0]}))
    return pd.concat(out) if out else pd.DataFrame(columns=REACHED)


FOUND = "query_id bigint, vec_id bigint, score double, verified bigint"


def _search_blocks(k: int) -> callable:
    """Step 2 in one block: neighbours of the queries that reach it."""
    def run(key, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(vectors) and len(queries):
            index = BlockIndex(vectors["vec_id"].to_numpy(np.int64), matrix(vectors["vec"]))
            for query_id, ids, scores, verified in index.search_within(
                    queries["query_id"].to_numpy(np.int64), matrix(queries["vec"]), queries["half"].to_numpy(), k):
                out += [(query_id, int(i), float(s), verified) for i, s in zip(ids, scores)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in FOUND.split(", ")])
    return run


def _upto(n: str) -> Column:
    """One row for each number below column ``n``."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n).cast("bigint") - 1))


def blocks_of(vectors: DataFrame, is_query: Column) -> DataFrame:
    """Usable rows (vec_id, vec, is_query) of ``vectors`` with the block of each (dim, cell, part)
    and ``parts``, the number of blocks of its cell. Floats are carried as such, other numbers as
    doubles; both are computed with in double precision."""
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("vec"),
                          F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("vec"))).withColumn("dim", F.size("vec"))
    pivots = rows.sparkSession.sparkContext.broadcast(_pivots(rows))
    schema = f"vec_id bigint, vec {kind}, is_query boolean, dim int, cell int, deal bigint"
    placed = stage(rows.mapInPandas(_place(pivots), schema), "ann-vectors")
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    return placed.join(parts, ["dim", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("deal"), F.col("parts")).cast("int"))


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """Rows query_id, vec_id, score, verified: up to k nearest of each query in each block that it
    was sent to; ``verified`` counts the vectors of that block whose cosine was taken."""
    blocks = blocks_of(vectors, is_query)
    first = F.min(F.struct("vec", "dim", "cell", "parts")).alias("s")
    queries = blocks.where("is_query").groupBy(F.col("vec_id").alias("query_id")).agg(first).select("query_id", "s.*")
    queries = stage(queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.col("parts")).cast("int")), "ann-queries")
    home = blocks.groupBy(*BLOCK).cogroup(queries.groupBy(*BLOCK)).applyInPandas(_search_home(k), HOME)
    home = stage(home, "ann-home")
    found = home.where("NOT is_bound").select("query_id", "vec_id", "score", "verified")

    # half width of each query: its k-th best distance, without a bound if it has fewer
    distance = F.sqrt(F.greatest(2 - 2 * F.col("least"), F.lit(0.0)))
    half = F.when(F.col("n") == k, F.greatest(STOP * distance, F.lit(FIRST))).otherwise(F.lit(float("inf")))
    best = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    sent = queries.join(best, "query_id", "left").withColumn("half", half)

    # a stated set of queries against the bounds of all blocks, both in groups of bounded size
    bounds = home.where("is_bound").select(*BLOCK, "low", "high")
    groups = bounds.groupBy("dim").agg(F.ceil(F.count("*") / BOUND_ROWS).alias("groups"))
    asked = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_ROWS).alias("query_groups"))
    sizes = groups.join(asked, "dim")
    left = sent.join(sizes, "dim").withColumn("query_group", F.pmod(F.xxhash64("query_id"), F.col("query_groups"))).select(
        *BLOCK, "query_id", "vec", "half", "query_group", _upto("groups").alias("group"))
    right = bounds.join(sizes, "dim").withColumn("group", F.pmod(F.xxhash64("cell", "part"), F.col("groups"))).select(
        *BLOCK, "low", "high", "group", _upto("query_groups").alias("query_group"))
    at = ["dim", "query_group", "group"]
    schema = f"dim int, cell int, part int, query_id bigint, vec {blocks.schema['vec'].dataType.simpleString()}, half double"
    reached = stage(left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_reach, schema), "ann-reached")

    copies = reached.groupBy(*BLOCK).agg(F.ceil(F.count("*") / QUERY_ROWS).alias("copies"))
    left = blocks.join(copies, BLOCK).select(*BLOCK, "vec_id", "vec", _upto("copies").alias("copy"))
    right = reached.join(copies, BLOCK).withColumn("copy", F.pmod(F.xxhash64("query_id"), F.col("copies")))
    at = [*BLOCK, "copy"]
    return found.unionByName(left.groupBy(*at).cogroup(right.groupBy(*at)).applyInPandas(_search_blocks(k), FOUND))


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each query row of ``vectors``
    (vec_id, embedding)."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = search(vectors, is_query, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
