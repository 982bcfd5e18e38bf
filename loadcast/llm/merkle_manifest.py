"""Merkle manifest of a dataset by checkpoint-and-recompute.

Every row is a leaf; the leaves of a source form a tree with ``FANOUT`` children a node, and
the sources' roots form one more tree, whose root stands for the dataset. Only every ``STEP``-th
level is written: a level-``k`` node and its stored descendants of level ``k - STEP`` are an
aligned subtree of at most ``FANOUT ** STEP`` stored nodes, the unit of all work. Building
reduces each aligned subtree to its top node. Proofs go the other way: from the top stored level
down, each aligned subtree regenerates its missing interior nodes from the stored ones below it,
emits their siblings behind the path its own top node got, and discards them. A leaf's path is
made in the task that holds its subtree and never stored.

A leaf's place in its source comes from one range partitioning of (source, doc_id, leaf) and the
sums of rows per source and partition, so a source with a third of all rows spreads over as many
tasks as its rows need. Nothing but the largest number of leaves of a source reaches the driver.

Defined results: a null value is ``-`` in its leaf, an empty text ``0:``; a null source is a
source of its own and comes first; null doc_ids come first and are never tampered with; rows of
equal doc_id are ordered by their leaf, and equal rows are leaves beside each other; texts count
whole; an empty table has no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import bucket_count, stage

FANOUT = 3
STEP = 4  # every fourth level is stored
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(data: str) -> str:
    return hashlib.sha256(data.encode()).hexdigest()


def height(leaves: int) -> int:
    """Levels above the leaves: the least h with FANOUT ** h >= leaves."""
    h, reach = 0, 1
    while reach < leaves:
        h, reach = h + 1, reach * FANOUT
    return h


# ---- one aligned subtree --------------------------------------------------------------------

def climb(nodes: list[str], levels: int) -> list[list[str]]:
    """The nodes of an aligned subtree, level by level from the given ones up."""
    out = [nodes]
    for _ in range(levels):
        nodes = [digest("".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]
        out.append(nodes)
    return out


def siblings(levels: list[list[str]], position: int) -> list[tuple[str, str]]:
    """What stands left and right of a node in its run, for each level below the top."""
    out = []
    for nodes in levels[:-1]:
        run = position - position % FANOUT
        out.append(("".join(nodes[run:position]), "".join(nodes[position + 1:run + FANOUT])))
        position //= FANOUT
    return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


def encode_path(path: list[tuple[str, str]]) -> str:
    return "".join(f"{left}|{right}," for left, right in path)


def decode_path(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in path.split(",")[:-1]]


# ---- forests --------------------------------------------------------------------------------

@dataclass
class Forest:
    """Trees by name: ``levels[i]`` holds the nodes of level i * STEP as (tree, idx, n, digest),
    n being the tree's leaves; level 0 keeps the leaves' other columns."""

    levels: list[DataFrame]
    payload: list[str]

    def roots(self) -> DataFrame:
        return self.levels[-1].select("tree", "digest")


def number_leaves(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, digest, ...) with ``idx``, their place within the tree by ``order``, and
    ``n``, the tree's rows."""
    spark = rows.sparkSession
    rows = stage(rows.withColumn("rid", F.monotonically_increasing_id()), "merkle-leaves")  # rid: splits equal rows
    by = ["tree", *order, "rid"]
    placed = rows.repartitionByRange(bucket_count(spark, rows.count()), *by).sortWithinPartitions(*by)
    # partition number and place within it, in one number
    placed = stage(placed.drop("rid").withColumn("at", F.monotonically_increasing_id()), "merkle-placed")
    part = F.shiftright("at", 33)
    runs = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                       F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    return (placed.withColumn("part", part).join(runs, ["tree", "part"])
            .withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift"))


def build_forest(rows: DataFrame, order: list[str]) -> Forest:
    """The trees over ``rows`` (tree, digest, ...); only every STEP-th level is stored."""
    payload = [c for c in rows.columns if c not in ("tree", "digest")]
    leaves = stage(number_leaves(rows, order), "merkle-level0")
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    for low in range(0, height(largest), STEP):
        up = _subtrees(levels[-1], ["digest"]).mapInArrow(_reduce(low), "tree string, idx bigint, n bigint, digest string")
        levels.append(stage(up, f"merkle-level{low + STEP}"))
    return Forest(levels, payload)


def _subtrees(nodes: DataFrame, columns: list[str]) -> DataFrame:
    """One row per aligned subtree: tree, idx (of its top node), n and its stored nodes."""
    return nodes.groupBy("tree", F.expr(f"idx div {FANOUT ** STEP}").alias("top")).agg(
        F.first("n").alias("n"), F.collect_list(F.struct("idx", *columns)).alias("nodes")).withColumnRenamed("top", "idx")


def _steps(n: int, low: int) -> int:
    """Levels that a tree of n leaves has between the stored level ``low`` and the next."""
    return max(0, min(STEP, height(n) - low))


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.StructArray, int, int]]:
    """(row, its nodes sorted by idx as one struct array, begin, end) of every subtree."""
    lists = batch.column("nodes")
    sizes = np.diff(lists.offsets.to_numpy())
    nodes = lists.flatten()
    idx = nodes.field("idx").to_numpy()
    nodes = nodes.take(pa.array(np.lexsort((idx, np.repeat(np.arange(len(sizes)), sizes)))))
    ends = np.cumsum(sizes)
    for row, (size, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
        yield row, nodes, end - size, end


def _reduce(low: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, names = [], None
            ns = batch.column("n").to_pylist()
            for row, nodes, begin, end in _batches(batch):
                names = nodes.field("digest").to_pylist() if names is None else names
                digests.append(climb(names[begin:end], _steps(ns[row], low))[-1][0])
            yield pa.RecordBatch.from_arrays([batch.column("tree"), batch.column("idx"), batch.column("n"),
                                              pa.array(digests, pa.string())], names=["tree", "idx", "n", "digest"])
    return run


Emit = Callable[[str, list[tuple[str, str]], tuple[str, str], dict], tuple]


def prove(forest: Forest, above: DataFrame, columns: list[str], schema: str, emit: Emit) -> DataFrame:
    """A row for every leaf: its ``columns``, then ``emit(digest, path, (subroot, root), values)``,
    path leading from the leaf to the root and values being the leaf's other columns. ``above``
    gives each tree its way on from its own root: tree, subroot, root, path."""
    nodes, paths = forest.levels, above.withColumn("idx", F.lit(0).cast("bigint"))
    for i in range(len(nodes) - 2, 0, -1):
        rows = _subtrees(nodes[i], ["digest"]).join(paths, ["tree", "idx"])
        paths = stage(rows.mapInArrow(_descend(i * STEP, ["idx"], PATH_COLUMNS, None), PATH_SCHEMA), "merkle-paths")
    rows = _subtrees(nodes[0], ["digest", *forest.payload]).join(paths, ["tree", "idx"])
    return rows.mapInArrow(_descend(0, columns, [c.split()[0] for c in schema.split(", ")], emit), schema)


PATH_COLUMNS = ["idx", "path", "tree", "subroot", "root"]
PATH_SCHEMA = "idx bigint, path string, tree string, subroot string, root string"


def _descend(low: int, kept: list[str], names: list[str], emit: Emit | None) -> Callable:
    """Regenerates each subtree's nodes and gives every stored node its path; without ``emit``
    the path itself is returned, for the level below."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, tops = batch.column("n").to_pylist(), batch.column("path").to_pylist()
            about = {c: batch.column(c).to_pylist() for c in ("tree", "subroot", "root")}
            out, owner, nodes = [], [], None
            for row, nodes, begin, end in _batches(batch):
                if not owner:
                    values = {f.name: nodes.field(f.name).to_pylist() for f in nodes.type}
                digests = values["digest"][begin:end]
                levels, roots, rest = climb(digests, _steps(ns[row], low)), (about["subroot"][row], about["root"][row]), tops[row]
                way = decode_path(rest) if emit else []
                for position in range(end - begin):
                    path = siblings(levels, position)
                    out.append(emit(digests[position], path + way, roots, {c: v[begin + position] for c, v in values.items()})
                               if emit else (encode_path(path) + rest,))
                owner += [row] * (end - begin)
            if out:
                columns = [*[nodes.field(c) for c in kept], *[pa.array(c) for c in zip(*out)]]
                if not emit:
                    columns += [pa.array([v[row] for row in owner], pa.string()) for v in about.values()]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


# ---- the manifest of documents --------------------------------------------------------------

def leaf_digest(**columns: Column) -> Column:
    """Digest of a row: each value is ``-`` if null, else its UTF-8 bytes' count, ``:``, itself."""
    def field(value: Column) -> Column:
        s = value.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[field(columns[c]) for c in LEAF_COLUMNS]), 256)


def tamper(text: Column, doc_id: Column) -> Column:
    """The text with its line feeds deleted, where 2 divides the crc32 of the doc_id."""
    hit = F.crc32(doc_id.cast("string")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


@dataclass
class Manifest:
    sources: Forest  # a tree per source; its leaves keep doc_id and tampered
    top: Forest  # the tree over the sources' roots

    def root(self) -> DataFrame:
        return self.top.roots().select(F.col("digest").alias("root"))


def build_manifest(docs: DataFrame) -> Manifest:
    """The manifest of a table of documents. Tree names are the sources behind an ``=``, so the
    null source ("") comes first."""
    columns = {c: F.col(c) for c in LEAF_COLUMNS}
    leaf = leaf_digest(**columns)
    # without a line feed tampering changes nothing
    changed = F.when(F.contains("text", F.lit("\n")), leaf_digest(**columns | {"text": tamper(F.col("text"), F.col("doc_id"))}))
    rows = docs.select(F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source").cast("string")))
                       .alias("tree"), leaf.alias("digest"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       changed.alias("tampered"))
    sources = build_forest(rows, ["doc_id", "digest"])
    names = sources.roots().select(F.lit("").alias("tree"), "digest", F.col("tree").alias("name"))
    return Manifest(sources, build_forest(names, ["name"]))


def _sources_above(manifest: Manifest) -> DataFrame:
    """Every source's root and its path to the dataset's root."""
    start = manifest.top.roots().select("tree", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                                        F.lit("").alias("path"))
    found = prove(manifest.top, start, ["name", "digest"], "tree string, subroot string, root string, path string",
                  lambda leaf, path, roots, values: (roots[1], encode_path(path)))
    return stage(found, "merkle-sources")


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf and its proof: the siblings of every level, left and right of the node, as
    ``left|right,`` each."""
    return prove(manifest.sources, _sources_above(manifest), ["doc_id", "digest"], "doc_id bigint, leaf string, proof string",
                 lambda leaf, path, roots, values: (encode_path(path),))


def _checked(leaf: str, path: list[tuple[str, str]], roots: tuple[str, str], values: dict) -> tuple:
    folded = fold(values["tampered"] or leaf, path)
    return (*roots, digest("".join(left + right for left, right in path)), folded, folded == roots[1])


def verify(manifest: Manifest) -> DataFrame:
    """Every document's digests, and whether its (tampered) leaf still leads to the root."""
    return prove(manifest.sources, _sources_above(manifest), ["doc_id", "digest"],
                 "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                 "verified boolean", _checked)
