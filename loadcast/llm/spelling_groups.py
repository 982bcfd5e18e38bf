"""Spelling variants of a corpus's words by dense prefix-suffix tiling.

Two words differ by a single edit exactly if their common prefix and common suffix together
reach the longer length minus one. Which pairs are looked at: let s be the shorter length, cut
into ``SEGMENTS`` intervals. The edit falls in one interval (u, v]; the u code points before it
and the s - v behind it are equal in both words. So each word of length L joins a tile per
interval of s = L and of s = L - 1, named by s, u and the hash of what lies outside the interval,
and every near pair meets in a tile. With x = s - (common suffix, at most s), the earliest place
of the edit, the pair belongs to the one interval with u < x <= v (x = 0: the first), so it is
found once, though it may meet in several tiles.

Tiles arrive sorted by name. The words of many tiles are laid out as two padded matrices of code
points, left- and right-aligned, and blocks of pairs of rows are compared at once. A tile of more
than ``HOT`` words is not compared: its rows are passed through, and the next round cuts their
interval further, down to one code point, where a tile has at most one word for each letter and
one for each two. So a set of words with a common beginning and end, however large, costs about
its size, and no task gathers it.

Words are counted per document in bounded dictionaries, merged by Spark. Counts and words are
complete: no cap, no sample.

Defined results: null text has no words; a null doc_id counts as an empty string in the crc32;
repeated rows count each; texts and runs of any length count whole; ties between near words of
equal count go to the smallest in code-point order; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import bucket_count, stage

SEGMENTS = 4
HOT = 2048  # words of a tile that are compared at once
PAIR_CELLS = 4_000_000  # bytes of each matrix of a block of pairs
COUNTER_WORDS = 200_000  # words that a task counts before it passes them on

# The letters of a run, the divisor of deletions, the least length and count of a
# word, how much more frequent a form is.
RUN = "[a-zÀ-ÿ]{%d,}"
DELETE_EACH = 31
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10


# ---- words ----------------------------------------------------------------------------------

def words_of(doc_id: str, text: str, run: re.Pattern) -> dict[str, int]:
    """Words of a document with their counts, after the deletions."""
    out: dict[str, int] = {}
    lower = text.encode("utf-8").lower().decode("utf-8")  # of bytes: A to Z only
    start = zlib.crc32(f"{doc_id}:".encode())
    for word, n in Counter(run.findall(lower)).items():
        h = zlib.crc32(word.encode("utf-8"), start)
        if h % DELETE_EACH == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
            if len(word) < LEAST_LENGTH:
                continue
        out[word] = out.get(word, 0) + n
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words with at least LEAST_COUNT occurrences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, seen = re.compile(RUN % LEAST_LENGTH), Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                seen.update(words_of(doc_id, text, pattern))
                if len(seen) >= COUNTER_WORDS:
                    yield flush()
                    seen.clear()
        if seen:
            yield flush()

    rows = docs.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ---- tiles ----------------------------------------------------------------------------------

def _cut(u: Column, v: Column, parts: Column) -> Column:
    """(u, v] cut into ``parts`` intervals of about equal length."""
    width = v - u
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(
        (u + F.floor(i * width / parts)).cast("int").alias("u"), (u + F.floor((i + 1) * width / parts)).cast("int").alias("v")))


def _named(rows: DataFrame) -> DataFrame:
    """Rows (word, n, s, u, v) with the name of their tile."""
    before, behind = F.col("word").substr(F.lit(1), F.col("u")), F.expr("right(word, s - v)")
    return rows.withColumn("tile", F.xxhash64("s", "u", "v", before, behind))


def first_tiles(words: DataFrame, least: int) -> DataFrame:
    """Tiles of all pairs whose shorter word has at least ``least`` code points."""
    length = F.char_length("word")
    rows = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("s")).where(F.col("s") >= least)
    return _intervals(rows, F.lit(0), F.col("s"))


def finer_tiles(rows: DataFrame) -> DataFrame:
    return _intervals(rows, F.col("u"), F.col("v"))


def _intervals(rows: DataFrame, u: Column, v: Column) -> DataFrame:
    cut = _cut(u, v, F.greatest(F.least(v - u, F.lit(SEGMENTS)), F.lit(1)))
    return _named(rows.select("word", "n", "s", F.explode(cut).alias("i")).select("word", "n", "s", "i.u", "i.v"))


def _pairs(sizes: np.ndarray, shorter: np.ndarray, first: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of at most about ``cells`` row pairs of the groups (first row, size), the shorter
    words of a group standing first: each of them with every word after it."""
    shape = np.stack([sizes, shorter], axis=1)
    for size, short in np.unique(shape[(sizes > 1) & (shorter > 0)], axis=0).tolist():
        starts = first[(sizes == size) & (shorter == short)]
        a, b = np.triu_indices(short, 1, size)
        for at in range(0, len(a), cells):
            left, right = a[at:at + cells], b[at:at + cells]
            step = max(1, cells // len(left))
            for g in range(0, len(starts), step):
                base = starts[g:g + step, None]
                yield (base + left).ravel(), (base + right).ravel()


def near_pairs(words: list[str], s: np.ndarray, u: np.ndarray, v: np.ndarray, first: np.ndarray,
               sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of each group that are a single edit apart and belong to the
    tile's interval. Words are in Latin-1, those of length s before the longer ones."""
    data = [w.encode("latin-1") for w in words]
    length = np.fromiter(map(len, data), np.int64, len(data))
    width = int(length.max(initial=1))
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in data), np.uint8).reshape(-1, width)
    right = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in data), np.uint8).reshape(-1, width)
    shorter = np.add.reduceat((length == s).astype(np.int64), first)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in _pairs(sizes, shorter, first, max(1, PAIR_CELLS // width)):
        least, longer = np.minimum(length[a], length[b]), np.maximum(length[a], length[b])
        prefix = np.minimum(_run(left[a] == left[b]), least)
        suffix = np.minimum(_run(right[a] == right[b]), least)
        x = s[a] - suffix
        near = (prefix + suffix >= longer - 1) & (prefix < longer)
        ours = (x <= v[a]) & ((x > u[a]) | ((x == 0) & (u[a] == 0)))
        hit = near & ours & (s[a] == s[b]) & (u[a] == u[b]) & (v[a] == v[b])  # names of tiles can collide
        found.append((a[hit], b[hit]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _run(same: np.ndarray) -> np.ndarray:
    """Leading true values of every row."""
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


OUT = ("word string, other string, n_other bigint, n bigint, s int, u int, v int")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile -> near pairs in both directions; rows of tiles that are too large
    (unless their interval is one code point) come out as they are, for the next round."""
    rest: pa.Table | None = None
    passing: int | None = None  # tile whose rows are passed through
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if passing is not None:
            tiles = table.column("tile").to_numpy()
            n = int(np.searchsorted(tiles != passing, True)) if tiles[-1] != passing else len(tiles)
            if n:
                yield from _through(table.slice(0, n))
            table = table.slice(n)
            if not len(table):
                continue
            passing = None
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        tiles = table.column("tile").to_numpy()
        start = int(np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1]))[-1])
        if start:
            yield from _closed(table.slice(0, start))
        rest = table.slice(start)
        if len(rest) > HOT and _coarse(rest):
            yield from _through(rest)
            passing, rest = int(tiles[-1]), None
    if rest is not None and len(rest):
        yield from _closed(rest)


def _coarse(rows: pa.Table) -> bool:
    return rows.column("v")[0].as_py() - rows.column("u")[0].as_py() > 1


def _through(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    empty = pa.nulls(len(rows), pa.string()), pa.nulls(len(rows), pa.int64())
    yield from pa.table([rows.column("word"), *empty, *[rows.column(c) for c in ("n", "s", "u", "v")]],
                        names=[c.split()[0] for c in OUT.split(", ")]).combine_chunks().to_batches()


def _closed(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near pairs of whole tiles; large ones are passed through."""
    tiles = table.column("tile").to_numpy()
    first = np.flatnonzero(np.append(True, tiles[1:] != tiles[:-1]))
    sizes = np.diff(np.append(first, len(tiles)))
    u, v = table.column("u").to_numpy(), table.column("v").to_numpy()
    hot = (sizes > HOT) & (v[first] - u[first] > 1)
    for at, size in zip(first[hot].tolist(), sizes[hot].tolist()):
        yield from _through(table.slice(at, size))
    keep = ~hot & (sizes > 1)
    first, sizes = first[keep], sizes[keep]
    if not len(first):
        return
    rows = np.repeat(first - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
    lengths = pc.utf8_length(table.column("word")).to_numpy()[rows]
    rows = rows[np.lexsort((lengths, np.repeat(np.arange(len(sizes)), sizes)))]  # the shorter words first
    table = table.take(pa.array(rows)).combine_chunks()
    first = np.append(0, np.cumsum(sizes)[:-1])
    words = table.column("word").to_pylist()
    s, u, v = (table.column(c).to_numpy().astype(np.int64) for c in ("s", "u", "v"))
    # widths differ: groups of like length share a matrix
    for part in _like_lengths(s[first], sizes):
        chosen = np.concatenate([np.arange(first[g], first[g] + sizes[g]) for g in part])
        starts = np.append(0, np.cumsum(sizes[part])[:-1])
        a, b = near_pairs([words[i] for i in chosen.tolist()], s[chosen], u[chosen], v[chosen], starts, sizes[part])
        if len(a):
            one, two = chosen[np.concatenate([a, b])], chosen[np.concatenate([b, a])]
            empty = pa.nulls(len(one), pa.int64())
            word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
            none = pa.nulls(len(one), pa.int32())
            yield pa.RecordBatch.from_arrays([word.take(pa.array(one)), word.take(pa.array(two)), n.take(pa.array(two)),
                                              empty, none, none, none], names=[c.split()[0] for c in OUT.split(", ")])


def _like_lengths(lengths: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Groups in bands of lengths up to a power of two, at most PAIR_CELLS of matrix a band."""
    band = np.maximum(4, np.ceil(np.log2(lengths + 2))).astype(np.int64)
    for k in np.unique(band).tolist():
        groups = np.flatnonzero(band == k)
        part = np.cumsum(sizes[groups] * (1 << k)) // PAIR_CELLS
        for p in np.unique(part).tolist():
            yield groups[part == p]


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, n_other) of all near pairs, in both directions. ``words`` is (word, n)."""
    spark = words.sparkSession
    size = words.agg(F.count(F.lit(1)).alias("n"), F.min(F.char_length("word")).alias("least")).first()
    rows, pairs = first_tiles(words, size.least or 0), None
    parts = bucket_count(spark, 2 * SEGMENTS * size.n)
    while True:  # an interval of more than one code point gets shorter each time
        tiled = rows.repartition(parts, "tile").sortWithinPartitions("tile")
        out = stage(tiled.mapInArrow(_compare, OUT), "spelling-pairs")
        found = out.where(F.col("other").isNotNull()).select("word", "other", "n_other")
        pairs = found if pairs is None else pairs.unionByName(found)
        large = out.where(F.col("other").isNull())
        if large.isEmpty():
            return pairs
        rows = finer_tiles(large.select("word", "n", "s", "u", "v"))


# ---- forms and roots ------------------------------------------------------------------------

def spelling_groups(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = stage(count_words(docs), "spelling-words")
    best = F.min(F.struct((-F.col("n_other")).alias("minus"), F.col("other").alias("form")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    accepted = -F.col("best.minus") >= FORM_FACTOR * F.col("n")
    groups = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(accepted, F.col("best.form")).alias("form"),
        F.when(accepted, -F.col("best.minus")).alias("form_n")), "spelling-forms")
    return groups.join(_roots(groups), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(groups: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: pointers doubled until the longest chain
    possible is covered (each step multiplies the count by FORM_FACTOR at least)."""
    ends = groups.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most = groups.agg(F.max("n")).first()[0] or 1
    chain = max(1, math.ceil(math.log(most, FORM_FACTOR)))
    for _ in range(math.ceil(math.log2(chain))):
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ends = stage(ends.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return ends
