"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A document is its bag of five-word shingles (lower-cased words between white space), each
weighted tf x idf. Improved consistent weighted sampling (Ioffe 2010) draws ``BANDS * ROWS``
samples a document such that two documents agree in a sample with probability equal to
their weighted Jaccard similarity; ``ROWS`` samples make a band key, and documents that
share a band key are candidates. Candidates are verified by their exact weighted Jaccard
similarity on all shingles (0.8 or more), verified links form classes.

Document frequencies are counted over every document in a table of ``IDF_CELLS`` hashed
cells. Its size is fixed, so merging and broadcasting it is safe at any input size, and what
it resolves is relative: shingles in more than about (shingles a document / IDF_CELLS) of
all documents get a smaller weight, the rest share the weight of a rare shingle. idf is
sqrt(ln(1 + N / cell)): the root keeps copies alike in large groups of near copies, whose
common shingles are frequent because of the group itself.

Work on groups stays linear: equal texts collapse to one representative first; in a band
bucket every document is compared with the bucket's leader (a star), not with all others. Where
a bucket's documents are still in several classes after that, they are compared with a randomly
drawn member too, then the bucket is split by further bands (``LEVELS`` in all), each finer
bucket with a drawn leader of its own. What these rounds leave is compared in full: in every
bucket that still spans several classes, all members of different classes, in cells of two
blocks of about ``BLOCK_DOCS`` texts dealt over the tasks. The largest class of a bucket is
not compared with itself, so its texts are copied once for each block of the others. No bucket
is capped, and no pair of different classes that shares a band is skipped.

A text is known by its sha256 digest; doc_id only chooses the row of a class that stays.

Defined results: null text counts as empty; texts without words are near-duplicates only of
equal texts; a text of one to four words has one shingle, the whole of it; a null doc_id
loses to any other; of several texts of a class with its largest doc_id the one of the
largest digest stays; repeated rows carry the same class; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .exact_dedup import NO_ID
from .frames import attach_by_group, bucket_count, pick_rows, stage
from .textvec import MIX2, Words, distinct_counts, mix64, shingles, text_slices

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 12, 3  # a pair of similarity 0.8 shares a band with probability 1 - (1 - 0.8**3)**12 = 0.9998
IDF_CELLS = 1 << 18
LEVELS = 2  # bands combined at most to split a bucket that spans several classes, before all its pairs are compared
BLOCK_DOCS, BLOCK_BYTES = 128, 4 << 20  # texts, and bytes of shingles, that a block of a bucket holds on average
SLICES = 64  # parts of the frequency table while partial tables are merged
FEATURES_PER_BUCKET = 10_000
LEADER_SALTS = 32
DRAW_BITS = 17  # table of random draws, indexed by two hashes of the shingle and the sample number
DRAWS = 1 << DRAW_BITS


# ---- shingles of a batch --------------------------------------------------------------------

def batch_shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, 48-bit shingle hash, tf), sorted by row and hash."""
    return distinct_counts(*shingles(Words([t.lower() for t in texts]), WIDTH))


def cell_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(IDF_CELLS - 1)).astype(np.int64)


# ---- document frequencies -------------------------------------------------------------------

def _count_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cells = np.zeros(IDF_CELLS, np.int64)
    n = 0
    for pdf in batches:
        n += len(pdf)
        for _, texts in text_slices(pdf["text"].tolist()):
            _, h, _ = batch_shingles(texts)
            cells += np.bincount(cell_of(h), minlength=IDF_CELLS)
    yield _sliced(cells, n)


def _sliced(cells: np.ndarray, n: int) -> pd.DataFrame:
    dtype = np.uint8 if cells.max(initial=0) < 256 else np.uint16 if cells.max() < 65536 else np.int64
    parts = cells.astype(dtype).reshape(SLICES, -1)
    return pd.DataFrame({"part": np.arange(SLICES), "kind": np.dtype(dtype).name,
                         "n": [n if i == 0 else 0 for i in range(SLICES)],
                         "cells": [zlib.compress(p.tobytes(), 1) for p in parts]})


def _merge_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds up the partial tables of each slice that reach this task, as they stream by."""
    sums: dict[int, np.ndarray] = {}
    n = 0
    for pdf in batches:
        n += int(pdf["n"].sum())
        for part, kind, data in zip(pdf["part"], pdf["kind"], pdf["cells"]):
            values = np.frombuffer(zlib.decompress(data), kind).astype(np.int64)
            sums[part] = sums[part] + values if part in sums else values
    if sums or n:
        rows = sorted(sums.items())
        yield pd.DataFrame({"part": [p for p, _ in rows], "kind": "int64",
                            "n": [n if i == 0 else 0 for i in range(len(rows))],
                            "cells": [zlib.compress(v.tobytes(), 1) for _, v in rows]})


CELL_SCHEMA = "part int, kind string, n bigint, cells binary"


def idf_table(docs: DataFrame) -> np.ndarray:
    """Weight factor of each cell, from all documents. IDF_CELLS numbers reach the driver."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    partial = texts.mapInPandas(_count_cells, CELL_SCHEMA)
    spread = partial.repartition(SLICES * 4, "part", F.pmod(F.xxhash64("cells"), F.lit(4)))
    merged = spread.mapInPandas(_merge_cells, CELL_SCHEMA).repartition(SLICES, "part")
    rows = merged.mapInPandas(_merge_cells, CELL_SCHEMA).collect()
    cells = np.zeros((SLICES, IDF_CELLS // SLICES), np.int64)
    for r in rows:
        cells[r["part"]] += np.frombuffer(zlib.decompress(r["cells"]), "int64")
    n = max(sum(r["n"] for r in rows), 1)
    return np.sqrt(np.log1p(n / np.maximum(cells.ravel(), 1))).astype(np.float32)


# ---- sampling -------------------------------------------------------------------------------

_draws: tuple[np.ndarray, ...] | None = None
LIFT = 64.0  # added to every ln a: positive floats sort like their bits


def draw_tables() -> tuple[np.ndarray, ...]:
    """1 / r, beta, r and ln c + r beta - r + LIFT for gamma(2, 1) draws r, c and uniform beta."""
    global _draws
    if _draws is None:
        g = np.random.Generator(np.random.PCG64(20240229))
        r = g.gamma(2.0, 1.0, DRAWS).clip(1e-6)
        c = g.gamma(2.0, 1.0, DRAWS).clip(1e-12)
        beta = g.random(DRAWS)
        _draws = tuple(x.astype(np.float32) for x in (1 / r, beta, r, np.log(c) + r * beta - r + LIFT))
    return _draws


def consistent_samples(rows: np.ndarray, hashes: np.ndarray, weights: np.ndarray, samples: int
                       ) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys): ``keys[i, k]`` identifies sample k of row ``rows[i]``.

    For each element: t = floor(ln w / r + beta), ln a = ln c - r (t - beta + 1); the sample
    is the element of least a together with its t. Rows must be sorted. The least is found on
    64-bit numbers with the bits of ln a above and the element's place below.
    """
    present, first = np.unique(rows, return_index=True)
    n = len(hashes)
    keys = np.empty((len(present), samples), np.uint64)
    if not n:
        return present, keys
    inverse_r, beta, r, constant = draw_tables()
    log_w = np.log(weights).astype(np.float32)
    packed = np.empty(n, "<u8")
    halves = packed.view("<u4").reshape(n, 2)
    halves[:, 0] = np.arange(n)
    t, x, y = (np.empty(n, np.float32) for _ in range(3))
    draw = np.empty(n, np.uint32)
    with np.errstate(over="ignore"):
        mixed = mix64(hashes)
        step = (mixed >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        at = mixed.astype(np.uint32)
        for k in range(samples):
            np.right_shift(at, np.uint32(32 - DRAW_BITS), out=draw)
            np.add(at, step, out=at)
            np.take(inverse_r, draw, out=t, mode="clip")
            np.multiply(t, log_w, out=t)
            np.take(beta, draw, out=x, mode="clip")
            np.floor(np.add(t, x, out=t), out=t)
            np.take(r, draw, out=x, mode="clip")
            np.take(constant, draw, out=y, mode="clip")
            halves[:, 1] = np.subtract(y, np.multiply(x, t, out=x), out=y).view(np.uint32)
            pick = (np.minimum.reduceat(packed, first) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            keys[:, k] = hashes[pick] * np.uint64(MIX2) + t[pick].astype(np.int64).astype(np.uint64)
    return present, keys


def band_keys(keys: np.ndarray) -> np.ndarray:
    """(documents, BANDS) band hashes out of (documents, BANDS * ROWS) sample keys."""
    with np.errstate(over="ignore"):
        out = np.zeros((len(keys), BANDS), np.uint64)
        for j in range(ROWS):
            out = mix64(out + keys[:, j::ROWS] * np.uint64(2 * j + 3))
        return out.view(np.int64)


def _signatures(idf) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = idf.value
        for pdf in batches:
            texts = pdf["text"].tolist()
            bands: list = [None] * len(texts)
            digest = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            for start, part in text_slices(texts):
                r, h, tf = batch_shingles(part)
                present, keys = consistent_samples(r, h, tf * factors[cell_of(h)], BANDS * ROWS)
                for i, row in zip((present + start).tolist(), band_keys(keys)):
                    bands[i] = row
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "digest": digest, "salt": pdf["salt"], "bands": bands})
    return run


def signatures(docs: DataFrame, idf) -> DataFrame:
    """Staged (doc_id, digest, salt, bands) of every document; bands is null without words."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"), F.spark_partition_id().alias("salt"))
    return stage(rows.mapInPandas(_signatures(idf), "doc_id bigint, digest binary, salt int, bands array<bigint>"),
                 "near-signatures")


# ---- verification ---------------------------------------------------------------------------

def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, shingles) of texts: the 48-bit hashes in 8 bytes each, then their tf in 4 bytes each."""
    for pdf in batches:
        texts, out = pdf["text"].tolist(), [b""] * len(pdf)
        for start, part in text_slices(texts):
            r, h, tf = batch_shingles(part)
            h, tf = h.astype("<u8"), tf.astype("<u4")
            for i, f, l in zip(*_runs(r)):
                out[start + i] = h[f:l].tobytes() + tf[f:l].tobytes()
        yield pd.DataFrame({"id": pdf["id"], "shingles": out})


def features_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the wanted (id, doc_id), bucketed by id: the joins that follow move
    pairs to the shingles, not the shingles to the pairs. Of equal texts only the rows of the
    doc_id asked for are read on."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text")).withColumn("id", F.unhex(F.sha2("text", 256)))
    n = bucket_count(spark, wanted.count(), FEATURES_PER_BUCKET)
    found = (rows.join(wanted, ["id", "doc_id"], "left_semi").select("id", "text")
             .mapInPandas(_features, "id binary, shingles binary")
             .repartition(n, "id").dropDuplicates(["id"]))
    path = scratch_path(spark, "near-features")
    name = "near_features_" + path.rpartition("-")[2]
    found.write.bucketBy(n, "id").sortBy("id").option("path", path).saveAsTable(name)
    return spark.table(name)


def _runs(rows: np.ndarray) -> tuple[list, list, list]:
    present, first = np.unique(rows, return_index=True)
    return present.tolist(), first.tolist(), np.append(first[1:], len(rows)).tolist()


def unpack(blob: bytes, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, weights) of a packed document."""
    n = len(blob) // 12
    h = np.frombuffer(blob, "<u8", n)
    return h, np.frombuffer(blob, "<u4", n, 8 * n).astype(np.float64) * factors[cell_of(h)]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller weights over sum of larger weights."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    at = np.searchsorted(ha, hb)
    at[at == len(ha)] = 0
    same = ha[at] == hb
    common = float(np.minimum(wa[at[same]], wb[same]).sum())
    return common / (float(wa.sum()) + float(wb.sum()) - common)


def _verify(idf, threshold: float) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = idf.value
        for pdf in batches:
            scores, last, left = [], None, None
            for a, blob_a, blob_b in zip(pdf["a"], pdf["shingles_a"], pdf["shingles_b"]):
                if a != last:
                    last, left = a, unpack(blob_a, factors)
                scores.append(weighted_jaccard(left, unpack(blob_b, factors)))
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "similarity": scores})
            yield out[out["similarity"] >= threshold]
    return run


def verified(pairs: DataFrame, features: DataFrame, idf, threshold: float) -> DataFrame:
    """The (a, b) pairs whose weighted Jaccard similarity reaches the threshold. A leader's
    pairs are dealt over LEADER_SALTS copies of it, so a huge class doesn't meet in one task."""
    left = features.select(F.col("id").alias("a"), F.col("shingles").alias("shingles_a"))
    right = features.select(F.col("id").alias("b"), F.col("shingles").alias("shingles_b"))
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(LEADER_SALTS)).alias("salt"))
    leaders = salted.select("a", "salt").distinct().join(left, "a")
    both = salted.join(right, "b").join(leaders, ["a", "salt"])
    return both.select("a", "b", "shingles_a", "shingles_b").mapInPandas(
        _verify(idf, threshold), "a binary, b binary, similarity double")


# ---- pairs of different classes in a bucket ---------------------------------------------------

def cell_links(rows: list[tuple], factors: np.ndarray, threshold: float) -> list[tuple]:
    """Links (a, b, similarity) among the (p, q, block, id, label, shingles) of one cell: of all
    pairs of its block with itself (p = q) or of its two blocks with one another, those of
    different classes. Classes joined by a link are not compared further."""
    rows = sorted(rows, key=lambda r: r[3])
    block = np.array([r[2] for r in rows])
    docs = [unpack(r[5], factors) for r in rows]
    total = np.array([w.sum() for _, w in docs])
    number: dict = {}
    joined = np.array([number.setdefault(r[4], len(number)) for r in rows])
    place, inside = np.arange(len(rows)), rows[0][0] == rows[0][1]
    least = threshold * (1 - 1e-9)  # what rounding may cost here is decided by weighted_jaccard
    out = []
    for i, (h, w) in enumerate(docs):
        other = place > i if inside else (place > i) & (block != block[i])
        near = np.minimum(total, total[i]) >= least * np.maximum(total, total[i])
        some = np.flatnonzero(other & near & (joined != joined[i]) & (total > 0))
        if not len(some):
            continue
        hs, ws = (np.concatenate(x) for x in zip(*(docs[j] for j in some)))
        first = np.cumsum([0, *(len(docs[j][0]) for j in some[:-1])])
        at = np.searchsorted(h, hs)
        at[at == len(h)] = 0
        common = np.add.reduceat(np.where(h[at] == hs, np.minimum(w[at], ws), 0.0), first)
        for j in some[common >= least * (total[i] + total[some] - common)].tolist():
            similarity = weighted_jaccard(docs[i], docs[j])
            if similarity >= threshold:
                out.append((rows[i][3], rows[j][3], similarity))
                joined[joined == joined[j]] = joined[i]
    return out


def _cells(idf, threshold: float) -> callable:
    """Rows arrive sorted by cell; one cell is held at a time."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors, cell, rows = idf.value, None, []
        for pdf in batches:
            out = []
            for band, key, *row in zip(*(pdf[c] for c in ("band", "key", "p", "q", "block", "id", "label", "shingles"))):
                if (band, key, row[0], row[1]) != cell:
                    if len(rows) > 1:
                        out += cell_links(rows, factors, threshold)
                    cell, rows = (band, key, row[0], row[1]), []
                rows.append(tuple(row))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])
        if len(rows) > 1:
            yield pd.DataFrame(cell_links(rows, factors, threshold), columns=["a", "b", "similarity"])
    return run


def remaining_links(in_bucket: DataFrame, labels: DataFrame, features: DataFrame, idf, threshold: float) -> DataFrame:
    """Links between the classes that still meet in a bucket (band, key, id, a), from all pairs
    but those with its leader a, which are tried already."""
    sizes = features.select("id", F.length("shingles").alias("size"))
    mixed = in_bucket.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 2").drop("n")
    members = stage(in_bucket.where("id <> a").select("band", "key", "id").join(mixed, ["band", "key"])
                    .join(labels, "id").join(sizes, "id"), "near-left")
    classes = members.groupBy("band", "key", "label").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_DOCS, size / BLOCK_BYTES)).cast("int")
    buckets = classes.groupBy("band", "key").agg(
        F.max(F.struct("n", "label", "size")).alias("top"), F.sum("n").alias("n"), F.sum("size").alias("size"),
        F.count("*").alias("classes")).where("classes > 1").select(
        "band", "key", F.col("top.label").alias("top"), blocks(F.col("top.n"), F.col("top.size")).alias("tops"),
        blocks(F.col("n") - F.col("top.n"), F.col("size") - F.col("top.size")).alias("rests"))
    # blocks of the largest class are -1, -2, ..., those of the others 0, 1, ...
    dealt = members.join(buckets, ["band", "key"]).withColumn(
        "block", F.expr("IF(label = top, -1 - pmod(xxhash64(id), tops), pmod(xxhash64(id), rests))").cast("int"))
    rest = F.expr("sequence(0, rests - 1)")
    cells = dealt.select("band", "key", "id", "label", "block", F.explode(
        F.when(F.col("block") < 0, rest).otherwise(F.concat(rest, F.expr("sequence(-tops, -1)")))).alias("with"))
    cells = cells.select(
        "band", "key", "id", "label", "block",
        F.expr("IF(block < 0, with, IF(with < 0, block, least(block, with)))").alias("p"),
        F.expr("IF(block < 0, block, IF(with < 0, with, greatest(block, with)))").alias("q"))
    cell = ["band", "key", "p", "q"]
    rows = cells.join(features, "id").repartition(*cell).sortWithinPartitions(*cell)
    found = rows.mapInPandas(_cells(idf, threshold), "a binary, b binary, similarity double")
    return found.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


# ---- classes --------------------------------------------------------------------------------

def components(nodes_in_links: DataFrame, links: DataFrame) -> DataFrame:
    """(id, label): the smallest id of each node's connected component.

    Rounds of "take the least label among the neighbours, then the label's label", each
    staged, until no label changes; a star needs one round, a chain of n links about
    log n rounds.
    """
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stage(edges, "near-links")
    labels = stage(nodes_in_links.select("id", F.col("id").alias("label")), "near-labels")
    while True:
        around = edges.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(
            F.min("label").alias("near"))
        hooked = labels.join(around, labels["id"] == around["a"], "left").select(
            "id", "label", F.least("label", F.coalesce("near", "label")).alias("low"))
        jump = hooked.select(F.col("id").alias("low"), F.col("low").alias("lower"))
        new = hooked.join(jump, "low", "left").select(
            "id", "label", F.least("low", F.coalesce("lower", "low")).alias("new"))
        new = stage(new, "near-labels")
        changed = new.where("new <> label").limit(1).count()
        labels = new.select("id", F.col("new").alias("label"))
        if not changed:
            return labels


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: doc_id, keep_id (the largest doc_id of its class), class_size
    (rows), links (verified links of its text with other texts), kept, text_sha256."""
    spark: SparkSession = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(docs))
    rows = signatures(docs, idf)

    # one representative for each distinct text; its digest is its id
    texts = stage(rows.groupBy(F.col("digest").alias("id")).agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("copies"),
                                                                F.first("bands").alias("bands")), "near-texts")
    members = texts.where("bands is not null").select("id", F.posexplode("bands").alias("band", "key"))
    # a bucket's leader is its document with the most company over all its buckets: of near
    # copies of one text, the one closest to that text
    sizes = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(members.join(sizes, ["band", "key"]), "near-shared")
    company = shared.groupBy("id").agg(F.sum("n").alias("company"))
    ranked = stage(shared.join(company, "id"), "near-ranked")
    leaders = ranked.groupBy("band", "key").agg(F.max(F.struct("company", "id"))["id"].alias("a"))
    in_bucket = stage(ranked.select("band", "key", "id").join(leaders, ["band", "key"]), "near-buckets")
    star = in_bucket.where("id <> a").select("a", F.col("id").alias("b")).distinct()

    # shingles of the documents that occur in any bucket of two or more
    wanted = stage(in_bucket.select("id").distinct(), "near-wanted")
    features = features_of(docs, texts.select("id", "doc_id").join(wanted, "id", "left_semi"))
    links = stage(verified(star, features, idf, threshold), "near-star")
    labels = components(wanted, links)

    # buckets that still span several classes: compare with a drawn leader as well, then
    # split them by further bands
    levels, tried = ranked.select("band", "key", "id", "company"), star
    for level in range(1, LEVELS + 1):
        if level > 1:
            bands = ranked.select("id", F.col("band").alias("band2"), F.col("key").alias("key2"))
            levels = levels.join(bands, "id").where("band2 > band").select(
                F.col("band2").alias("band"), F.xxhash64("band", "key", "key2").alias("key"), "id", "company")
        levels = stage(levels.join(labels, "id"), "near-levels")
        drawn = levels.groupBy("band", "key").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"),
            F.max(F.struct(F.xxhash64("band", "key", "id").alias("draw"), "id", "label")).alias("l")
            ).where("lo <> hi").select("band", "key", "l")
        levels = stage(levels.join(drawn, ["band", "key"]), "near-levels")
        pairs = (levels.where("label <> l.label").select(F.col("l.id").alias("a"), F.col("id").alias("b"))
                 .distinct().join(tried, ["a", "b"], "left_anti"))
        pairs = stage(pairs, "near-pairs")
        levels = levels.select("band", "key", "id", "company")
        if pairs.isEmpty():
            break
        more = stage(verified(pairs, features, idf, threshold), "near-more")
        tried = tried.unionByName(pairs)
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = components(wanted, links)

    # all pairs of different classes that are left
    more = stage(remaining_links(in_bucket, labels, features, idf, threshold), "near-rest")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = components(wanted, links)

    # classes of texts, then of rows
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    of_text = (texts.select("id", "doc_id", "copies").join(labels, "id", "left").join(degree, "id", "left")
               .select("id", "doc_id", "copies", F.coalesce("label", "id").alias("label"),
                       F.coalesce("links", F.lit(0)).alias("links")))
    of_text = stage(of_text, "near-text-classes")
    heads = of_text.groupBy("label").agg(F.max(F.struct("doc_id", "id")).alias("head"),
                                         F.sum("copies").alias("class_size"))
    groups = of_text.join(heads, "label").select(
        F.col("id").alias("digest"), F.col("head.doc_id").alias("keep_id"), "class_size", "links",
        (F.col("id") == F.col("head.id")).alias("head"))
    out = attach_by_group(rows.select("doc_id", "digest", "salt"), "digest", "salt", groups)
    return out.select(F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
                      F.nullif("keep_id", F.lit(NO_ID)).alias("keep_id"), "class_size", "links",
                      (F.col("head") & (F.col("doc_id") == F.col("keep_id"))).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, one for each class, with all their columns."""
    kept = near_classes(docs, threshold).where("kept")
    return pick_rows(docs, stage(kept.groupBy(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("digest"))
                                 .agg(F.count("*").alias("n_keep")), "near-kept"))
