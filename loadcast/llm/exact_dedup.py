"""Exact dedup through a cuckoo-filter index of live digests.

``CuckooIndex`` is the index of one hash bucket: a cuckoo filter (16-bit fingerprints, four
slots a bucket, two candidate buckets) whose slots point at the stored keys. A fingerprint
hit is only a hint; it counts when the key stored with the slot equals the looked-up key
(sha256 of the whole text). Keys can be inserted, found and deleted; when an insertion
finds no place within ``MAX_KICKS`` moves the table doubles and is refilled from the stored
keys, so nothing is ever lost to an overflow.

``exact_groups`` runs the index over a whole table in two passes: one index per input
partition (each digest once per partition, whatever its number of copies), then one index
per hash bucket over what the first pass left. ``apply_changes`` maintains a stored index
by insertions and deletions.

Defined results: null text counts as empty; equal texts form one group, the largest doc_id
stays; a null doc_id loses to any other; of repeated rows with the same doc_id and text one
row is marked kept by ``drop_copies`` and both carry the same decision in ``exact_groups``;
an empty table gives an empty result; extra columns pass through ``drop_copies`` untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import ROWS_PER_BUCKET, attach_by_group, bucket_count, pick_rows, stage

SLOTS = 4
MAX_KICKS = 200
NO_ID = -(1 << 63)  # stands for a null doc_id: smaller than any other


class CuckooIndex:
    """Keys (bytes of a cryptographic digest) with one value each."""

    def __init__(self, capacity: int = 64):
        n = 1
        while n * SLOTS * 0.9 < max(capacity, 4):
            n *= 2
        self._alloc(n)
        self.resizes = 0
        self.false_hits = 0

    def _alloc(self, n_buckets: int) -> None:
        self.mask = n_buckets - 1
        self.fingerprints = [0] * (n_buckets * SLOTS)
        self.keys: list[bytes | None] = [None] * (n_buckets * SLOTS)
        self.values: list = [None] * (n_buckets * SLOTS)
        self.size = 0

    def _fingerprint(self, key: bytes) -> int:
        return (key[0] << 8 | key[1]) or 1

    def _home(self, key: bytes) -> int:
        return int.from_bytes(key[2:10], "little") & self.mask

    def _other(self, bucket: int, fingerprint: int) -> int:
        return (bucket ^ (fingerprint * 0x5BD1E995)) & self.mask

    def find(self, key: bytes) -> int:
        """Slot of a live key, or -1. Fingerprint hits are verified against the stored key."""
        fp = self._fingerprint(key)
        first = self._home(key)
        fps, keys = self.fingerprints, self.keys
        for bucket in (first, self._other(first, fp)):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if fps[slot] == fp:
                    if keys[slot] == key:
                        return slot
                    self.false_hits += 1
        return -1

    def __contains__(self, key: bytes) -> bool:
        return self.find(key) >= 0

    def __len__(self) -> int:
        return self.size

    def insert(self, key: bytes, value=None) -> None:
        """Store a key that is not live."""
        self.size += 1
        while (left := self._place(key, value)) is not None:
            key, value = left
            self._grow()

    def _place(self, key, value):
        """Put an entry into the table; returns the entry left over when it is full."""
        fp = self._fingerprint(key)
        bucket = self._home(key)
        for kick in range(MAX_KICKS):
            for b in (bucket, self._other(bucket, fp)):
                for slot in range(b * SLOTS, b * SLOTS + SLOTS):
                    if self.keys[slot] is None:
                        self.fingerprints[slot], self.keys[slot], self.values[slot] = fp, key, value
                        return None
            # both buckets are full: move an entry of the second one to its other bucket
            victim = self._other(bucket, fp) * SLOTS + kick % SLOTS
            bucket = self._other(victim // SLOTS, self.fingerprints[victim])
            moved = self.fingerprints[victim], self.keys[victim], self.values[victim]
            self.fingerprints[victim], self.keys[victim], self.values[victim] = fp, key, value
            fp, key, value = moved
        return key, value

    def _grow(self) -> None:
        """Double the table and refill it from the stored keys."""
        self.resizes += 1
        entries = list(self.items())
        size, n = self.size, (self.mask + 1) * 2
        while True:
            self._alloc(n)
            if all(self._place(k, v) is None for k, v in entries):
                self.size = size
                return
            n *= 2

    def delete(self, key: bytes) -> bool:
        slot = self.find(key)
        if slot < 0:
            return False
        self.fingerprints[slot], self.keys[slot], self.values[slot] = 0, None, None
        self.size -= 1
        return True

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((k, v) for k, v in zip(self.keys, self.values) if k is not None)


def _merge(most: int | None = None) -> Callable:
    """One row per digest of the partition: its largest doc_id, its rows, and the rows that
    hold the largest doc_id. With ``most``, an index of that many digests is passed on and a new
    one begun, so that a digest can come out again: for the pass that only combines."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = CuckooIndex()
        for pdf in batches:
            for digest, doc_id, n, n_top in zip(pdf["digest"], pdf["keep_id"].tolist(),
                                                pdf["group_size"].tolist(), pdf["n_keep"].tolist()):
                slot = index.find(digest)
                if slot < 0:
                    if most is not None and len(index) >= most:
                        yield from _entries(index)
                        index = CuckooIndex()
                    index.insert(digest, [doc_id, n, n_top])
                    continue
                held = index.values[slot]
                held[1] += n
                if doc_id > held[0]:
                    held[0], held[2] = doc_id, n_top
                elif doc_id == held[0]:
                    held[2] += n_top
        yield from _entries(index)
    return run


def _entries(index: CuckooIndex) -> Iterator[pd.DataFrame]:
    entries = list(index.items())
    for at in range(0, len(entries), 10_000):
        part = entries[at:at + 10_000]
        yield pd.DataFrame({"digest": [k for k, _ in part],
                            "keep_id": [v[0] for _, v in part],
                            "group_size": [v[1] for _, v in part],
                            "n_keep": [v[2] for _, v in part]})


GROUP_SCHEMA = "digest binary, keep_id bigint, group_size bigint, n_keep bigint"


def digest_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, salt) of every row; the salt numbers the input partition."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"),
                       F.spark_partition_id().alias("salt"))


def exact_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): the staged (doc_id, digest, salt) of every row, and one row per
    distinct text: digest, keep_id, group_size, n_keep (rows that carry keep_id)."""
    spark = docs.sparkSession
    rows = stage(digest_rows(docs), "exact-digests")
    one = rows.select("digest", F.coalesce("doc_id", F.lit(NO_ID)).alias("keep_id"),
                      F.lit(1).cast("bigint").alias("group_size"), F.lit(1).cast("bigint").alias("n_keep"))
    partial = one.mapInPandas(_merge(ROWS_PER_BUCKET), GROUP_SCHEMA)
    buckets = bucket_count(spark, rows.count())
    groups = partial.repartition(buckets, "digest").mapInPandas(_merge(), GROUP_SCHEMA)
    groups = groups.withColumn("keep_id", F.nullif("keep_id", F.lit(NO_ID)))
    return rows, stage(groups, "exact-groups")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, groups = exact_groups(docs)
    out = attach_by_group(rows, "digest", "salt", groups)
    return out.select("doc_id", "keep_id", "group_size",
                      F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns."""
    _, groups = exact_groups(docs)
    return pick_rows(docs, groups.select(F.col("keep_id").alias("id"), "digest", "n_keep"))


# ---- a stored index under insertions and deletions -----------------------------------------

INDEX_SCHEMA = "digest binary, doc_id bigint"
CHANGE_RESULT = "kind string, digest binary, doc_id string, holder string"


def _replay(key, stored: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """Ids and numbers come and go as text (see ``map_keyed``); null is first in order."""
    index = CuckooIndex(len(stored) + len(changes))
    for digest, doc_id in zip(stored["digest"], stored["doc_id"]):
        index.insert(digest, doc_id)
    number = lambda v: (v is not None, int(v or 0))
    rows = zip(changes["seq"], changes["doc_id"], changes["op"], changes["digest"])
    out = []
    for _, doc_id, op, digest in sorted(rows, key=lambda r: (number(r[0]), number(r[1]))):
        slot = index.find(digest)
        holder = index.values[slot] if slot >= 0 else None
        if op == "delete":
            found = slot >= 0 and holder == doc_id
            if found:
                index.delete(digest)
            out.append(("deleted" if found else "absent", digest, doc_id, holder))
        elif slot < 0:
            index.insert(digest, doc_id)
            out.append(("added", digest, doc_id, doc_id))
        else:
            out.append(("duplicate", digest, doc_id, holder))
    out += [("live", k, v, v) for k, v in index.items()]
    return pd.DataFrame(out, columns=["kind", "digest", "doc_id", "holder"])


def apply_changes(index: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Insert and delete documents in a stored index of live digests.

    ``index`` has (digest, doc_id), one row per live text. ``changes`` has (seq, op, doc_id,
    text), op ``insert`` or ``delete``, replayed by seq. Returns the new index and one row
    per change: kind (added, duplicate, deleted, absent), doc_id, holder. A text becomes
    insertable again once its holder is deleted; a null doc_id holds and deletes like any other,
    changes of equal seq go by doc_id, null first. Changes are bucketed by digest prefix;
    a batch's changes of one text are expected to fit a task.
    """
    spark = index.sparkSession
    n = bucket_count(spark, index.count() + changes.count())

    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(n)))

    text_id = F.col("doc_id").cast("bigint").cast("string").alias("doc_id")
    rows = changes.select(F.col("seq").cast("bigint").cast("string").alias("seq"), "op", text_id,
                          F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"))
    done = bucketed(index.select("digest", text_id)).groupBy("bucket").cogroup(
        bucketed(rows).groupBy("bucket")).applyInPandas(_replay, CHANGE_RESULT)
    done = stage(done.withColumns({c: F.col(c).cast("bigint") for c in ("doc_id", "holder")}), "dedup-index")
    return (done.where("kind = 'live'").select("digest", "doc_id"),
            done.where("kind <> 'live'").select("kind", "doc_id", "holder"))
