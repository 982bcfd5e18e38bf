import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers_llm import docs_frame
from loadcast.llm import exact_dedup as X
from loadcast.llm.exact_dedup import CuckooIndex


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 60)), max_size=300))
def test_index_behaves_like_a_dict(ops):
    index, model = CuckooIndex(4), {}
    for insert, i in ops:
        key = digest(i)
        if insert and key not in model:
            index.insert(key, i)
            model[key] = i
        elif not insert:
            assert index.delete(key) == (model.pop(key, None) is not None)
    assert dict(index.items()) == model and len(index) == len(model)


def test_index_resizes_from_stored_keys_and_keeps_every_entry():
    index = CuckooIndex(4)
    for i in range(5000):
        index.insert(digest(i), i)
    assert index.resizes > 5
    assert all(index.values[index.find(digest(i))] == i for i in range(5000))
    assert not any(digest(i) in index for i in range(5000, 20000))


def test_equal_fingerprints_are_told_apart_by_the_stored_key():
    index = CuckooIndex(4)
    a, b = b"\x01\x02" + bytes(30), b"\x01\x02" + bytes(29) + b"\x01"
    index.insert(a, "a")
    assert b not in index and index.false_hits >= 1
    index.insert(b, "b")
    assert index.delete(a) and a not in index and b in index


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_matches_brute_force_with_a_hot_group(spark):
    r = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"text {r.randrange(60)}") for i in range(400)]
    rows += [(None, "only null id"), (None, "hot"), (900, None), (901, ""), (902, "x" * 200_000), (903, "x" * 200_000)]
    rows += [(5, rows[5][1]), (950, "twice"), (950, "twice")]
    got = X.exact_dedup(docs_frame(spark, rows).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_drop_copies_keeps_one_row_of_each_text(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (7, "b"), (None, "c"), (None, "c")]
    df = docs_frame(spark, rows).selectExpr("*", "1 AS digest", "2 AS keep_id", "3 AS n_keep", "4 AS salt")
    out = X.drop_copies(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text or "") for r in out.collect()), key=str) == [(2, "a"), (4, ""), (7, "b"), (None, "c")]


def test_empty_table(spark):
    df = docs_frame(spark, [])
    assert X.exact_dedup(df).count() == 0 and X.drop_copies(df).count() == 0


def test_stored_index_under_insertions_and_deletions(spark):
    index = spark.createDataFrame([], "digest binary, doc_id bigint")
    changes = spark.createDataFrame(
        [(1, "insert", 1, "a"), (2, "insert", 2, "a"), (3, "delete", 1, "a"), (4, "insert", 3, "a"),
         (5, "insert", 4, "b"), (6, "delete", 9, "b"), (7, "insert", 5, None), (8, "insert", 6, "")],
        "seq int, op string, doc_id bigint, text string")
    index, done = X.apply_changes(index, changes)
    kinds = {(r.doc_id, r.kind) for r in done.collect()}
    assert kinds == {(1, "added"), (2, "duplicate"), (1, "deleted"), (3, "added"), (4, "added"), (9, "absent"),
                     (5, "added"), (6, "duplicate")}
    assert {r.doc_id for r in index.collect()} == {3, 4, 5}
    again, done = X.apply_changes(index, spark.createDataFrame(
        [(1, "insert", 10, "b"), (2, "delete", 4, "b"), (3, "insert", 11, "b")],
        "seq int, op string, doc_id bigint, text string"))
    assert {r.doc_id for r in again.collect()} == {3, 5, 11}
