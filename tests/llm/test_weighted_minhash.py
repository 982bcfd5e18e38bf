import hashlib

import numpy as np
from pyspark.sql import functions as F

from helpers_llm import docs_frame, edited, rng, sentence
from loadcast.llm import weighted_minhash as M


def brute_weights(texts, factors):
    out = []
    for t in texts:
        _, h, tf = M.batch_shingles([t or ""])
        out.append(dict(zip(h.tolist(), (tf * factors[M.cell_of(h)]).tolist())))
    return out


def brute_similarity(a, b):
    keys = set(a) | set(b)
    top = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys)
    bottom = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return top / bottom if bottom else 0.0


def test_samples_agree_with_probability_of_weighted_jaccard():
    r = np.random.default_rng(5)
    hashes = r.integers(0, 1 << 48, 60, dtype=np.uint64)
    hashes.sort()
    wa, wb = r.random(60) * 3 + 0.1, r.random(60) * 3 + 0.1
    wa[:10], wb[50:] = 0, 0
    keep_a, keep_b = wa > 0, wb > 0
    n = 3000
    _, ka = M.consistent_samples(np.zeros(keep_a.sum(), np.int64), hashes[keep_a], wa[keep_a], n)
    _, kb = M.consistent_samples(np.zeros(keep_b.sum(), np.int64), hashes[keep_b], wb[keep_b], n)
    expected = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    assert abs((ka == kb).mean() - expected) < 0.04


def test_short_texts_and_distinct_counts():
    rows, hashes, tf = M.batch_shingles(["one two", "", "a b c d e a b c d e", "one  TWO"])
    assert rows.tolist().count(1) == 0 and rows.tolist().count(0) == 1
    assert hashes[rows == 0] == hashes[rows == 3]
    assert tf[rows == 2].sum() == 6 and (tf[rows == 2] == 2).sum() == 1


def corpus():
    r = rng(7)
    texts = [sentence(r, 80) for _ in range(60)]
    passage = sentence(r, 60)  # in many otherwise different texts
    texts += [sentence(r, 60) + " " + passage for _ in range(20)]
    base = sentence(r, 150)
    texts += [edited(r, base, int(r.integers(1, 4))) for _ in range(25)]  # one large group of near copies
    texts += [edited(r, texts[i], 1) for i in range(10)]
    texts += [texts[0], texts[0], texts[70], None, "", "one two", "one two", "one two three", " ".join(["loop"] * 5000)]
    return [(i, t) for i, t in enumerate(texts)]


def test_classes_match_brute_force(spark):
    rows = corpus()
    df = docs_frame(spark, rows).repartition(4)
    factors = M.idf_table(df)
    weights = brute_weights([t for _, t in rows], factors)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = (rows[i][1] or "") == (rows[j][1] or "")
            if same or brute_similarity(weights[i], weights[j]) >= M.THRESHOLD:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    expected = {i: (max(g), len(g)) for g in groups.values() for i in g}
    got = {r.doc_id: (r.keep_id, r.class_size) for r in M.near_classes(df).collect()}
    assert got == expected
    assert max(n for _, n in got.values()) >= 10


def test_no_pair_of_a_bucket_is_skipped(spark, monkeypatch):
    """One bucket of a ruling class of 300 texts and 100 pairs, which meet nowhere else."""
    r = rng(11)
    base = sentence(r, 120)
    texts = [edited(r, base, 1) for _ in range(300)]
    for _ in range(100):
        texts.append(sentence(r, 120))
        texts.append(edited(r, texts[-1], 1))
    signed = M.signatures

    def one_bucket(docs, idf):
        alone = F.transform(F.sequence(F.lit(2), F.lit(M.BANDS)), lambda band: F.xxhash64("doc_id", band))
        return signed(docs, idf).withColumn("bands", F.concat(F.array(F.lit(7).cast("bigint")), alone))

    monkeypatch.setattr(M, "signatures", one_bucket)
    got = {x.doc_id: (x.keep_id, x.class_size) for x in M.near_classes(docs_frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: (299, 300) if i < 300 else (i | 1, 2) for i in range(500)}


def test_texts_that_share_a_doc_id_are_told_apart(spark):
    r = rng(4)
    texts = [sentence(r, 120) for _ in range(6)]
    near = [edited(r, t, 1) for t in texts]
    rows = [(9, texts[0]), (None, near[0]), (5, texts[1]), (None, near[1]), (None, texts[2]), (None, near[2]),
            (None, texts[3]), (2, texts[4]), (1, near[4]), (1, texts[5]), (1, near[5])]
    got = {x.text_sha256: x for x in M.near_classes(docs_frame(spark, rows)).collect()}
    classes = [[got[hashlib.sha256(t.encode()).hexdigest()] for _, t in rows[a:b]]
               for a, b in ((0, 2), (2, 4), (4, 6), (6, 7), (7, 9), (9, 11))]
    assert [[x.keep_id for x in c] for c in classes] == [[9, 9], [5, 5], [None, None], [None], [2, 2], [1, 1]]
    assert all(x.class_size == len(c) for c in classes for x in c)
    assert all(sum(x.kept for x in c) == 1 for c in classes)
    kept = {x.text for x in M.drop_near_copies(docs_frame(spark, rows)).collect()}
    assert len(kept) == 6 and {texts[0], texts[1], texts[3], texts[4]} <= kept


def test_counts_beyond_16_bits_are_verified_whole(spark):
    rows = [(i, "ab cd ef gh ij " * n) for i, n in enumerate((66_000, 90_000, 120_000, 160_000))]
    assert [x.class_size for x in M.near_classes(docs_frame(spark, rows)).collect()] == [1] * 4


def test_star_links_are_the_verified_similarities(spark):
    rows = corpus()[:3] + [(50, corpus()[0][1])]
    out = {r.doc_id: r for r in M.near_classes(docs_frame(spark, rows)).collect()}
    assert out[50].keep_id == out[0].keep_id == 50 and out[0].links == 0 and not out[0].kept and out[50].kept


def test_drop_near_copies_keeps_columns_and_one_of_each_class(spark):
    r = rng(2)
    base = sentence(r, 120)
    rows = [(1, base), (2, edited(r, base, 1)), (2, "other words here"), (3, None), (4, None), (None, sentence(r, 30)),
            (9, "same row"), (9, "same row")]
    df = docs_frame(spark, rows).selectExpr("*", "0 AS id", "1 AS bands", "2 AS n_keep")
    out = M.drop_near_copies(df)
    assert out.columns == df.columns
    kept = sorted(((x.doc_id, (x.text or "")[:10]) for x in out.collect()), key=str)
    assert len(kept) == 5 and (4, "") in kept and (9, "same row") in kept and (2, "other word") in kept


def test_empty_table(spark):
    df = docs_frame(spark, [])
    assert M.near_classes(df).count() == 0 and M.drop_near_copies(df).count() == 0
