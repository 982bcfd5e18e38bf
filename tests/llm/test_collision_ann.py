import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from loadcast.llm import collision_ann as A

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(rows, k=5, step=50):
    def cosine(a, b):
        a, b = np.asarray(a, np.float32).astype(float), np.asarray(b, np.float32).astype(float)
        return (a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))
    out = {}
    for q, v in rows:
        if q % step == 0:
            near = sorted(((-cosine(v, x), i) for i, x in rows if i != q and len(x) == len(v)))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def found(df):
    out = {}
    for r in A.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_scores_and_blocks(spark, monkeypatch):
    r = np.random.default_rng(3)
    centers = r.standard_normal((30, 24))
    rows = [(i, [float(x) for x in centers[i % 30] + 0.6 * r.standard_normal(24)]) for i in range(2000)]
    monkeypatch.setattr(A, "BLOCK_ROWS", 700)
    monkeypatch.setattr(A, "QUERY_ROWS", 25)
    got, want = found(frame(spark, rows)), brute(rows)
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    exact = {(q, i): s for q, v in brute(rows, k=2000).items() for i, s in v}
    assert all(abs(exact[q, i] - s) < 1e-12 for q, v in got.items() for i, s in v)


def test_ties_copies_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(0, 120)] + [(200, [1.0, 0.0, 0.0])]
    bad = [(300, None), (350, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]), (450, [nan, 1.0, 1.0]), (500, [1.0, inf, 0.0]),
           (550, []), (None, [1.0, 1.0, 1.0])]
    other = [(600, [1.0, 1.0]), (601, [2.0, 2.1])]
    got = found(frame(spark, rows + bad + other))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[200]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[600]] == [601]
    assert set(got) == {0, 50, 100, 200, 600}


def test_fewer_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.5]), (1, [0.2, 1.0]), (2, [-1.0, 0.3])]
    assert {q: [i for i, _ in v] for q, v in found(frame(spark, rows)).items()} == {0: [1, 2]}
    assert found(frame(spark, [(0, [1.0])])) == {}
    assert found(frame(spark, [])) == {}


def test_repeated_query_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])]
    assert {q: [i for i, _ in v] for q, v in found(frame(spark, rows)).items()} == {0: [1, 2]}


def clustered(n, clusters, dim=32, noise=0.02, seed=5):
    r = np.random.default_rng(seed)
    centers = r.standard_normal((clusters, dim))
    return centers[np.arange(n) % clusters] + noise * r.standard_normal((n, dim))


def test_blocks_that_are_left_out_hold_no_vector_to_verify():
    vecs = clustered(600, 12)
    blocks = [A.BlockIndex(np.arange(600)[b::12], vecs[b::12]) for b in range(12)]
    bounds = pd.DataFrame({"cell": range(12), "part": 0, "low": [b.sorted[:, 0] for b in blocks],
                           "high": [b.sorted[:, -1] for b in blocks]})
    half = 0.4
    queries = pd.DataFrame({"query_id": range(60), "vec": list(vecs[:60]), "half": half,
                            "cell": [i % 12 for i in range(60)], "part": 0})
    reached = {(r.query_id, r.cell) for r in A._reach((32, 0, 0), queries, bounds).itertuples()}
    axes, all_units = A.directions(32), A.unit(vecs)
    projected = all_units @ axes.T
    for q in range(60):
        collisions = (np.abs(projected - projected[q]) <= half).sum(axis=1) >= A.COLLISIONS
        holding = {b for b in range(12) if b != q % 12 and collisions[b::12].any()}
        assert holding <= {c for i, c in reached if i == q}
    assert len(reached) < 60


def test_one_round_counts_the_same_collisions():
    vecs = np.random.default_rng(2).standard_normal((500, 16))
    index = A.BlockIndex(np.arange(500), vecs)
    projected = A.unit(vecs) @ index.axes.T
    for half in (0.2, 0.9, 1.6):
        for q, ids, scores, verified in index.search_within(np.arange(20), vecs[:20], np.full(20, half), 5):
            hit = (np.abs(projected - projected[q]) <= half).sum(axis=1) >= A.COLLISIONS
            hit[q] = False
            assert verified == hit.sum() and set(ids) <= set(np.flatnonzero(hit))
            assert list(scores) == sorted(scores, reverse=True)


def test_clustered_vectors_meet_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 100)
    vecs = clustered(2000, 40)
    df = frame(spark, [(i, [float(x) for x in v]) for i, v in enumerate(vecs)])
    met = A.search(df, F.col("vec_id") % 50 == 0).groupBy("query_id").agg(F.sum("verified").alias("n")).collect()
    got, want = found(df), brute([(i, list(v)) for i, v in enumerate(vecs)])
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    # k rows for each block that has any; each carries its block's count
    assert all(r.n <= 5 * 200 for r in met)


def test_tiny_and_huge_vectors(spark):
    rows = [(0, [1e-200, 1e-200]), (1, [1e300, 1e300]), (2, [5e-324, 0.0]), (3, [1.7e308, -1.7e308]), (50, [0.0, 1e-310])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = found(df)
    assert [i for i, _ in got[0]] == [1, 2, 50, 3] and abs(got[0][0][1] - 1) < 1e-12
    assert [i for i, _ in got[50]][-1] == 3 and abs(dict(got[50])[0] - np.sqrt(0.5)) < 1e-12


def test_a_third_of_all_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 50)
    r = np.random.default_rng(8)
    rows = [(i, [1.0, 2.0, -1.0, 0.5] if i % 3 == 0 else [float(x) for x in r.standard_normal(4)]) for i in range(600)]
    sizes = A.blocks_of(frame(spark, rows), F.col("vec_id") % 50 == 0).groupBy(*A.BLOCK).count().collect()
    assert max(s["count"] for s in sizes) < 120
    got = found(frame(spark, rows))
    assert [i for i, _ in got[0]] == [3, 6, 9, 12, 15] and all(len(v) == 5 for v in got.values())
