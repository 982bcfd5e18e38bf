import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as P
from helpers_llm import docs_frame, edited, rng, sentence
from loadcast.llm import weighted_minhash as M
from loadcast.llm.queries import TOKENIZER
from test_mixing import brute as mixture
from test_weighted_minhash import brute_similarity, brute_weights

BAD = ["grumblefuzz", "snarkweed"]


def rows_and_labels():
    r = rng(11)
    rows = [(i, sentence(r, 60), "en" if i % 4 else "de", f"src{i % 6}") for i in range(150)]
    labels = []
    for i in range(0, 150, 5):
        words = rows[i][1].split()
        words[7:7] = BAD
        rows[i] = (i, " ".join(words), *rows[i][2:])
    labels = [(i, 1, int(i % 5 == 0)) for i in range(150)]
    rows += [(200 + i, rows[i][1], "en", "src1") for i in (1, 2, 3)]  # exact copies
    rows += [(300 + i, edited(r, rows[i][1], 1), "en", "src2") for i in (6, 7, 8)]  # near copies
    rows += [(400, "sn4rkweed gr umblefuzz grumbl3fuzz", "en", "src0"), (401, None, None, None), (402, "", "fr", "src3"),
             (403, "twice", "en", "src4"), (403, "twice", "en", "src4")]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = rows_and_labels()
    docs_frame(spark, rows).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "tokens"]


def test_matches_brute_force_stage_by_stage(spark, folder):
    from tokenizers import Tokenizer
    rows, labels = rows_and_labels()
    columns = spark.read.parquet(f"{folder}/documents.parquet").columns
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    outs = []
    for k, (name, f) in enumerate(P.STAGES):
        path = f"{folder}/stage{k}"
        f(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if k < len(P.STAGES) - 1:
            assert docs.columns == columns
        outs.append(docs)
    key = lambda r: (str(r.doc_id), r.text)

    # toxicity: the labelled toxic ones and the disguised one go, all else stays
    left = [r for r in rows if not (r[0] < 150 and r[0] % 5 == 0) and r[0] != 400]
    assert Counter(map(key, outs[0].collect())) == Counter((str(r[0]), r[1]) for r in left)

    # exact dedup: the largest doc_id of each text
    best = {}
    for r in left:
        if r[1] is None or r[1] == "":
            best[""] = max(best.get("", r), r, key=lambda x: x[0])
        else:
            best[r[1]] = max(best.get(r[1], r), r, key=lambda x: x[0])
    left = list(best.values())
    assert sorted(map(key, outs[1].collect())) == sorted((str(r[0]), r[1]) for r in left)

    # near dedup: the largest doc_id of each class of weighted Jaccard similarity 0.8
    weights = brute_weights([r[1] for r in left], M.idf_table(outs[1]))
    label = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if brute_similarity(weights[i], weights[j]) >= M.THRESHOLD:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    left = [max((left[i] for i in range(len(left)) if label[i] == c), key=lambda r: r[0]) for c in set(label)]
    assert sorted(map(key, outs[2].collect())) == sorted((str(r[0]), r[1]) for r in left)
    assert {1, 2, 3, 6, 7, 8}.isdisjoint(r[0] for r in left)

    # mixing, then tokens
    taken = Counter(d for d, _ in mixture(left))
    assert Counter(r.doc_id for r in outs[3].collect()) == taken
    t = Tokenizer.from_file(TOKENIZER)
    text = {r[0]: r[1] or "" for r in left}
    for r in outs[4].collect():
        ids = t.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert Counter(r.doc_id for r in outs[4].collect()) == taken


def test_run_applies_all_stages(spark, folder):
    out = P.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and out.count() > 100


def test_empty_tables(spark, tmp_path):
    docs_frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
