import zlib
from collections import defaultdict

import pytest

from conftest import SF_SMALL
from helpers_llm import DOCS
from loadcast.llm import merkle_manifest as M
from loadcast.llm.queries import op13_merkle_manifest

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def leaf_of(doc_id, text, lang, source, n_chars):
    def field(v):
        s = None if v is None else str(v)
        return "-" if s is None else f"{len(s.encode())}:{s}"
    return M.digest("".join(map(field, (doc_id, source, lang, n_chars, text))))


def whole_tree(leaves):
    """(root, siblings of every leaf, level by level) with every node kept."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([M.digest("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for level in levels[:-1]:
            path.append([(j < i, level[j]) for j in range(i - i % 3, min(i - i % 3 + 3, len(level))) if j != i])
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append((r, leaf_of(*r)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    order = lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])
    trees = {s: whole_tree([leaf for _, leaf in sorted(by_source[s], key=order)]) for s in names}
    root, upper = whole_tree([trees[s][0] for s in names]) if names else ("", [])
    out = []
    for s, above in zip(names, upper):
        for (row, leaf), path in zip(sorted(by_source[s], key=order), trees[s][1]):
            doc_id, text = row[0], row[1]
            node = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
                node = leaf_of(doc_id, text.replace("\n", ""), *row[2:])
            for run in path + above:
                node = M.digest("".join(d for left, d in run if left) + node + "".join(d for left, d in run if not left))
            proof = M.digest("".join(d for run in path + above for _, d in run))
            out.append((doc_id, leaf, trees[s][0], root, proof, node, node == root))
    return sorted(out, key=str)


def spark_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def run(spark, rows, extra=()):
    df = spark.createDataFrame(rows, DOCS).repartition(3).selectExpr("*", *extra)
    return spark_rows(M.verify(M.build_manifest(df)))


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (3, 4, 9), (10, 27, 28, 82), (81, 244, 1), (1,) * 30])
def test_trees_of_every_shape(spark, sizes):
    rows, doc_id = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            doc_id += 7
            rows.append((doc_id, f"text {doc_id}\nline", "en", f"s{k}", doc_id))
    got = run(spark, rows)
    assert got == brute(rows)
    assert {r[6] for r in got} == {True, False} or len(got) < 5


def test_nulls_ties_and_clashing_columns(spark):
    rows = [(None, "a\n", "en", None, 1), (None, None, None, None, None), (2 ** 53 + 1, "", "", "", 0),
            (2 ** 53, "é\n漢", "fr", "", 3), (-5, "x\ny", "en", "s", 3), (7, "tie", "en", "s", 3), (7, "tie", "en", "s", 3),
            (7, "other\n", "en", "s", 3), (8, "long\n" * 40_000, "en", "=", 1)] + [(9, "same\n", "en", "hot", 5)] * 100
    extra = ["1 AS tree", "2 AS idx", "3 AS rid", "4 AS path", "5 AS digest", "6 AS leaf", "7 AS at", "8 AS part"]
    assert run(spark, rows, extra) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_query_on_the_small_table(spark):
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars"))
            for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert spark_rows(op13_merkle_manifest(spark, SF_SMALL)) == brute(rows)


def test_proofs_lead_to_the_root_and_only_some_levels_are_stored(spark):
    rows = [(i, f"t{i}", "en", "one" if i % 3 else "two", i) for i in range(700)]
    manifest = M.build_manifest(spark.createDataFrame(rows, DOCS))
    root = manifest.root().first().root
    found = M.proofs(manifest).collect()
    assert len(found) == 700 and all(M.fold(r.leaf, M.decode_path(r.proof)) == root for r in found)
    assert [df.count() for df in manifest.sources.levels] == [700, 6 + 3, 2]  # 467 and 233 leaves: levels 0, 4 and 8
