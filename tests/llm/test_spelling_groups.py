import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF_SMALL
from helpers_llm import DOCS, rng
from loadcast.llm import spelling_groups as S
from loadcast.llm.queries import op12_spelling_groups

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def count(rows):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def group(n):
    by = {}
    for w in n:  # neighbours through one deleted code point
        for i in range(len(w)):
            by.setdefault((w[:i], w[i + 1:]), []).append(w)
    for w in n:
        for i in range(len(w) + 1):
            if (w[:i], w[i:]) in by:
                by[w[:i], w[i:]].append(w)
    neighbours = {w: set() for w in n}
    for words in by.values():
        for w in words:
            neighbours[w].update(words)
    form = {}
    for w in n:
        neighbours[w] = {x for x in neighbours[w] if near(w, x)}
        best = min(neighbours[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted(((w, form[w], root(w), n[w], len(neighbours[w]), n.get(form[w])) for w in n), key=str)


def frame(spark, rows, extra=()):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(3).selectExpr("*", *extra)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def variants(r, word):
    letters = "abcdeéßÿ"
    i = int(r.integers(len(word)))
    return r.choice([word[:i] + word[i + 1:], word[:i] + letters[r.integers(8)] + word[i + 1:],
                     word[:i] + letters[r.integers(8)] + word[i:]])


def corpus(r, bases, docs):
    words = ["".join(r.choice(list("abcdeéß"), r.integers(6, 13))) for _ in range(bases)]
    words += [variants(r, w) for w in words for _ in range(6)]
    weights = 1 / np.arange(1, len(words) + 1) ** 1.2
    return [(i, " ".join(w.upper() if r.random() < .1 else w for w in r.choice(words, 120, p=weights / weights.sum())) + ".")
            for i in range(docs)]


def test_brute_force(spark):
    rows = corpus(rng(3), 40, 60)
    got = result(S.spelling_groups(frame(spark, rows, ["1 AS word", "2 AS n", "3 AS tile"])))
    assert got == group(count(rows))
    assert any(r[1] for r in got)


@pytest.mark.parametrize("hot", [1, 4])
def test_large_tiles_are_cut_further(spark, hot, monkeypatch):
    """With every tile too large the intervals are cut to one code point; nothing is lost."""
    monkeypatch.setattr(S, "HOT", hot)
    run = S._compare
    r = rng(4)
    words = {"".join(r.choice(list("ab"), r.integers(1, 8))) + "commonend" for _ in range(300)}
    words |= {"x" * 40 + w for w in words}
    n = {w: int(r.integers(2, 50)) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n bigint")
    # the tiles' function runs in this process: the patched bound holds
    seen, rows = set(), S.first_tiles(df, min(map(len, words)))
    for turn in range(20):
        import pyarrow as pa
        table = pa.Table.from_pandas(rows.toPandas().sort_values("tile"), preserve_index=False)
        table = table.set_column(table.schema.get_field_index("n"), "n", table.column("n").cast(pa.int64()))
        out = [x for b in run(iter(table.to_batches(max_chunksize=7))) for x in b.to_pylist()]
        found = [(x["word"], x["other"]) for x in out if x["other"] is not None]
        assert len(found) == len(set(found)) and not seen & set(found)
        seen |= set(found)
        large = [(x["word"], x["n"], x["s"], x["u"], x["v"]) for x in out if x["other"] is None]
        if not large:
            break
        rows = S.finer_tiles(spark.createDataFrame(large, "word string, n bigint, s int, u int, v int"))
    assert turn > 0
    assert seen == {(a, b) for a in words for b in words if near(a, b)}


def test_edges(spark):
    long = "q" * 30_000
    rows = [(None, "Ämterén ämterén Ämterén"), (1, None), (2, ""), (3, long + " " + long), (4, long[1:] + " " + long[1:]),
            (5, "Straße-strasse STRASSEN strassen"), (5, "Straße-strasse STRASSEN strassen"), (2 ** 53 + 1, "×÷Strassen×"),
            (6, "sixsix sixsix seven77 seventy seventy")]
    assert result(S.spelling_groups(frame(spark, rows))) == group(count(rows))
    assert result(S.spelling_groups(frame(spark, []))) == []


def test_ties_go_to_the_smallest_and_chains_to_their_last(spark):
    text = " ".join(["abcdefgh"] * 2 + ["abcdefgx"] * 40 + ["abcdefgb"] * 40 + ["abcdefghh"] * 39 + ["abcdefbb"] * 500)
    rows = [(10, text)]
    got = {r[0]: r for r in result(S.spelling_groups(frame(spark, rows)))}
    assert sorted(got.values(), key=str) == group(count(rows))
    assert got["abcdefgh"][1:3] == ("abcdefgb", "abcdefbb")


def test_query_on_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(op12_spelling_groups(spark, SF_SMALL)) == group(count(rows))
