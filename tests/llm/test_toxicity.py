import math
import re
import unicodedata
import zlib

import numpy as np
import pytest

from helpers_llm import docs_frame, rng, sentence
from loadcast.llm import toxicity as T
from loadcast.llm.textvec import Words

BAD = ["grumblefuzz", "snarkweed", "loathepot"]


def rows(n=240, seed=4):
    r = rng(seed)
    out, labels = [], []
    for i in range(n):
        words = sentence(r, 40).split()
        toxic = i % 6 == 0
        if toxic:
            for w in r.choice(BAD, int(r.integers(1, 3)), replace=False):
                words.insert(int(r.integers(40)), w)
        out.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return out, labels


@pytest.fixture(scope="module")
def table(spark):
    docs, labels = rows()
    extra = [(1000, "grumbl3fuzz and sn@rkweed"), (1001, "s n a r k w e e d l o a t h e p o t"), (1002, None),
             (1003, ""), (1004, "snaaaaarkweed " + "garden stone " * 3000 + "l0athep0t"), (1005, "river stone 2024 4 u a b"),
             (None, "grumblefuzz snarkweed")]
    df = docs_frame(spark, docs + extra).selectExpr("*", "1 AS score", "'x' AS toxic")
    lab = spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id bigint, toxic int")
    return df, lab, docs, labels


def test_held_out_accuracy_and_restored_spans(spark, table):
    df, lab, docs, labels = table
    got = {r.doc_id: r for r in T.toxicity(df, lab).collect()}
    truth = dict(labels)
    held = [i for i in truth if got[i].held_out]
    assert 40 < len(held) < 120
    assert all(got[i].predicted == truth[i] for i in held)
    assert got[1000].predicted == 1 and got[1001].predicted == 1 and got[1004].predicted == 1
    assert got[1005].predicted == 0 and got[None].predicted == 1
    assert got[1002].score == got[1003].score and got[1002].predicted == 0
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_do_not_matter(spark, table):
    df, lab, _, _ = table
    flipped = lab.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 3 = 1 THEN 1 - toxic ELSE toxic END AS toxic")
    a = sorted((r.doc_id or -1, round(r.score, 9)) for r in T.toxicity(df, lab).collect())
    b = sorted((r.doc_id or -1, round(r.score, 9)) for r in T.toxicity(df, flipped).collect())
    assert a == b


def test_drop_toxic_keeps_clean_rows_and_columns(spark, table):
    df, lab, docs, labels = table
    out = T.drop_toxic(df, lab)
    assert out.columns == df.columns
    left = {r.doc_id for r in out.collect()}
    assert left == {i for i, t in labels if not t} | {1002, 1003, 1005}


def test_viterbi_is_the_best_path(spark):
    model = T.character_model(docs_frame(spark, rows(60)[0]))

    def cost(word):
        x = y = 0
        total = 0.0
        for c in word + " ":
            z = T.symbol_of(c)
            total -= model[x, y, z]
            x, y = y, z
        return total

    for span in ["g4rd3n", "st0ne", "ri1ver", "l1ght", "gaarrden", "wiiinter"]:
        lattice = T.lattice(span)
        paths = [("", 0.0)]
        for options in lattice:
            paths = [(w + t, c + e) for w, c in paths for t, e in options]
        best = min(c + cost(w) for w, c in paths)
        restored = T.viterbi(lattice, model)
        assert abs(min(c for w, c in paths if w == restored) + cost(restored) - best) < 1e-9
    assert T.viterbi(T.lattice("g4rd3n"), model) == "garden"


def test_suspicious_spans():
    found = T.suspicious_spans(Words(["plain words only, here!! a b", "l0ser s c u m coool", "wow$$$ 2024"]))
    assert {s for r, s in found if r == 0} == set()
    assert {s for r, s in found if r == 1} == {"l0ser", "s c u m", "coool"}
    assert {s for r, s in found if r == 2} == set()


def test_degenerate_tables(spark):
    docs = docs_frame(spark, [(1, "a b c"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score < 0.01 for r in T.toxicity(docs, none).collect()] == [True, True]
    one_class = spark.createDataFrame([(1, 1), (2, 1)], "doc_id bigint, toxic int")
    assert T.toxicity(docs, one_class).count() == 2
    assert T.toxicity(docs_frame(spark, []), none).count() == 0


def test_logistic_fit_separates():
    x = np.array([[0.0], [0.2], [2.0], [2.5]])
    w = T.fit_logistic(x, np.array([0, 0, 1, 1]))
    p = 1 / (1 + np.exp(-(w[0] + x[:, 0] * w[1])))
    assert p[1] < 0.5 < p[2]


def test_spans_of_mixed_and_accented_obfuscations():
    texts = ["so l 0 $ e r here", "$ c u m", "du i d i ö t !", "f * c k", "ööö п р и в е т", "a | 1 | 2 and 4 $ 5", "😀s.c.u.m😀"]
    found = {}
    for row, span in T.suspicious_spans(Words(texts)):
        found.setdefault(row, set()).add(span)
    assert found == {0: {"l 0 $ e r"}, 1: {"$ c u m"}, 2: {"i d i ö t"}, 3: {"f * c k"}, 4: {"ööö", "п р и в е т"},
                     6: {"s.c.u.m"}}
    flat = np.log(np.full((T.SYMBOLS,) * 3, 1 / T.SYMBOLS))
    read = [[t for t, _ in options] for options in T.lattice("l 0 $ e r")]
    assert read == [["l"], ["o"], ["s", ""], ["e"], ["r"]]
    assert T.viterbi(T.lattice("i d i ö t"), flat) == "idiöt"


def test_signs_beside_a_word_are_not_part_of_it():
    words = Words(["😀scum😀️ a　b。über", "ñandú—हिन्दी﻿ x"], letters_only=True)
    assert [words.raw[a:b].tobytes().decode() for a, b in zip(words.start, words.end)] == [
        "scum", "a", "b", "über", "ñandú", "हिन्दी", "x"]


def test_long_spans_are_read_in_linear_time():
    flat = np.log(np.full((T.SYMBOLS,) * 3, 1 / T.SYMBOLS))
    assert len(T.viterbi(T.lattice("ab3$x" * 40_000), flat)) > 100_000


def brute_scores(docs, labels):
    """Scores by plain sets and strings; readings of spans come from the tested Viterbi."""
    texts = [(i, (t or "").lower()) for i, t in docs]
    counts = np.full((T.SYMBOLS,) * 3, 0.5)
    for _, t in texts:
        symbols = [T.symbol_of(c) for c in t]
        for x in zip(symbols, symbols[1:], symbols[2:]):
            counts[x] += 1
    # texts are counted with two line breaks between them
    for (_, t), (_, u) in zip(texts, texts[1:]):
        around = [T.symbol_of(c) for c in t[-2:]] + [0, 0] + [T.symbol_of(c) for c in u[:2]]
        for x in zip(around, around[1:], around[2:]):
            counts[x] += 1
    model = np.log(counts / counts.sum(axis=2, keepdims=True))

    def features(t):
        restored = []
        for m in re.finditer(r"\S*[a-z][034@][a-z]\S*|(?<!\S)[a-z](?: [a-z]){2,}(?!\S)|\S*([a-z])\1\1\S*", t):
            word = T.viterbi(T.lattice(m.group(0)), model)
            if word and word != m.group(0):
                restored.append(word)
        t = "\n".join([t, *restored])
        words = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in t).split()
        return [[w] + [(k, w[:k]) for k in (4, 5, 6) if len(w) > k] for w in words]

    truth = {}
    for i, y in labels:
        truth.setdefault(i, y)
    train = [(features(t), truth[i]) for i, t in texts if i in truth]
    share = sum(y for _, y in train) / len(train)
    n, toxic = {}, {}
    for words, y in train:
        for f in {f for w in words for f in w}:
            n[f] = n.get(f, 0) + 1
            toxic[f] = toxic.get(f, 0) + y
    kept = {f for f in n if toxic[f] >= T.MIN_TOXIC and toxic[f] >= T.MIN_SHARE * share * n[f]}

    def top(words, own=None):
        best = {}
        for w in words:
            values = []
            for f in w:
                if f in kept:
                    a, b = (n[f], toxic[f]) if own is None else (n[f] - 1, toxic[f] - own)
                    p = (b + T.SHRINK * share) / (a + T.SHRINK)
                    values.append((max(math.log(p / (1 - p)) - math.log(share / (1 - share)), 0.0), f))
            if values:
                most = max(v for v, _ in values)
                best[frozenset(f for v, f in values if v == most)] = most
        return sorted(best.values(), reverse=True)

    return train, top, features, texts


def test_scores_against_plain_counts(spark):
    docs, labels = rows(120, seed=9)
    docs += [(500, "grumbl3fuzz in the garden"), (501, "s n a r k w e e d"), (502, ""), (503, "loaaathepot stone")]
    frame_docs = docs_frame(spark, docs)
    learn = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    train, top, features, texts = brute_scores(docs, learn)

    def padded(values):
        return (values + [0.0] * T.TOP)[:T.TOP]

    w = T.fit_logistic(np.array([padded(top(words, y)) for words, y in train]), np.array([y for _, y in train], float))
    got = {r.doc_id: r.score for r in T.toxicity(frame_docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    for i, t in texts:
        z = w[0] + np.dot(w[1:], padded(top(features(t))))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-6, i
