"""Toxicity scores after noisy-channel deobfuscation.

A character trigram model is counted over every document. Suspicious spans (letters mixed
with look-alike signs such as ``l0$er``, letters of any script and such signs spaced out as
``s c u m`` or ``l 0 $ e r``, letters repeated three times or more) become lattices of what each sign may stand for, what a repetition may
have been, and Viterbi decoding under the character model picks the restored word. A span
without such signs has one path only, itself, so it needs no decoding.

The score looks at the words of the text and the restored words: each word, and its first
four to six letters, has an evidence learned from labelled documents, the share of toxic
documents among those that hold it, shrunk towards the overall share. A logistic function
of the three strongest evidences is the score; it is fitted on the same labelled documents
with each document's own label left out of the counts it is scored with.

Labels may be a bounded sample: ``TRAIN_ROWS`` labelled documents, those of least hash of
doc_id. Everything else covers all documents and whole texts.

Defined results: null and empty texts get the score of a text without evidence; null labels
and null doc_ids do not train; a doc_id with contradicting labels counts once for each label
row; repeated documents score alike; without any label of one of the classes every score is
0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_keyed
from .textvec import BLANK, LETTER, Words, code_points, kinds, text_slices

TRAIN_ROWS = 20_000
SHRINK = 8.0  # labelled documents that the overall share counts for
MIN_TOXIC, MIN_SHARE = 2, 2.0  # evidence is kept from two toxic documents and twice the overall share
TOP = 3
THRESHOLD = 0.7

# What a sign may stand for.
LOOKALIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a",
             "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
SIGN = np.zeros(256, bool)
SIGN[[ord(c) for c in LOOKALIKE]] = True
JOINERS = " .-_*"
JOINER = np.zeros(256, bool)
JOINER[[ord(c) for c in JOINERS]] = True
STAR = ord("*")  # a joiner between letters, a sign where spaces stand around it
CACHED = 64  # code points of the longest span whose reading is kept

# Symbols of the character model: 0 outside words, 1 to 26 letters, 27 any other letter.
SYMBOLS = 28
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[192:] = 27  # first byte of a letter beyond ASCII; its other bytes are skipped
CHANNEL_COST = 1.0  # cost (natural log) of reading a sign as a letter or undoing a repetition


# ---- character model ------------------------------------------------------------------------

def trigram_counts(texts: list[str]) -> np.ndarray:
    """Counts of symbol trigrams of lower-cased texts."""
    raw = np.frombuffer("\n\n".join(texts).encode("utf-8", "replace"), np.uint8)
    s = SYMBOL[raw[(raw < 128) | (raw >= 192)]]
    if len(s) < 3:
        return np.zeros(SYMBOLS ** 3, np.int64)
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)


def _count_trigrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for pdf in batches:
        for _, texts in text_slices(pdf["text"].tolist(), 2_000_000):
            total += trigram_counts([t.lower() for t in texts])
    at = np.flatnonzero(total)
    yield pd.DataFrame({"gram": at, "n": total[at]})


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities [first, second, third] from all documents; at most SYMBOLS**3 counts
    reach the driver."""
    counts = np.full(SYMBOLS ** 3, 0.5)
    rows = (docs.select(F.coalesce("text", F.lit("")).alias("text"))
            .mapInPandas(_count_trigrams, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect())
    for r in rows:
        counts[r["gram"]] += r["n"]
    counts = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    return np.log(counts / counts.sum(axis=2, keepdims=True))


# ---- Viterbi over the lattice of a span -----------------------------------------------------

def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Readings of each run of a span, with their costs. Joining signs of a spaced-out span
    read as nothing; three or more equal signs at the end are decoration."""
    core = span
    while len(core) >= 3 and not core[-1].isalnum() and core[-1] == core[-2] == core[-3]:
        core = core.rstrip(core[-1])
    between, units = core[1::2], core[::2]
    if len(core) >= 5 and (not any(c.isalnum() for c in between) and all(c.isalnum() for c in units)
                           or all(c in JOINERS for c in between)
                           and all(c.isalnum() or c in LOOKALIKE for c in units)):
        core = units
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(core):
        c = core[i]
        j = i
        while j < len(core) and core[j] == c:
            j += 1
        n, i = j - i, j
        if c in LOOKALIKE:
            readings = [(x * min(n, 2), CHANNEL_COST * n) for x in LOOKALIKE[c]]
            if n >= 2:
                readings += [(x, CHANNEL_COST * n) for x in LOOKALIKE[c]]
            if not c.isalnum():
                readings.append(("", CHANNEL_COST * 2 * n))
        elif c.isalpha():
            readings = [(c * n, 0.0)] if n < 3 else [(c * n, CHANNEL_COST * (n - 2)), (c * 2, CHANNEL_COST),
                                                     (c, CHANNEL_COST)]
        else:
            readings = [("", CHANNEL_COST)]
        out.append(readings)
    return out


def symbol_of(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def viterbi(readings: list[list[tuple[str, float]]], model: np.ndarray) -> str:
    """The most probable restored word: least channel cost minus log probability. Paths are
    chained backwards, so time and memory grow with the span's length only."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in [*readings, [(" ", 0.0)]]:
        step: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (cost, path) in states.items():
            for text, extra in options:
                x, y, total = a, b, cost + extra
                for c in text:
                    z = symbol_of(c)
                    total -= model[x, y, z]
                    x, y = y, z
                if (x, y) not in step or total < step[x, y][0]:
                    step[x, y] = total, (path, text) if text else path
        states = step
    least = min(cost for cost, _ in states.values())
    return min(spelled(path) for cost, path in states.values() if cost == least).strip()


def spelled(path: tuple | None) -> str:
    parts = []
    while path is not None:
        path, text = path
        parts.append(text)
    return "".join(reversed(parts))


class Restorer:
    """Viterbi decoding with a bounded memory of spans seen."""

    def __init__(self, model: np.ndarray):
        self.model = model
        self.remembered = lru_cache(maxsize=50_000)(self.decode)

    def decode(self, span: str) -> str:
        return viterbi(lattice(span), self.model)

    def restore(self, span: str) -> str:
        return self.remembered(span) if len(span) <= CACHED else self.decode(span)


def suspicious_spans(words: Words) -> list[tuple[int, str]]:
    """(row, span) of every suspicious span of a batch (whole white-space words, or runs of
    spaced single letters and signs, two of them letters at least)."""
    raw = words.raw
    cp = code_points(raw)
    at_byte = np.arange(len(raw)) if len(cp) == len(raw) else np.flatnonzero((raw & 0xC0) != 0x80)
    byte_end = np.append(at_byte, len(raw))
    kind = kinds()[cp]
    ascii_cp = np.where(cp < 128, cp, 0)
    letter, blank, sign = kind == LETTER, kind == BLANK, SIGN[ascii_cp]

    def span(start: int, end: int) -> tuple[int, str]:
        row = int(np.searchsorted(words.doc_start, at_byte[start], side="right") - 1)
        return row, raw[byte_end[start]:byte_end[end]].tobytes().decode("utf-8", "replace")

    flag = np.zeros(len(cp), bool)
    if len(cp) > 2:
        flag[2:] |= letter[2:] & (cp[2:] == cp[1:-1]) & (cp[1:-1] == cp[:-2])
        flag[:-1] |= sign[:-1] & letter[1:]
        flag[1:] |= sign[1:] & letter[:-1] & (cp[1:] != ord("!")) & (cp[1:] != STAR) & (cp[1:] != ord("("))
        tail = np.zeros(len(cp), bool)  # a sign three times over is decoration, not a letter
        tail[:-2] = sign[:-2] & (cp[:-2] == cp[1:-1]) & (cp[1:-1] == cp[2:])
        flag &= ~tail
    edge = np.diff((~blank).astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters_before = np.concatenate([[0], np.cumsum(letter)])
    hits = np.unique(np.searchsorted(start, np.flatnonzero(flag & ~blank), side="right") - 1)
    hits = hits[letters_before[end[hits]] > letters_before[start[hits]]]
    out = [span(s, e) for s, e in zip(start[hits].tolist(), end[hits].tolist())]
    # letters and signs one by one, with one joining sign between: at least three in a row
    star = cp == STAR
    if len(cp) > 2:
        star[1:-1] &= (cp[:-2] == 32) & (cp[2:] == 32)
    star[[0, -1]] = False
    unit = letter | star | sign & (cp != STAR)
    solid = unit | (cp >= 48) & (cp <= 57)
    alone = unit.copy()
    alone[1:] &= ~solid[:-1]
    alone[:-1] &= ~solid[1:]
    at = np.flatnonzero(alone)
    if len(at) > 2:
        chained = (np.diff(at) == 2) & JOINER[ascii_cp[at[:-1] + 1 - (at[:-1] + 1 == len(cp))]]
        edge = np.diff(np.concatenate([[0], chained.astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            while e > s and cp[at[e]] in (ord("!"), ord("(")):  # punctuation after the last letter
                e -= 1
            if e - s >= 2 and letters_before[at[e] + 1] - letters_before[at[s]] >= 2:
                out.append(span(int(at[s]), int(at[e]) + 1))
    return out


# ---- evidence -------------------------------------------------------------------------------

def word_features(texts: list[str], restorer: Restorer) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word number, feature hash): the words of each lower-cased text and the restored
    words of its suspicious spans, each as a whole and by its first 4, 5 and 6 bytes."""
    extra: dict[int, list[str]] = {}
    for row, span in suspicious_spans(Words(texts)):
        restored = restorer.restore(span)
        if restored and restored != span:
            extra.setdefault(row, []).append(restored)
    full = [t + "\n" + "\n".join(dict.fromkeys(extra[i])) if i in extra else t for i, t in enumerate(texts)]
    words = Words(full, letters_only=True)
    size = words.end - words.start
    rows, which, feats = [words.doc], [np.arange(len(size))], [words.hashes()]
    for k in (4, 5, 6):
        long = np.flatnonzero(size > k)
        rows.append(words.doc[long])
        which.append(long)
        feats.append(words.hashes(words.start[long], words.start[long] + k) ^ np.uint64(k))
    return np.concatenate(rows), np.concatenate(which), np.concatenate(feats)


def _training_counts(restorer_of) -> callable:
    """Documents and toxic documents of each feature, summed within the partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = restorer_of()
        for pdf in batches:
            texts, toxic = pdf["text"].str.lower().tolist(), pdf["toxic"].to_numpy(np.int64)
            for start, part in text_slices(texts):
                rows, _, feats = word_features(part, restorer)
                pairs = np.unique(np.stack([feats.view(np.int64), rows]), axis=1) if len(rows) else np.zeros((2, 0), np.int64)
                keys, at, n = np.unique(pairs[0], return_inverse=True, return_counts=True)
                yield pd.DataFrame({"feature": keys, "n": n, "toxic": np.bincount(
                    at, weights=toxic[start + pairs[1]], minlength=len(keys)).astype(np.int64)})
    return run


@dataclass
class ToxicityModel:
    characters: np.ndarray
    share: float
    features: np.ndarray  # sorted hashes
    docs: np.ndarray
    toxic: np.ndarray
    weights: np.ndarray  # logistic weights: constant, then the TOP evidences

    def evidence(self, n: np.ndarray, toxic: np.ndarray) -> np.ndarray:
        p = (toxic + SHRINK * self.share) / (n + SHRINK)
        return np.log(p / (1 - p)) - math.log(self.share / (1 - self.share))


def top_evidence(model: ToxicityModel, texts: list[str], restorer: Restorer,
                 labels: np.ndarray | None = None) -> np.ndarray:
    """(texts, TOP) strongest evidences of distinct words; with labels, each text's own label
    is left out of the counts."""
    out = np.zeros((len(texts), TOP))
    rows, which, feats = word_features(texts, restorer)
    if not len(rows) or not len(model.features):
        return out
    at = np.minimum(np.searchsorted(model.features, feats), len(model.features) - 1)
    hit = np.flatnonzero(model.features[at] == feats)
    rows, which, at = rows[hit], which[hit], at[hit]
    n, toxic = model.docs[at].astype(float), model.toxic[at].astype(float)
    if labels is not None:
        n, toxic = n - 1, toxic - labels[rows]
    value = np.maximum(model.evidence(n, toxic), 0.0)
    # the best feature of each word, then the best distinct features of each text
    order = np.lexsort((-value, which))
    order = order[np.concatenate([[True], which[order][1:] != which[order][:-1]])] if len(order) else order
    order = order[np.lexsort((at[order], -value[order], rows[order]))]
    seen: dict[int, int] = {}
    last = None
    for i in order.tolist():
        r, key = int(rows[i]), (int(rows[i]), int(at[i]))
        if key == last or seen.get(r, 0) >= TOP:
            continue
        last = key
        out[r, seen.get(r, 0)] = value[i]
        seen[r] = seen.get(r, 0) + 1
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Newton's method with a ridge penalty on all but the constant."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """``labels`` has (doc_id, toxic). The sample of at most ``train_rows`` labelled rows is
    small by this bound and is broadcast; texts are not shuffled."""
    spark = docs.sparkSession
    characters = character_model(docs)
    sample = (labels.where("doc_id is not null and toxic is not null")
              .select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(train_rows))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(sample), "doc_id").select("text", "toxic")
    shared = spark.sparkContext.broadcast(characters)

    def restorer_of() -> Restorer:
        return Restorer(shared.value)

    # docs and toxic docs of the sample, as the whole of a feature that every text has
    totals = texts.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    n, t = totals["n"], totals["t"] or 0
    none = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
    if not 0 < t < n:
        return ToxicityModel(characters, 0.5, *none, np.array([-50.0] + [0.0] * TOP))
    share = t / n
    counts = (texts.mapInPandas(_training_counts(restorer_of), "feature bigint, n bigint, toxic bigint")
              .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
              .where((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_SHARE * share * F.col("n")))
              .toPandas())
    counts["feature"] = counts["feature"].to_numpy(np.int64).view(np.uint64)
    counts = counts.sort_values("feature")
    model = ToxicityModel(characters, share, counts["feature"].to_numpy(np.uint64), counts["n"].to_numpy(float),
                          counts["toxic"].to_numpy(float), np.zeros(TOP + 1))
    sent = spark.sparkContext.broadcast(model)

    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, restorer = sent.value, restorer_of()
        for pdf in batches:
            low, y = pdf["text"].str.lower().tolist(), pdf["toxic"].to_numpy(float)
            for start, part in text_slices(low):
                own = y[start:start + len(part)]
                e = top_evidence(m, part, restorer, own)
                yield pd.DataFrame({"y": own, **{f"e{i}": e[:, i] for i in range(TOP)}})

    rows = texts.mapInPandas(left_out, "y double, " + ", ".join(f"e{i} double" for i in range(TOP))).toPandas()
    model.weights = fit_logistic(rows[[f"e{i}" for i in range(TOP)]].to_numpy(), rows["y"].to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, score) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        restorer = Restorer(m.characters)
        for pdf in batches:
            scores = np.zeros(len(pdf))
            for start, part in text_slices(pdf["text"].str.lower().tolist()):
                e = top_evidence(m, part, restorer)
                z = m.weights[0] + e @ m.weights[1:]
                scores[start:start + len(part)] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": scores})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_keyed(rows, "doc_id", run, "doc_id bigint, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept from training."""
    return F.crc32(doc_id.cast("string")) % 3 == 1


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by labels outside the held-out part."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
                                     "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def text_score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        restorer = Restorer(m.characters)
        for texts in batches:
            scores = np.zeros(len(texts))
            for start, part in text_slices(texts.str.lower().tolist()):
                z = m.weights[0] + top_evidence(m, part, restorer) @ m.weights[1:]
                scores[start:start + len(part)] = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
            yield pd.Series(scores)

    return docs.where(text_score(F.coalesce("text", F.lit(""))) < THRESHOLD)
