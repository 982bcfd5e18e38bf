"""Language of web pages by Bayesian fusion of several kinds of evidence.

For each page the log posterior of a language is the sum of

- the likelihood of its visible text under byte-trigram models (fitted on at most
  ``TRAIN_DOCS`` labelled documents, those of least hash of doc_id), with the number of
  trigrams that count limited to ``TEXT_WEIGHT``: neighbouring trigrams are not independent;
- the likelihood of the language its markup declares, from how often pages of each language
  (by their text) declare it, over all pages;
- the prior of its host, from the languages (by text) of the host's pages, smoothed towards
  its registered domain, that towards the address suffix, that towards all pages. A suffix
  that belongs to a country adds ``SUFFIX_PAGES`` pages of that country's language.

The corpus statistics are grouped sums over every page; a page's own share in its host's
counts is taken out again before it is scored, so no page confirms itself.

Defined results: null html has no text and declares nothing, null urls have the empty host;
such pages are decided by the remaining evidence; equal posteriors go to the first language
in alphabetical order; repeated rows count as often as they occur and are decided alike;
without any labelled document the result has null languages; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_keyed, stage
from .host_reputation import domain_of, host_of, suffix_of
from .textvec import text_slices

TRAIN_DOCS = 20_000
CELLS = 1 << 16
TEXT_WEIGHT = 60.0
SUFFIX_PAGES = 5.0
STRENGTH = {"host": 10.0, "domain": 50.0, "suffix": 50.0}
DECLARED_PRIOR = 1.0

# Languages of country suffixes.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "co.uk": "en",
                   "us": "en", "au": "en", "com.au": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt",
                   "com.br": "pt", "nl": "nl", "pl": "pl", "se": "sv", "jp": "ja"}

HIDDEN = ("script", "style", "head", "nav", "noscript", "template")
_OPENING = re.compile(rf"<!--|<({'|'.join(HIDDEN)})\b", re.I)
_CLOSING = {None: re.compile("-->")} | {name: re.compile(rf"</{name}\s*>", re.I) for name in HIDDEN}
_TAG = re.compile(r"<[^>]*>")
_DECLARED = r"(?is)<html\b[^<>]*?\blang\s*=\s*[\"']?\s*([A-Za-z]+)"


def visible_text(source: str) -> str:
    """Text of a page without markup, scripts, styles, head and navigation. An element that is
    never closed is not hidden, only its tag is."""
    shown = _without_hidden(source)
    last = shown.rfind(">") + 1  # no tag ends behind it
    return html_entities.unescape(_TAG.sub(" ", shown[:last]) + shown[last:])


def _without_hidden(source: str) -> str:
    """One pass: a closing tag that was looked for in vain is not looked for again."""
    out, at, place, missing = [], 0, 0, set()
    while opening := _OPENING.search(source, place):
        name = opening[1] and opening[1].lower()
        closing = None if name in missing else _CLOSING[name].search(source, opening.end())
        if closing is None:
            missing.add(name)
            place = opening.end()
        else:
            out += [source[at:opening.start()], " "]
            at = place = closing.end()
    return "".join(out) + source[at:]


def trigram_cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every byte trigram of the lower-cased texts."""
    data = [t.lower().encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(texts)), sizes)
    key = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    cell = ((key * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) & (CELLS - 1)
    inside = rows[:-2] == rows[2:]
    return rows[:-2][inside], cell[inside]


# ---- text models ----------------------------------------------------------------------------

def text_models(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [language, cell]) from labelled documents."""
    sample = (docs.where("lang is not null and doc_id is not null").select("doc_id", "lang")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "lang").limit(train_docs))
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((0, CELLS))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(langs), CELLS), np.int64)
        for pdf in batches:
            code = pdf["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(np.int64)
            for start, texts in text_slices(pdf["text"].tolist()):
                rows, cells = trigram_cells(texts)
                total += np.bincount(code[start + rows] * CELLS + cells, minlength=total.size).reshape(total.shape)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": at // CELLS, "cell": at % CELLS, "n": total.ravel()[at]})

    texts = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(sample), ["doc_id", "lang"], "left_semi")  # at most train_docs rows
    rows = (texts.mapInPandas(count, "lang int, cell int, n bigint").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
            .toPandas())
    counts = np.full((len(langs), CELLS), 0.5)
    counts[rows["lang"], rows["cell"]] += rows["n"]
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def text_log_likelihoods(sources: list[str], models: np.ndarray) -> np.ndarray:
    """[page, language]: mean log likelihood of a trigram times the trigrams that count."""
    out = np.zeros((len(sources), len(models)))
    for start, texts in text_slices([visible_text(s) for s in sources]):
        rows, cells = trigram_cells(texts)
        n = np.bincount(rows, minlength=len(texts))
        for i, model in enumerate(models):
            total = np.bincount(rows, weights=model[cells], minlength=len(texts))
            out[start:start + len(texts), i] = total / np.maximum(n, 1) * np.minimum(n, TEXT_WEIGHT)
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


# ---- fusion ---------------------------------------------------------------------------------

def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, host, suffix, declared, text_lang, lang, confidence of every page; ``docs``
    (doc_id, text, lang) trains the text models."""
    spark = pages.sparkSession
    langs, models = text_models(docs)
    base = pages.select("page_id", host_of(F.col("url")).alias("host"),
                        F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), _DECLARED, 1)).alias("declared"),
                        F.coalesce("html", F.lit("")).alias("html"), F.spark_partition_id().alias("salt"))
    base = base.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host")))
    if not langs:
        return base.select("page_id", "host", "suffix", "declared", F.lit(None).cast("string").alias("text_lang"),
                           F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    sent = spark.sparkContext.broadcast(models)
    k = len(langs)

    def likelihoods(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            z = text_log_likelihoods(pdf["html"].tolist(), sent.value)
            out = pdf.drop(columns="html")
            out["loglik"], out["soft"] = list(z), list(softmax(z))
            yield out

    fields = "page_id bigint, host string, declared string, salt int, suffix string, domain string"
    rows = base.select(F.col("page_id").cast("bigint").alias("page_id"), "host", "declared", "salt", "suffix",
                             "domain", "html")
    rows = stage(map_keyed(rows, "page_id", likelihoods, fields + ", loglik array<double>, soft array<double>"), "lang-pages")
    # a declaration outside the known languages is one of two values: none, other
    known = F.when(F.col("declared") == "", "").when(F.col("declared").isin(langs), F.col("declared")).otherwise("?")
    rows = rows.withColumn("declared_class", known)

    # how often pages of a language declare each value
    sums = [F.sum(F.col("soft")[i]).alias(f"c{i}") for i in range(k)]
    table = {r["declared_class"]: [r[f"c{i}"] for i in range(k)]
             for r in rows.groupBy("declared_class").agg(*sums).collect()}  # at most k + 2 rows
    values = [*langs, "", "?"]
    confusion = np.array([[table.get(v, [0.0] * k)[i] for v in values] for i in range(k)]) + DECLARED_PRIOR
    confusion = np.log(confusion / confusion.sum(axis=1, keepdims=True))

    # languages of hosts, smoothed towards domain, suffix, all pages
    hosts = stage(rows.groupBy("host", "domain", "suffix").agg(*sums), "lang-hosts")
    total = [F.sum(f"c{i}").alias(f"c{i}") for i in range(k)]
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    suffixes = hosts.groupBy("suffix").agg(*total)
    overall = hosts.agg(*total).withColumn("root", F.lit(""))

    def shares(counts: list, parent: list, strength: float):
        whole = sum(counts[1:], counts[0]) + strength
        return [(c + strength * p) / whole for c, p in zip(counts, parent)]

    cs = [F.col(f"c{i}") for i in range(k)]
    top = overall.select("root", *[x.alias(f"p{i}") for i, x in enumerate(
        shares(cs, [F.lit(1.0 / k)] * k, float(k)))])
    country = F.lit(None)
    for name, lang in SUFFIX_LANGUAGE.items():
        country = F.when(F.col("suffix") == name, lang).otherwise(country)
    hinted = [c + F.when(country == langs[i], SUFFIX_PAGES).otherwise(0.0) for i, c in enumerate(cs)]
    parents = [F.col(f"p{i}") for i in range(k)]

    def smoothed(level: DataFrame, above: DataFrame, on: str, counts: list, name: str) -> DataFrame:
        joined = level.join(above.select(on, *[f"p{i}" for i in range(k)]), on)
        return joined.select(*level.columns, *[x.alias(f"p{i}") for i, x in enumerate(
            shares(counts, parents, STRENGTH[name]))])

    of_suffix = smoothed(suffixes.withColumn("root", F.lit("")), top, "root", hinted, "suffix")
    of_domain = smoothed(domains, of_suffix.select("suffix", *[f"p{i}" for i in range(k)]), "suffix", cs, "domain")
    # per host: its own counts and its parent's shares, so that a page can be left out
    of_host = hosts.join(of_domain.select("domain", *[f"p{i}" for i in range(k)]), "domain").select(
        "host", F.array(*cs).alias("counts"), F.array(*parents).alias("parent"))
    parts = rows.select("host", "salt").distinct().join(of_host, "host")
    joined = rows.join(parts, ["host", "salt"])

    def fuse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {v: i for i, v in enumerate(values)}
        for pdf in batches:
            if not len(pdf):
                continue
            z, soft = np.stack(pdf["loglik"]), np.stack(pdf["soft"])
            counts = np.maximum(np.stack(pdf["counts"]) - soft, 0.0)
            s = STRENGTH["host"]
            prior = (counts + s * np.stack(pdf["parent"])) / (counts.sum(axis=1, keepdims=True) + s)
            declared = confusion[:, [place[v] for v in pdf["declared_class"]]].T
            p = softmax(z + declared + np.log(np.maximum(prior, 1e-9)))
            best = p.argmax(axis=1)
            yield pd.DataFrame({"page_id": pdf["page_id"], "host": pdf["host"], "suffix": pdf["suffix"],
                                "declared": pdf["declared"], "text_lang": [langs[i] for i in z.argmax(axis=1)],
                                "lang": [langs[i] for i in best], "confidence": p.max(axis=1)})

    joined = joined.select("page_id", "host", "suffix", "declared", "declared_class", "loglik", "soft", "counts", "parent")
    return map_keyed(joined, "page_id", fuse, "page_id bigint, host string, suffix string, declared string, "
                                              "text_lang string, lang string, confidence double")
