"""Small tables for the tests of the text operators."""

import numpy as np

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
VOCABULARY = ("river stone light winter garden paper market silver engine window harbor summer forest bridge "
              "candle mirror orchard valley thunder copper ribbon lantern meadow anchor compass saddle velvet "
              "marble canyon feather").split()


def docs_frame(spark, rows, extra=""):
    """Rows (doc_id, text[, lang, source]) as a documents table."""
    full = [(r + ("en", "src0")[len(r) - 2:] if len(r) < 4 else r) for r in rows]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], DOCS)


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY, n))


def edited(rng, text, edits):
    words = text.split()
    for i in rng.choice(len(words), edits, replace=False):
        words[i] = "changed" + str(rng.integers(1000))
    return " ".join(words)


def rng(seed=1):
    return np.random.default_rng(seed)
