"""Ids above 2 ** 53 beside a null in one batch, clashing column names, pages of unclosed tags."""

import time

import pytest

from conftest import SF_SMALL
from helpers_llm import DOCS, docs_frame
from loadcast.llm import (bpe, chat_format, exact_dedup, frames, language_id, license_scan, merkle_manifest, mixing,
                          packing, toxicity, weighted_minhash)
from loadcast.llm.queries import TOKENIZER

BIG = 2 ** 53
IDS = [None, BIG - 1, BIG, BIG + 1, 2 ** 63 - 1]


@pytest.fixture(scope="module")
def docs(spark):
    return docs_frame(spark, [(i, f"text of {i}\n") for i in IDS]).coalesce(1)


def ids_of(df, key="doc_id"):
    return sorted((r[key] for r in df.select(key).collect()), key=str)


def test_ids_survive_every_operator_on_documents(spark, docs):
    want = sorted(IDS, key=str)
    labelled = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    assert ids_of(bpe.encode_digests(docs, TOKENIZER)) == want
    assert ids_of(bpe.encode_with_digests(docs, TOKENIZER)) == want
    assert ids_of(bpe.decode(bpe.encode(docs, TOKENIZER), TOKENIZER)) == want
    assert ids_of(license_scan.scan_licenses(docs)) == want
    assert ids_of(toxicity.score(docs, toxicity.train(labelled, labels))) == want
    assert ids_of(exact_dedup.exact_dedup(docs)) == want
    assert ids_of(weighted_minhash.near_classes(docs)) == want
    assert ids_of(mixing.mix(docs, target_tokens=10 ** 6, max_epochs=1)) == want
    assert ids_of(packing.pack_documents(docs, TOKENIZER).select("doc_id").distinct()) == want
    assert ids_of(merkle_manifest.verify(merkle_manifest.build_manifest(docs))) == want


def test_page_ids_survive(spark):
    pages = spark.createDataFrame([(i, "http://a.de/x", f"<p>seite {i}") for i in IDS], "page_id bigint, url string, html string")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert ids_of(language_id.identify(pages.coalesce(1), docs), "page_id") == sorted(IDS, key=str)


def test_conversations_of_neighbouring_ids_stay_apart(spark):
    rows = [(i, turn, "user", f"{i} {turn}") for i in IDS for turn in range(2)]
    got = chat_format.conversation_digests(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert sorted(((r.conv_id, r.n_turns) for r in got.collect()), key=str) == sorted(((i, 2) for i in IDS), key=str)


def test_replayed_changes_keep_ids(spark):
    changes = spark.createDataFrame([(1, "insert", BIG + 1, "a"), (2, "insert", None, "a"), (3, "delete", BIG, "a"),
                                     (4, "insert", None, "b"), (5, "delete", None, "b"), (5, "insert", 7, "b")],
                                    "seq int, op string, doc_id bigint, text string")
    index, done = exact_dedup.apply_changes(spark.createDataFrame([], "digest binary, doc_id bigint"), changes.coalesce(1))
    assert sorted(((r.kind, r.doc_id, r.holder) for r in done.collect()), key=str) == sorted(
        [("added", BIG + 1, BIG + 1), ("duplicate", None, BIG + 1), ("absent", BIG, BIG + 1), ("added", None, None),
         ("deleted", None, None), ("added", 7, 7)], key=str)
    assert ids_of(index) == [7, BIG + 1]


CLASHING = ["text_digest", "pick_digest", "pick_id", "__digest", "__id", "__epochs", "__domain", "mix_domain", "mix_copies",
            "domain", "n_keep", "n", "key"]


def test_clashing_columns_pass_through(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long), (2, long), (2, long), (3, long + " more"), (4, "other text")]
    df = docs_frame(spark, rows).selectExpr("*", *[f"'{c}' AS {c}" for c in CLASHING])
    for out, kept in ((exact_dedup.drop_copies(df), [2, 3, 4]), (weighted_minhash.drop_near_copies(df), [3, 4])):
        assert out.columns == df.columns
        found = out.collect()
        assert sorted(r.doc_id for r in found) == kept
        assert all(r[c] == c for r in found for c in CLASHING)
    found = mixing.mix(df)
    assert found.columns == [*df.columns, "epoch"] and all(r[c] == c for r in found.collect() for c in CLASHING)


def test_the_partial_index_is_passed_on_when_full():
    import pandas as pd
    digests = [i.to_bytes(32, "big") for i in (1, 2, 3, 1, 2, 3, 3)]
    batch = pd.DataFrame({"digest": digests, "keep_id": range(7), "group_size": 1, "n_keep": 1})
    parts = list(exact_dedup._merge(2)(iter([batch])))
    assert all(len(p) <= 2 for p in parts) and sum(p["group_size"].sum() for p in parts) == 7
    whole, = exact_dedup._merge()(iter(parts))
    assert sorted(zip(whole["keep_id"], whole["group_size"], whole["n_keep"])) == [(3, 2, 1), (4, 2, 1), (6, 3, 1)]


@pytest.mark.parametrize("page", ["<nav ", "<!-- ", "<script>", "</nav", "<", "<nav></nav ", "<html "])
def test_pages_of_unclosed_tags_are_cleaned_in_linear_time(page):
    begun = time.time()
    language_id.visible_text(page * (2_000_000 // len(page)))
    assert time.time() - begun < 5


def test_page_cleaning_equals_its_pattern():
    import random
    import re
    hidden = re.compile(r"<!--.*?-->|<(script|style|head|nav|noscript|template)\b.*?</\1\s*>", re.S | re.I)
    parts = ["<nav>", "</nav>", "</NAV >", "<script x>", "</script>", "a<b", "text ", "<!--", "-->", "<p>", ">", "<headx>", "<head>", "</head\n>"]
    r = random.Random(1)
    for _ in range(3000):
        page = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        assert language_id.visible_text(page) == language_id.html_entities.unescape(re.sub(r"<[^>]*>", " ", hidden.sub(" ", page)))


def test_free_names():
    assert frames.free_name("a", ["b"]) == "a" and frames.free_name("a", ["A", "a_"]) == "a__"
