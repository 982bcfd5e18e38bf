import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers_llm import docs_frame
from loadcast.llm import bpe as B
from loadcast.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(TOKENIZER)


def own(text):
    return np.frombuffer(b"".join(B.encoder(TOKENIZER).encode(text)), "<u4").tolist()


def theirs(library, text):
    return library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcxyzAÉéßΣσ'’.,!$ \n\t\x1c0123½漢🙂<|>", max_size=80))
def test_encodes_like_the_library(text):
    from tokenizers import Tokenizer
    if not hasattr(test_encodes_like_the_library, "t"):
        test_encodes_like_the_library.t = Tokenizer.from_file(TOKENIZER)
    t = test_encodes_like_the_library.t
    ids = theirs(t, text)
    assert own(text) == ids
    assert B.TokenStrings(B.encoder(TOKENIZER).merges).feed(ids) == t.decode(ids, skip_special_tokens=False)


def test_special_tokens_long_pieces_and_long_texts(library):
    r = random.Random(1)
    texts = ["a<|endoftext|>b<|startoftext|>", "<|endoftext|>" * 3, "they're I'll DON'T", "a" * 4000, "=-" * 3000,
             "".join(r.choice("abcdehilnorstuy") for _ in range(5000)), "word " * 40_000, "", "é" * 3000,
             "x" * 70_000 + " y"]
    assert all(own(t) == theirs(library, t) for t in texts)


def test_lookahead_is_sufficient():
    """Tokens emitted block by block equal those of the whole piece, and the buffer is bounded."""
    merges = B.encoder(TOKENIZER).merges
    assert 32 <= merges.lookahead < 5000
    r = random.Random(2)
    words = [w for w in merges.vocabulary if w.isascii() and w.isalpha()]
    for _ in range(15):
        data = "".join(r.choice(words) for _ in range(600)).encode()
        run, got, most = B.WordTransducer(merges), [], 0
        for at in range(0, len(data), 100):
            got += run.feed(data[at:at + 100])
            most = max(most, len(run.buffer))
        got += run.finish()
        whole = merges.merge([merges.inner[b] for b in data[:-1]] + [merges.last[data[-1]]])
        assert got == whole and most <= merges.lookahead + B.BLOCK + 200


def test_lookahead_of_a_small_merge_list(tmp_path):
    """ab, bc, cd, ...: whether a joins b can hang on the far end; the chain is counted in full."""
    import json
    chars = B.byte_characters()
    vocab = {c: i for i, c in enumerate(chars)} | {c + "</w>": 256 + i for i, c in enumerate(chars)}
    merges = [("c", "d"), ("b", "c"), ("a", "b")]
    vocab |= {a + b: 512 + i for i, (a, b) in enumerate(merges)}
    spec = {"added_tokens": [], "model": {"vocab": vocab, "merges": [" ".join(m) for m in merges],
                                          "end_of_word_suffix": "</w>"},
            "pre_tokenizer": {"pretokenizers": [{"type": "Split", "pattern": {"Regex": "\\S+"}}]}}
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    m = B.MergeList(str(path))
    assert m.lookahead == 3  # a|b hangs on b|c, that on c|d
    names = [m.strings[t] for t in m.merge([m.inner[x] for x in b"abcd"])]
    assert names == ["ab", "cd"]


def test_decoding_round_trip_and_state_machine(spark):
    texts = ["hello wide world", "été 漢字 🙂 ok", "", None]
    df = docs_frame(spark, list(enumerate(texts)))
    back = {r.doc_id: r.text for r in B.decode(B.encode(df, TOKENIZER), TOKENIZER).collect()}
    assert back[0].split() == texts[0].split() and back[1].split() == texts[1].split() and back[2] == back[3] == ""
    out = B.Detokenizer(B.encoder(TOKENIZER).merges)
    m = out.merges
    pieces = [out.feed(m.inner[b]) for b in "é".encode()]
    assert pieces == ["", "é"]  # waits for the second byte
    assert out.feed(m.inner[0xC3]) == "" and out.finish() == "\ufffd"


def test_digests(spark, library):
    rows = [(1, "Hello, hello world! 12"), (2, None), (3, ""), (4, "big " * 30_000), (5, "tie"), (5, "tie"), (None, "x")]
    df = docs_frame(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256)
                 for r in B.encode_digests(df, TOKENIZER).collect())

    def expected(doc_id, text):
        ids = theirs(library, text or "")
        return (doc_id or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())

    assert got == sorted(expected(*r) for r in rows)
    full = {r.doc_id: r for r in B.encode_with_digests(df, TOKENIZER).collect()}
    assert full[1].ids == theirs(library, rows[0][1]) and full[1].ids_sha256 == got[1][2]
    assert B.encode_digests(docs_frame(spark, []), TOKENIZER).count() == 0
