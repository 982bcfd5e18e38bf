import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from helpers_llm import DOCS, rng
from loadcast.llm import bpe
from loadcast.llm import packing as P
from loadcast.llm.queries import TOKENIZER, op11_instruction_packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


def check(pieces, ids, limits, loss_from=None, whole=True):
    """Every id in one piece, gapless sequences within the limits; full or a power of two long."""
    seen, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        own = ids[p.doc_id][p.start:p.start + p.length]
        assert p.length > 0 and len(own) == p.length and p.doc_tokens == len(ids[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        seen[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append(p)
    for doc_id, all_ids in ids.items():
        at = 0
        for start, length in sorted(seen[doc_id]):
            assert start == at
            at += length
        assert at == len(all_ids)
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(parts) <= limits.segments
        if loss_from:
            assert sum(max(0, p.start + p.length - max(p.start, loss_from[p.doc_id])) for p in parts) <= limits.loss
        if whole:
            assert at == limits.tokens or at & (at - 1) == 0
    return sequences


def test_ranks_give_the_ids_of_the_library(library):
    assert P.ranks_suffice(bpe.encoder(TOKENIZER).merges)
    run, r = P.encoder(TOKENIZER, True), random.Random(5)
    letters = "abcdeghilmnoprstuvz" * 3 + "éñóüßçÀ漢🙂',.!0123456789-<|>"
    texts = [" ".join("".join(r.choice(letters) for _ in range(r.randrange(1, 16))) for _ in range(40)) for _ in range(300)]
    texts += ["", "a<|endoftext|>b", "aaa " * 50, "a" * 3000, "they're DON'T", "ÿ\xff þ", " ".join(library.get_vocab())]
    for t in texts:
        got = np.frombuffer(b"".join(run.encode(t)), "<u4").tolist()
        assert got == library.encode(t, add_special_tokens=False).ids


def test_ranks_are_refused_where_they_differ():
    """a + bc makes abc by rank, but the merge list makes it of ab + c only."""
    class Merges(bpe.MergeList):
        def __init__(self):
            self.suffix, self.merged = "$", [3, 4, 5]
            self.rules = {(1, 2): 0, (0, 1): 1, (4, 2): 2}  # bc, ab, ab + c
            self.inner = [{97: 0, 98: 1, 99: 2}.get(b, 9) for b in range(256)]
            self.last = self.inner
            self.bytes = [(b"a", False), (b"b", False), (b"c", False), (b"bc", False), (b"ab", False), (b"abc", False)]
    assert not P.ranks_suffice(Merges())


def test_the_dot_product_chooses(spark):
    r = rng(7)
    limits = P.Limits(64, 4, 40)
    sizes = [(int(r.integers(1, 50)), int(r.integers(0, 50))) for _ in range(60)]
    examples = [P.Example(k, np.arange(n, dtype=np.uint32), 0, n, p) for k, (n, p) in enumerate(sizes)]
    need = {k: (n, 1, max(n - p, 0)) for k, (n, p) in enumerate(sizes)}
    caps = (64, 4, 40)
    total = [sum(d[x] for d in need.values()) / caps[x] for x in range(3)]
    weights = [t / sum(total) for t in total]
    pieces, closed = P.Cell(examples, limits, False).next_sequence()
    left, wanted = list(caps), []
    while True:
        fits = [k for k, d in need.items() if all(d[x] <= left[x] for x in range(3))]
        if not fits:
            break
        score = lambda k: sum(weights[x] * need[k][x] / caps[x] * left[x] / caps[x] for x in range(3))
        best = max(fits, key=lambda k: (round(score(k), 12), -k))
        left = [a - b for a, b in zip(left, need.pop(best))]
        wanted.append(best)
    assert [e.doc_id for e, begin, end in pieces][:len(wanted)] == wanted and closed


@pytest.mark.parametrize("shrink, limits", [(True, P.Limits(64, 3, 64)), (False, P.Limits(64, 8, 24)),
                                            (True, P.Limits(64, 8, 24)), (True, P.Limits(100, 100, 1000))])
def test_examples_with_three_limits(spark, shrink, limits):
    r = rng(8)
    ids = {k: r.integers(0, 50_000, int(r.integers(1, 200))).tolist() for k in range(400)}
    loss_from = {k: int(r.integers(0, len(v) + 10)) for k, v in ids.items()}
    df = spark.createDataFrame([(k, v, loss_from[k]) for k, v in ids.items()], "doc_id bigint, ids array<int>, loss_from int")
    out = P.pack_examples(df.repartition(7), limits, shrink, merge=2).collect()
    check(out, ids, limits, loss_from, whole=shrink and limits.tokens == 64)
    assert all(np.frombuffer(p.ids, "<u4").tolist() == ids[p.doc_id][p.start:p.start + p.length] for p in out)


def test_documents(spark, library):
    texts = ["", None, "one", "big word " * 9000, "x" * 20_000] + [f"document {i} says {'so ' * (i % 90)}" for i in range(300)]
    rows = [(i + 2 ** 53, t, "en", "s", 0) for i, t in enumerate(texts)]
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 2] for d, t, *_ in rows}
    df = spark.createDataFrame([*rows, (None, "no id", "en", "s", 0)], DOCS).repartition(5).selectExpr(
        "*", "1 AS ids", "2 AS start", "3 AS task", "4 AS offset")
    out = P.pack_documents(df, TOKENIZER, merge=2).collect()
    ids[None] = [*library.encode("no id", add_special_tokens=False).ids, 2]
    sequences = check(out, ids, P.Limits())
    assert sum(1 for s in sequences.values() if sum(p.length for p in s) < 4096) <= 12
    assert P.pack_documents(df.where("false"), TOKENIZER).count() == 0


def test_many_empty_documents_meet_the_segment_limit(spark):
    df = spark.createDataFrame([(i, "", "en", "s", 0) for i in range(1000)], DOCS)
    out = P.pack_documents(df, TOKENIZER, P.Limits(segments=48)).collect()
    check(out, {i: [2] for i in range(1000)}, P.Limits(segments=48))


def test_query_on_the_small_table(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    ids = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs}
    check(op11_instruction_packing(spark, SF_SMALL).collect(), ids, P.Limits())
