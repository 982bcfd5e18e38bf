"""BPE encoding as a bounded-lookahead streaming transducer, and incremental decoding.

``MergeList`` reads a tokenizer file (byte-level BPE with merges in rank order and an
end-of-word suffix) and computes the merge list's sufficient lookahead: how many symbols
beyond a place decide whether a token boundary is there. Take a merge rule k = (u, v).
Whether it joins across a place depends on the next |v| symbols being v, and on v's right end
not having been taken by an earlier rule (s, c), s being v or a right part v was merged from;
that rule in turn needs its own symbols. So

    need(k) = |v| + max(need(j) for rules j < k whose left side is on v's right spine)

and the lookahead is the largest need of all rules. A boundary that lies this far behind the
end of what was read never changes, and what follows it is tokenized as if it began there.

``WordTransducer`` emits a token as soon as it is stable in this sense and keeps at most
lookahead + one block of symbols. ``encode`` runs it over the pieces of a text in blocks;
short pieces (nearly all) are cached. ``Detokenizer`` decodes token by token with a
byte-to-text state machine: undecodable bytes become U+FFFD, an unfinished character waits.

Defined results: null text counts as empty, which has no tokens; strings of special tokens
in a text become those tokens, as the file declares; white space separates and is dropped;
a piece of any length keeps constant memory; repeated rows encode alike; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_keyed

SHORT = 64  # symbols: longer pieces go through the transducer in blocks
BLOCK = 256
CACHE = 200_000  # words of each of two generations
TEXT_BLOCK = 1 << 16

# The visible characters that stand for themselves in a byte-level vocabulary.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> list[str]:
    """The character of each byte in a byte-level vocabulary."""
    table = {b: chr(b) for b in VISIBLE}
    others = (b for b in range(256) if b not in table)
    table |= {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class MergeList:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        ids = self.vocabulary
        self.rules = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}
        self.merged = [ids[a + b] for a, b in merges]  # token that each rule makes
        chars = byte_characters()
        self.inner = [ids[c] for c in chars]  # symbol of a byte within a piece
        self.last = [ids[c + self.suffix] for c in chars]  # symbol of a piece's last byte
        self.strings: list[str] = [""] * (max([*ids.values(), *self.specials.values()]) + 1)
        for s, i in [*ids.items(), *self.specials.items()]:
            self.strings[i] = s
        byte_of = {c: b for b, c in enumerate(chars)}
        self.bytes: list[tuple[bytes, bool]] = []  # what a token spells, and whether it ends a piece
        for i, s in enumerate(self.strings):
            ends = bool(self.suffix) and s.endswith(self.suffix) and i not in self.specials.values()
            core = s[:len(s) - len(self.suffix)] if ends else s
            self.bytes.append((s.encode(), False) if i in self.specials.values()
                              else (bytes(byte_of[c] for c in core), ends))
        self.lookahead = self._sufficient_lookahead(merges)

    def _sufficient_lookahead(self, merges: list[tuple[str, str]]) -> int:
        def length(token: str) -> int:
            return len(token.removesuffix(self.suffix)) if self.suffix else len(token)

        right: dict[str, str] = {}  # right part a token was merged from
        most: dict[str, int] = {}  # largest need so far of rules with this left side
        longest = 0
        for a, b in merges:
            need, part = 0, b
            while part is not None:
                need = max(need, most.get(part, 0))
                part = right.get(part)
            need += length(b)
            most[a] = max(most.get(a, 0), need)
            longest = max(longest, need)
            right.setdefault(a + b, b)
        return longest

    def merge(self, symbols: list[int]) -> list[int]:
        """Tokens of a piece: least rank first, leftmost first."""
        rules = self.rules
        if len(symbols) <= SHORT:
            tokens, new_id, none, rank_of = list(symbols), self.merged, len(self.merged), rules.get
            ranks = list(map(rank_of, zip(tokens, tokens[1:]), repeat(none)))
            while ranks and (rank := min(ranks)) < none:
                i = ranks.index(rank)
                tokens[i] = new = new_id[rank]
                del tokens[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = rank_of((tokens[i - 1], new), none)
                if i < len(ranks):
                    ranks[i] = rank_of((new, tokens[i + 1]), none)
            return tokens
        # a linked list and a heap of candidate pairs: n log n for long buffers
        n = len(symbols)
        token = list(symbols)
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rules[p], i, p) for i, p in enumerate(zip(token, token[1:])) if p in rules]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = following[i] if token[i] >= 0 else n
            if j >= n or (token[i], token[j]) != pair:
                continue
            token[i], token[j] = self.merged[rules[pair]], -1
            following[i] = following[j]
            if following[i] < n:
                before[following[i]] = i
            for x, y in ((before[i], i), (i, following[i])):
                if x >= 0 and y < n and (rank := rules.get((token[x], token[y]))) is not None:
                    heapq.heappush(heap, (rank, x, (token[x], token[y])))
        return [t for t in token if t >= 0]

    def size(self, token: int) -> int:
        return len(self.bytes[token][0])


class WordTransducer:
    """Tokens of one piece read in blocks of bytes; emits what is stable."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.buffer = b""

    def feed(self, data: bytes) -> list[int]:
        self.buffer += data
        m, keep = self.merges, self.merges.lookahead + 1  # the last byte read may be the piece's last
        if len(self.buffer) < keep + BLOCK:
            return []
        tokens, stable, out = m.merge([m.inner[b] for b in self.buffer]), 0, []
        for t in tokens:
            if stable + m.size(t) > len(self.buffer) - keep:
                break
            stable += m.size(t)
            out.append(t)
        self.buffer = self.buffer[stable:]
        return out

    def finish(self) -> list[int]:
        m, data = self.merges, self.buffer
        self.buffer = b""
        return m.merge([m.inner[b] for b in data[:-1]] + [m.last[data[-1]]]) if data else []


class PieceCache(dict):
    """Strings and the bytes of their ids; when a generation is full, the one before it is
    forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= SHORT:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    def __init__(self, merges: MergeList):
        self.merges = merges
        self.pieces = regex.compile(merges.pattern)
        self.special = regex.compile("|".join(map(regex.escape, sorted(merges.specials, key=len, reverse=True)))) \
            if merges.specials else None
        self.words = PieceCache(self.word)  # between white space
        self.parts = PieceCache(self.piece)  # of the splitting pattern

    def piece(self, text: str) -> bytes:
        """Ids of one piece of the splitting pattern."""
        data, m = text.encode("utf-8"), self.merges
        if len(data) <= SHORT:
            symbols = list(map(m.inner.__getitem__, data))
            symbols[-1] = m.last[data[-1]]
            return pack(m.merge(symbols))
        run, out = WordTransducer(m), []
        for at in range(0, len(data), BLOCK):
            out += run.feed(data[at:at + BLOCK])
        return pack(out + run.finish())

    def word(self, text: str) -> bytes:
        """Ids of normalized text, as 32-bit integers."""
        return b"".join(map(self.parts.__getitem__, self.pieces.findall(text)))

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, block by block, as little-endian 32-bit integers."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._plain(text[at:m.start()])
            yield pack([self.merges.specials[m.group()]])
            at = m.end()
        yield from self._plain(text[at:] if at else text)

    def _plain(self, text: str) -> Iterator[bytes]:
        for block in text_blocks(text):
            block = normalized(block)
            if SEPARATORS.search(block):  # split() takes these for white space, the pattern doesn't
                yield self.word(block)
            else:
                yield b"".join(map(self.words.__getitem__, block.split()))


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


SEPARATORS = regex.compile("[\x1c-\x1f]")


def normalized(text: str) -> str:
    """Composed and lower-cased character by character (no context rules for sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def text_blocks(text: str) -> Iterator[str]:
    """Blocks of about TEXT_BLOCK characters cut at plain white space (across which no piece,
    composition or case rule reaches)."""
    at = 0
    while len(text) - at > TEXT_BLOCK:
        cut = at + TEXT_BLOCK
        while cut < len(text) and text[cut] not in " \n\t":
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


class Detokenizer:
    """Text of a token stream, token by token; a piece's end becomes one space."""

    def __init__(self, merges: MergeList):
        self.merges = merges
        self.bytes = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        data, ends = self.merges.bytes[token]
        return self.bytes.decode(data, ends) + (" " if ends else "")

    def finish(self) -> str:
        return self.bytes.decode(b"", True)


class TokenStrings:
    """The decoder of a file that declares none: the tokens' own strings, one space between;
    fed token by token, it holds nothing but whether a token came before."""

    def __init__(self, merges: MergeList):
        self.strings = merges.strings
        self.begun = False

    def feed(self, tokens: list[int]) -> str:
        if not tokens:
            return ""
        text = " ".join(map(self.strings.__getitem__, tokens))
        if self.begun:
            return " " + text
        self.begun = True
        return text


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The file's encoder, loaded once per Python worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(MergeList(path))
    return _loaded[path]


def token_digests(run: Encoder, text: str) -> tuple[int, str, str]:
    """(number of tokens, sha256 of the ids as 32-bit integers, sha256 of the decoded text),
    fed block by block as the tokens come."""
    ids, words, out, n = hashlib.sha256(), hashlib.sha256(), TokenStrings(run.merges), 0
    for block in run.encode(text):
        n += len(block) // 4
        ids.update(block)
        words.update(out.feed(np.frombuffer(block, "<u4").tolist()).encode("utf-8"))
    return n, ids.hexdigest(), words.hexdigest()


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document. ``path`` names the
    tokenizer file, readable on every executor."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            rows = [token_digests(enc, t) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": [r[0] for r in rows],
                                "ids_sha256": [r[1] for r in rows], "decoded_sha256": [r[2] for r in rows]})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_keyed(rows, "doc_id", run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_with_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf[at:at + 500]
                ids = [b"".join(enc.encode(text)) for text in part["text"]]
                rows = [np.frombuffer(i, "<u4") for i in ids]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "n_tokens": [len(r) for r in rows],
                    "ids": [r.astype(np.int32) for r in rows],
                    "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
                    "decoded_sha256": [hashlib.sha256(TokenStrings(enc.merges).feed(r.tolist()).encode()).hexdigest()
                                       for r in rows]})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_keyed(rows, "doc_id", run, "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, "
                                          "decoded_sha256 string")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids of every document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for pdf in batches:
            ids = [np.frombuffer(b"".join(enc.encode(text)), "<u4").astype(np.int32) for text in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "ids": ids})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_keyed(rows, "doc_id", run, "doc_id bigint, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of token ids, through the byte-to-text state machine."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        merges = encoder(path).merges
        for pdf in batches:
            texts = []
            for ids in pdf["ids"]:
                out = Detokenizer(merges)
                texts.append("".join([out.feed(int(t)) for t in ids if 0 <= t < len(merges.bytes)]) + out.finish()
                             if ids is not None else "")
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "text": texts})

    rows = tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return map_keyed(rows, "doc_id", run, "doc_id bigint, text string")
