"""Vector bin packing of token sequences by the dot-product heuristic.

A training sequence has limits on three things at once: tokens, segments (pieces of examples)
and loss-bearing tokens. An example demands some of each. The open sequence takes, of the
examples that fit, the one whose demand has the largest dot product with what is left of the
limits, each dimension weighted by the total demand for it. When none fits whole, an example is
cut to fill the sequence; a sequence that the segment or loss limit closes early goes back to
the largest power of two below its length if ``shrink`` is set (such a sequence needs no padding).

Examples stream through each task in cells of at most ``CELL_TOKENS`` tokens or ``CELL_ROWS``
examples; what a cell leaves is the beginning of the next one, and at its end a task passes on
one sequence that isn't full. These are few and short, and are packed again by a 256th of the
tasks, until one task has one sequence left, which is cut into powers of two. No example is
shuffled but the pieces of those last sequences, no key gathers rows, and a task holds one cell
(and the example that is read). Which examples share a sequence depends on how Spark splits the
input; a repeated task gives the same pieces.

``RankEncoder`` gives the ids of ``bpe.Encoder`` faster: short pieces are merged by tiktoken's
ranks. Ranks name what a pair makes, merges name the pair, and the results are the same if each
merge makes its own token and every token, encoded alone, is itself: take two neighbours that
spell a token, but are not its merge; within these two the token's own encoding has gone through
the same states, and from this one it can't have come to the token. ``ranks_suffice`` tests it.

Defined results: null and empty texts are the end token alone; very long examples are cut into
as many pieces as needed; ties go to the example that came first; repeated rows are packed each;
a null doc_id stays null; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .frames import stage

CELL_TOKENS = 1 << 20
CELL_ROWS = 4096
RESERVE = 8  # sequences' worth of tokens that a cell leaves to the next one, for choice
MERGE = 256  # tasks whose last sequences are packed again together
END_ID = 2


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss: int = 4096


# ---- encoding -------------------------------------------------------------------------------

def ranks_suffice(merges: bpe.MergeList) -> bool:
    """Whether merging by ranks of results equals merging by pairs (see above)."""
    if not merges.suffix or len(set(merges.merged)) < len(merges.merged):
        return False
    for token in merges.merged:
        data, ends = merges.bytes[token]
        symbols = [merges.inner[b] for b in data[:-1]] + [(merges.last if ends else merges.inner)[data[-1]]]
        if merges.merge(symbols) != [token]:
            return False
    return True


class RankEncoder(bpe.Encoder):
    END = b"\xff"  # no byte of UTF-8: stands behind a piece's last byte

    def __init__(self, merges: bpe.MergeList):
        super().__init__(merges)
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b]) + self.END: 256 + b for b in range(255)}
        self.ids = [*merges.inner, *merges.last]
        for token in merges.merged:
            data, ends = merges.bytes[token]
            ranks[data + (self.END if ends else b"")] = len(self.ids)
            self.ids.append(token)
        # ranks 511 and 255 stand for no symbol; 511 keeps the numbering whole
        ranks[self.END + self.END] = 511
        self.core = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def piece(self, text: str) -> bytes:
        data = text.encode("utf-8")
        if len(data) > bpe.SHORT:
            return super().piece(text)
        return bpe.pack([self.ids[r] for r in self.core.encode_single_piece(data + self.END)])


_encoders: dict[tuple[str, bool], bpe.Encoder] = {}


def encoder(path: str, by_ranks: bool) -> bpe.Encoder:
    if (path, by_ranks) not in _encoders:
        _encoders[path, by_ranks] = RankEncoder(bpe.MergeList(path)) if by_ranks else bpe.encoder(path)
    return _encoders[path, by_ranks]


# ---- packing --------------------------------------------------------------------------------

@dataclass
class Example:
    """Tokens ``start`` to ``start + len(ids)`` of an example of ``total`` tokens, of which those
    from ``loss_from`` on bear loss."""

    doc_id: int | None
    ids: np.ndarray
    start: int
    total: int
    loss_from: int


Piece = tuple[Example, int, int]  # example, begin, end (in its ids)


class Cell:
    """Examples to be packed; ``begin`` moves on as their tokens are placed."""

    def __init__(self, examples: list[Example], limits: Limits, shrink: bool):
        self.examples, self.limits, self.shrink = examples, limits, shrink
        self.size = np.array([len(e.ids) for e in examples], np.int64)
        self.begin = np.zeros(len(examples), np.int64)
        self.prompt = np.array([min(max(e.loss_from - e.start, 0), len(e.ids)) for e in examples], np.int64)
        self.tokens = self.size.copy()
        self.loss = self.size - self.prompt
        totals = np.array([self.tokens.sum() / limits.tokens, len(examples) / limits.segments, self.loss.sum() / limits.loss])
        self.weights = totals / max(totals.sum(), 1e-9)

    def _move(self, i: int, begin: int) -> None:
        self.begin[i] = begin
        self.tokens[i] = self.size[i] - begin
        self.loss[i] = self.size[i] - max(begin, self.prompt[i])

    def next_sequence(self) -> tuple[list[Piece], bool]:
        """A sequence, and whether it is closed (else the examples have run out)."""
        lim, pieces, (wt, ws, wl) = self.limits, [], self.weights
        tokens, segments, loss = lim.tokens, lim.segments, lim.loss
        while tokens and segments:
            alive = self.tokens > 0
            # the dot product of each demand with what is left
            value = self.tokens * (wt * tokens / lim.tokens ** 2) + ws * segments / lim.segments ** 2 \
                + self.loss * (wl * loss / lim.loss ** 2)
            value[~(alive & (self.tokens <= tokens) & (self.loss <= loss))] = -1
            i = int(value.argmax()) if len(value) else -1
            if i >= 0 and value[i] >= 0:
                take = int(self.tokens[i])
            else:  # none fits whole: the longest piece that does, of the longest example
                free = np.maximum(self.prompt - self.begin, 0)
                fits = np.where(alive, np.minimum(np.minimum(self.tokens, tokens), free + loss), 0)
                take = int(fits.max(initial=0))
                if not take:
                    break
                i = int(np.where(fits == take, self.tokens, 0).argmax())
            begin = int(self.begin[i])
            pieces.append((self.examples[i], begin, begin + take))
            before = int(self.loss[i])
            self._move(i, begin + take)
            tokens, segments, loss = tokens - take, segments - 1, loss - (before - int(self.loss[i]))
            pieces[-1] += (i,)
        used, closed = lim.tokens - tokens, tokens == 0 or bool((self.tokens > 0).any())
        if closed and tokens and self.shrink:
            pieces = self._trim(pieces, used, 1 << (used.bit_length() - 1))
        return [p[:3] for p in pieces], closed

    def _trim(self, pieces: list[tuple], used: int, keep: int) -> list[tuple]:
        """The first ``keep`` tokens of a sequence; the others go back."""
        while used > keep:
            example, begin, end, i = pieces.pop()
            back = min(end - begin, used - keep)
            used -= back
            self._move(i, end - back)
            if end - back > begin:
                pieces.append((example, begin, end - back, i))
        return pieces

    def rest(self) -> list[Example]:
        return [part(self.examples[i], int(self.begin[i]), int(self.size[i])) for i in np.flatnonzero(self.tokens > 0).tolist()]


def part(e: Example, begin: int, end: int) -> Example:
    return e if end - begin == len(e.ids) else Example(e.doc_id, e.ids[begin:end], e.start + begin, e.total, e.loss_from)


def pack_cell(examples: list[Example], limits: Limits, shrink: bool, reserve: int) -> tuple[list[list[Piece]], list[Example]]:
    """Closed sequences, and the examples left: at least ``reserve`` tokens if there are as many,
    or with 0, those of the one sequence that isn't full."""
    cell, out = Cell(examples, limits, shrink), []
    left = int(cell.tokens.sum())
    while left > reserve:
        pieces, closed = cell.next_sequence()
        if not closed:
            return out, [part(*p) for p in pieces]
        out.append(pieces)
        left -= sum(end - begin for _, begin, end in pieces)
    return out, cell.rest()


def powers_of_two(examples: list[Example]) -> list[list[Piece]]:
    """Examples that fill no sequence, one after the other in sequences of a power of two."""
    left, out = [(e, 0, len(e.ids)) for e in examples], []
    while left:
        room = 1 << (sum(end - begin for _, begin, end in left).bit_length() - 1)
        out.append([])
        while room:
            e, begin, end = left.pop(0)
            cut = min(end, begin + room)
            room -= cut - begin
            out[-1].append((e, begin, cut))
            if cut < end:
                left.insert(0, (e, cut, end))
    return out


# ---- Spark ----------------------------------------------------------------------------------

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, loss_from bigint, ids binary, task int")
TYPES = [pa.int64()] * 8 + [pa.binary(), pa.int32()]
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


def _rows(sequences: list[list[Piece]], first_id: int, with_ids: bool) -> pa.RecordBatch:
    rows = []
    for k, pieces in enumerate(sequences):
        offset = 0
        for e, begin, end in pieces:
            data = e.ids[begin:end].astype("<u4").tobytes()
            rows.append((e.doc_id, e.start + begin, end - begin, zlib.crc32(data), e.total, first_id + k, offset, e.loss_from,
                         data if with_ids else None, None))
            offset += end - begin
    return _batch(rows)


def _open_rows(examples: list[Example], task: int) -> pa.RecordBatch:
    return _batch([(e.doc_id, e.start, len(e.ids), None, e.total, None, None, e.loss_from, e.ids.astype("<u4").tobytes(), task)
                   for e in examples])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES)], names=NAMES)


def _packer(read: Callable[[pa.RecordBatch], Iterator[Example]], limits: Limits, shrink: bool, with_ids: bool, turn: int,
            last: bool) -> Callable:
    """Packs a task's examples; what is left is passed on, or with ``last`` closed as well."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        next_id = (turn << 52) | (task << 28)
        pool, tokens, fresh = [], 0, 0
        for batch in batches:
            for example in read(batch):
                pool.append(example)
                tokens += len(example.ids)
                fresh += 1
                if tokens >= CELL_TOKENS or fresh >= CELL_ROWS:
                    done, pool = pack_cell(pool, limits, shrink, RESERVE * limits.tokens)
                    yield _rows(done, next_id, with_ids)
                    next_id += len(done)
                    tokens, fresh = sum(len(e.ids) for e in pool), 0
        done, pool = pack_cell(pool, limits, shrink, 0)
        if last and pool:
            done += powers_of_two(pool) if shrink else [[(e, 0, len(e.ids)) for e in pool]]
            pool = []
        if done:
            yield _rows(done, next_id, with_ids)
        if pool:
            yield _open_rows(pool, task)
    return run


def _read_open(batch: pa.RecordBatch) -> Iterator[Example]:
    columns = [batch.column(c).to_pylist() for c in ("doc_id", "ids", "start", "doc_tokens", "loss_from")]
    for doc_id, ids, start, total, loss_from in zip(*columns):
        yield Example(doc_id, np.frombuffer(ids, "<u4"), start, total, loss_from)


def _pack(rows: DataFrame, read: Callable, limits: Limits, shrink: bool, with_ids: bool, merge: int = MERGE) -> DataFrame:
    out = stage(rows.mapInArrow(_packer(read, limits, shrink, with_ids, 0, False), SCHEMA), "packing-0")
    closed, waiting, turn = out.where("sequence_id IS NOT NULL"), out.where("sequence_id IS NULL"), 0
    tasks = waiting.agg(F.count_distinct("task")).first()[0]
    while tasks:
        turn, tasks = turn + 1, -(-tasks // merge)
        dealt = waiting.repartition(tasks, "task")
        out = stage(dealt.mapInArrow(_packer(_read_open, limits, shrink, with_ids, turn, tasks == 1), SCHEMA), f"packing-{turn}")
        closed = closed.unionByName(out.where("sequence_id IS NOT NULL"))
        if tasks == 1:
            break
        waiting = out.where("sequence_id IS NULL")
    return closed.drop("task")


def _read_examples(batch: pa.RecordBatch) -> Iterator[Example]:
    for doc_id, ids, loss_from in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(),
                                      batch.column("loss_from").to_pylist()):
        if ids:
            yield Example(doc_id, np.array(ids, np.uint32), 0, len(ids), loss_from)


def pack_examples(examples: DataFrame, limits: Limits = Limits(), shrink: bool = False, merge: int = MERGE) -> DataFrame:
    """Pieces (with their ids) of examples ``doc_id``, ``ids`` (array of int; null or empty: no
    piece) and ``loss_from`` (tokens before it bear no loss; null counts as 0)."""
    rows = examples.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<bigint>").alias("ids"),
                           F.coalesce(F.col("loss_from").cast("bigint"), F.lit(0)).alias("loss_from"))
    return _pack(rows, _read_examples, limits, shrink, True, merge)


def pack_documents(docs: DataFrame, path: str, limits: Limits = Limits(), end_id: int = END_ID, with_ids: bool = False,
                   merge: int = MERGE) -> DataFrame:
    """Pieces of all documents, each encoded by the tokenizer file ``path`` and ended by
    ``end_id``; all tokens bear loss. Sequences are full or a power of two long."""
    by_ranks = ranks_suffice(bpe.encoder(path).merges)

    def read(batch: pa.RecordBatch) -> Iterator[Example]:
        run, end = encoder(path, by_ranks), bpe.pack([end_id])
        doc_ids = batch.column("doc_id").to_pylist()
        for doc_id, text in zip(doc_ids, batch.column("text")):
            ids = np.frombuffer(b"".join([*run.encode(text.as_py()), end]), "<u4")
            yield Example(doc_id, ids, 0, len(ids), 0)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return _pack(rows, read, limits, True, with_ids, merge)
