"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) turns to a string. It is rendered on
successive prefixes of a conversation, and consecutive outputs are compared: where the output
of k turns continues the output of k - 1 turns, the new part is turn k's span; where it does
not, the template has rewritten history, and the place of the first difference is reported.
Within the span, the text's own place is found by rendering the same prefix with two probe
texts in place of the last: what all three share before and after is the template's, the
rest is the text. Nothing is assumed about the template's marks.

Long conversations: each prefix is rendered anew, which is quadratic, but nothing shorter shows
that a black box left its history alone. Only a template that declares itself ``local`` (a
turn's span is the same after the first turn alone, in every conversation) is rendered in that
short context after ``LOCAL_TURNS`` turns, during which the declaration is tested; rows of a
conversation then stream through with constant memory. A template that does not declare it, or
fails the test, keeps being rendered in full. Rows arrive sorted by conversation and turn, and a
conversation's digests are fed turn by turn.

``MarkedTemplate`` is the template of the query: turns between control strings, which are
escaped inside roles and texts, reversibly (``<|`` becomes ``<\\|``, one backslash more each
time); its loss mask covers the assistants' texts.

Defined results: null text and null role count as empty; turns are ordered by turn number,
nulls first, ties by role and text, so repeated rows stand one after the other; a null
conv_id is a conversation of its own; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_keyed

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
PROBES = ("\u0001", "\u0002")
LOCAL_TURNS = 32


# ---- the query's template -------------------------------------------------------------------

class MarkedTemplate:
    local = True  # a turn's output depends on nothing but the turn
    begin, end = "<|im_start|>", "<|im_end|>"
    _escape, _unescape = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
    _turn = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)

    def __call__(self, turns: list[Turn]) -> str:
        return "".join(f"{self.begin}{self.escape_role(r)}\n{self.escape(t)}{self.end}\n" for r, t in turns)

    def escape(self, text: str) -> str:
        return self._escape.sub(r"<\\\1|", text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(r"<\1|", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role.replace("%", "%25").replace("\n", "%0A"))

    def unescape_role(self, role: str) -> str:
        return self.unescape(role).replace("%0A", "\n").replace("%25", "%")

    def read(self, output: str) -> list[tuple[str, str, int, int]]:
        """(role, text, start, end) of every turn of an output; the span is of the text."""
        return [(self.unescape_role(m[1]), self.unescape(m[2]), m.start(2), m.end(2))
                for m in self._turn.finditer(output)]


# ---- incremental rendering ------------------------------------------------------------------

def common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:  # compares slices, not characters
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def common_suffix(a: str, b: str) -> int:
    return common_prefix(a[::-1], b[::-1])


@dataclass
class Span:
    piece: str  # what the turn adds to the output
    text_start: int  # place of the text within the piece
    text_end: int
    rewritten_at: int  # first place of earlier output that changed, or -1


class IncrementalRenderer:
    """Spans of a conversation's turns, one turn at a time."""

    def __init__(self, template: Template):
        self.template = template
        self.turns: list[Turn] = []
        self.output = ""
        self.length = 0
        self.count = 0
        self.local = getattr(template, "local", False)
        self.first: Turn | None = None
        self.first_output = ""

    def _piece(self, turns: list[Turn], before: str) -> Span:
        out = self.template(turns)
        same = common_prefix(before, out)
        role, text = turns[-1]
        probes = [self.template([*turns[:-1], (role, p)]) for p in PROBES]
        start = common_prefix(*probes)
        stop = min(common_suffix(*probes), len(out) - start)
        rewritten = same if same < len(before) else -1
        base = same if rewritten >= 0 else len(before)
        return Span(out[base:], max(start - base, 0), max(len(out) - stop - base, max(start - base, 0)), rewritten)

    def add(self, role: str, text: str) -> Span:
        self.count += 1
        turn = (role, text)
        if self.first is None:
            self.first, self.first_output = turn, self.template([turn])
        if self.local and self.count > LOCAL_TURNS:
            self.turns, self.output = [], ""  # no longer needed
            return self._piece([self.first, turn], self.first_output)
        self.turns.append(turn)
        span = self._piece(self.turns, self.output)
        self.output = self.output + span.piece if span.rewritten_at < 0 else self.template(self.turns)
        if self.local and self.count > 1:
            self.local = span.rewritten_at < 0 and self._piece([self.first, turn], self.first_output) == span
        return span


# ---- Spark ----------------------------------------------------------------------------------

def _ordered(conversations: DataFrame) -> DataFrame:
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


SPAN_SCHEMA = ("conv_id bigint, turn_no bigint, role string, piece string, text_start int, text_end int, "
               "loss boolean, rewritten_at int")


def _spans(template: Template, trained: str) -> callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, renderer = object(), None
        for pdf in batches:
            out = []
            for conv, role, text in zip(pdf["conv_id"], pdf["role"], pdf["text"]):
                if renderer is None or conv != current:
                    current, renderer = conv, IncrementalRenderer(template)
                s = renderer.add(role, text)
                out.append((conv, renderer.count - 1, role, s.piece, s.text_start, s.text_end, role == trained,
                            s.rewritten_at))
            yield pd.DataFrame(out, columns=["conv_id", "turn_no", "role", "piece", "text_start", "text_end", "loss",
                                             "rewritten_at"])
    return run


def turn_spans(conversations: DataFrame, template: Template | None = None, trained: str = "assistant") -> DataFrame:
    """One row per turn, in order: its piece of the output, the text's place in the piece,
    whether the loss covers it, and where the template rewrote history (-1: nowhere). The
    pieces of a conversation, joined, are its formatted text unless history was rewritten."""
    return map_keyed(_ordered(conversations), "conv_id", _spans(template or MarkedTemplate(), trained), SPAN_SCHEMA)


DIGEST_SCHEMA = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                 "formatted_chars bigint, rewrites bigint")


def _digests(template: MarkedTemplate) -> callable:
    """Reads the formatted output back: turns from the marks, the loss from the spans."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = object(), None

        def row():
            return (current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        columns = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
        for pdf in batches:
            out = []
            for conv, piece, start, end, loss, rewritten in zip(
                    pdf["conv_id"], pdf["piece"], pdf["text_start"].tolist(),
                    pdf["text_end"].tolist(), pdf["loss"].tolist(), pdf["rewritten_at"].tolist()):
                if state is None or conv != current:
                    if state is not None:
                        out.append(row())
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, text, _, _ in template.read(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if loss:
                    text = template.unescape(piece[start:end])
                    state[2] += len(text)
                    state[3].update(text.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
                state[5] += rewritten >= 0
            yield pd.DataFrame(out, columns=columns)
        if state is not None:
            yield pd.DataFrame([row()], columns=columns)
    return run


def conversation_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites."""
    template = MarkedTemplate()
    return map_keyed(turn_spans(conversations, template), "conv_id", _digests(template), DIGEST_SCHEMA)
