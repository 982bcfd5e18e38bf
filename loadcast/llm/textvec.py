"""Word and shingle hashing of a batch of texts as numpy arrays.

One batch of texts is laid out as one byte buffer; words are the runs of bytes that are
not white space (space, tab, line breaks), found on the whole buffer at once. A word's
hash is a polynomial over its bytes modulo 2**64, so hashes of all words, and of their
prefixes, come from one running sum. Nothing here knows about Spark: the functions run
inside ``mapInPandas`` tasks on one bounded batch.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

# An odd multiplier, its powers' period is long; finalizer constants of
# the public splitmix64 generator.
BASE = 0x9E3779B97F4A7C15
MIX1 = 0xBF58476D1CE4E5B9
MIX2 = 0x94D049BB133111EB
MASK64 = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, grown on demand."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        inv = pow(BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, BASE, np.uint64), dtype=np.uint64)])
            _inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, inv, np.uint64), dtype=np.uint64)])
    return _powers, _inverses


def mix64(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finalizer: spreads every input bit over the word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
        return x ^ (x >> np.uint64(31))


LETTER, BLANK = 1, 2
TABLED = 0x32400  # letters are assigned below this code point


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Kind of each code point below ``TABLED`` by its Unicode category: letters and the marks
    that stand on them (not those that choose the look of a sign), white space, else 0."""
    out = np.zeros(TABLED, np.uint8)
    for i in range(TABLED):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind[0] == "L" or kind in ("Mn", "Mc") and not 0xFE00 <= i <= 0xFE0F and not 0x20D0 <= i <= 0x20FF:
            out[i] = LETTER
        elif c.isspace():
            out[i] = BLANK
    return out


def code_points(raw: np.ndarray) -> np.ndarray:
    """Code points of a UTF-8 buffer; those above every letter become the one below ``TABLED``."""
    if not len(raw) or raw.max() < 128:
        return raw.astype(np.uint32)
    text = raw.tobytes().decode("utf-8", "surrogatepass")
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), TABLED - 1)


def letter_bytes(raw: np.ndarray) -> np.ndarray:
    """Bytes of letters, of any script, in lower-cased UTF-8."""
    cp = code_points(raw)
    letter = kinds()[cp] == LETTER
    if len(cp) == len(raw):
        return letter
    return letter[np.cumsum((raw & 0xC0) != 0x80) - 1]


class Words:
    """Words of a batch (runs of bytes other than white space, of letters, or of a to z only): ``start``/``end`` byte offsets, ``doc`` (row number of each word),
    ``first`` (index of each row's first word, with a final total) and ``raw`` bytes."""

    def __init__(self, texts: list[str], letters_only: bool = False, ascii_only: bool = False):
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        sizes = np.fromiter((len(d) + 1 for d in data), np.int64, len(data))
        self.doc_start = np.concatenate([[0], np.cumsum(sizes)])
        if ascii_only:
            inside = (self.raw >= 97) & (self.raw <= 122)
        else:
            inside = letter_bytes(self.raw) if letters_only else ~SPACE[self.raw]
        edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.doc = np.searchsorted(self.doc_start, self.start, side="right") - 1
        self.first = np.searchsorted(self.start, self.doc_start)
        self._sums: np.ndarray | None = None

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of the byte spans (all words by default)."""
        start = self.start if start is None else start
        end = self.end if end is None else end
        if self._sums is None:
            pw, _ = _power_tables(len(self.raw) + 1)
            with np.errstate(over="ignore"):
                terms = (self.raw.astype(np.uint64) + np.uint64(1)) * pw[:len(self.raw)]
                self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        _, inv = _power_tables(len(self.raw) + 1)
        with np.errstate(over="ignore"):
            poly = (self._sums[end] - self._sums[start]) * inv[start]
            return mix64(poly + (end - start).astype(np.uint64) * np.uint64(MIX2))


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``width`` words; a row with fewer words but at least one
    has one shingle made of all its words; a row without words has none."""
    h = words.hashes()
    counts = np.diff(words.first)
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        n = len(h) - width + 1
        rows = np.zeros(0, np.int64)
        out = np.zeros(0, np.uint64)
        if n > 0:
            acc = np.zeros(n, np.uint64)
            for j in range(width):
                acc = acc * np.uint64(BASE) + h[j:j + n]
            whole = words.doc[:n] == words.doc[width - 1:]
            rows, out = words.doc[:n][whole], mix64(acc[whole])
        short = np.flatnonzero((counts > 0) & (counts < width))
        if len(short):
            extra = np.zeros(len(short), np.uint64)
            for j in range(width - 1):
                has = counts[short] > j
                at = np.minimum(words.first[short] + j, len(h) - 1)
                extra = np.where(has, extra * np.uint64(BASE) + h[at], extra)
            rows = np.concatenate([rows, short])
            out = np.concatenate([out, mix64(extra + counts[short].astype(np.uint64))])
            order = np.argsort(rows, kind="stable")
            rows, out = rows[order], out[order]
    return rows, out


def distinct_counts(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, 48-bit hash) pairs in order, with how often each occurs. Rows are
    below 65536 (one batch); row and hash share one sorted 64-bit key."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.sort((rows.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    key = key[at]
    return ((key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1),
            np.diff(np.append(at, len(new))))


def text_slices(texts: list[str], max_chars: int = 400_000, max_rows: int = 4096):
    """(first row, texts) slices of a batch that keep the working arrays small; a text longer
    than ``max_chars`` is a slice of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and (size + len(t) > max_chars or i - at >= max_rows):
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, texts[at:]
