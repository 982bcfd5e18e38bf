"""License scan by patience alignment of texts with license templates.

A text and a template are word sequences (letters and digits, lower case). Words that occur
once in each are anchors; the longest increasing subsequence of anchor places is taken as
the alignment's frame, and each gap between neighbouring anchors is aligned the same way,
where other words become unique. What is left without anchors extends from the gap's two
ends while words agree. Coverage is the share of the template's words that are aligned; a
template is found where it reaches ``COVERAGE``, the words that tell it from neighbouring licenses
(names, versions, terms such as ShareAlike) are among the aligned ones, and no neighbour's such word
stands between them.

Exact prefilter: the aligned words of a template are words the text holds, so where the
template's words that occur in the text at all make less than ``COVERAGE`` of it, it can't be
found. The words of a batch are compared with all templates at once by their hashes; only
the few texts that pass are aligned, in windows around dense places: a template is shorter
than ``WINDOW`` times its length around the words they share. Where a template stands several
times, its words are unique nowhere in the whole range, so a range is also aligned in overlapping
windows of about the template's length and up to ``WINDOW`` times it. Windows whose words,
counted as often as the template has them, can't reach the coverage are passed over.

Defined results: null and empty texts hold no license; a template that occurs several times
is reported once, at its best place, the first of equals; of several templates ``license``
is the one of the most aligned words, then alphabetical, and ``licenses`` lists all; repeated
rows are scanned alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_keyed
from .textvec import Words, text_slices

COVERAGE = 0.8
WINDOW = 3
_WORD = re.compile(r"[^\W_]+")

# Public license texts and notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
        "the License for the specific language governing permissions and limitations under the License."],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."],
}
BSD_THIRD = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
             "derived from this software without specific prior written permission.")
GNU_SHORT = "This work is licensed under the GNU {kind}General Public License, version {version}."
GNU_NOTICE = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public "
    "License as published by the Free Software Foundation, either version {version} of the License, or (at your option) any "
    "later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
    "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for "
    "more details. You should have received a copy of the GNU {kind}General Public License along with this {thing}.")
GNU = {"GPL-2.0": ("", "2", "program"), "GPL-3.0": ("", "3", "program"), "LGPL-2.1": ("Lesser ", "2.1", "library"),
       "LGPL-3.0": ("Lesser ", "3", "library"), "AGPL-3.0": ("Affero ", "3", "program")}
CC_SHORT = "Licensed under CC {short} 4.0{where}."
CC_NOTICE = "This work is licensed under a Creative Commons {long} 4.0 International License."
CC = {"BY": "Attribution", "BY-NC": "Attribution-NonCommercial", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}

TEMPLATES["BSD-3-Clause"] = [f"{TEMPLATES['BSD-2-Clause'][0]} {BSD_THIRD}"]
for _name, (_kind, _version, _thing) in GNU.items():
    TEMPLATES[_name] = [t.format(kind=_kind, version=_version, thing=_thing) for t in (GNU_SHORT, GNU_NOTICE)]
for _short, _long in CC.items():
    TEMPLATES[f"CC-{_short}-4.0"] = [CC_SHORT.format(short=_short, where=w) for w in ("", " International")] + [CC_NOTICE.format(long=_long)]

# Words that tell a license from its neighbours. Of TELLING, those that a template holds must all be
# aligned; of MARKS, none that the template lacks may stand between its aligned words.
TELLING = {"mit", "apache", "gnu", "lesser", "affero", "mozilla", "cc", "commons", "attribution", "noncommercial", "sharealike",
           "noderivatives", "by", "nc", "sa", "nd", "neither"}
MARKS = {"lesser", "affero", "noncommercial", "sharealike", "noderivatives", "nc", "sa", "nd"}
VERSIONED = re.compile(r"(?:GPL|MPL|Apache|CC-)")  # their templates' numbers must be aligned as well


# ---- alignment ------------------------------------------------------------------------------

def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of (a, b) pairs, sorted by a, whose b increase (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[at], piles[at] = b, i
    out = []
    i = piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def once(words: list, start: int, end: int) -> dict:
    """Places of the words that occur exactly once in a range."""
    places: dict = {}
    for i in range(start, end):
        w = words[i]
        places[w] = -1 if w in places else i
    return {w: i for w, i in places.items() if i >= 0}


def patience_align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) with a[i] == b[j], increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = once(a, a0, a1), once(b, b0, b1)
        frame = longest_increasing(sorted((i, in_b[w]) for w, i in in_a.items() if w in in_b))
        if not frame:
            continue
        out += frame
        edges = [(a0 - 1, b0 - 1), *frame, (a1, b1)]
        todo += [(i + 1, k, j + 1, l) for (i, j), (k, l) in zip(edges, edges[1:])]
    return sorted(out)


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m.group().lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


class Template:
    def __init__(self, name: str, text: str):
        self.name = name
        self.words = [w for w, _, _ in words_of(text)]
        self.counts: dict[str, int] = {}
        for w in self.words:
            self.counts[w] = self.counts.get(w, 0) + 1
        self.telling = {w for w in self.counts if w in TELLING or (w.isdigit() and VERSIONED.search(name))}
        self.foreign = MARKS - self.counts.keys()

    def tells(self, words: list[str], pairs: list[tuple[int, int]]) -> bool:
        """Whether an alignment is with this license and not with a neighbour of it."""
        between = words[pairs[0][0]:pairs[-1][0] + 1]
        return self.telling <= {self.words[j] for _, j in pairs} and self.foreign.isdisjoint(between)


def templates() -> list[Template]:
    return [Template(name, text) for name, texts in TEMPLATES.items() for text in texts]


def dense_windows(places: list[int], size: int, least: int) -> list[tuple[int, int]]:
    """Ranges of text words where at least ``least`` shared words stand within ``size`` words,
    overlapping ranges joined."""
    out: list[list[int]] = []
    for i in range(len(places) - least + 1):
        if places[i + least - 1] - places[i] < size:
            low, high = places[i], places[i + least - 1] + 1
            if out and low <= out[-1][1]:
                out[-1][1] = max(out[-1][1], high)
            else:
                out.append([low, high])
    return [(a, b) for a, b in out]


def template_windows(words: list[str], low: int, high: int, template: Template, least: int) -> Iterator[tuple[int, int]]:
    """Windows of the range that hold at least ``least`` of the template's words: any stretch of
    up to ``WINDOW`` template lengths stands whole in one that is hardly more than half longer."""
    n = len(template.words)
    size = n
    while True:
        step = max(size // 4, 1)
        width = size + step - 1
        counts = dict.fromkeys(template.counts, 0)
        held, last = 0, low
        for start in range(low, max(high - size, low) + step, step):
            for i in range(max(start - step, low), start):  # words that leave, then those that come
                w = words[i]
                if w in counts:
                    counts[w] -= 1
                    held -= counts[w] < template.counts[w]
            end = min(start + width, high)
            for i in range(last, end):
                w = words[i]
                if w in counts:
                    held += counts[w] < template.counts[w]
                    counts[w] += 1
            last = end
            if held >= least:
                yield start, end
        if size >= min(WINDOW * n, high - low):
            return
        size = min(size + max(size // 4, 1), WINDOW * n)


def best_match(words: list[str], template: Template, coverage: float) -> tuple[int, int, int] | None:
    """(aligned words, first text word, last text word) of the template's best place: of the
    most aligned words, then the shortest, then the first."""
    least = max(int(np.ceil(coverage * len(template.words))), 1)
    places = [i for i, w in enumerate(words) if w in template.counts]
    best = None
    for low, high in dense_windows(places, WINDOW * len(template.words), least):
        step = WINDOW * len(template.words)
        starts = range(low, max(high - step, low) + step, step) if high - low > 2 * step else [low]
        # a long run of shared words is walked in overlapping parts
        parts = [(start, min(start + 2 * step, high) if high - low > 2 * step else high) for start in starts]
        if high - low > len(template.words):
            parts += template_windows(words, low, high, template, least)
        for start, end in parts:
            window = words[start:end]
            pairs = patience_align(window, template.words)
            if len(pairs) >= least and template.tells(window, pairs):
                first, last = start + pairs[0][0], start + pairs[-1][0]
                found = -len(pairs), last - first, first
                best = found if best is None else min(best, found)
    return best and (-best[0], best[2], best[2] + best[1])


def scan(text: str, found: list[Template], coverage: float = COVERAGE) -> list[tuple[str, int, float, int, int]]:
    """(license, aligned words, coverage, start, end) of each template found, best first;
    start and end are character places."""
    spans = words_of(text)
    words = [w for w, _, _ in spans]
    out = {}
    for t in found:
        match = best_match(words, t, coverage)
        if match is not None:
            row = (t.name, match[0], match[0] / len(t.words), spans[match[1]][1], spans[match[2]][2])
            if t.name not in out or row[1] > out[t.name][1]:
                out[t.name] = row
    rows = sorted(out.values(), key=lambda r: (-r[1], r[0]))
    # a license whose place lies in that of one with more aligned words is a part of that one
    return [r for i, r in enumerate(rows) if not any(q[3] <= r[3] and r[4] <= q[4] and q[1] > r[1] for q in rows[:i])]


# ---- Spark ----------------------------------------------------------------------------------

def candidates(texts: list[str], all_templates: list[Template], coverage: float) -> list[tuple[int, int]]:
    """(row, template) pairs that pass the exact prefilter. Words are compared as runs of a to z in
    the lower-cased text. Whatever the aligner takes for a word's neighbour, a word of these letters
    is such a run, so that every word it can align is present here."""
    vocabulary = sorted({w for t in all_templates for w in t.counts if w.isascii() and w.isalpha()})
    probe = Words([" ".join(vocabulary)], ascii_only=True)
    hashes = probe.hashes()
    order = np.argsort(hashes)
    words = Words([t.lower() for t in texts], ascii_only=True)
    h = words.hashes()
    at = np.minimum(np.searchsorted(hashes[order], h), len(order) - 1)
    hit = hashes[order][at] == h
    present = np.zeros((len(texts), len(vocabulary)), bool)
    present[words.doc[hit], order[at[hit]]] = True
    weight = np.zeros((len(vocabulary), len(all_templates)))
    slack = np.zeros(len(all_templates))
    for j, t in enumerate(all_templates):
        for i, w in enumerate(vocabulary):
            weight[i, j] = t.counts.get(w, 0)
        slack[j] = len(t.words) - weight[:, j].sum()  # words with digits count as present
    need = np.array([coverage * len(t.words) for t in all_templates])
    rows, which = np.nonzero(present @ weight + slack >= need)
    return list(zip(rows.tolist(), which.tolist()))


SCHEMA = ("doc_id bigint, license string, coverage double, start bigint, end bigint, licenses array<string>")


def scan_licenses(docs: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per document: doc_id, license (null: none), coverage, start, end, licenses."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = templates()
        for pdf in batches:
            texts = pdf["text"].tolist()
            found: list[list] = [[] for _ in texts]
            for start, part in text_slices(texts):
                passed: dict[int, list[Template]] = {}
                for row, j in candidates(part, known, coverage):
                    passed.setdefault(row, []).append(known[j])
                for row, some in passed.items():
                    found[start + row] = scan(part[row], some, coverage)
            first = [f[0] if f else (None, 0, None, None, None) for f in found]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "license": [f[0] for f in first],
                                "coverage": [f[2] for f in first],
                                "start": pd.array([f[3] for f in first], "Int64"),
                                "end": pd.array([f[4] for f in first], "Int64"),
                                "licenses": [[x[0] for x in f] for f in found]})

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_keyed(rows, "doc_id", run, SCHEMA)
