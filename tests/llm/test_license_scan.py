from itertools import combinations

from hypothesis import given
from hypothesis import strategies as st

from helpers_llm import docs_frame, rng, sentence
from loadcast.llm import license_scan as S


@given(st.lists(st.integers(0, 9), max_size=9, unique=True))
def test_longest_increasing_is_longest(values):
    pairs = list(enumerate(values))
    got = S.longest_increasing(pairs)
    assert all(x < y and b < d for (x, b), (y, d) in zip(got, got[1:]))
    best = max((n for n in range(len(pairs) + 1) for c in combinations(values, n) if list(c) == sorted(c)), default=0)
    assert len(got) == best


@given(st.lists(st.sampled_from("abcde"), max_size=12), st.lists(st.sampled_from("abcde"), max_size=12))
def test_alignment_is_a_common_subsequence(a, b):
    pairs = S.patience_align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < l for (i, j), (k, l) in zip(pairs, pairs[1:]))


def test_gaps_are_aligned_recursively():
    template = "x a b a c y a d a z".split()
    text = "x a b q a c y a d a z".split()
    assert len(S.patience_align(text, template)) == len(template)


def test_every_template_is_found_in_place(spark):
    r = rng(3)
    rows, truth = [], {}
    for i, t in enumerate(t for name in S.TEMPLATES for t in [(name, x) for x in S.TEMPLATES[name]]):
        before = sentence(r, 200) + ". "
        rows.append((i, before + t[1] + "\n" + sentence(r, 50)))
        truth[i] = (t[0], len(before))
    mit = S.TEMPLATES["MIT"][2].split()
    changed = " ".join("blah" if i % 12 == 0 else w for i, w in enumerate(mit))
    rows += [(100, changed.upper()), (101, " ".join(mit[: len(mit) // 2])), (102, None), (103, ""), (104, sentence(r, 400)),
             (105, "the software and the license " * 20_000), (106, "license " * 3 + S.TEMPLATES["GPL-3.0"][0]),
             (107, S.TEMPLATES["MIT"][0] + " " + sentence(r, 90) + " " + S.TEMPLATES["Apache-2.0"][0]), (107, "x"),
             (None, S.TEMPLATES["MIT"][0])]
    df = docs_frame(spark, rows).selectExpr("*", "1 AS license", "2 AS start")
    got = {}
    for x in S.scan_licenses(df).collect():
        got.setdefault(x.doc_id, []).append(x)
    for i, (name, start) in truth.items():
        assert got[i][0].license == name and got[i][0].start == start and got[i][0].coverage == 1.0, (i, name)
        assert got[i][0].licenses == [name]
    assert got[100][0].license == "MIT" and 0.8 <= got[100][0].coverage < 1
    assert all(got[i][0].license is None for i in (101, 102, 103, 104, 105))
    assert got[106][0].license == "GPL-3.0" and got[None][0].license == "MIT"
    two = next(x for x in got[107] if x.license)
    assert set(two.licenses) == {"MIT", "Apache-2.0"}


def test_templates_that_stand_several_times_are_found():
    traced = "the license: Released under the MIT License. Released under the MIT License. See the license"
    assert S.scan(traced, S.templates()) == [("MIT", 5, 1.0, 13, 43)]
    r = rng(12)
    for t, text in zip(S.templates(), (x for texts in S.TEMPLATES.values() for x in texts)):
        common = sorted(t.counts, key=lambda w: (-t.counts[w], w))[:4]

        def noise(n):
            return " ".join(w if r.random() < 0.5 else str(r.choice(common)) for w in sentence(r, n).split())

        for copies in (2, 3):
            for between in (0, 7, 60):
                before = noise(40) + " | "
                whole = before + "".join(text + " " + noise(between) + "\n" for _ in range(copies)) + noise(40)
                found = S.best_match([w for w, _, _ in S.words_of(whole)], t, S.COVERAGE)
                assert found is not None and found[0] == len(t.words), (t.name, copies, between)
                assert found[2] - found[1] == len(t.words) - 1


def test_prefilter_loses_nothing():
    r = rng(8)
    known = S.templates()
    texts = [sentence(r, 30) + " " + " ".join(w for w in t.words if r.random() > 0.15) for t in known for _ in range(4)]
    passed = set(S.candidates(texts, known, S.COVERAGE))
    for i, text in enumerate(texts):
        words = [w for w, _, _ in S.words_of(text)]
        for j, t in enumerate(known):
            if len(S.patience_align(words, t.words)) >= S.COVERAGE * len(t.words):
                assert (i, j) in passed


def test_empty_table(spark):
    assert S.scan_licenses(docs_frame(spark, [])).count() == 0


NEIGHBOURS = [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU General Public License.", None),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("Licensed under CC BY-SA 4.0 International.", "CC-BY-SA-4.0"), ("Licensed under CC BY 4.0.", "CC-BY-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("This work is licensed under a Creative Commons Attribution 3.0 International License.", None),
    ("Licensed under the Apache License, Version 1.1.", None), ("Released under the BSD License.", None),
    ("Released under the terms of the MIT License.", "MIT"),
    (S.TEMPLATES["GPL-2.0"][1].replace(",", ";").replace("software:", "software;"), "GPL-2.0"),
    (S.TEMPLATES["LGPL-2.1"][1], "LGPL-2.1"), (S.TEMPLATES["BSD-3-Clause"][0], "BSD-3-Clause")]


def test_neighbouring_licenses_are_told_apart():
    r = rng(21)
    for text, name in NEIGHBOURS:
        found = S.scan(f"{sentence(r, 20)}. {text} {sentence(r, 20)}", S.templates())
        assert [f[0] for f in found] == ([name] if name else []), (text, found)


def test_scan_equals_the_bare_aligner_beside_any_character(spark):
    """Every template, damaged or whole, between random Unicode: the whole scan against every
    template aligned with every text."""
    r = rng(22)
    signs = list("\U0001f600\u3000\u3002\ufffd\ufeff\u00abé漢_-9ßİ\u212a")
    texts = []
    for t in S.templates():
        words = [w for w in t.words if r.random() > 0.1]
        glue = [str(r.choice([" ", " ", " ", *signs])) for _ in words]
        texts.append("".join(str(r.choice(signs)) + " "[:int(r.integers(2))] + w + g for w, g in zip(words, glue)))
        texts.append(str(r.choice(signs)) + " ".join(t.words).upper() + str(r.choice(signs)))
    texts.append("\U0001f600Released under the MIT License\U0001f600")
    got = {x.doc_id: x for x in S.scan_licenses(docs_frame(spark, list(enumerate(texts)))).collect()}
    for i, text in enumerate(texts):
        want = S.scan(text, S.templates())
        assert got[i].licenses == [f[0] for f in want], text
        assert (got[i].license, got[i].start, got[i].end) == ((want[0][0], want[0][3], want[0][4]) if want else (None, None, None))
    assert got[len(texts) - 1].license == "MIT"
