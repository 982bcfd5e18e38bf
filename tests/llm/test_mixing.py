import hashlib
from fractions import Fraction

import duckdb

from helpers_llm import docs_frame
from loadcast.llm import mixing as M


def water(budget, nodes):
    """Shares of (name, capacity, weight) nodes: full ones first, the rest by weight."""
    left, out, open_ = budget, {}, dict((n, (c, w)) for n, c, w in nodes)
    while open_:
        total = sum(w for _, w in open_.values())
        full = [n for n, (c, w) in open_.items() if Fraction(c, w) <= Fraction(left, total)]
        if not full:
            return out | {n: left * w // total for n, (c, w) in open_.items()}
        for n in full:
            out[n] = open_.pop(n)[0]
        left = budget - sum(out.values())
    return out


def brute(rows, target=None):
    n_of = lambda t: len((t or "").split())
    leaf = {}
    for doc_id, text, lang, source in rows:
        digits = "".join(c for c in (source or "")[::-1] if c.isdigit())[::-1]
        domain = M.DOMAINS[int(digits or 0) % 4]
        leaf.setdefault((domain, lang or "", source or ""), []).append((doc_id, n_of(text)))
    tokens = {k: sum(n for _, n in v) for k, v in leaf.items()}
    up = lambda d: sum(t for k, t in tokens.items() if k[:len(d)] == d)
    w = lambda level, name, t: M.WEIGHTS[level].get(name, 1) if level in M.WEIGHTS else max(t, 1)
    total = up(())
    shares = {(): min(total if target is None else target, total * 2)}
    for depth, level in enumerate(M.LEVELS):
        nodes = {}
        for k in tokens:
            nodes.setdefault(k[:depth], set()).add(k[:depth + 1])
        for parent, children in nodes.items():
            got = water(shares[parent], [(c, up(c) * 2, w(level, c[-1], up(c))) for c in sorted(children)])
            shares |= got
    out = []
    for k, docs in leaf.items():
        epochs, room = (shares[k] // tokens[k], shares[k] % tokens[k]) if tokens[k] else (1, 0)
        key = lambda d: hashlib.md5(f"{M.SEED}:{epochs}:{'' if d is None else d}".encode()).hexdigest()
        by_key = {}
        for d, n in docs:
            by_key.setdefault(key(d), []).append((d, n))
        used, cut = 0, False
        for kk in sorted(by_key):
            used += sum(n for _, n in by_key[kk])
            cut = cut or used > room
            for d, _ in by_key[kk]:
                out += [(d, e) for e in range(epochs + (not cut))]
    return sorted(out, key=str)


def table():
    rows = [(i, "word " * (1 + i * 7 % 40), "en" if i % 3 else "fr", f"src{i % 7 if i % 2 else 0}") for i in range(300)]
    return rows + [(400, None, "en", "src1"), (401, "", None, None), (402, "tok " * 3000, "es", "src2"),
                   (403, "a b", "de", "odd"), (404, "", "xx", "src9"), (None, "c d e", "en", "src3"),
                   (405, "same key", "en", "src5"), (405, "same key", "en", "src5")]


def test_matches_brute_force(spark):
    df = docs_frame(spark, table()).repartition(3)
    for target in (None, 500, 10**9):
        got = sorted(((r.doc_id, r.epoch) for r in M.mix(df, target_tokens=target).collect()), key=str)
        assert got == brute(table(), target), target


def test_whole_capacity_is_every_document_twice(spark):
    got = M.mix(docs_frame(spark, table()[:50]), target_tokens=10**9).groupBy("doc_id").count().collect()
    assert len(got) == 50 and all(r["count"] == 2 for r in got)


def test_keeps_columns_and_prefixes_are_seeded(spark):
    df = docs_frame(spark, table()).selectExpr("*", "'x' AS domain", "1 AS tokens", "2 AS n", "9 AS epoch")
    out = M.mix(df)
    assert sorted(out.columns) == sorted(df.columns)
    a = sorted(map(str, out.select("doc_id", "epoch").collect()))
    assert a == sorted(map(str, M.mix(df.repartition(5)).select("doc_id", "epoch").collect()))
    assert a != sorted(map(str, M.mix(df, seed=3).select("doc_id", "epoch").collect()))


def test_sql_form(spark):
    rows = table()
    con = duckdb.connect()
    con.register("documents", docs_frame(spark, rows).toPandas().astype({"doc_id": "Int64"}))
    sql = sorted(((None if r[0] is None else int(r[0]), r[1]) for r in con.sql(M.oracle()).fetchall()), key=str)
    assert sql == brute(rows)


def test_empty_table(spark):
    assert M.mix(docs_frame(spark, [])).count() == 0
