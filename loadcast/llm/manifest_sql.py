"""DuckDB SQL of the Merkle manifest: every level kept, siblings by join, folding by recursion."""

from __future__ import annotations


def crc32_table() -> str:
    """The 256 remainders of the byte-wise crc32, from its polynomial (fixed value 3988292384)."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return (f"SELECT list_transform(range(256), lambda i: list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], "
            f"lambda c, k: {step})) AS t")


def crc32(byte_list: str, table: str = "t") -> str:
    """Unsigned crc32 of a list of byte values."""
    return (f"xor(list_reduce([4294967295] || {byte_list}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), "
            f"4294967295)")


def _leaf(text: str) -> str:
    fields = [f"COALESCE(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
              for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _levels(name: str, leaves: str) -> str:
    """Nodes of every level above the rows (tree, idx, n, digest) of ``leaves``, and what stands
    left and right of each in its run."""
    return f"""{name} AS (
  SELECT tree, idx, 0 AS level, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, idx // 3, level + 1, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY tree, idx // 3, level, n),
{name}_sides AS (
  SELECT a.tree, a.idx, a.level, COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
         COALESCE(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after
  FROM {name} a JOIN {name} b ON a.tree = b.tree AND a.level = b.level AND a.idx // 3 = b.idx // 3
  WHERE a.n > 1 GROUP BY ALL)"""


def _walk(name: str, start: str, sides: str) -> str:
    """Nodes (rid, tree, idx, n, node, proof) of ``start`` folded to their tree's root."""
    return f"""{name} AS (
  SELECT rid, tree, idx, 0 AS level, n, node, proof FROM {start}
  UNION ALL
  SELECT w.rid, w.tree, w.idx // 3, w.level + 1, (w.n + 2) // 3, sha256(s.before || w.node || s.after),
         w.proof || s.before || s.after
  FROM {name} w JOIN {sides} s ON s.tree = w.tree AND s.level = w.level AND s.idx = w.idx WHERE w.n > 1)"""


OP13_SQL = f"""
WITH RECURSIVE remainders AS ({crc32_table()}),
tampered AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND
         {crc32("list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 2 = 0
         THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM documents, remainders),
hashed AS (SELECT doc_id, COALESCE('=' || source, '') AS tree, {_leaf('text')} AS digest, {_leaf('changed')} AS node FROM tampered),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, digest) AS rid, '' AS proof, count(*) OVER (PARTITION BY tree) AS n,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx
  FROM hashed),
{_levels('low', 'leaves')},
subroots AS (
  SELECT tree AS name, '' AS tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n
  FROM low WHERE n = 1),
{_levels('high', 'subroots')},
{_walk('lower', 'leaves', 'low_sides')},
crossing AS (
  SELECT w.rid, s.tree, s.idx, s.n, w.node, w.proof FROM lower w JOIN subroots s ON s.name = w.tree WHERE w.n = 1),
{_walk('upper', 'crossing', 'high_sides')}
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(u.proof) AS proof_sha256,
       u.node AS folded_root, u.node = r.digest AS verified
FROM leaves l JOIN upper u ON u.rid = l.rid AND u.n = 1 JOIN subroots s ON s.name = l.tree
JOIN high r ON r.n = 1"""
