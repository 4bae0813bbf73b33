"""DuckDB SQL of the trie and of the vector codes; the rounds of the codes are written out one after the other."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"

#: CRC-32 of the decimal digits of c: a byte at a time, eight shifts for each.
_CRC = """xor(list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::UBIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
      lambda p, q: xor(p >> 1, 3988292384::UBIGINT * (p & 1)))), 4294967295::UBIGINT)"""

TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
    coalesce(role, '') AS r, coalesce(text, '') AS x
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list(struct_pack(r := r, x := x) ORDER BY pos) AS ts FROM t GROUP BY c
), h AS (
  SELECT c, ts, ({_CRC} % 4)::BIGINT AS h FROM own
), whole AS (
  SELECT h.c, list_concat(coalesce(b.ts, [])[1:h.h], h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN own b ON b.c = h.c - h.c % 20
), prefixes AS (
  SELECT c, d, ts[1:d] AS p, d = len(ts) AS ends FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM whole)
), nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends) AS e FROM prefixes GROUP BY p, d
), children AS (
  SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), worth AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n.n - 1) * len(regexp_extract_all(n.p[n.d].x, '{_WORDS}')) END AS saved
  FROM nodes n LEFT JOIN children c ON c.p = n.p AND c.d = n.d
), above AS (
  SELECT p[1:k] AS p, k AS d, sum(saved) AS saved, sum((n_children = 0)::INTEGER) AS leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM worth) GROUP BY ALL
)
SELECT w.conv_id, w.d::BIGINT AS depth, u.conv_id AS parent_conv_id, w.n::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
  a.leaves::BIGINT AS n_leaves, a.saved::BIGINT AS saved_tokens, sha256(coalesce(w.e, '')) AS ends_sha256
FROM worth w JOIN above a ON a.p = w.p AND a.d = w.d LEFT JOIN nodes u ON u.p = w.p[1:w.d - 1] AND u.d = w.d - 1
"""


def _assigned(books: str, out: str) -> str:
    return f"""{out} AS (
  SELECT vec_id, p, e, dist FROM (
    SELECT c.vec_id, c.p, b.e, sum((c.v - b.v) * (c.v - b.v)) AS dist
    FROM cells c JOIN {books} b ON b.p = c.p AND b.i = c.i GROUP BY c.vec_id, c.p, b.e)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY dist, e) = 1
)"""


def _round(r: int) -> str:
    return _assigned(f"b{r}", f"a{r}") + f""", m{r} AS (
  SELECT a.p, a.e, c.i, sum(c.v)::HUGEINT AS s, count(*)::HUGEINT AS n
  FROM a{r} a JOIN cells c ON c.vec_id = a.vec_id AND c.p = a.p GROUP BY ALL
), b{r + 1} AS (
  SELECT b.p, b.e, b.i, CASE WHEN m.n IS NULL THEN b.v ELSE ((m.s - ((m.s % m.n) + m.n) % m.n) // m.n)::BIGINT END AS v
  FROM b{r} b LEFT JOIN m{r} m ON m.p = b.p AND m.e = b.e AND m.i = b.i
)"""


def codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    steps = ", ".join(_round(r) for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cells AS (
  SELECT vec_id, j // n AS p, j % n AS i, x[j + 1] AS v
  FROM (SELECT vec_id, x, len(x) // {parts} AS n, unnest(range(0, len(x))) AS j FROM kept)
), b0 AS (
  SELECT c.p, s.e, c.i, c.v FROM cells c JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) s ON s.vec_id = c.vec_id
), {steps}, {_assigned(f"b{rounds}", "last")}, coded AS (
  SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(dist)::BIGINT AS error FROM last GROUP BY vec_id
)
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, e, i)) FROM b{rounds}) AS codebooks_sha256
FROM kept k JOIN coded c ON c.vec_id = k.vec_id
"""
