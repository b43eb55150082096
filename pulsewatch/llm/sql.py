"""DuckDB twins of the queries that SQL can express, over the same parquet tables."""

from __future__ import annotations

from .secretscan import RULES


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {i + 1}, 5))::BIGINT >> {shift}) & 31) + 1, 1)"
    for i in range(0, 40, 5) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS kept FROM p GROUP BY h)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to, url
FROM p JOIN k USING (h)
"""


def _secret_rule(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    quoted = "'" + pattern.replace("'", "''") + "'"
    return (f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, "
            f"regexp_extract_all(t, {quoted}, 0) AS m, regexp_extract_all(t, {quoted}, {group}) AS g, "
            f"string_split_regex(t, {quoted}) AS s FROM d WHERE regexp_matches(t, {quoted})")


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS ({' UNION ALL '.join(_secret_rule(i, r.kind, r.pattern, r.group, r.least) for i, r in enumerate(RULES))}),
e AS (SELECT doc_id, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m, g, s FROM h),
l AS (SELECT doc_id, rank, kind, least, i, length(s[i]) AS gap, length(m[i]) AS size, length(g[i]) AS part FROM e),
p AS (SELECT *, (sum(gap + size) OVER (PARTITION BY doc_id, rank ORDER BY i))::BIGINT - size AS a FROM l),
f AS (SELECT doc_id, rank, kind, a, a + size AS z FROM p WHERE part >= least),
r AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, rank) AS spans
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN r USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) >= 4
                          THEN list_distinct([array_to_string(ws[i:i + 3], ' ') for i in range(1, len(ws) - 2)])
                          WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS g FROM w),
n AS (SELECT doc_id, len(g) AS n FROM s),
u AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r(id, other) AS (SELECT x, y FROM e UNION SELECT r.id, e.y FROM r JOIN e ON r.other = e.x),
m AS (SELECT id, least(id, min(other)) AS component FROM r GROUP BY id)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, coalesce(m.component, n.doc_id) AS component_id,
       coalesce(m.component, n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN m ON m.id = n.doc_id
"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, x, length(x) // 2 AS n FROM d),
i AS (SELECT doc_id, x, unnest(range(0, n - 399)) AS a FROM b WHERE n >= 400),
w AS (SELECT doc_id, a, md5(substr(x, 2 * a + 1, 800)) AS h FROM i),
k AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
t AS (SELECT doc_id, a, CASE WHEN a <= lag(a) OVER (PARTITION BY doc_id ORDER BY a) + 400 THEN 0 ELSE 1 END AS fresh
      FROM w WHERE h IN (SELECT h FROM k)),
g AS (SELECT doc_id, a, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a) AS run FROM t),
s AS (SELECT doc_id, min(a) AS a, max(a) + 400 AS z FROM g GROUP BY doc_id, run),
q AS (SELECT s.doc_id, s.a, s.z, coalesce(lag(s.z) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0) AS p FROM s),
r AS (SELECT q.doc_id, sum(q.z - q.a)::BIGINT AS removed, count(*) AS spans,
             string_agg(substr(x, 2 * p + 1, 2 * (q.a - p)), '' ORDER BY q.a) AS kept, max(q.z) AS last
      FROM q JOIN b USING (doc_id) GROUP BY q.doc_id)
SELECT b.doc_id, b.n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN r.doc_id IS NULL THEN x ELSE kept || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM b LEFT JOIN r USING (doc_id)
"""


def _nearest(name: str, books: str) -> str:
    """Each part with its nearest entry of ``books``: the least distance, then the least entry number."""
    distance = " + ".join(f"(p.{x} - c.{x}) * (p.{x} - c.{x})" for x in "abcd")
    return f"""{name} AS (SELECT p.vec_id, p.i, p.label, p.a, p.b, p.c, p.d, min(({distance}) * 64 + c.e) AS m
  FROM p JOIN {books} c ON c.i = p.i GROUP BY ALL)"""


def _updated(name: str, assigned: str, books: str) -> str:
    """``books`` with each used entry replaced by the floored mean of its parts."""
    mean = ", ".join(f"(s{x} - (s{x} % n + n) % n) // n AS {x}" for x in "abcd")
    sums = ", ".join(f"sum({x})::BIGINT AS s{x}" for x in "abcd")
    pick = ", ".join(f"coalesce(u.{x}, o.{x})::BIGINT AS {x}" for x in "abcd")
    return f"""{name} AS (SELECT o.i, o.e, {pick} FROM {books} o LEFT JOIN (
  SELECT i, e, {mean} FROM (SELECT i, m % 64 AS e, count(*) AS n, {sums} FROM {assigned} GROUP BY ALL)) u
  ON u.i = o.i AND u.e = o.e)"""


CODEBOOKS = f"""
WITH v AS (SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NOT NULL AND isfinite(x)]) = len(embedding)),
p AS (SELECT vec_id, label, i, v[4 * i + 1] AS a, v[4 * i + 2] AS b, v[4 * i + 3] AS c, v[4 * i + 4] AS d
  FROM v, range(16) t(i)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM v ORDER BY vec_id LIMIT 64),
c0 AS (SELECT i, e, a, b, c, d FROM p JOIN f USING (vec_id)),
{_nearest("a0", "c0")},
{_updated("c1", "a0", "c0")},
{_nearest("a1", "c1")},
{_updated("c2", "a1", "c1")},
{_nearest("a2", "c2")},
r AS (SELECT vec_id, label, string_agg(format('{{:02x}}', m % 64), '' ORDER BY i) AS code, sum(m // 64)::BIGINT AS error
  FROM a2 GROUP BY ALL),
h AS (SELECT sha256(string_agg(concat_ws(',', a, b, c, d), ',' ORDER BY i, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, label, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM r, h
"""
