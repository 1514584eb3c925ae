"""SQL of the text operators that SQL can express, by other means than the operators' own."""

from __future__ import annotations

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower(x: str) -> str:
    return f"translate(coalesce({x}, ''), {_AZ})"


def _windows(table: str, size: str) -> str:
    return f"SELECT *, ws[i:i + {size} - 1] AS win FROM (SELECT *, unnest(range(1, len(ws) - {size} + 2)) AS i FROM {table})"


DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_lower("text")}, '{_WORD}') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, win, size FROM ({_windows("(SELECT *, least(10, len(ws)) AS size FROM b WHERE len(ws) > 0)", "size")})),
dw AS ({_windows("(SELECT * FROM d, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size)", "size")}),
hit AS (SELECT doc_id, i, dw.size AS size, item_id FROM dw JOIN bw ON dw.win = bw.win),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower("text")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, win FROM ({_windows("(SELECT *, least(4, len(ws)) AS size FROM d WHERE len(ws) > 0)", "size")})),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.win = b.win AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x) USING (doc_id)"""


#: As the contract has them: kinds, patterns (group 1: the value) and least lengths; the rest is the method's own rule.
KINDS = ("assign", "access", "hex")
SECRET_PATTERNS = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", "(AKIA[A-Z0-9]+)", "([0-9a-f]+)")
LEAST = (6, 20, 24)
OWNERS, REPOSITORIES, LIVE_LENGTH = 3, 100, 12


def _found(k: int) -> str:
    p = SECRET_PATTERNS[k].replace("'", "''")
    length = lambda part: f"coalesce(list_sum(list_transform({part}, lambda v: length(v))), 0)"
    return f"""SELECT doc_id, owner, {k} AS kind, ({length("p[1:i]")} + {length("m[1:i - 1]")})::BIGINT AS a, length(m[i]) AS n, v[i] AS value
 FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, owner, string_split_regex(text, '{p}') AS p, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', 1) AS v FROM d)) WHERE length(v[i]) >= {LEAST[k]}"""


_COUNTS = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{name}" for k, name in enumerate(KINDS))
_NAME = "['" + "','".join((*KINDS, "live")) + "'][kind + 1] || ':' || a || ':' || z"
SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, coalesce(text, '') AS text FROM documents),
f AS ({" UNION ALL ".join(map(_found, range(len(KINDS))))}),
o AS (SELECT value FROM f GROUP BY value HAVING count(DISTINCT owner) < {OWNERS} AND count(DISTINCT owner || '/' || coalesce(doc_id::VARCHAR, '')) < {REPOSITORIES}),
s AS (SELECT doc_id, kind, a, a + n AS z FROM f),
live AS (SELECT DISTINCT doc_id, {len(KINDS)} AS kind, a + n - length(value) AS a, a + n AS z FROM f JOIN o USING (value) WHERE length(value) >= {LIVE_LENGTH} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')),
g AS (SELECT doc_id, {_COUNTS}, string_agg({_NAME}, ',' ORDER BY a, kind) AS base FROM s GROUP BY doc_id),
t AS (SELECT doc_id, string_agg({_NAME}, ',' ORDER BY a, kind) AS spans FROM (SELECT * FROM s UNION ALL SELECT * FROM live) GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id) LEFT JOIN t USING (doc_id)"""
