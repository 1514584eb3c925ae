"""SQL of the registered queries, from shared parts: each part is a list of common table expressions."""

from __future__ import annotations

from linkmill.functions import vocab
from linkmill.plans.records import ALIASES, CAP, PREFILTER


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean(x: str) -> str:
    for a, b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"), ("ø", "o"), ("Ø", "O")):
        x = f"replace({x}, '{a}', '{b}')"
    return f"trim(regexp_replace(replace(lower(strip_accents({x})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def _case(x: str, d: dict[str, str], other: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in d.items()) + f" ELSE {other} END"


def _digits(x: str) -> str:
    return f"regexp_full_match({x}, '[0-9]+')"


def _zeros(x: str) -> str:
    return f"regexp_replace({x}, '^0+([0-9])', '\\1')"


def token(x: str) -> str:
    d = f"CASE WHEN {_digits(x)} THEN {_zeros(x)} ELSE {x} END"
    return _case(f"({d})", vocab.ADDRESS_WORDS, f"({d})")


_STOP = "[" + ", ".join(map(_q, vocab.NAME_STOP)) + "]"
_END = r"\.(?:" + "|".join(vocab.DOMAIN_ENDINGS) + r")\b"
_URL, _HAS_URL = r"https?://|www\.|" + _END, r"https?://|www\.|[a-z0-9]" + _END
_PHRASES = r"\b(?:" + "|".join(vocab.NAME_STOP_PHRASES) + r")\b"
words = lambda x: f"list_filter(string_split({x}, ' '), lambda t: t <> '')"
join = lambda x: f"coalesce(array_to_string({x}, ' '), '')"

RECORDS = r"""
r AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, CAST(1 + doc_id % 3 AS TINYINT) AS source, lang AS country,
  array_to_string(w[1:4], ' ') AS business_name, (n_chars % 50) || ' ' || array_to_string(w[5:10], ' ') || ', ' || src AS business_address
  FROM (SELECT doc_id, lang, source AS src, n_chars, string_split_regex(trim(text), '\s+') AS w FROM documents))"""

NORM = (
    RECORDS
    + f""",
n1 AS (SELECT *, {clean(f"regexp_replace(split_part(business_name, '|', 1), '{_URL}', ' ', 'gi')")} AS name_norm,
  list_filter(list_transform(string_split(business_address, ','), lambda x: {clean("x")}), lambda x: x <> '') AS parts FROM r),
n2 AS (SELECT *, list_filter(string_split(regexp_replace(name_norm, '{_PHRASES}', ' ', 'g'), ' '), lambda t: t <> '' AND NOT list_contains({_STOP}, t)) AS kept,
  list_transform(parts, lambda p, j: CASE WHEN j > len(parts) - 2 THEN {_case(join("list_filter(string_split(p, ' '), lambda t: NOT " + _digits("t") + ")"), ALIASES, "NULL")} END) AS admins FROM n1),
n3 AS (SELECT *, {join("list_filter(kept, lambda t, i: i = 1 OR t <> kept[i - 1])")} AS core,
  {join("flatten(list_transform(parts, lambda p: list_transform(list_filter(string_split(p, ' '), lambda t: t <> '' AND t <> 'null'), lambda t: " + token("t") + ")))")} AS addr_norm,
  {join("flatten(list_transform(parts, lambda p, j: list_transform(list_filter(string_split(p, ' '), lambda t: t <> '' AND t <> 'null' AND (admins[j] IS NULL OR " + _digits("t") + ")), lambda t: " + token("t") + ")))")} AS addr_core,
  list_filter(admins, lambda a: a IS NOT NULL) AS adm FROM n2),
n4 AS (SELECT *, CASE WHEN core = '' THEN name_norm ELSE core END AS name_core, list_transform(regexp_extract_all(addr_norm, '[0-9]+'), lambda t: {_zeros("t")}) AS nums FROM n3),
norm AS (SELECT entity_id, source, country, name_norm, name_core, replace(name_core, ' ', '') AS name_nospace,
  CAST(regexp_matches(business_name, '{_HAS_URL}', 'i') AS TINYINT) AS name_has_url, CAST(0 AS TINYINT) AS name_nonlatin, addr_norm, addr_core,
  {join("nums")} AS addr_nums, coalesce(nums[1], '') AS addr_first_num, {join("CASE WHEN len(adm) = 2 AND adm[1] = adm[2] THEN adm[1:1] ELSE adm END")} AS addr_admin,
  CAST(addr_norm = '' AS TINYINT) AS addr_empty FROM n4)"""
)

_NAME, _ADDR = words("name_core"), words("addr_core")
_LETTERS = lambda n: f"list_filter({_ADDR}, lambda t: regexp_full_match(t, '[a-z]+') AND length(t) >= {n})"
KEYS = (
    NORM
    + f""",
k0 AS (SELECT entity_id, source, country, 1 AS bit, addr_first_num || '|' || unnest(list_filter({_NAME}, lambda t: length(t) >= 2)) AS key FROM norm WHERE addr_first_num <> ''
 UNION ALL SELECT entity_id, source, country, 2, addr_first_num || '|' || unnest({_LETTERS(3)}) FROM norm WHERE addr_first_num <> ''
 UNION ALL SELECT entity_id, source, country, 4, n || '|' || unnest(({_LETTERS(4)})[1:6]) FROM (SELECT *, unnest((list_filter({_NAME}, lambda t: length(t) >= 3))[1:4]) AS n FROM norm)
 UNION ALL SELECT entity_id, source, country, 8, substr(name_nospace, 1, 8) FROM norm WHERE length(name_nospace) >= 5),
keys AS (SELECT DISTINCT entity_id, source, country, CAST(bit AS TINYINT) AS bit, key FROM k0)"""
)
GROUPS = KEYS + """,
groups AS (SELECT country, bit, key, count(*) FILTER (source <> 1) AS n_index, count(*) FILTER (source = 1) AS n_query FROM keys GROUP BY ALL)"""
CAPPED = GROUPS + f""",
capped AS (SELECT k.*, n_index FROM keys k JOIN groups g USING (country, bit, key) WHERE n_index BETWEEN 1 AND {CAP} AND n_query BETWEEN 1 AND {CAP})"""
PAIRS = CAPPED + """,
pairs AS (SELECT q.entity_id AS s1_id, i.entity_id AS other_id, CAST(bit_or(CAST(q.bit AS INTEGER)) AS INTEGER) AS key_hits, round(sum(1.0::DOUBLE / i.n_index), 9) AS key_weight
  FROM capped q JOIN capped i USING (country, bit, key) WHERE q.source = 1 AND i.source <> 1 GROUP BY ALL)"""
CAND = PAIRS + f""",
cand AS (SELECT *, round(key_weight / (1 + key_weight), 6) AS cheap_score FROM pairs
  QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY key_weight DESC, other_id) <= {PREFILTER})"""
PRED = CAND + """,
pred AS (SELECT s1_id, other_id, cheap_score AS prob FROM cand QUALIFY row_number() OVER (PARTITION BY other_id ORDER BY cheap_score DESC, s1_id) = 1)"""


def crc32(x: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({x}, ''), lambda c: unicode(c)::BIGINT)), lambda crc, byte: {bits}), 4294967295::BIGINT)"


def lcs(pairs: str) -> str:
    """lcs (x, y, n): length of the longest common subsequence of each pair, row after row of the plain dynamic program."""
    row = "list_transform(row, lambda v, i: CASE WHEN i > 1 AND xs[i - 1] = ch[1] THEN row[i - 1] + 1 ELSE v END)"
    grown = f"list_reduce(list_transform({row}, lambda v: [v]), lambda p, v: list_append(p, greatest(p[-1], v[1])))"
    return f"""
lp AS (SELECT x, y, list_transform(string_split(x, ''), lambda c: unicode(c)::BIGINT) AS xs, list_transform(string_split(y, ''), lambda c: [unicode(c)::BIGINT]) AS ys FROM ({pairs})),
lcs AS (SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0 ELSE (list_reduce(list_concat([list_transform(range(len(xs) + 1), lambda i: 0::BIGINT)], ys), lambda row, ch: {grown}))[-1] END AS n FROM lp)"""


def ratio(a: str, b: str, n: str) -> str:
    return f"CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {n} / (length({a}) + length({b})) END"


def rest(a: str, b: str) -> str:
    """The sorted words of a that b lacks."""
    return join(f"list_sort(list_filter(list_distinct({words(a)}), lambda t: NOT list_contains({words(b)}, t)))")


def rests(table: str, a: str, b: str) -> str:
    return f"SELECT {rest(a, b)} AS x, {rest(b, a)} AS y FROM {table}"


def token_set(a: str, b: str, n: str) -> str:
    """n: the common subsequence of both rests."""
    common = f"length({join(f'list_intersect({words(a)}, {words(b)})')})"
    x, y = f"length({rest(a, b)})", f"length({rest(b, a)})"
    gap = f"({common} > 0)::INT"
    part = lambda r: f"CASE WHEN {common} > 0 THEN 100.0::DOUBLE * (1 - (1 + {r})::DOUBLE / ({common} + {common} + 1 + {r})) ELSE 0 END"
    full = f"100.0::DOUBLE * (1 - ({x} + {y} - 2 * {n})::DOUBLE / (2 * ({common} + {gap}) + {x} + {y}))"
    return f"CASE WHEN len({words(a)}) = 0 OR len({words(b)}) = 0 THEN 0.0::DOUBLE WHEN {common} > 0 AND ({x} = 0 OR {y} = 0) THEN 100.0 ELSE greatest({full}, {part(x)}, {part(y)}) END"


SCORED = (
    CAND
    + f""",
sp AS (SELECT c.s1_id, c.other_id, key_hits, key_weight, a.name_core AS an, o.name_core AS bn, a.addr_core AS aa, o.addr_core AS ba, a.addr_first_num <> '' AND a.addr_first_num = o.addr_first_num AS num
  FROM cand c JOIN norm a ON a.entity_id = c.s1_id JOIN norm o ON o.entity_id = c.other_id),{lcs(rests("sp", "an", "bn") + " UNION " + rests("sp", "aa", "ba"))},
sc AS (SELECT s1_id, other_id, key_hits, key_weight, round((0.5::DOUBLE * {token_set("an", "bn", "l.n")} + 0.3::DOUBLE * {token_set("aa", "ba", "m.n")} + CASE WHEN num THEN 20.0::DOUBLE ELSE 0 END) / 100, 9) AS cheap_score FROM sp
  JOIN lcs l ON l.x = {rest("an", "bn")} AND l.y = {rest("bn", "an")} JOIN lcs m ON m.x = {rest("aa", "ba")} AND m.y = {rest("ba", "aa")}),
scored AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY cheap_score DESC, other_id) <= {vocab.TOP_K})"""
)
TRUTH = f"""
e AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS id, 1 + doc_id % 3 AS source, lang, md5({clean("text")}) AS h FROM documents),
truth AS (SELECT s1_id, e.id AS other_id FROM e JOIN (SELECT lang, h, min(id) AS s1_id FROM e WHERE source = 1 GROUP BY ALL) USING (lang, h) WHERE e.source <> 1),
ids AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS s1_id, lang AS country FROM documents WHERE doc_id % 3 = 0)"""


def f05(tp: str, p: str, t: str) -> str:
    return f"CASE WHEN {t} = 0 THEN CASE WHEN {p} = 0 THEN 1.0::DOUBLE ELSE 0.0 END WHEN {tp} = 0 THEN 0.0 ELSE 1.25 * ({tp} / {p}::DOUBLE) * ({tp} / {t}::DOUBLE) / (0.25 * ({tp} / {p}::DOUBLE) + ({tp} / {t}::DOUBLE)) END"


def entities(pred: str) -> str:
    """ent: counts and F0.5 of every id against a relation of predicted pairs."""
    return f"""
p1 AS (SELECT s1_id, count(*) AS n_pred FROM {pred} GROUP BY 1), t1 AS (SELECT s1_id, count(*) AS n_true FROM truth GROUP BY 1),
h1 AS (SELECT s1_id, count(*) AS tp FROM {pred} JOIN truth USING (s1_id, other_id) GROUP BY 1),
ent AS (SELECT *, {f05("tp", "n_pred", "n_true")} AS f05 FROM (SELECT ids.s1_id, country, coalesce(tp, 0) AS tp, coalesce(n_pred, 0) AS n_pred, coalesce(n_true, 0) AS n_true
  FROM ids LEFT JOIN p1 USING (s1_id) LEFT JOIN t1 USING (s1_id) LEFT JOIN h1 USING (s1_id)))"""


EVAL = f"{PRED}, {TRUTH}"


def w(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"
