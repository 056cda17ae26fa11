"""The queries as DuckDB SQL, where it can say the same; written independently of the operators."""
from __future__ import annotations

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP5 = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM d),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_STRIP})")} AS key FROM x),
bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(bad.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN bad USING (key) GROUP BY doc_id
"""

OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
n AS (SELECT doc_id, t, ws, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_stuck
  FROM w),
g AS (SELECT doc_id, unnest(range(1, n_words - 3)) AS i, ws FROM n WHERE n_words >= 5),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM h WHERE c > 1) GROUP BY doc_id),
m AS (SELECT n.doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(ls) AS n_lines, n_upper, n_stuck
  FROM n LEFT JOIN r ON r.doc_id = n.doc_id),
f AS (SELECT *, n_words < 10 AS r0, 100 * n_repeat_words > 20 * n_words AS r1, 100 * n_symbols > 10 * n_words AS r2,
    100 * n_dup_lines > 50 * n_lines AS r3, word_chars < 2 * n_words AS r4, word_chars > 20 * n_words AS r5,
    100 * n_upper > 50 * word_chars AS r6, 100 * n_stuck > 20 * n_words AS r7 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 OR r1 AS base_failed,
  NOT (r0 OR r1 OR r2 OR r3 OR r7) AS kept,
  (r0::INT + 2 * r1::INT + 4 * r2::INT + 8 * r3::INT + 16 * r4::INT + 32 * r5::INT + 64 * r6::INT + 128 * r7::INT)::BIGINT AS failed_rules
FROM f
"""

OP8 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM e AS a JOIN e AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS c ON c.a = s.doc_id
"""


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one kind: a row per match with its number in the text."""
    quoted = pattern.replace("'", "''")
    return f"""
SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, unnest(range(1, len(a) + 1)) AS i,
  unnest(list_transform(a, lambda x: length(x))) AS size, unnest(list_transform(v, lambda x: length(x))) AS val,
  unnest(list_transform(s[1 : len(a)], lambda x: length(x))) AS gap
FROM (SELECT doc_id, regexp_extract_all(text, '{quoted}') AS a, regexp_extract_all(text, '{quoted}', {group}) AS v,
    string_split_regex(text, '{quoted}') AS s FROM documents WHERE regexp_matches(text, '{quoted}'))
WHERE len(a) > 0"""


#: Kind, pattern, group, least length (fixed values).
_KINDS = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("github", "gh[pousr]_[A-Za-z0-9]+", 0, 24),
    ("google", "AIza[0-9A-Za-z_-]+", 0, 39),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    ("pem", "-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----", 0, 0),
    ("slack", "xox[abpr]-[A-Za-z0-9-]+", 0, 15),
    ("stripe", "sk_live_[0-9A-Za-z]+", 0, 24),
)

OP10 = f"""
WITH m AS ({" UNION ALL ".join(_spans(k, *x) for k, x in enumerate(_KINDS))}),
p AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM m),
q AS (SELECT doc_id, rank, kind, stop - size AS start, kind || ':' || (stop - size) || ':' || stop AS span FROM p WHERE val >= least),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS k,
    count(*) FILTER (WHERE kind = 'hex') AS h, string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
    string_agg(span, ',' ORDER BY start, rank) AS spans FROM q GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents AS d LEFT JOIN g ON g.doc_id = d.doc_id
"""

OP11 = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 3))::INT AS bucket FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS words, (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT AS weight
  FROM d GROUP BY source),
-- Sources fill up in the order of words per weight; the level is the first that its next source can hold.
o AS (SELECT *, sum(words) OVER ()::BIGINT AS all_words, sum(weight) OVER ()::BIGINT AS all_weight,
    row_number() OVER (ORDER BY words / weight, source) AS place,
    coalesce(sum(words) OVER (ORDER BY words / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_words,
    coalesce(sum(weight) OVER (ORDER BY words / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_weight
  FROM s),
l AS (SELECT *, (all_words - 3 * full_words) / (all_weight - full_weight) AS level FROM o),
f AS (SELECT arg_min(level, place) AS level FROM l WHERE NOT 3 * words < weight * level),
t AS (SELECT source, words, least(weight * (SELECT level FROM f), (3 * words)::DOUBLE) AS target FROM s),
r AS (SELECT *, CASE WHEN words > 0 THEN floor(target / words) ELSE 0 END AS times FROM t),
u AS (SELECT source, bucket AS edge, sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) AS upto FROM d GROUP BY source, bucket
  UNION ALL SELECT source, -1, 0 FROM s),
c AS (SELECT r.source, min({'off': abs(upto - (target - times * words)), 'edge': edge}).edge AS last
  FROM r JOIN u ON u.source IS NOT DISTINCT FROM r.source GROUP BY r.source)
SELECT doc_id, size, r.words AS source_size, r.target AS target, ((times + (bucket <= c.last)::INT) * size)::BIGINT AS taken
FROM d JOIN r ON r.source IS NOT DISTINCT FROM d.source JOIN c ON c.source IS NOT DISTINCT FROM d.source
"""

# The checksum bit by bit: a byte is mixed in, then eight shifts, written as -1.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, v: CASE WHEN v >= 0 THEN xor(a, v) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)"""

OP12 = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, turn, length(text) AS n, md5('trie-0' || length(role) || ':' || role || text) AS h FROM t),
o AS (SELECT conv_id, list({{'n': n, 'h': h}} ORDER BY turn NULLS FIRST, h) AS own, conv_id - conv_id % 100 AS base,
    {_CRC.format("conv_id::VARCHAR")} % 6 AS head FROM i GROUP BY conv_id),
r AS (SELECT o.conv_id, list_concat(coalesce(b.own, [])[1 : o.head], o.own[o.head + 1 :]) AS turns FROM o LEFT JOIN o AS b ON b.conv_id = o.base),
p AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS d, turns FROM r),
q AS (SELECT conv_id, d, len(turns) AS stop, array_to_string(list_transform(turns[1 : d], lambda x: x.h), '') AS key,
    CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n FROM p),
g AS (SELECT d, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(n) AS n,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE stop = d) AS ends FROM q GROUP BY d, key),
k AS (SELECT d - 1 AS d, substr(key, 1, 32 * (d - 1)) AS key, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT g.*, coalesce(n_children, 0) AS n_children, (coalesce(n_children, 0) = 0)::INT AS leaf, (n_convs - 1) * n AS saved
  FROM g LEFT JOIN k ON k.d = g.d AND k.key = g.key),
s AS (SELECT q.d, q.key, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM v JOIN q ON q.conv_id = v.conv_id AND q.d <= v.d GROUP BY q.d, q.key)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN s ON s.d = v.d AND s.key = v.key LEFT JOIN v AS u ON u.d = v.d - 1 AND u.key = substr(v.key, 1, 32 * (v.d - 1))
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda w: {_LOWER.format("w")}) AS ws FROM documents),
w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY lang, source, term),
f AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT f.*, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY f.lang, source) + v) AS p FROM f JOIN v ON v.lang = f.lang),
t AS (SELECT p.lang, term, sum(n) AS n FROM p GROUP BY p.lang, term),
q AS (SELECT t.lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY t.lang) + v) AS q FROM t JOIN v ON v.lang = t.lang),
x AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p AS a JOIN p AS b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g AS a JOIN g AS b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
  FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op5_line_dedup": OP5, "op6_quality_rules": OP6, "op8_near_duplicates": OP8, "op10_secret_scan": OP10,
    "op11_source_mixing": OP11, "op12_prefix_trie": OP12, "op13_source_divergence": OP13,
}
