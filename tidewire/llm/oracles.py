"""SQL for the corpus queries that SQL can express, over the whole tables."""

from __future__ import annotations

from .urlfilter import RULES, SOFT, SOFT_NEEDED, STRICT

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
r(node, c) AS (SELECT doc_id, doc_id FROM s UNION SELECT links.b, r.c FROM r JOIN links ON links.a = r.node),
m AS (SELECT node, min(c) AS component_id FROM r GROUP BY node),
k AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN 1 ELSE count(*) OVER (PARTITION BY list_sort(s)) END AS n_copies FROM s)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept, n_copies FROM s JOIN m ON m.node = s.doc_id JOIN k ON k.doc_id = s.doc_id
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _hits(terms: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(regexp_matches(hp, '(^|\\P{{L}}){t}(\\P{{L}}|$)') AS INTEGER)" for t in terms)


def _rule(column: str) -> str:
    cases = "".join(
        f" WHEN (host = '{site}' OR ends_with(host, '.{site}')) AND starts_with(path, '{start}') THEN '{site + start if column == 'rule' else what}'" for site, start, what in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    )
    return f"CASE{cases} END"


URLS = f"""
WITH a AS (SELECT page_id, lower(coalesce(url, '')) AS whole, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, whole, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, whole AS hp FROM h),
t AS (SELECT *, {_hits(STRICT)} AS strict_hits, {_hits(SOFT)} AS soft_hits, {_rule("rule")} AS rule, {_rule("verdict")} AS given FROM c)
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN strict_hits > 0 OR soft_hits >= {SOFT_NEEDED} THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_hits FROM t
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (SELECT *, length(text) + len(regexp_extract_all(text, '\[\\*/?INST\]|<\\*(?:/?s>|</?\w*>>)')) AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 ELSE 11 + 2 * length(role) END) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id
"""

LINES = f"""
WITH l AS (SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM (SELECT row_number() OVER () AS rowid, * FROM documents)),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS common FROM k LEFT JOIN c ON c.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (common) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT common), '')) AS kept_sha256 FROM m GROUP BY r, doc_id
"""

#: The remainders of the reflected polynomial for 4 bits, fixed values of CRC-32.
_CRC4 = [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, 4 bits at a time, lower half first."""
    nibbles = f"flatten([[ascii(c) & 15, ascii(c) >> 4] FOR c IN string_split({text}, '')])"
    step = f"xor({_CRC4}[CAST(xor(c, CAST(n AS BIGINT)) & 15 AS INT) + 1], c >> 4)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST({nibbles} AS BIGINT[])), lambda c, n: {step}), 4294967295)"


RETENTION = f"""
WITH c AS (SELECT DISTINCT * FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL),
h AS (SELECT *, {_crc32("CAST(click_id AS VARCHAR)")} AS h FROM c),
k AS (SELECT client_id, ts, kind, coalesce(arrived_at + to_days(CAST(CASE WHEN h % 3 = 0 THEN h % 100 ELSE 0 END AS INTEGER)) < TIMESTAMP '2024-02-15 00:00:00', FALSE) AS known,
  CASE WHEN value IS NULL OR NOT isfinite(value) OR abs(value) >= 9e13 THEN 0 ELSE CAST(floor(100 * value + 0.5) AS BIGINT) END AS cents FROM h),
s AS (SELECT client_id, min(ts) FILTER (known) AS s0, min(ts) AS s1 FROM k WHERE kind = 'signup' GROUP BY client_id),
g AS (SELECT client_id, segment FROM clients QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY updated_at DESC NULLS LAST, segment DESC NULLS LAST) = 1),
u AS (SELECT s.client_id, s0, s1, coalesce(segment, '') AS segment, {_crc32("CAST(s.client_id AS VARCHAR)")} AS crc, CAST(coalesce(CAST(s0 AS DATE) <> CAST(s1 AS DATE), FALSE) AS BIGINT) AS moved FROM s LEFT JOIN g ON g.client_id = s.client_id),
b AS (
  SELECT 0 AS state, u.client_id, s0 AS start, ts, segment, crc, moved, cents FROM k JOIN u ON u.client_id = k.client_id WHERE known AND ts >= s0
  UNION ALL SELECT 1, u.client_id, s1, ts, segment, crc, moved, cents FROM k JOIN u ON u.client_id = k.client_id WHERE ts >= s1),
p AS (SELECT state, client_id, segment, crc, moved, CAST(date_diff('day', DATE '1970-01-01', CAST(start AS DATE)) AS BIGINT) AS cohort, CAST((epoch_us(ts) - epoch_us(start)) // 86400000000 AS BIGINT) AS period, sum(cents) AS cents FROM b GROUP BY ALL)
SELECT CAST(state AS INTEGER) AS state, segment, cohort, period, count(*) AS users, CAST(sum(crc) AS BIGINT) AS users_crc32, CAST(sum(moved) AS BIGINT) AS moved, CAST(sum(cents) AS BIGINT) AS cents FROM p GROUP BY state, segment, cohort, period
"""

ORACLES = {"op4_minhash_near_dedup": NEAR_DUPLICATES, "op7_exact_top_k": TOP_K, "op8_url_filter": URLS, "op9_chat_formatting": CHAT, "op11_line_dedup": LINES, "op12_cohort_retention": RETENTION}
