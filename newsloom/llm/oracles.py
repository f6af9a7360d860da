"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

#: Words of the decontamination contract: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII characters.
_OP2 = r"""
WITH dw AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM (SELECT row_number() OVER () AS rid, doc_id, "text" FROM documents)),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ') FOR i IN range(1, len(w) - least(10, len(w)) + 2)]) AS g
  FROM bw WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM win),
dwin AS (
  SELECT rid, size, unnest(range(1, len(w) - size + 2)) AS p, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS g
  FROM dw, sizes WHERE len(w) >= size),
hits AS (SELECT d.rid, d.p, d.size, item_id FROM dwin d JOIN win b ON d.size = b.size AND d.g = b.g),
words AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS q FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

_OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    translate(concat(to_base(CAST(concat('0x', h[1:10]) AS BIGINT), 32, 8), to_base(CAST(concat('0x', h[11:20]) AS BIGINT), 32, 8),
      to_base(CAST(concat('0x', h[21:30]) AS BIGINT), 32, 8), to_base(CAST(concat('0x', h[31:40]) AS BIGINT), 32, 8)),
      '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
  FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM first_id OR first_id IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

#: Words and shingles of the Jaccard contract.
_OP5 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g FROM w),
e AS (SELECT rid, len(g) AS n, unnest(g) AS s FROM g),
p AS (SELECT x.rid AS a, y.rid AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS c FROM e x JOIN e y ON x.s = y.s AND x.rid <> y.rid GROUP BY ALL),
links AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
reach AS (SELECT rid AS a, rid AS b FROM g UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(d.doc_id) AS component_id FROM reach JOIN g d ON d.rid = b GROUP BY a)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM g JOIN least ON a = rid
"""


def _op6() -> str:
    from .quality import _MENU, KEEP_SHARE, MIN_WORDS, REPEAT_PERCENT, SHORT_LINE, SYMBOL_SHARE

    menu = "|".join(sorted(x.decode() for x in _MENU))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce("text", '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS q FROM twice) GROUP BY rid),
lines AS (SELECT rid, generate_subscripts(string_split(t, chr(10)), 1) AS k, unnest(string_split(t, chr(10))) AS l FROM d),
full_lines AS (SELECT rid, k, l, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT rid, n, row_number() OVER (PARTITION BY rid, l ORDER BY k) > 1 AS dup,
    len(regexp_extract_all(l, '[#*$%&|<>]')) > {SYMBOL_SHARE} * n
    OR (n <= 12 AND (len(regexp_extract_all(l, '[|>»·•]')) >= 2 OR regexp_full_match(low, '[\x20\x09-\x0D]*(?:[.,|]*(?:{menu})[.,|]*(?:[\x20\x09-\x0D]+|$))+')))
    OR (n < {SHORT_LINE} AND NOT regexp_matches(l, '[.!?:;"'')\]…”’»。！？」』）][\x20\x09-\x0D]*$'))
    OR regexp_matches(low, '\b(?:cookies?|javascript|privacy policy|terms of (?:use|service)|all rights reserved|subscribe|newsletter|click here|sign up|lorem ipsum)\b') AS bad
  FROM full_lines),
lost AS (SELECT rid, count(*) FILTER (dup) AS dups, coalesce(sum(n) FILTER (dup OR bad), 0) AS lost FROM judged GROUP BY rid),
f AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AND n_words - lost >= {KEEP_SHARE} * n_words AS kept
FROM f"""


def _op10() -> str:
    from .licenses import ABOUT, CUTS, END, RULES, SENTENCES

    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    cases = " ".join(f"WHEN regexp_full_match(s, {quoted(p)}) THEN {quoted(n)}" for n, p in SENTENCES)
    normal = lambda x: f"trim(regexp_replace({x}, '[^a-z0-9]+', ' ', 'g'))"
    cut = "t"
    for pattern, new in CUTS:
        cut = f"regexp_replace({cut}, {quoted(pattern)}, {quoted(new)}, 'g')"
    parts = [
        f"""cut AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce("text", '')) AS t FROM documents),
pieces AS (SELECT rid, string_split({cut}, {quoted(END)}) AS p FROM cut),
sent AS (SELECT rid, unnest(p) AS raw, generate_subscripts(p, 1) AS k FROM pieces),
whole AS (SELECT rid, k, raw, CASE {cases} ELSE 'Unknown' END AS id FROM (SELECT rid, k, raw, {normal("raw")} AS s FROM sent) WHERE regexp_matches(s, {quoted(ABOUT)})),
lines AS (SELECT rid, k, unnest(string_split(raw, chr(10))) AS line, generate_subscripts(string_split(raw, chr(10)), 1) AS j FROM whole WHERE id = 'Unknown' AND contains(raw, chr(10))),
by_line AS (SELECT * FROM (SELECT rid, k, j, CASE {cases} ELSE 'Unknown' END AS id FROM (SELECT rid, k, j, {normal("line")} AS s FROM lines) WHERE regexp_matches(s, {quoted(ABOUT)})) WHERE id <> 'Unknown'),
ids AS (SELECT rid, k, 0 AS j, id FROM whole WHERE (rid, k) NOT IN (SELECT (rid, k) FROM by_line) UNION ALL SELECT rid, k, j, id FROM by_line),
r0 AS (SELECT rid, ';' || string_agg(id || ';', '' ORDER BY k, j) FILTER (id <> 'Unknown') AS seq, string_agg(id, ',' ORDER BY k, j) FILTER (id <> 'Unknown') AS sentence_ids, count(*) FILTER (id <> 'Unknown') AS n, count(*) FILTER (id = 'Unknown') AS u, CAST([] AS VARCHAR[]) AS found FROM ids GROUP BY rid)"""
    ]
    for i, (name, rule) in enumerate(RULES, 1):
        parts.append(f"r{i} AS (SELECT rid, regexp_replace(seq, {quoted(rule)}, ';', 'g') AS seq, sentence_ids, n, u, CASE WHEN regexp_matches(seq, {quoted(rule)}) AND NOT list_contains(found, {quoted(name)}) THEN list_append(found, {quoted(name)}) ELSE found END AS found FROM r{i - 1})")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, CAST(coalesce(u, 0) AS BIGINT) AS n_unknown, coalesce(sentence_ids, '') AS sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses
FROM cut LEFT JOIN r{len(RULES)} USING (rid)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": _OP2, "op5_jaccard_join": _OP5, "op6_quality_rules": _op6(), "op8_warc": _OP8, "op10_license_scan": _op10()}
