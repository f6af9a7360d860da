"""The same queries in DuckDB SQL."""

from __future__ import annotations

from ..functions.text import COMPANY_SUFFIXES, FORBIDDEN_WORDS
from ..operators.select import DEFAULTS, NOISE, PLACEHOLDER
from . import exchange

#: White space as Spark's (?U)\s has it, for a RE2 class.
_WS = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"


def _no_space(c: str) -> str:
    return f"regexp_replace({c}, '{_WS}+', '', 'g')"


def _company(c: str) -> str:
    cut = _no_space(c)
    cases = " ".join(f"WHEN ends_with({cut}, '{s}') AND length({cut}) > {len(s)} THEN left({cut}, length({cut}) - {len(s)})" for s in COMPANY_SUFFIXES)
    return f"regexp_replace(CASE {cases} ELSE {cut} END, '[（(].*?[）)]', '', 'g')"


_CTX = """ctx AS (SELECT context, item FROM (SELECT DISTINCT l_orderkey AS context, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)
  QUALIFY count(*) OVER (PARTITION BY context) >= 2)"""
_NPMI = """n AS (SELECT count(DISTINCT context) AS n FROM ctx), s AS (SELECT item, count(*) AS c FROM ctx GROUP BY 1),
p AS (SELECT x.item AS a, y.item AS b, count(*) AS cooc FROM ctx x JOIN ctx y ON x.context = y.context AND x.item < y.item GROUP BY ALL),
e AS (SELECT a, b, cooc, ln(cooc * n / (sa.c * sb.c)) / nullif(-ln(cooc / n), 0) AS npmi FROM p JOIN s sa ON a = sa.item JOIN s sb ON b = sb.item, n WHERE cooc < n)"""
_TOPIC = "tr AS (SELECT vec_id, label - 1 AS topic_id, embedding, 'summary ' || (vec_id % 7) AS summary FROM embeddings)"

_SQL = {
    "time_range_filter": "SELECT event_id, user_id, event_type FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 12:00:00'",
    "earliest_per_group": "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) = 1",
    "propagation_path": """
WITH a AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) AS before FROM events),
p AS (SELECT user_id, string_agg(event_type, '——>' ORDER BY ts, event_id) FILTER (before IS NULL OR before <> event_type) AS path, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS end_time, arg_min(event_type, (ts, event_id)) AS title, count(*) AS items_in_group, count(DISTINCT ts) AS times FROM a GROUP BY user_id)
SELECT user_id, path, start_time, end_time, title, items_in_group FROM p WHERE times >= 2""",
    "exact_dup_groups": """
WITH g AS (SELECT "text", min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1), n AS (SELECT "text", row_number() OVER (ORDER BY first) AS group_id FROM g)
SELECT doc_id AS row_no, coalesce(group_id, -1) AS group_id FROM documents LEFT JOIN n USING ("text")""",
    "distinct_rows": "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem",
    "source_rule": """
SELECT doc_id, CASE WHEN doc_id % 5 = 0 AND doc_id % 2 = 0 THEN 'eastmoney' WHEN doc_id % 5 = 0 THEN '123456' || source WHEN doc_id % 7 = 0 THEN '' ELSE source END AS origin FROM documents""",
    "generated_ids": "SELECT doc_id, '118_' || (1500 + n) AS news_id, CAST('118' || (1500 + n) AS BIGINT) AS int_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents)",
    "field_defaults": f"""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{DEFAULTS["trigger"]}' ELSE event_type END AS "trigger", CASE WHEN event_id % 4 IN (0, 1) THEN strftime(ts, '%Y-%m-%d') ELSE '2024-02-01' END AS event_time FROM events""",
    "noise_flag": f"""
WITH g AS (SELECT source, count(*) AS size, min(doc_id) AS m FROM documents GROUP BY 1),
w AS (SELECT *, CASE m % 3 WHEN 0 THEN '收盘 ETF' WHEN 1 THEN '指数' ELSE '新品' END || chr(10) || source AS t FROM g),
h AS (SELECT source, size, len(regexp_extract_all(t, '{"|".join(f"(?:{p})" for p in NOISE)}')) AS hits FROM w)
SELECT source, size, hits, hits >= 2 OR (hits >= 1 AND size >= 80) AS noise FROM h""",
    "parsed_numbers": """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS INT) ELSE 0 END AS number, CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 6 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0') ELSE CAST(p_partkey AS VARCHAR) END AS code, length(CAST(p_partkey AS VARCHAR)) <= 6 AS is_code FROM part""",
    "forbidden_words": f"""SELECT doc_id, regexp_matches(CASE WHEN quality = 1 THEN '业绩大涨' ELSE '业绩公告' END, '{"|".join(FORBIDDEN_WORDS)}') AS forbidden, toxic <> 0 AS outside FROM labels""",
    "text_normalize": f"""
WITH s AS (SELECT doc_id, '　 （' || "text" || '）【 】 ' AS t FROM documents)
SELECT doc_id, md5(trim(regexp_replace(t, '{_WS}+', ' ', 'g'))) AS collapsed, md5(translate({_no_space("t")}, '（）【】', '()[]')) AS surface, md5(lower({_no_space("t")})) AS matched, length({_strip("t")}) AS n FROM s""",
    "company_normalize": f"""
WITH s AS (SELECT s_suppkey, s_name || (['股份有限公司', '集团股份有限公司', '（中国）有限公司', '集团', '控股'])[s_suppkey % 5 + 1] AS f FROM supplier) SELECT s_suppkey, {_company("f")} AS norm FROM s""",
    "set_cell_parse": """
WITH g AS (SELECT source, list_sort(list_distinct(list(lang))) AS langs FROM documents GROUP BY 1)
SELECT source, array_to_string(langs, '+') AS items, array_to_string((list_concat(langs, CASE WHEN list_contains(langs, 'en') THEN [] ELSE ['en'] END))[1:3], '+') AS keywords FROM g""",
    "occurrence_count": """SELECT doc_id, (length("text") - length(replace("text", 'an', ''))) // 2 AS n_an, CAST(0 AS BIGINT) AS n_empty FROM documents""",
    "json_answers": "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "time_buckets": "SELECT event_id, strftime(ts, '%G-W%V') AS week, strftime(ts, '%Y-%m') AS month FROM events",
    "hash_keys": """
SELECT doc_id, substr(sha1(doc_id || '|' || length(lang)), 1, 12) AS cluster_id, md5('{"lang":"' || lang || '","prompt_version":"1","source":"' || source || '"}') AS cache_key FROM documents""",
    "labels_text": """
SELECT label, printf('w%d(%.4f)', label, count(*) / 8.0) AS weighted, CASE WHEN label = 0 THEN 'OUTLIER' ELSE 'w' || label || ' | x' END AS named FROM embeddings GROUP BY label""",
    "embed_texts": """
WITH k AS (SELECT *, list_sort([x FOR x IN [CASE WHEN p_size % 2 = 0 THEN 'C:' || p_partkey END, 'CNAME:' || p_brand, 'INAME:' || p_type, CASE WHEN p_size % 3 = 0 THEN 'K:k' END] IF x IS NOT NULL]) AS toks FROM part)
SELECT p_partkey, array_to_string([x FOR x IN ['TYPE=' || p_brand, 'ACT=' || p_type, CASE WHEN p_size > 25 THEN 'SENT=+' END, 'PARTS=' || array_to_string(toks, ',')] IF x IS NOT NULL], ' | ') AS embed_text,
  CASE WHEN p_size % 2 = 0 THEN 'C:' || p_partkey WHEN p_size % 3 = 0 THEN 'K:k' ELSE '__NONE__' END AS anchor FROM k""",
    "flatten_pairs": f"""
WITH s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, CASE WHEN turn % 3 = 2 THEN '{PLACEHOLDER}' WHEN turn % 5 = 4 THEN '' ELSE role END AS s FROM conversations)
SELECT conv_id AS NewsID, min(pos) AS pos, s AS event_summary FROM s WHERE s <> '' AND s <> '{PLACEHOLDER}' GROUP BY conv_id, s""",
    "event_assembly": f"""
WITH e AS (SELECT n_regionkey, n_name, n_nationkey, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_name, CAST(n_nationkey AS VARCHAR)) - 1 AS k FROM nation),
ent AS (SELECT CAST(n_regionkey AS VARCHAR) AS NewsID, n_name AS surface, CASE WHEN k < 3 THEN 'company' ELSE 'industry' END AS etype, CAST(n_nationkey AS VARCHAR) AS code, k FROM e WHERE k < 4),
rows AS (
  SELECT NewsID, 0 AS phase, 0 AS o, surface, etype, code, '2024-01-01' AS event_time, '发布' AS "trigger", 'a' AS event_summary FROM ent WHERE k = 0
  UNION ALL SELECT DISTINCT NewsID, 0, 1, 'someone', 'unknown', NULL, '2024-02-02', '发布', 'b' FROM ent
  UNION ALL SELECT NewsID, 1, k, surface, etype, code, '2024-01-01', '提及', '{PLACEHOLDER}' FROM ent WHERE k > 0),
n AS (SELECT *, row_number() OVER (PARTITION BY NewsID ORDER BY phase, o) AS n FROM rows)
SELECT NewsID, 'E_auto_' || NewsID || CASE phase WHEN 0 THEN '_' ELSE '_fallback_' END || n AS event_ID, surface, etype, code AS stockCode, event_time, "trigger", event_summary, '{DEFAULTS["sentiment"]}' AS sentiment FROM n""",
    "fallback_events": f"""
WITH e AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_returnflag) - 1 AS event_pos FROM lineitem)
SELECT l_orderkey AS NewsID, event_pos, l_returnflag AS surface, 'company' AS etype, CAST(l_suppkey AS VARCHAR) AS stockCode, '2024-01-01' AS event_time, '{DEFAULTS["trigger"]}' AS "trigger", '{PLACEHOLDER}' AS event_summary
FROM e WHERE NOT EXISTS (SELECT 1 FROM lineitem u WHERE u.l_orderkey = e.l_orderkey AND u.l_returnflag = e.l_returnflag AND u.l_linestatus = 'O')""",
    "nested_news": "SELECT l_orderkey AS NewsID, string_agg(l_returnflag, ', ' ORDER BY l_linenumber, l_returnflag) AS target_subject, count(*) AS n_events FROM lineitem GROUP BY 1",
    "explode_ids": "SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) - 1 AS pos, CAST(l_partkey AS VARCHAR) AS news_id FROM lineitem",
    "distinct_pairs": "SELECT conv_id, role, min(turn) AS turn FROM conversations GROUP BY conv_id, role",
    "alias_link_unique": """
WITH a AS (SELECT DISTINCT p_partkey, x AS alias FROM part, unnest([replace(p_name, ' ', ''), replace(p_brand, ' ', '') || p_size]) AS u(x)),
i AS (SELECT alias, min(p_partkey) AS code FROM a GROUP BY alias HAVING count(DISTINCT p_partkey) = 1)
SELECT p_partkey, CAST(code AS VARCHAR) AS code FROM part JOIN i ON alias = replace(p_brand, ' ', '') || p_size""",
    "link_last_row": "SELECT p_partkey, max(p_partkey) OVER (PARTITION BY p_brand) AS last_partkey FROM part",
    "code_to_industry": "SELECT s_suppkey, n_name AS industry FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey",
    "industry_normalize": """
WITH std AS (SELECT DISTINCT n_name AS std FROM nation),
s AS (SELECT DISTINCT x AS surface FROM nation, unnest([n_name, n_name || '行业', '大' || n_name || '概念', substr(n_name, 2, 4), '板块', 'zz']) AS u(x)),
c AS (SELECT surface, nullif(regexp_replace(surface, '(行业|板块|概念)$', ''), '') AS cut FROM s),
b AS (SELECT surface, arg_min(std, (abs(length(std) - length(cut)), length(std), std)) AS best FROM c JOIN std ON contains(std, cut) OR contains(cut, std) WHERE length(std) >= 2 GROUP BY surface)
SELECT c.surface, coalesce(e.std, t.std, best) AS industry FROM c LEFT JOIN std e ON e.std = surface LEFT JOIN std t ON t.std = cut LEFT JOIN b ON b.surface = c.surface""",
    "dictionary_match": """
WITH n AS (SELECT lower(substr(n_name, 1, 3)) AS name, min(n_nationkey) AS k FROM nation GROUP BY 1),
h AS (SELECT doc_id, name, k FROM documents JOIN n ON contains("text", name) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) <= 20)
SELECT doc_id, string_agg(name, ',' ORDER BY k) AS hits FROM h GROUP BY doc_id""",
    "topic_aggregate": f"WITH {_TOPIC} SELECT topic_id, count(*) AS topic_size, string_agg(CAST(vec_id AS VARCHAR), ', ' ORDER BY vec_id) AS ids, md5(string_agg(summary, chr(10) ORDER BY vec_id)) AS summaries_md5 FROM tr WHERE topic_id <> -1 GROUP BY topic_id",
    "topic_centroid_pick": f"""
WITH {_TOPIC}, x AS (SELECT topic_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM tr), m AS (SELECT topic_id, i, avg(x) AS x FROM x GROUP BY ALL),
c AS (SELECT topic_id, list(x ORDER BY i) AS c FROM m GROUP BY 1),
d AS (SELECT topic_id, vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), c) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(c, c)) + 1e-12) AS cos FROM tr JOIN c USING (topic_id))
SELECT topic_id, vec_id, round(cos, 6) AS cosine FROM d QUALIFY row_number() OVER (PARTITION BY topic_id ORDER BY round(cos, 9) DESC, vec_id) = 1""",
    "unit_vectors": """
WITH v AS (SELECT vec_id, [CAST(x AS DOUBLE) * 3 FOR x IN embedding] AS v FROM embeddings), n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) + 1e-12 AS n FROM v)
SELECT vec_id, round(list_dot_product(v, v) / (n * n), 6) AS norm2, round(v[1] / n, 6) AS u0 FROM n""",
    "topic_keywords": r"""
WITH k AS (SELECT source, unnest(regexp_extract_all(lower("text"), '[\p{L}\p{N}\p{M}_]{2,}')) AS word FROM documents),
tf AS (SELECT source, word, count(*) AS n FROM k WHERE word NOT IN ('the', 'de') GROUP BY ALL), z AS (SELECT source, sum(n) AS total FROM tf GROUP BY 1), f AS (SELECT word, sum(n) AS f FROM tf GROUP BY 1),
w AS (SELECT source, word, n / total * ln(1 + (SELECT avg(total) FROM z) / f) AS weight FROM tf JOIN z USING (source) JOIN f USING (word)),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(weight, 12) DESC, word) AS rank FROM w)
SELECT source, rank, word, round(weight, 9) AS weight FROM r WHERE rank <= 10""",
    "keyword_hit_pick": f"""
WITH s AS (SELECT doc_id, source, "text", lower({_no_space('"text"')}) AS m FROM documents),
h AS (SELECT *, contains(m, 'the') AS a, contains(m, 'de') AS b, contains(m, source) AS c FROM s),
v AS (SELECT *, (CASE WHEN a THEN 0.5 ELSE 0 END + CASE WHEN b THEN 0.25 ELSE 0 END + CASE WHEN c THEN 0.125 ELSE 0 END) + 0.15 * (CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT)) / 3 AS score FROM h)
SELECT source, md5("text") AS key_md5, round(CAST(score AS DOUBLE), 6) AS score FROM v QUALIFY row_number() OVER (PARTITION BY source ORDER BY round(score, 9) DESC, doc_id) = 1""",
    "topic_info": f"WITH {_TOPIC} SELECT topic_id, count(*) AS count, topic_id || '_w' || topic_id || '_x' AS name, array_to_string(list(summary ORDER BY vec_id)[1:3], '|') AS docs FROM tr GROUP BY topic_id",
    "report_topics": """
WITH m AS (SELECT d.source AS topic, d.doc_id, 'q' || quality || 't' || toxic AS s FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT topic, CAST(count(*) AS INT) AS count, array_to_string(list(s ORDER BY doc_id) FILTER (s IS NOT NULL)[1:25], ',') AS texts, array_to_string(list(CAST(doc_id AS VARCHAR) ORDER BY doc_id)[1:50], ',') AS news_ids FROM m GROUP BY topic)
SELECT topic, topic AS name, count, topic || ',x,y' AS keywords, texts, news_ids FROM g WHERE topic <> 'src3'""",
    "anchor_buckets": """
WITH e AS (SELECT event_id, CASE WHEN event_type = 'click' THEN 'UNKNOWN' ELSE event_type END AS high_type, strftime(ts, '%G-W%V') AS time_bucket,
  CASE WHEN user_id % 2 = 0 THEN 'C:' || (user_id % 10) WHEN user_id % 3 = 0 THEN 'K:k' ELSE '__NONE__' END AS anchor FROM events)
SELECT high_type, time_bucket, anchor, count(*) AS n, min(event_id) AS first_id FROM e GROUP BY ALL HAVING count(*) >= 3""",
    "cluster_summary": """
WITH e AS (SELECT event_id, user_id % 50 AS cluster, strftime(ts, '%Y-%m-%d') AS date, event_type, CASE WHEN event_id % 3 = 0 THEN event_type END AS trig, coalesce(CASE WHEN event_id % 2 = 0 THEN 'e' || event_id END, 'root:' || event_id) AS seed FROM events),
c AS (SELECT cluster, substr(sha1(arg_min(seed, event_id) || '|' || count(*)), 1, 12) AS cluster_id FROM e GROUP BY cluster)
SELECT cluster_id, count(*) AS size, min(date) AS first_date, max(date) AS last_date, array_to_string(list_sort(list(DISTINCT CAST('118' || event_id AS BIGINT))), ',') AS news_ids, arg_min(trig, event_id) FILTER (trig IS NOT NULL) AS trigger_norm, arg_min(event_type, event_id) AS high_level_type, CAST(NULL AS VARCHAR) AS core_action_norm
FROM e JOIN c USING (cluster) GROUP BY cluster_id""",
    "npmi_edges": f"""
WITH {_CTX}, n AS (SELECT count(DISTINCT context) AS n FROM ctx), s AS (SELECT item, count(*) AS c FROM ctx GROUP BY 1),
p AS (SELECT x.item AS a, y.item AS b, count(*) AS cooc FROM ctx x JOIN ctx y ON x.context = y.context AND x.item < y.item GROUP BY ALL)
SELECT a, b, cooc, round(ln(cooc * n / (sa.c * sb.c)) / nullif(-ln(cooc / n), 0), 6) AS npmi FROM p JOIN s sa ON a = sa.item JOIN s sb ON b = sb.item, n WHERE cooc >= 2 AND cooc < n AND ln(cooc * n / (sa.c * sb.c)) / -ln(cooc / n) >= -1""",
    "edge_evidence": f"""
WITH {_CTX}, p AS (SELECT x.context, x.item AS a, y.item AS b FROM ctx x JOIN ctx y ON x.context = y.context AND x.item < y.item),
l AS (SELECT DISTINCT a, b, CAST(o_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS title FROM p JOIN orders ON context = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY id) AS rn FROM l)
SELECT a, b, count(*) AS n_news, string_agg(id, ',' ORDER BY rn) FILTER (rn <= 500) AS news_ids, coalesce(array_to_string((list(title ORDER BY rn) FILTER (rn <= 300 AND title IS NOT NULL))[1:12], ' || '), '') AS titles FROM r GROUP BY a, b""",
    "most_frequent_name": """
WITH n AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY ALL) SELECT user_id, event_type FROM n QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1""",
    "belongs_to": "SELECT DISTINCT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey <> 2",
    "mentioned_in": "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey WHERE o_orderstatus = 'O'",
    "duplicate_keys": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT l_orderkey, l_suppkey, count(*) FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "upsert_nodes": """
WITH f AS (SELECT o_custkey AS id, arg_min(o_orderpriority, o_orderkey) AS title FROM orders GROUP BY 1)
SELECT * FROM f UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT id FROM f)""",
    "news_industries": """
SELECT DISTINCT news_id, industry FROM (SELECT l_orderkey AS news_id, CAST(s_nationkey AS VARCHAR) AS industry FROM lineitem JOIN supplier ON l_suppkey = s_suppkey UNION ALL SELECT l_orderkey, l_returnflag FROM lineitem)""",
    "person_rule": """
SELECT doc_id, CASE WHEN quality = 1 THEN '[{"name":"公司","title":"董事长"},{"name":"王小明","title":"总经理"}]' ELSE '[{"name":"李雷","title":"CEO"}]' END AS persons FROM documents JOIN labels USING (doc_id)""",
    "prompts": """
SELECT doc_id, md5('List the companies, concepts and industries that this news names, as JSON with keys companies, concepts, industries, each a list of {surface}.' || chr(10) || 'Title: ' || source || chr(10) || 'Text: ' || "text") AS extract_md5,
  md5('Name the main event of this group of news, as JSON with name, confidence and why.' || chr(10) || 'Keywords: ' || lang || chr(10) || 'Summaries:' || chr(10) || '- ' || lang || chr(10) || '- ' || source) AS naming_md5,
  md5('List the persons and organisations named in this text, as JSON with keys companies and persons.' || chr(10) || "text") AS surface_md5 FROM documents""",
    "topic_names": f"""
WITH {_TOPIC}, a AS (SELECT topic_id, arg_max(summary, k) AS last FROM (SELECT topic_id, summary, min(vec_id) AS k FROM tr GROUP BY ALL) GROUP BY topic_id)
SELECT topic_id, last AS main_event_name, CAST(0.5 AS DOUBLE) AS main_event_confidence, 'offline' AS main_event_why FROM a""",
    "hash_embeddings": """SELECT doc_id, 'hash-64' AS embedding_model, CAST(64 AS INT) AS embedding_dim, CAST(1 AS DOUBLE) AS norm2 FROM documents WHERE trim("text") <> ''""",
    "density_topics": """
WITH RECURSIVE u AS (SELECT vec_id, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) + 1e-12 AS n, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.8),
r AS (SELECT vec_id AS a, vec_id AS b FROM u UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS comp, count(*) AS n FROM r GROUP BY a)
SELECT a AS vec_id, CASE WHEN n >= 5 THEN comp ELSE -1 END AS topic_id FROM c""",
    "entity_types": "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'company' ELSE 'industry' END AS etype FROM documents WHERE doc_id % 3 < 2",
    "typed_contexts": """
WITH m AS (SELECT 'micro:' || (l_orderkey % 40) AS context, l_suppkey AS item FROM lineitem UNION SELECT 'macro:' || (l_orderkey % 8), l_suppkey FROM lineitem)
SELECT context, item FROM m QUALIFY count(*) OVER (PARTITION BY context) >= 2""",
    "strong_edges": f"""WITH {_CTX}, {_NPMI} SELECT a, b, cooc FROM e WHERE cooc >= 2 AND npmi >= 0.05""",
    "sorted_edges": f"""WITH {_CTX}, {_NPMI} SELECT a, b, cooc, row_number() OVER (ORDER BY round(npmi, 12) DESC, cooc DESC, a, b) AS place FROM e WHERE cooc >= 2 AND npmi >= -1""",
    "community_nodes": """
SELECT n_name, n_regionkey, n_regionkey < 3 AS has, CASE WHEN n_regionkey < 3 THEN count(*) OVER (PARTITION BY n_regionkey) END AS community_size FROM nation""",
    "bucket_components": """
SELECT event_id, CASE WHEN event_id % 11 = 0 OR user_id % 7 = 0 THEN 'row:' || event_id ELSE 'c:' || event_type || ':' || (user_id % 7 - 1) END AS component FROM events""",
    "run_statistics": """
WITH e AS (SELECT event_id, event_type || '|' || strftime(ts, '%Y-%m-%d-%H') AS bucket, user_id FROM events),
b AS (SELECT bucket, count(*) AS n FROM e GROUP BY 1), c AS (SELECT count(DISTINCT CASE WHEN user_id % 5 = 0 THEN 'row:' || event_id ELSE bucket || ':' || (user_id % 7) END) AS n FROM e)
SELECT CAST(sum(b.n) AS BIGINT) AS n_events, count(*) AS n_buckets, count(*) FILTER (b.n >= 3) AS processed_buckets, count(*) FILTER (b.n < 3) AS skipped_small_buckets, CAST(sum(b.n) - any_value(c.n) AS BIGINT) AS total_unions, any_value(c.n) AS n_global_clusters FROM b, c""",
    "full_name_match": """
WITH w AS (SELECT DISTINCT substr(u.w, 1, 3) AS name FROM documents, unnest(regexp_extract_all("text", '[a-z]{3,}')) AS u(w)),
h AS (SELECT doc_id, name FROM documents JOIN w ON contains("text", name) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY name) <= 30)
SELECT doc_id, string_agg(name, ',' ORDER BY name) AS hits FROM h GROUP BY doc_id""",
    "topics_by_size": f"WITH {_TOPIC}, a AS (SELECT topic_id, count(*) AS topic_size FROM tr WHERE topic_id <> -1 GROUP BY 1) SELECT *, row_number() OVER (ORDER BY topic_size DESC, topic_id) AS place FROM a",
    "top_level": f"""
SELECT user_id AS NewsID, CASE WHEN min(event_id) % 3 <> 0 THEN arg_min(event_type, event_id) ELSE '{DEFAULTS["scope"]}' END AS scope, CASE WHEN min(event_id) % 2 <> 0 THEN arg_min(event_type, event_id) ELSE '{DEFAULTS["depth"]}' END AS depth, '{DEFAULTS["novelty"]}' AS novelty FROM events GROUP BY user_id""",
}


_SQL["co_occur_edges"] = f"""SELECT a, b, cooc, npmi, n_news, news_ids, titles FROM ({_SQL["npmi_edges"]}) JOIN ({_SQL["edge_evidence"]}) USING (a, b)"""


def oracle_sql() -> dict[str, str]:
    return dict(_SQL) | exchange.oracle_sql()
