"""Queries that take whole driver tables through a sink and back through a reader, and through the offline providers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as t
from ..operators import buckets, providers
from ..sources import readers, sinks
from ..sources.scratch import Scratch

_all: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str):
    def add(f):
        _all[f.__name__], _sql[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_all)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _path(spark: SparkSession, name: str) -> str:
    return Scratch(spark, "exchange").path(name)


# ---- sources and sinks ----

_TITLED = "concat('银行 \"', s_name, '\", ', s_nationkey)"
_TITLED_SQL = "'银行 \"' || s_name || '\", ' || s_nationkey"


def _suppliers(spark, d):
    return _t(spark, d, "supplier").select(t.zero_pad("s_suppkey").alias("code"), F.expr(_TITLED).alias("title"), F.when(F.col("s_suppkey") % 3 != 0, "s").alias("maybe"))


_CODE = "CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 6 THEN lpad(CAST(s_suppkey AS VARCHAR), 6, '0') ELSE CAST(s_suppkey AS VARCHAR) END"
_SUPPLIERS_SQL = f"SELECT {_CODE} AS code, {_TITLED_SQL} AS title, CASE WHEN s_suppkey % 3 <> 0 THEN 's' ELSE '' END AS maybe FROM supplier"


@query(_SUPPLIERS_SQL)
def csv_any_encoding(spark, d):
    path = _path(spark, "gbk")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # GBK isn't in the short list
    _suppliers(spark, d).write.option("header", True).option("encoding", "GBK").option("quoteAll", True).option("escape", '"').csv(path)
    return readers.csv_any_encoding(spark, path, "code", "title")


@query(_SUPPLIERS_SQL)
def csv_strings(spark, d):
    path = _path(spark, "csv")
    sinks.csv(_suppliers(spark, d), path)
    return readers.csv_strings(spark, path, "code", "title", "maybe")


@query("SELECT s_suppkey, s_acctbal, s_name FROM supplier")
def csv_inferred(spark, d):
    path = _path(spark, "inferred")
    sinks.csv(_t(spark, d, "supplier").select("s_suppkey", "s_acctbal", "s_name"), path)
    return readers.csv_inferred(spark, path).select(F.col("s_suppkey").cast("long"), F.col("s_acctbal").cast("double"), "s_name")


@query("SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS code, row_number() OVER (ORDER BY n_name) - 1 AS place FROM nation")
def bom_dictionary(spark, d):
    """A dictionary in file order, and a file that isn't there."""
    path = _path(spark, "dictionary")
    sinks.csv(_t(spark, d, "nation").orderBy("n_name").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code")).coalesce(1), path, bom=True)
    missing = readers.dictionary(spark, f"{path}-none", "name", "code")
    return readers.dictionary(spark, path, "name", "code").unionByName(missing).select("name", "code", F.col("row_no").alias("place"))


@query(_SUPPLIERS_SQL)
def xlsx_sheet(spark, d):
    path = f"{_path(spark, 'sheet')}.xlsx"
    sinks.excel(_suppliers(spark, d), path)
    return readers.table(spark, path, "code", "title")


_EVENT_SQL = "SELECT CAST(event_id AS VARCHAR) AS NewsID, event_type AS event_summary FROM events"


def _pairs(spark, d):
    return _t(spark, d, "events").select(F.col("event_id").cast("string").alias("NewsID"), F.col("event_type").alias("event_summary"))


def _whole(spark, rows: DataFrame, name: str, envelope: bool) -> str:
    """JSON arrays, one file for each range of the rows' ids."""
    path = _path(spark, name)
    made = rows.select(F.to_json(F.struct("*")).alias("j"), F.pmod(F.xxhash64("NewsID"), F.lit(8)).alias("part")).groupBy("part").agg(F.concat(F.lit('{"data": [' if envelope else "["), F.array_join(F.collect_list("j"), ",\n"), F.lit("]}" if envelope else "]")).alias("value"))
    made.select("value", "part").write.partitionBy("part").text(path)
    return f"{path}/*/"


@query(_EVENT_SQL)
def json_array(spark, d):
    return readers.json_array(spark, _whole(spark, _pairs(spark, d), "array", False), readers.PAIRS)


@query(_EVENT_SQL)
def json_envelope(spark, d):
    return readers.json_envelope(spark, _whole(spark, _pairs(spark, d), "envelope", True), readers.PAIRS)


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS NewsID, 'e' || p_partkey AS canonical_event_id, CASE WHEN p_size % 2 = 0 THEN 'C:' || p_partkey WHEN p_size % 3 = 0 THEN 'K:k' || p_size WHEN p_size % 5 = 0 THEN 'I:i' ELSE '__NONE__' END AS anchor,
  array_to_string(list_sort([x FOR x IN [CASE WHEN p_size % 2 = 0 THEN 'C:' || p_partkey END, 'CNAME:' || p_brand, CASE WHEN p_size % 3 = 0 THEN 'K:k' || p_size ELSE 'KNAME:plain' END, CASE WHEN p_size % 5 = 0 THEN 'I:i' END, 'INAME:' || p_type] IF x IS NOT NULL]), ',') AS tokens FROM part""")
def canonical_anchors(spark, d):
    """From a file with codes as the sources write them, plain strings and broken lines, to anchors and tokens."""
    p = _t(spark, d, "part")
    q = lambda c: F.to_json(F.struct(c.alias("v")))  # noqa: E731  {"v":...}, the quoted value is cut out below
    text = lambda c: F.regexp_extract(q(c), r'^\{"v":(.*)\}$', 1)
    company = F.concat(F.lit('[{"stockCode": '), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey").cast("string")).otherwise("null"), F.lit(', "name": '), text(F.col("p_brand")), F.lit('}, "a company without a code"]'))
    concept = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('[{"code": "k'), F.col("p_size"), F.lit('"}]'))).otherwise(F.lit('["plain"]'))
    industry = F.concat(F.lit("[{"), F.when(F.col("p_size") % 5 == 0, F.lit('"stockCode": "i", ')).otherwise(""), F.lit('"name": '), text(F.col("p_type")), F.lit("}]"))
    line = F.concat(F.lit('{"NewsID": '), F.col("p_partkey"), F.lit(', "canonicals": [{"canonical_event_id": "e'), F.col("p_partkey"), F.lit('", "participants": {"companies": '), company, F.lit(', "concepts": '), concept, F.lit(', "industries": '), industry, F.lit("}}, 7]}\n{broken"))
    path = _path(spark, "canonicals")
    p.select(line.alias("value")).write.text(path)
    c = readers.canonicals(spark, path)
    return c.select("NewsID", "canonical_event_id", t.anchor("participants").alias("anchor"), F.array_join(F.array_sort(t.participant_tokens("participants")), ",").alias("tokens"))


@query("SELECT DISTINCT source AS word FROM documents")
def stop_words(spark, d):
    path = _path(spark, "words")
    _t(spark, d, "documents").select(F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("# "), "source")).when(F.col("doc_id") % 5 == 1, "").otherwise(F.concat(F.lit("　"), "source", F.lit(" "))).alias("value")).unionByName(_t(spark, d, "documents").select(F.col("source").alias("value"))).write.text(path)
    return readers.stop_words(spark, path)


@query("SELECT 'chat_url' AS name, 'https://example.org/chat' AS value UNION ALL SELECT 'chat_key', 'k' UNION ALL SELECT 'chat', 'HttpChat' UNION ALL SELECT 'offline', 'StubChat'")
def settings(spark, d):
    told = readers.settings({"NEWSLOOM_CHAT_URL": "https://example.org/chat", "NEWSLOOM_CHAT_KEY": "k"})
    rows = [(k, v) for k, v in told.items() if v] + [("chat", type(providers.from_settings(told)).__name__), ("offline", type(providers.from_settings(readers.settings({}))).__name__)]
    return spark.createDataFrame(rows, "name string, value string")


@query("SELECT event_id AS news_id, event_type AS title, CAST(user_id AS VARCHAR) AS media FROM events")
def rename_map(spark, d):
    raw = _t(spark, d, "events").select(F.col("event_id").alias("F4000"), F.col("event_type").alias("F4001"), F.col("user_id").cast("string").alias("F4024"))
    return readers.raw_news(raw)


@query("SELECT source, string_agg(DISTINCT lang, ', ' ORDER BY lang) AS langs FROM documents GROUP BY source")
def csv_bom_sink(spark, d):
    path = _path(spark, "bom")
    sinks.csv(_t(spark, d, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs")), path, bom=True, only_if_rows=True)
    return readers.csv_strings(spark, path, "source", "langs")


@query("SELECT event_id, user_id, event_type, CASE WHEN event_id % 2 = 0 THEN event_type END AS maybe FROM events")
def json_lines_sink(spark, d):
    path = f"{_path(spark, 'lines')}.jsonl"
    sinks.json_lines(_t(spark, d, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("maybe")), path)
    return readers.table(spark, path, "event_id", "maybe").select("event_id", "user_id", "event_type", "maybe")


@query("SELECT vec_id, round(CAST(list_sum([CAST(x AS DOUBLE) FOR x IN embedding]) AS DOUBLE), 4) AS total, len(embedding) AS dim FROM embeddings")
def vector_sink(spark, d):
    path = _path(spark, "vectors")
    sinks.parquet(_t(spark, d, "embeddings").select("vec_id", "embedding"), path)
    v = readers.table(spark, path, "embedding")
    return v.select("vec_id", F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 4).alias("total"), F.size("embedding").cast("long").alias("dim"))


@query("SELECT 'event_agg' AS sheet, label AS topic, count(*) AS n FROM embeddings GROUP BY label UNION ALL SELECT 'topic_info', label, min(vec_id) FROM embeddings GROUP BY label")
def sheets_sink(spark, d):
    path = _path(spark, "sheets")
    e = _t(spark, d, "embeddings").groupBy(F.col("label").alias("topic"))
    sinks.sheets(path, event_agg=e.agg(F.count("*").alias("n")), topic_info=e.agg(F.min("vec_id").alias("n")))
    read = lambda name: readers.table(spark, f"{path}/{name}", "topic", "n").select(F.lit(name).alias("sheet"), "topic", "n")
    return read("event_agg").unionByName(read("topic_info"))


@query("SELECT n_nationkey AS id, n_name AS name, r_name AS part_of, (SELECT count(*) FROM nation) AS sent FROM nation JOIN region ON n_regionkey = r_regionkey")
def graph_sink(spark, d):
    """Nodes and edges written twice and read again; the batches that a connector got are counted."""
    path = _path(spark, "graph")
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    for _ in range(2):
        sinks.graph(path, {"nation": n, "region": r}, {"in_region": n.select("n_nationkey", "n_regionkey")})
    got = spark.sparkContext.accumulator(0)
    sinks.in_batches(n, lambda rows: got.add(len(rows)))
    e = spark.read.parquet(f"{path}/edges/in_region").join(spark.read.parquet(f"{path}/nodes/nation").select("n_nationkey", "n_name"), "n_nationkey").join(spark.read.parquet(f"{path}/nodes/region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return e.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("r_name").alias("part_of"), F.lit(got.value).cast("long").alias("sent"))


@query("SELECT 'empty' AS name, false AS written, false AS found UNION ALL SELECT 'full', true, true")
def no_empty_output(spark, d):
    e = _t(spark, d, "events")
    rows = []
    for name, df in (("empty", e.where("event_id < 0")), ("full", e)):
        path = _path(spark, name)
        rows.append((name, sinks.csv(df, path, only_if_rows=True), readers.exists(spark, path)))
    return spark.createDataFrame(rows, "name string, written boolean, found boolean")


# ---- providers ----


@query("SELECT doc_id, lang, 'hash-16' AS embedding_model, CAST(16 AS INT) AS embedding_dim, length(source) AS n FROM documents")
def embed_batches(spark, d):
    n = _t(spark, d, "documents").select("doc_id", "lang", "source")
    e = providers.embed(n, "source", providers.HashEmbedder(16), batch=10)
    return e.select("doc_id", "lang", "embedding_model", "embedding_dim", (F.length("source") + F.size("embedding") - 16).cast("long").alias("n"))


_NAMED_SQL = """
SELECT label AS topic_id, CASE label % 3 WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE '' END AS main_event_name, CASE WHEN label % 3 < 2 THEN CAST(0.5 AS DOUBLE) END AS main_event_confidence FROM (SELECT DISTINCT label FROM embeddings)"""


def _script(failures: int = 0) -> providers.ScriptedChat:
    answer = lambda name: json.dumps({"answer": '```json\n{"name": "' + name + '", "confidence": 0.5, "why": "w"}\n```'})
    return providers.ScriptedChat({"topic0": answer("zero"), "topic1": answer("one"), "topic2": "no JSON at all"}, failures=failures)


def _topics(spark, d):
    return _t(spark, d, "embeddings").select(F.col("label").alias("topic_id")).distinct().select("topic_id", F.format_string("topic%d", F.col("topic_id") % 3).alias("keywords"), F.array(F.format_string("s%d", "topic_id")).alias("summaries"))


@query("SELECT label AS topic_id, CASE label % 3 WHEN 2 THEN 'no JSON at all' ELSE 'found' END AS answer FROM (SELECT DISTINCT label FROM embeddings)")
def chat_answers(spark, d):
    """The first try of every prompt fails, the second one answers."""
    asked = providers.ask(_topics(spark, d).withColumn("prompt", t.naming_prompt(F.col("keywords"), F.col("summaries"))), "prompt", _script(failures=1))
    return asked.select("topic_id", F.when(t.repair_json(t.answer_text("answer"), objects_only=True).isNotNull(), "found").otherwise(F.col("answer")).alias("answer"))


@query(_NAMED_SQL)
def named_in_batches(spark, d):
    """Two runs over one cache: the second one asks only what could not be read."""
    scratch = Scratch(spark, "batches")
    cache = scratch.path("cache")
    for _ in range(2):
        named = providers.name_in_batches(_topics(spark, d), _script(), cache, scratch, pause=0)
    return named.select("topic_id", "main_event_name", "main_event_confidence")


@query("""SELECT n_nationkey AS "NewsID", n_name AS surface, '{"events":1}' AS analysis FROM nation WHERE n_regionkey < 2""")
def two_stage_extraction(spark, d):
    """The second question is only put for news that the first one found entities in."""
    n = _t(spark, d, "nation").select(F.col("n_nationkey").alias("NewsID"), F.col("n_name").alias("title"), F.format_string("region%d", "n_regionkey").alias("content"), F.lit("2024-01-01").alias("news_time"))
    found = '{"companies":[{"surface":"it"}]}'
    chat = providers.ScriptedChat({"Describe the events": '{"events":1}', "region0": found, "region1": found})

    def link(first: DataFrame) -> DataFrame:
        named = F.from_json("surfaces", "companies array<struct<surface:string>>")["companies"]
        return first.select("NewsID", F.coalesce(named, F.expr("cast(array() as array<struct<surface:string>>)")).alias("entities"))

    return providers.extract(n, chat, link).select("NewsID", F.col("title").alias("surface"), "analysis")


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'A,B' ELSE '' END AS companies, CASE WHEN n_regionkey = 0 THEN 'P' ELSE '' END AS persons FROM nation")
def surface_entities(spark, d):
    n = _t(spark, d, "nation").select("n_nationkey", F.format_string("region%d", "n_regionkey").alias("body"))
    e = providers.surface_entities(n, "body", providers.ScriptedChat({"region0": 'So: {"companies": ["A", "B"], "persons": ["P"]} as asked'}, default="sorry"))
    return e.select("n_nationkey", F.array_join("companies", ",").alias("companies"), F.array_join("persons", ",").alias("persons"))


@query("""
SELECT n_nationkey, n_name || ':0.9:1,Full:0.95:' || CASE WHEN contains(n_name, 'A') THEN (length(n_name) - length(replace(n_name, 'A', ''))) ELSE 0 END AS companies, '王:0.5,李雷:0.4' AS persons FROM nation""")
def entity_records(spark, d):
    n = _t(spark, d, "nation").withColumn("mapped", F.array(F.struct(F.lit("x").alias("surface"), F.col("n_name").alias("full_name"), F.lit(1.0).alias("score")), F.struct(F.lit("A").alias("surface"), F.lit("Full").alias("full_name"), F.lit(0.95).alias("score"))))
    persons = F.array(F.struct(F.lit("王").alias("name"), F.lit("CEO").alias("title"), F.lit("").alias("evidence")))
    r = n.select("n_nationkey", providers.entity_record(F.col("n_name"), F.array("n_name"), F.col("mapped"), persons, F.array(F.lit("李雷"), F.lit("王"))).alias("r"))
    return r.select("n_nationkey", F.array_join(F.transform("r.companies", lambda c: F.concat_ws(":", c["name"], c["relevance"].cast("string"), c["mentions"].cast("string"))), ",").alias("companies"), F.array_join(F.transform("r.persons", lambda p: F.concat_ws(":", p["name"], p["relevance"].cast("string"))), ",").alias("persons"))


@query("SELECT event_type AS high_type, strftime(ts, '%Y-%m') AS time_bucket, '__NONE__' AS anchor, count(*) AS n FROM events GROUP BY ALL")
def monthly_buckets(spark, d):
    none = F.expr("cast(array() as array<struct<stockCode:string,code:string,name:string>>)")
    e = _t(spark, d, "events").withColumn("high_level_type", F.col("event_type")).withColumn("participants", F.struct(none.alias("companies"), none.alias("concepts"), none.alias("industries")))
    b = buckets.bucketed(e, F.date_format("ts", "yyyy/MM/dd"), monthly=True)
    return b.groupBy("high_type", "time_bucket", "anchor").agg(F.count("*").alias("n"))
