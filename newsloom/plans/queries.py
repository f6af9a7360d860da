"""One query per operator, over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import buckets, events, graph, linking, providers, select, similar, topics
from ..sources.scratch import Scratch
from . import exchange

#: Queries by name.
_all: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    _all[f.__name__] = f
    return f


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_all) | exchange.queries()


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz")


# ---- filters, ids, defaults ----


@query
def time_range_filter(spark, d):
    e = _t(spark, d, "events").withColumn("ts_text", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
    return select.time_range(e, "ts_text", "2024-01-05 00:00:00", "2024-01-12 12:00:00").select("event_id", "user_id", "event_type")


@query
def earliest_per_group(spark, d):
    e = _t(spark, d, "events").withColumn("ts", _ntz("ts"))
    return select.earliest_per_group(e, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query
def propagation_path(spark, d):
    e = _t(spark, d, "events").withColumn("ts", _ntz("ts"))
    p = select.propagation_path(e, "user_id", "ts", "event_type", "event_id", "event_type")
    return p.select("user_id", "path", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss").alias("start_time"), F.date_format("end_time", "yyyy-MM-dd HH:mm:ss").alias("end_time"), "title", "items_in_group")


@query
def exact_dup_groups(spark, d):
    return similar.exact_duplicate_groups(_t(spark, d, "documents"), "doc_id", "text", Scratch(spark, "exact"))


@query
def near_dup_groups(spark, d):
    return similar.near_duplicate_groups(_t(spark, d, "documents"), "doc_id", "text", Scratch(spark, "near"))


@query
def distinct_rows(spark, d):
    return _t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").dropDuplicates()


@query
def source_rule(spark, d):
    n = _t(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("123456"), "source")).when(F.col("doc_id") % 7 == 0, "nan").otherwise(F.col("source")).alias("media"), F.when(F.col("doc_id") % 2 == 0, "https://news.eastmoney.com/a").otherwise("https://example.org").alias("url"))
    return n.select("doc_id", select.source_of(F.col("media"), F.col("url")).alias("origin"))


@query
def generated_ids(spark, d):
    n = select.numbered(_t(spark, d, "documents").select("doc_id"), ["doc_id"], "n", Scratch(spark, "ids"))
    return n.select("doc_id", F.format_string("118_%d", F.col("n") + 1500).alias("news_id"), t.int_id(F.format_string("118_%d", F.col("n") + 1500)).alias("int_id"))


@query
def field_defaults(spark, d):
    e = _t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, None).otherwise(F.col("event_type")).alias("trigger"), F.when(F.col("event_id") % 4 == 0, "YYYY-MM-DD").when(F.col("event_id") % 4 == 1, "").otherwise("2024-02-01").alias("event_time"), F.date_format("ts", "yyyy-MM-dd").alias("news_time"))
    return select.with_defaults(e).select("event_id", "trigger", select.event_time(F.col("event_time"), F.col("news_time")).alias("event_time"))


@query
def noise_flag(spark, d):
    n = _t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("size"), F.min("doc_id").alias("m"))
    n = n.withColumn("words", F.when(F.col("m") % 3 == 0, "收盘 ETF").when(F.col("m") % 3 == 1, "指数").otherwise("新品"))
    hits = select.noise_hits(F.col("words"), F.col("source"))
    return n.select("source", "size", hits.cast("long").alias("hits"), select.is_noise(hits, F.col("size")).alias("noise"))


@query
def parsed_numbers(spark, d):
    p = _t(spark, d, "part").select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey").cast("string")).otherwise(F.col("p_name")).alias("raw"))
    return p.select("p_partkey", t.safe_int("raw").alias("number"), t.zero_pad("p_partkey").alias("code"), t.is_stock_code(t.zero_pad("p_partkey")).alias("is_code"))


@query
def forbidden_words(spark, d):
    n = _t(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "业绩大涨").otherwise("业绩公告").alias("summary"), "toxic")
    return n.select("doc_id", t.has_forbidden_word("summary").alias("forbidden"), t.bad_value(F.col("toxic").cast("string"), ("0",)).alias("outside"))


# ---- text ----


@query
def text_normalize(spark, d):
    n = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("　 （"), F.col("text"), F.lit("）【 】 ")).alias("text"))
    return n.select("doc_id", F.md5(t.collapse_space("text")).alias("collapsed"), F.md5(t.normalize_surface("text")).alias("surface"), F.md5(t.match_form("text")).alias("matched"), F.length(t.safe_str("text")).cast("long").alias("n"))


@query
def company_normalize(spark, d):
    s = _t(spark, d, "supplier").select("s_suppkey", F.concat("s_name", F.element_at(F.array(*map(F.lit, ("股份有限公司", "集团股份有限公司", "（中国）有限公司", "集团", "控股"))), (F.col("s_suppkey") % 5 + 1).cast("int"))).alias("full_name"))
    return s.select("s_suppkey", t.normalize_company("full_name").alias("norm"))


@query
def set_cell_parse(spark, d):
    n = _t(spark, d, "documents").groupBy("source").agg(F.array_sort(F.collect_set("lang")).alias("langs"), F.min("doc_id").alias("m"))
    cell = F.when(F.col("m") % 3 == 0, F.to_json("langs")).when(F.col("m") % 3 == 1, F.array_join("langs", "；")).otherwise(F.array_join("langs", " 、 "))
    return n.select("source", F.array_join(t.parse_set_cell(cell), "+").alias("items"), F.array_join(t.keyword_list(F.concat(F.array_join("langs", " | "), F.lit(" | en | ")), 3), "+").alias("keywords"))


@query
def occurrence_count(spark, d):
    return _t(spark, d, "documents").select("doc_id", t.occurrences("text", F.lit("an")).cast("long").alias("n_an"), t.occurrences("text", F.lit("")).cast("long").alias("n_empty"))


@query
def json_answers(spark, d):
    e = _t(spark, d, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("Here: ```json\n"), "props", F.lit("\n``` done"))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("answer "), "props", F.lit(" ok"))).otherwise(F.col("props"))
    reply = F.to_json(F.struct(raw.alias("answer")))
    return e.select("event_id", F.get_json_object(t.repair_json(t.answer_text(reply)), "$.k").cast("long").alias("k"))


@query
def time_buckets(spark, d):
    e = _t(spark, d, "events")
    return e.select("event_id", t.week_bucket(_ntz("ts")).alias("week"), t.month_bucket(_ntz("ts")).alias("month"))


@query
def hash_keys(spark, d):
    n = _t(spark, d, "documents")
    return n.select("doc_id", buckets.cluster_id(F.col("doc_id"), F.length("lang")).alias("cluster_id"), t.cache_key("1", lang=F.col("lang"), source=F.col("source")).alias("cache_key"))


@query
def labels_text(spark, d):
    e = _t(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    words = F.array(F.struct(F.format_string("w%d", "label").alias("word"), (F.col("n") / 8).alias("weight")))
    return e.select("label", t.weighted_keywords(words).alias("weighted"), t.keyword_label((F.col("label") - 1).cast("int"), F.array(F.format_string("w%d", "label"), F.lit("x"))).alias("named"))


@query
def embed_texts(spark, d):
    p = _t(spark, d, "part")
    one = lambda c, n, s=None: F.array(F.struct(F.lit(None).cast("string").alias("stockCode") if s is None else s.alias("stockCode"), c.alias("code"), n.alias("name")))
    parts = F.struct(one(F.lit("no code of a company"), F.col("p_brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_partkey").cast("string"))).alias("companies"), one(F.lit(None).cast("string"), F.col("p_type")).alias("industries"), one(F.when(F.col("p_size") % 3 == 0, F.lit("k")), F.lit("")).alias("concepts"))
    p = p.withColumn("participants", parts)
    return p.select("p_partkey", t.embed_text(F.col("p_brand"), F.lit(""), F.col("p_type"), F.when(F.col("p_size") > 25, "+"), t.participant_tokens("participants")).alias("embed_text"), t.anchor("participants").alias("anchor"))


@query
def person_rule(spark, d):
    n = _t(spark, d, "documents").join(_t(spark, d, "labels"), "doc_id").select("doc_id", F.concat(F.col("text"), F.when(F.col("quality") == 1, F.lit(" 公司董事长，王小明总经理表示 ")).otherwise(F.lit(" 李雷CEO称 "))).alias("text"))
    return n.select("doc_id", F.to_json(F.transform(t.persons_by_title("text"), lambda p: F.struct(p["name"].alias("name"), p["title"].alias("title")))).alias("persons"))


@query
def prompts(spark, d):
    n = _t(spark, d, "documents")
    return n.select("doc_id", F.md5(t.extraction_prompt(F.col("source"), F.col("text"))).alias("extract_md5"), F.md5(t.naming_prompt(F.col("lang"), F.array("lang", "source"))).alias("naming_md5"), F.md5(t.surface_prompt(F.col("text"))).alias("surface_md5"))


# ---- nested events ----


def _news(spark, d):
    c = _t(spark, d, "conversations").withColumn("s", F.when(F.col("turn") % 3 == 2, F.lit(select.PLACEHOLDER)).when(F.col("turn") % 5 == 4, F.lit("  ")).otherwise(F.concat(F.lit(" "), "role", F.lit(" "))))
    return c.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "s", "text"))), lambda x: F.struct(x["s"].alias("event_summary"), x["text"].alias("text"))).alias("events")).select(F.col("conv_id").alias("item_no"), F.col("conv_id").alias("NewsID"), "events")


@query
def flatten_pairs(spark, d):
    return events.flatten_pairs(_news(spark, d)).select("NewsID", F.col("pos").cast("long").alias("pos"), "event_summary")


@query
def event_assembly(spark, d):
    s = _t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct(F.col("n_name").alias("surface"), F.col("n_nationkey").cast("string").alias("code")))).alias("items"))
    none = F.expr("cast(array() as array<struct<surface:string,code:string>>)")
    ents = events.merge_entities(F.slice("items", 1, 3), none, F.slice("items", 4, 1))
    name = lambda i: F.get(F.col("items"), F.lit(i))["surface"]
    blank = F.lit(None).cast("string")
    ev = lambda subjects, when, what: F.struct(subjects.alias("subjects"), when.alias("event_time"), F.lit("发布").alias("trigger"), what.alias("event_summary"), blank.alias("sentiment"))
    news = s.select(F.col("n_regionkey").cast("string").alias("NewsID"), F.lit("2024-01-01").alias("news_time"), ents.alias("entities"), F.array(ev(F.array(name(0), F.lit("nobody")), F.lit("YYYY"), F.lit("a")), ev(F.array(F.lit("someone")), F.lit("2024-02-02"), F.lit("b"))).alias("event_analyses"))
    return events.assemble(news).select("NewsID", "event_ID", "surface", "etype", "stockCode", "event_time", "trigger", "event_summary", "sentiment")


@query
def fallback_events(spark, d):
    none = F.lit(None).cast("string")
    entity = F.struct(F.lit("company").alias("etype"), F.col("l_returnflag").alias("surface"), F.col("l_suppkey").cast("string").alias("stockCode"), none.alias("conceptCode"), none.alias("industryCode"))
    l = _t(spark, d, "lineitem")
    news = l.groupBy(F.col("l_orderkey").alias("NewsID")).agg(topics.ordered(entity, "l_linenumber", "l_suppkey").alias("entities")).withColumn("news_time", F.lit("2024-01-01"))
    used = l.where("l_linestatus = 'O'").select(F.col("l_orderkey").alias("NewsID"), F.col("l_returnflag").alias("surface"))
    return events.fallback_events(news, used).select("NewsID", F.col("event_pos").cast("long").alias("event_pos"), "surface", "etype", "stockCode", "event_time", "trigger", "event_summary")


@query
def nested_news(spark, d):
    l = _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("NewsID"), F.col("l_linenumber").alias("n"), F.col("l_returnflag").alias("surface"))
    return events.nest(l, "surface").select("NewsID", events.target_subject(F.col("events")).alias("target_subject"), F.size("events").cast("long").alias("n_events"))


@query
def top_level(spark, d):
    field = lambda c, k: F.when(F.col("event_id") % k != 0, F.col(c)).alias
    e = _t(spark, d, "events").select(F.col("user_id").alias("NewsID"), F.col("event_id").alias("n"), field("event_type", 3)("scope"), field("event_type", 2)("depth"), F.lit(None).cast("string").alias("novelty"))
    nested = events.nest(e, "scope", "depth", "novelty")
    return nested.select("NewsID", *(c.alias(k) for k, c in events.top_level(F.col("events")).items()))


@query
def explode_ids(spark, d):
    a = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.concat(F.array_join(topics.ordered(F.col("l_partkey").cast("string"), "l_linenumber"), " , "), F.lit(", nan,")).alias("ids"))
    return events.explode_ids(a, "ids", "news_id", skip_nan=True).select("l_orderkey", F.col("pos").cast("long").alias("pos"), "news_id")


@query
def distinct_pairs(spark, d):
    c = _t(spark, d, "conversations")
    return select.distinct_pairs(c, "conv_id", "role", [F.col("turn")]).select("conv_id", "role", "turn")


# ---- linking ----


@query
def alias_link_unique(spark, d):
    p = _t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("code"), "p_name", F.concat_ws(" ", "p_brand", F.col("p_size").cast("string")).alias("short"))
    index = linking.alias_index(p, "code", "p_name", "short")
    m = _t(spark, d, "part").select("p_partkey", F.concat_ws("  ", "p_brand", F.col("p_size").cast("string")).alias("surface"))
    return linking.link_unique(m, "surface", index).select("p_partkey", "code")


@query
def link_last_row(spark, d):
    index = linking.name_index(_t(spark, d, "part"), "p_brand", "p_partkey", "p_partkey")
    m = _t(spark, d, "part").select("p_partkey", "p_brand")
    return linking.link_last(m, "p_brand", index).select("p_partkey", F.col("code").alias("last_partkey"))


@query
def code_to_industry(spark, d):
    s = _t(spark, d, "supplier").select("s_suppkey", t.zero_pad("s_nationkey").alias("code"))
    n = _t(spark, d, "nation").select(t.zero_pad("n_nationkey").alias("code"), F.col("n_name").alias("industry"))
    return s.join(linking.small(n), "code", "left").select("s_suppkey", "industry")


@query
def industry_normalize(spark, d):
    std = _t(spark, d, "nation").select("n_name")
    s = _t(spark, d, "nation").select(F.explode(F.array("n_name", F.concat("n_name", F.lit("行业")), F.concat(F.lit("大"), "n_name", F.lit("概念")), F.substring("n_name", 2, 4), F.lit("板块"), F.lit("zz"))).alias("surface"))
    return linking.normalize_industry(s, "surface", std, "n_name")


@query
def dictionary_match(spark, d):
    n = _t(spark, d, "nation").select(F.lower(F.substring("n_name", 1, 3)).alias("name"), "n_nationkey")
    h = linking.dictionary_hits(_t(spark, d, "documents"), "doc_id", "text", n.groupBy("name").agg(F.min("n_nationkey").alias("n_nationkey")), "name", "n_nationkey")
    return h.select("doc_id", F.array_join("hits", ",").alias("hits"))


@query
def fuzzy_link(spark, d):
    c = _t(spark, d, "supplier").select(F.concat("s_name", F.lit("股份有限公司")).alias("full_name"))
    m = _t(spark, d, "supplier").select(F.concat(F.lit("x"), "s_name").alias("surface"), F.col("s_suppkey").alias("ord"))
    return linking.link_names(m, "surface", "ord", c, "full_name").select("surface", "full_name", F.round("score", 6).alias("score"))


@query
def full_name_match(spark, d):
    """Two-letter beginnings of words as names, so that texts contain more than are kept."""
    words = _t(spark, d, "documents").select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("[a-z]{3,}"), F.lit(0)))).alias("w")).select(F.left("w", F.lit(3)).alias("name")).distinct()
    h = linking.dictionary_hits(_t(spark, d, "documents"), "doc_id", "text", words.withColumn("ord", F.col("name")), "name", "ord", most=30)
    return h.select("doc_id", F.array_join("hits", ",").alias("hits"))


# ---- topics ----


def _topic_rows(spark, d):
    return _t(spark, d, "embeddings").select("vec_id", (F.col("label") - 1).alias("topic_id"), "embedding", F.format_string("summary %d", F.col("vec_id") % 7).alias("summary"))


@query
def topic_aggregate(spark, d):
    a = topics.aggregate(_topic_rows(spark, d), "topic_id", "vec_id", "summary", "vec_id")
    return a.select("topic_id", "topic_size", topics.ids_text().alias("ids"), F.md5(topics.summaries_text()).alias("summaries_md5"))


@query
def topics_by_size(spark, d):
    a = topics.aggregate(_topic_rows(spark, d), "topic_id", "vec_id", "summary", "vec_id")
    return topics.by_size(a, Scratch(spark, "sizes")).select("topic_id", "topic_size", "place")


@query
def topic_centroid_pick(spark, d):
    return topics.nearest_to_centroid(_topic_rows(spark, d), "topic_id", "embedding", "vec_id").select("topic_id", "vec_id", F.round("cosine", 6).alias("cosine"))


@query
def unit_vectors(spark, d):
    e = _t(spark, d, "embeddings").select("vec_id", topics.unit(F.transform("embedding", lambda x: x.cast("double") * 3)).alias("u"))
    return e.select("vec_id", F.round(topics.dot(F.col("u"), F.col("u")), 6).alias("norm2"), F.round(F.get("u", F.lit(0)), 6).alias("u0"))


@query
def topic_keywords(spark, d):
    toks = topics.tokens(_t(spark, d, "documents"), "text", spark.createDataFrame([("the",), ("de",)], "word string"), "source")
    return topics.keywords(toks, "source").select("source", F.col("rank").cast("long").alias("rank"), "word", F.round("weight", 9).alias("weight"))


@query
def keyword_hit_pick(spark, d):
    n = _t(spark, d, "documents")
    words = n.select("source").distinct().withColumn("keywords", F.array(F.struct(F.lit("The").alias("word"), F.lit(0.5).alias("weight")), F.struct(F.lit("d e").alias("word"), F.lit(0.25).alias("weight")), F.struct(F.col("source").alias("word"), F.lit(0.125).alias("weight"))))
    return topics.keyword_pick(n, "source", "text", "doc_id", words).select("source", F.md5("key_event").alias("key_md5"), F.round("score", 6).alias("score"))


@query
def topic_info(spark, d):
    r = _topic_rows(spark, d)
    w = r.select("topic_id").distinct().withColumn("words", F.array(F.format_string("w%d", "topic_id"), F.lit("x")))
    return topics.topic_info(r, "topic_id", w, "summary", "vec_id").select("topic_id", "count", "name", F.array_join("docs", "|").alias("docs"))


@query
def report_topics(spark, d):
    n = _t(spark, d, "documents")
    tp = n.groupBy(F.col("source").alias("topic")).agg(F.count("*").cast("string").alias("count")).select("topic", F.when(F.col("topic") == "src3", "NaN").otherwise(F.col("topic")).alias("name"), "count", F.concat("topic", F.lit(" | x | x | y")).alias("keywords"))
    m = n.select(F.col("source").alias("topic"), F.col("doc_id").alias("pos"), F.col("doc_id").cast("string").alias("news_id"))
    s = _t(spark, d, "labels").select(F.col("doc_id").cast("string").alias("news_id"), F.col("doc_id").alias("row_no"), F.format_string("q%dt%d", "quality", "toxic").alias("summary"))
    r = topics.report_topics(tp, m, s)
    return r.select("topic", "name", "count", F.array_join("keywords", ",").alias("keywords"), F.array_join("original_texts", ",").alias("texts"), F.array_join("news_ids", ",").alias("news_ids"))


@query
def density_topics(spark, d):
    return topics.density_topics(_t(spark, d, "embeddings"), "vec_id", "embedding", Scratch(spark, "density"))


@query
def anchor_buckets(spark, d):
    e = _t(spark, d, "events").withColumn("date", F.date_format("ts", "yyyy-MM-dd")).withColumn("high_level_type", F.when(F.col("event_type") == "click", None).otherwise(F.col("event_type")))
    one = lambda c: F.array(F.struct(c.alias("stockCode"), F.lit(None).cast("string").alias("code"), F.lit("").alias("name")))
    e = e.withColumn("participants", F.struct(one(F.when(F.col("user_id") % 2 == 0, (F.col("user_id") % 10).cast("string"))).alias("companies"), one(F.when(F.col("user_id") % 3 == 0, "k")).alias("concepts"), one(F.lit(None).cast("string")).alias("industries")))
    b = buckets.big_enough(buckets.bucketed(e, F.col("date")), "high_type", "time_bucket", "anchor")
    return b.groupBy("high_type", "time_bucket", "anchor").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query
def cluster_summary(spark, d):
    e = _t(spark, d, "events").select(F.col("event_id").alias("row_no"), F.format_string("118_%d", "event_id").alias("NewsID"), F.date_format("ts", "yyyy-MM-dd").alias("date"), (F.col("user_id") % 50).alias("cluster"), F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("trigger_norm"), F.col("event_type").alias("high_level_type"), F.lit(None).cast("string").alias("core_action_norm"), F.when(F.col("event_id") % 2 == 0, F.format_string("e%d", "event_id")).alias("eid"))
    s = buckets.summarize(buckets.with_cluster_id(e, "cluster", "row_no", "eid"))
    return s.select("cluster_id", "size", "first_date", "last_date", F.array_join("news_ids", ",").alias("news_ids"), "trigger_norm", "high_level_type", "core_action_norm")


@query
def bucket_components(spark, d):
    e = _t(spark, d, "events").select("event_id", "event_type", F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("user_id") % 7 - 1).alias("label"))
    return buckets.components(e, "event_type", "label", "event_id").select("event_id", "component")


@query
def run_statistics(spark, d):
    e = _t(spark, d, "events").withColumn("label", F.when(F.col("user_id") % 5 == 0, -1).otherwise(F.col("user_id") % 7)).withColumn("day", F.date_format("ts", "yyyy-MM-dd-HH"))
    e = buckets.components(e.withColumn("bucket", F.concat_ws("|", "event_type", "day")), "bucket", "label", "event_id")
    return buckets.statistics(e, "event_type", "day")


# ---- graph ----


def _contexts(spark, d):
    l = _t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return graph.contexts(l, "l_orderkey", "p_brand")


@query
def npmi_edges(spark, d):
    return graph.strong(graph.npmi(_contexts(spark, d)), 2, -1.0).select("a", "b", "cooc", F.round("npmi", 6).alias("npmi"))


@query
def edge_evidence(spark, d):
    c = _contexts(spark, d)
    news = _t(spark, d, "orders").select(F.col("o_orderkey").alias("context"), F.col("o_custkey").alias("news_id"))
    titles = _t(spark, d, "customer").select(F.col("c_custkey").alias("news_id"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("title"))
    return graph.evidence(c, news, titles)


@query
def communities(spark, d):
    return graph.communities(graph.strong(graph.npmi(_contexts(spark, d)), 2, -1.0).withColumn("w", F.col("npmi") + 1), "w").select("item", "community", "community_size")


@query
def most_frequent_name(spark, d):
    return graph.most_frequent(_t(spark, d, "events"), "user_id", "event_type", "event_id")


@query
def belongs_to(spark, d):
    s, n = _t(spark, d, "supplier"), _t(spark, d, "nation").where("n_regionkey <> 2")
    e = s.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    return graph.relate(e, s, "s_suppkey", n, "n_nationkey")


@query
def mentioned_in(spark, d):
    e = _t(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = _t(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    s = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return graph.relate(e, o, "l_orderkey", s, "l_suppkey")


@query
def duplicate_keys(spark, d):
    return graph.duplicates(_t(spark, d, "lineitem"), "l_orderkey", "l_linenumber").unionByName(graph.duplicates(_t(spark, d, "lineitem"), "l_orderkey", "l_suppkey").withColumnRenamed("l_suppkey", "l_linenumber").select("l_orderkey", "l_linenumber", "n"))


@query
def upsert_nodes(spark, d):
    old = _t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))
    new = _t(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("ord"))
    return graph.upsert(old, new, "id", "ord").select("id", "title")


@query
def news_industries(spark, d):
    l = _t(spark, d, "lineitem")
    mapped = l.join(_t(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_orderkey").alias("news_id"), F.col("s_nationkey").cast("string").alias("industry"))
    explicit = l.select(F.col("l_orderkey").alias("news_id"), F.col("l_returnflag").alias("industry"))
    return graph.news_industries(mapped, explicit)


@query
def entity_types(spark, d):
    n = _t(spark, d, "documents").select("doc_id", F.element_at(F.array(*map(F.lit, ("company", "industry", "concept"))), (F.col("doc_id") % 3 + 1).cast("int")).alias("etype"))
    return graph.entity_rows(n)


@query
def typed_contexts(spark, d):
    l = _t(spark, d, "lineitem")
    micro = l.select((F.col("l_orderkey") % 40).alias("topic_id"), F.col("l_suppkey").alias("item"))
    macro = l.select((F.col("l_orderkey") % 8).alias("topic_id"), F.col("l_suppkey").alias("item"))
    every = graph.typed_contexts(micro=micro, macro=macro)
    return graph.contexts(every, "context", "item")


def _edges(spark, d):
    return graph.strong(graph.npmi(_contexts(spark, d)), 2, -1.0)


@query
def strong_edges(spark, d):
    return graph.strong(graph.npmi(_contexts(spark, d))).select("a", "b", "cooc")


@query
def sorted_edges(spark, d):
    return graph.sorted_edges(_edges(spark, d), Scratch(spark, "edges")).select("a", "b", "cooc", "place")


@query
def co_occur_edges(spark, d):
    c = _contexts(spark, d)
    news = _t(spark, d, "orders").select(F.col("o_orderkey").alias("context"), F.col("o_custkey").alias("news_id"))
    titles = _t(spark, d, "customer").select(F.col("c_custkey").alias("news_id"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("title"))
    e = graph.co_occur(_edges(spark, d), graph.evidence(c, news, titles))
    return e.select("a", "b", "cooc", F.round("npmi", 6).alias("npmi"), "n_news", "news_ids", "titles")


@query
def community_nodes(spark, d):
    """Three cliques of nations, one a region, and regions of their own without an edge."""
    n = _t(spark, d, "nation")
    e = n.alias("x").join(n.alias("y"), F.col("x.n_regionkey") == F.col("y.n_regionkey")).where("x.n_name < y.n_name and x.n_regionkey < 3").select(F.col("x.n_name").alias("a"), F.col("y.n_name").alias("b"), F.lit(1.0).alias("npmi"))
    return graph.write_communities(n.select("n_name", "n_regionkey"), "n_name", graph.communities(e)).select("n_name", "n_regionkey", F.col("community").isNotNull().alias("has"), "community_size")


# ---- providers ----


@query
def hash_embeddings(spark, d):
    n = providers.embed(_t(spark, d, "documents").select("doc_id", F.col("text").alias("event_summary")), "event_summary", providers.HashEmbedder())
    return n.select("doc_id", "embedding_model", "embedding_dim", F.round(topics.dot(F.col("embedding"), F.col("embedding")), 4).alias("norm2"))


@query
def topic_names(spark, d):
    a = topics.aggregate(_topic_rows(spark, d), "topic_id", "vec_id", "summary", "vec_id", outliers=True).select("topic_id", F.format_string("k%d", "topic_id").alias("keywords"), F.array_distinct("summaries").alias("summaries"))
    cache = spark.createDataFrame([], "key string, name string, confidence double, why string")
    named, _ = providers.name_topics(a, providers.StubChat(), cache, Scratch(spark, "names"))
    return named.select("topic_id", "main_event_name", "main_event_confidence", "main_event_why")
