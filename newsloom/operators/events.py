"""Nested news: events out of model answers, fallbacks, flattening and nesting again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .select import DEFAULTS, PLACEHOLDER, event_time


def merge_entities(companies: Column, concepts: Column, industries: Column) -> Column:
    """Three lists of {surface, code} as one typed list; entries without surface or code go."""
    none = F.lit(None).cast("string")

    def typed(items: Column, kind: str) -> Column:
        return F.transform(
            F.filter(items, lambda x: (t.safe_str(x["surface"]) != "") & x["code"].isNotNull()),
            lambda x: F.struct(F.lit(kind).alias("etype"), x["surface"].alias("surface"), (x["code"] if kind == "company" else none).alias("stockCode"), (x["code"] if kind == "concept" else none).alias("conceptCode"), (x["code"] if kind == "industry" else none).alias("industryCode")),
        )

    empty = F.expr("cast(array() as array<struct<etype:string,surface:string,stockCode:string,conceptCode:string,industryCode:string>>)")
    return F.concat(*(F.coalesce(typed(c, k), empty) for c, k in ((companies, "company"), (concepts, "concept"), (industries, "industry"))))


def valid_subjects(subjects: Column, known: Column) -> Column:
    """The subjects that are known entities, repeats included; all of them if none is."""
    kept = F.filter(subjects, lambda s: F.array_contains(known, s))
    return F.when(F.size(kept) > 0, kept).otherwise(F.coalesce(subjects, F.array().cast("array<string>")))


def explode_events(news: DataFrame) -> DataFrame:
    """Rows of NewsID, news_time, event_pos, subject_pos, surface and the event's fields, one per event and subject.

    Needs NewsID, news_time, entities (merged) and event_analyses (array of structs with subjects).
    """
    known = F.transform("entities", lambda e: e["surface"])
    ev = news.select("NewsID", "news_time", "entities", F.posexplode("event_analyses").alias("event_pos", "event"))
    return ev.select("NewsID", "news_time", "entities", "event_pos", "event", F.posexplode(valid_subjects(F.col("event.subjects"), known)).alias("subject_pos", "surface"))


def with_entity(rows: DataFrame) -> DataFrame:
    """etype and code of the surface, the last entity of that surface; unknown and null without one."""
    hit = F.element_at(F.filter("entities", lambda e: e["surface"] == F.col("surface")), -1)
    has = F.exists("entities", lambda e: e["surface"] == F.col("surface"))
    return rows.withColumn("etype", F.when(has, hit["etype"]).otherwise("unknown")).withColumn("stockCode", F.when(has, F.coalesce(hit["stockCode"], hit["conceptCode"], hit["industryCode"])))


def fallback_events(news: DataFrame, exploded: DataFrame) -> DataFrame:
    """Entities without an event, one row each, repeats included."""
    ents = news.select("NewsID", "news_time", F.posexplode("entities").alias("event_pos", "e")).select("NewsID", "news_time", "event_pos", F.col("e.surface").alias("surface"), F.col("e.etype").alias("etype"), F.coalesce("e.stockCode", "e.conceptCode", "e.industryCode").alias("stockCode"))
    used = exploded.select("NewsID", "surface").distinct()
    return ents.join(used, ["NewsID", "surface"], "left_anti").select("NewsID", "event_pos", "surface", "etype", "stockCode", F.col("news_time").alias("event_time"), F.lit(DEFAULTS["trigger"]).alias("trigger"), F.lit(PLACEHOLDER).alias("event_summary"), F.lit(DEFAULTS["sentiment"]).alias("sentiment"))


def assemble(news: DataFrame) -> DataFrame:
    """All events of a news, numbered through: first those of its analyses, then the fallbacks."""
    e = with_entity(explode_events(news))
    own = e.select("NewsID", F.lit(0).alias("phase"), "event_pos", "subject_pos", "surface", "etype", "stockCode", event_time(F.col("event.event_time"), F.col("news_time")).alias("event_time"), *(F.coalesce(F.col(f"event.{c}"), F.lit(DEFAULTS.get(c))).alias(c) for c in ("trigger", "event_summary", "sentiment")))
    back = fallback_events(news, e).withColumn("phase", F.lit(1)).withColumn("subject_pos", F.lit(0)).select(own.columns)
    n = F.row_number().over(Window.partitionBy("NewsID").orderBy("phase", "event_pos", "subject_pos"))
    every = own.unionByName(back).withColumn("n", n)
    return every.withColumn("event_ID", F.when(F.col("phase") == 0, F.format_string("E_auto_%s_%d", "NewsID", "n")).otherwise(F.format_string("E_auto_%s_fallback_%d", "NewsID", "n")))


def nest(events: DataFrame, *fields: str) -> DataFrame:
    """Events as an array per news, in their order."""
    return events.groupBy("NewsID").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", *fields))), lambda x: F.struct(*(x[f].alias(f) for f in fields))).alias("events"))


def top_level(events: Column) -> dict[str, Column]:
    """scope, depth and novelty of the first event, with sentinels."""
    return {k: F.coalesce(F.get(events, F.lit(0))[k], F.lit(DEFAULTS[k])) for k in ("scope", "depth", "novelty")}


def target_subject(entities: Column) -> Column:
    return F.array_join(F.transform(entities, lambda e: e["surface"]), ", ")


def flatten_pairs(news: DataFrame, order: str = "item_no") -> DataFrame:
    """(NewsID, event_summary) of every event; null ids, blank summaries and placeholders go, and repeats within one item."""
    rows = news.where("NewsID is not null").select(order, "NewsID", F.posexplode("events").alias("pos", "event"))
    rows = rows.select(order, "NewsID", "pos", t.non_empty("event.event_summary").alias("event_summary")).where(f"event_summary is not null and event_summary <> '{PLACEHOLDER}'")
    w = Window.partitionBy(order, "event_summary").orderBy("pos")
    return rows.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def explode_ids(df: DataFrame, column: str, out: str, skip_nan: bool = False) -> DataFrame:
    """A row per id of a comma list; blanks, and 'nan' if asked, go."""
    ids = F.filter(F.transform(F.split(F.coalesce(F.col(column), F.lit("")), ","), lambda x: F.trim(x)), lambda x: (x != "") & ((F.lower(x) != "nan") if skip_nan else F.lit(True)))
    return df.select("*", F.posexplode(ids).alias("pos", out))
