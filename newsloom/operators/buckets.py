"""Canonical events: buckets, clusters inside them, ids and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.scratch import Scratch
from .topics import density_topics

MIN_BUCKET = 3


def bucketed(events: DataFrame, date: Column, monthly: bool = False) -> DataFrame:
    """Adds high_type, time_bucket and anchor: each event is in exactly one bucket."""
    when = t.parse_time(date)
    return events.withColumn("high_type", F.coalesce(t.non_empty("high_level_type"), F.lit("UNKNOWN"))).withColumn("time_bucket", t.month_bucket(when) if monthly else t.week_bucket(when)).withColumn("anchor", t.anchor("participants"))


def big_enough(df: DataFrame, *keys: str, least: int = MIN_BUCKET) -> DataFrame:
    """Rows of buckets that are worth clustering."""
    n = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") >= least).drop("__n")
    return df.join(n, list(keys), "left_semi")


def clusters(rows: DataFrame, key: str, vector: str, bucket: Column, scratch: Scratch, least: float = 0.8, min_size: int = 3) -> DataFrame:
    """key, cluster: members of a dense group in a bucket share one, every other row is its own."""
    found = density_topics(rows.withColumn("__bucket", bucket), key, vector, scratch, least, min_size, block_col="__bucket")
    return found.select(key, F.when(F.col("topic_id") == -1, F.concat(F.lit("row:"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("c:"), F.col("topic_id").cast("string"))).alias("cluster"))


def components(rows: DataFrame, bucket: str, label: str, key: str) -> DataFrame:
    """Adds component: rows of a bucket with the same label share one; noise (-1 or no label) is a component of its own."""
    own = F.concat(F.lit("row:"), F.col(key).cast("string"))
    return rows.withColumn("component", F.when(F.coalesce(F.col(label), F.lit(-1)) == -1, own).otherwise(F.concat_ws(":", F.lit("c"), F.col(bucket).cast("string"), F.col(label).cast("string"))))


def statistics(rows: DataFrame, *bucket: str, component: str = "component", least: int = MIN_BUCKET) -> DataFrame:
    """One row on a run: events, buckets, those clustered and those too small, unions made, and clusters."""
    per = rows.groupBy(*bucket).agg(F.count("*").alias("n"))
    shape = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"), F.count("*").alias("n_buckets"), F.count_if(F.col("n") >= least).alias("processed_buckets"), F.count_if(F.col("n") < least).alias("skipped_small_buckets"))
    found = rows.groupBy(component).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("total_unions"), F.count("*").alias("n_global_clusters"))
    return shape.crossJoin(F.broadcast(found))  # one row each


def cluster_id(seed: Column, size: Column) -> Column:
    """First 12 hexadecimal digits of the SHA-1 of ``seed|size``; equal seeds and sizes are one cluster."""
    return t.sha1_prefix(F.concat_ws("|", seed.cast("string"), size.cast("string")))


def with_cluster_id(rows: DataFrame, cluster: str, order: str, event_id: str) -> DataFrame:
    """Adds cluster_id: the seed is the event id of the first member, or root:order without one."""
    w = Window.partitionBy(cluster)
    seed = F.coalesce(t.non_empty(event_id), F.concat(F.lit("root:"), F.col(order).cast("string")))
    return rows.withColumn("cluster_id", cluster_id(F.min_by(seed, F.col(order)).over(w), F.count("*").over(w)))


def summarize(rows: DataFrame, order: str = "row_no") -> DataFrame:
    """A row per cluster_id: size, first and last date, sorted whole-number ids, first trigger, type and action that are there."""
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))
    return rows.groupBy("cluster_id").agg(F.count("*").alias("size"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.array_sort(F.collect_set(t.int_id("NewsID"))).alias("news_ids"), *(first(c).alias(c) for c in ("trigger_norm", "high_level_type", "core_action_norm")))
