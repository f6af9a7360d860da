"""Filters, defaults, ids and deduplication of news rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t

#: What a summary says when a subject is only mentioned (fixed value).
PLACEHOLDER = "文中提及该主体，未识别到独立事件"
#: Market-noise patterns (fixed values).
NOISE = (
    r"融资|融券|两融|融资余额|融资净买入|融券余额|融券净卖出",
    r"龙虎榜|主力资金|北向资金|南向资金|资金流入|资金流出|净流入|净流出",
    r"成交额|成交量|换手率|涨跌幅|收盘|开盘|盘中|大盘|指数|ETF|板块异动",
    r"风险提示|免责声明|据统计|数据显示|截至.*?收盘",
)


def time_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """Rows in the closed range; times that can't be parsed are out."""
    c = F.col(column) if dict(df.dtypes)[column].startswith("timestamp") else t.parse_time(column)
    kind = "timestamp_ntz" if dict(df.dtypes)[column] == "timestamp_ntz" else "timestamp"
    return df.where(c.between(F.lit(low).cast(kind), F.lit(high).cast(kind)))


def source_of(media: Column, url: Column) -> Column:
    """eastmoney for its numbered media, else the media unless that is 'nan'."""
    return F.when(media.contains("123456") & url.contains("eastmoney"), "eastmoney").otherwise(F.when(F.lower(media) != "nan", media).otherwise(""))


def event_time(time: Column, news_time: Column) -> Column:
    """The news' time where the event has none or an unfilled one."""
    return F.when(time.isNull() | (time == "") | time.contains("YYYY"), news_time).otherwise(time)


#: Sentinels of missing fields (fixed values).
DEFAULTS = {"scope": "暂无", "depth": "暂无", "novelty": "暂无", "summary": "暂无摘要", "trigger": "提及", "sentiment": "中性", "investment_advice": "观望"}


def with_defaults(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    d = DEFAULTS if defaults is None else defaults
    return df.na.fill({k: v for k, v in d.items() if k in df.columns})


def noise_hits(words: Column, summaries: Column) -> Column:
    return F.regexp_count(F.concat_ws("\n", words, summaries), F.lit("|".join(f"(?:{p})" for p in NOISE)))


def is_noise(hits: Column, size: Column) -> Column:
    """Two hits or more, or one in a topic of 80 or more."""
    return (hits >= 2) | ((hits >= 1) & (size >= 80))


def drop_placeholders(df: DataFrame, column: str = "event_summary") -> DataFrame:
    return df.where(F.col(column) != PLACEHOLDER)


def drop_outliers(df: DataFrame, column: str = "topic_id") -> DataFrame:
    return df.where(F.col(column) != -1)


def named_topics(df: DataFrame, column: str) -> DataFrame:
    """Without topics whose name is empty or 'nan' in any case."""
    name = t.safe_str(column)
    return df.where((name != "") & (F.lower(name) != "nan"))


def first_by(df: DataFrame, keys: list, order: list[Column]) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def earliest_per_group(df: DataFrame, group: str, time: str, order: str) -> DataFrame:
    """The earliest row of each group, unknown times last, ties by order; rows of group -1 all stay."""
    grouped = first_by(df.where(F.col(group) != -1), [F.col(group)], [F.col(time).asc_nulls_last(), F.col(order)])
    return grouped.unionByName(df.where(F.col(group) == -1))


def propagation_path(df: DataFrame, group: str, time: str, media: str, order: str, title: str | None = None, most: str = "9999-12-31") -> DataFrame:
    """How a story went from outlet to outlet: groups with two times or more (unknown counts as one), repeats collapsed.

    The path's outlets are gathered in order after repeats are dropped, so an array is as long as the path.
    """
    w = Window.partitionBy(group).orderBy(F.col(time).asc_nulls_last(), F.col(order))
    m = F.trim(F.col(media))
    shown = df.withColumn("__m", F.when(m != "", m)).withColumn("__before", F.last("__m", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    step = F.when(F.col("__m").isNotNull() & ~F.col("__m").eqNullSafe(F.col("__before")), F.struct(F.coalesce(F.col(time).cast("timestamp"), F.lit(most).cast("timestamp")).alias("t"), F.col(order).alias("o"), F.col("__m").alias("m")))
    rank = F.struct(F.col(time).isNull(), F.col(time), F.col(order))
    out = shown.groupBy(group).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(step)), lambda x: x["m"]), "——>").alias("path"),
        F.min_by(F.col(time), rank).alias("start_time"),
        F.max_by(F.col(time), rank).alias("end_time"),
        *([F.min_by(F.col(title), rank).alias("title")] if title else []),
        F.count("*").alias("items_in_group"),
        F.count_distinct(F.coalesce(F.col(time).cast("timestamp"), F.lit(most).cast("timestamp"))).alias("__times"),
    )
    return out.where("__times >= 2").drop("__times")


def distinct_pairs(df: DataFrame, id_col: str, summary: str, order: list[Column]) -> DataFrame:
    """The first of equal (id, stripped summary); empty ones go."""
    s = df.withColumn(summary, t.non_empty(summary)).where(F.col(summary).isNotNull() & F.col(id_col).isNotNull())
    return first_by(s, [F.col(id_col).cast("string"), F.col(summary)], order)


def numbered(df: DataFrame, order: list[str], out: str, scratch) -> DataFrame:
    """Adds 1, 2, ... in the given order without sorting everything in one task.

    Rows are dealt out by range and written with the number of their range; numbers are ranks within a range plus the sizes
    of the ranges before it, of which there is one row each.
    """
    ranged = scratch.keep(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranged")
    inside = ranged.withColumn("__k", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__c"))
    before = sizes.withColumn("__off", F.coalesce(F.sum("__c").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__c")
    return inside.join(F.broadcast(before), "__part").withColumn(out, (F.col("__k") + F.col("__off")).cast("long")).drop("__part", "__k", "__off")
