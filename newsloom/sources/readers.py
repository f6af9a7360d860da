"""Readers.  All go through Spark's own sources, so any store that Spark reads will do."""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import xlsx

#: Raw news columns and their names here (fixed values).
RAW_COLUMNS = {"F4000": "news_id", "F4001": "title", "F4003": "publish_time", "F4004": "source", "F4020": "content", "F4022": "news_type", "F4023": "source_id", "F4024": "media", "F4025": "source_category", "F4026": "url", "F4027": "summary"}

EVENT = T.StructType([T.StructField(n, T.StringType()) for n in ("event_ID", "etype", "surface", "stockCode", "event_time", "trigger", "core_action", "event_summary", "sentiment", "trend_one_line", "investment_advice")])
NEWS = T.StructType([*(T.StructField(n, T.StringType()) for n in ("NewsID", "timestamp", "title", "source", "scope", "depth", "novelty", "summary", "target_subject")), T.StructField("events", T.ArrayType(EVENT))])
PAIRS = T.StructType([T.StructField("NewsID", T.StringType()), T.StructField("event_summary", T.StringType())])
VECTORS = T.StructType([*PAIRS.fields, T.StructField("embedding_model", T.StringType()), T.StructField("embedding_dim", T.IntegerType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """The frame, or ValueError if it lacks one of these columns."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _unmark(df: DataFrame) -> DataFrame:
    """Without a byte-order mark in front of the first column's name."""
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def csv_strings(spark: SparkSession, path: str, *columns: str, encoding: str = "UTF-8") -> DataFrame:
    """All columns as strings, nothing is taken for null; missing columns raise."""
    df = _unmark(spark.read.option("header", True).option("encoding", encoding).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").csv(path))
    return require(df, *columns).na.fill("")


def csv_any_encoding(spark: SparkSession, path: str, *columns: str, fallback: str = "GBK") -> DataFrame:
    """UTF-8, or the fallback if a character can't be read as UTF-8."""
    df = csv_strings(spark, path, encoding="UTF-8")
    broken = df.where(F.concat_ws("", *df.columns).contains("�")).limit(1).count() or any("�" in c for c in df.columns)
    if broken:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")  # GBK isn't in the short list; the plan reads this when it runs
        df = csv_strings(spark, path, encoding=fallback)
    return require(df, *columns)


def csv_inferred(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Plain CSV; give a schema where codes must keep leading zeros."""
    r = spark.read.option("header", True)
    return _unmark(r.schema(schema).csv(path) if schema else r.option("inferSchema", True).csv(path))


def dictionary(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A CSV dictionary with a row number in file order; a missing file is an empty dictionary."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType([*(T.StructField(c, T.StringType()) for c in columns), T.StructField("row_no", T.LongType())]))
    return csv_strings(spark, path, *columns).withColumn("row_no", F.monotonically_increasing_id())


def excel(spark: SparkSession, path: str, sheet: int = 1) -> DataFrame:
    """One sheet of each workbook, numbered from 1, all columns as strings; a workbook's rows are bounded by the format.

    The columns are those of the first row of the first workbook; workbooks are read by executors, through Spark's own source.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    first = files.orderBy("path").limit(1).mapInPandas(lambda frames: (pd.DataFrame({"row": [next(xlsx.rows(c, sheet), [])]}) for f in frames for c in f["content"]), "row array<string>").collect()
    names = [(n or "").lstrip("﻿") or f"column{i + 1}" for i, n in enumerate(first[0]["row"])] if first else []

    def run(frames: Iterator[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for f in frames:
            for content in f["content"]:
                for part in xlsx.blocks(itertools.islice(xlsx.rows(content, sheet), 1, None), len(names)):
                    yield pd.DataFrame(part, columns=names)

    return files.mapInPandas(run, T.StructType([T.StructField(n, T.StringType()) for n in names]))


def table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """By the extension: Parquet, CSV, JSON lines, JSON array or Excel."""
    kind = os.path.splitext(path.rstrip("/"))[1].lower()
    if kind in (".xlsx", ".xls"):
        return require(excel(spark, path), *columns)
    if kind == ".csv":
        return csv_any_encoding(spark, path, *columns)
    if kind == ".jsonl":
        return require(spark.read.json(path), *columns)
    if kind == ".json":
        return require(spark.read.option("multiLine", True).json(path), *columns)
    return require(spark.read.parquet(path), *columns)


def json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A whole-file JSON array with a given schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_envelope(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array, or an object with the array under ``data``; each of the first rows must have every field."""
    whole = spark.read.schema(T.StructType([*schema.fields, T.StructField("data", T.ArrayType(schema))])).option("multiLine", True).json(path)
    bare = whole.where("data is null").select(*schema.names)
    df = whole.where("data is not null").select(F.inline("data")).unionByName(bare)
    for r in df.limit(5).collect():
        if missing := [n for n in schema.names if r[n] is None]:
            raise ValueError(f"missing fields in the first rows: {', '.join(missing)}")
    return df


def canonicals(spark: SparkSession, path: str) -> DataFrame:
    """Canonical events, a row each with its NewsID, from a JSON array or from JSON lines.

    Lines that are no JSON are skipped, and so is what is no list of events; neighbours stay.  Participants may be objects or
    plain strings: industries and concepts then have only a name, companies, which count by code, are passed over.
    """
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    lines = bool(first) and first[0][0].lstrip("﻿ ").startswith("{")
    raw = spark.read.schema("NewsID string, canonicals array<string>").option("multiLine", not lines).json(path)  # objects come as their text
    event = F.from_json("event", "canonical_event_id string, date string, high_level_type string, trigger_norm string, core_action_norm string, sentiment_coarse string, sentiment_final string, participants string")
    lists = F.from_json("event.participants", "companies array<string>, concepts array<string>, industries array<string>")

    def one(x):
        made = F.from_json(x, "stockCode string, code string, name string")
        return F.when(x.startswith("{"), made).otherwise(F.struct(F.lit(None).cast("string").alias("stockCode"), F.lit(None).cast("string").alias("code"), x.alias("name")))

    rows = raw.where("NewsID is not null").select("NewsID", F.explode("canonicals").alias("event")).where(F.col("event").startswith("{"))
    rows = rows.select("NewsID", event.alias("event")).select("NewsID", "event.*", lists.alias("__lists"))
    companies = F.filter(F.col("__lists.companies"), lambda x: x.startswith("{"))
    parts = F.struct(*(F.transform(c, one).alias(n) for n, c in (("companies", companies), ("concepts", F.col("__lists.concepts")), ("industries", F.col("__lists.industries")))))
    return rows.withColumn("participants", parts).drop("__lists")


def stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words, one a line; empty lines and those that start with # are passed over; a missing file raises."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.text(path).select(F.trim(F.regexp_replace("value", r"(?U)^\s+|\s+$", "")).alias("word")).where((F.col("word") != "") & ~F.col("word").startswith("#")).distinct()


def raw_news(df: DataFrame) -> DataFrame:
    """Raw news with speaking column names."""
    return df.withColumnsRenamed({k: v for k, v in RAW_COLUMNS.items() if k in df.columns})


def settings(env: Mapping[str, str] | None = None) -> dict[str, str | None]:
    """Endpoints and limits from the environment; without them everything runs offline."""
    env = os.environ if env is None else env
    return {k: env.get(f"NEWSLOOM_{k.upper()}") for k in ("chat_url", "chat_key", "embed_url", "embed_key", "graph_url", "graph_user", "graph_password")}
