"""Topics: aggregation, keywords, representatives, default clusterers, and report payloads."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from ..sources.scratch import Scratch
from .components import contract
from .select import numbered


def ordered(value: Column | str, *order: str) -> Column:
    """The values of a group as an array in order; nulls go."""
    v = F.col(value) if isinstance(value, str) else value
    return F.transform(F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(*(F.col(o).alias(f"o{i}") for i, o in enumerate(order)), v.alias("v"))))), lambda x: x["v"])


def aggregate(rows: DataFrame, topic: str, id_col: str, summary: str, order: str, outliers: bool = False) -> DataFrame:
    """topic_id, topic_size, ids and summaries in order; sort by size, then topic, at the sink."""
    d = rows if outliers else rows.where(F.col(topic) != -1)
    return d.groupBy(F.col(topic).alias("topic_id")).agg(ordered(F.col(id_col).cast("string"), order).alias("ids"), ordered(summary, order).alias("summaries"), F.count("*").alias("topic_size"))


def by_size(topics: DataFrame, scratch: Scratch) -> DataFrame:
    """Topics with their place: the largest first, then by topic."""
    return numbered(topics.withColumn("__s", -F.col("topic_size")), ["__s", "topic_id"], "place", scratch).drop("__s")


def ids_text(c: Column | str = "ids") -> Column:
    return F.array_join(c, ", ")


def summaries_text(c: Column | str = "summaries") -> Column:
    return F.array_join(c, "\n")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(v: Column | str) -> Column:
    """The vector divided by its length (plus 1e-12)."""
    c = F.col(v) if isinstance(v, str) else v
    return t.let(F.sqrt(dot(c, c)) + F.lit(1e-12), lambda n: F.transform(c, lambda x: x.cast("double") / n))


def centroid(rows: DataFrame, topic: str, vector: str) -> DataFrame:
    """The mean vector of each topic."""
    e = rows.select(topic, F.posexplode(vector).alias("i", "x"))
    m = e.groupBy(topic, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy(topic).agg(ordered("x", "i").alias("centroid"))


def nearest_to_centroid(rows: DataFrame, topic: str, vector: str, order: str) -> DataFrame:
    """The row of each topic nearest to its mean by cosine, the first of equals, with the cosine."""
    c = rows.join(centroid(rows, topic, vector), topic)
    v, m = F.col(vector), F.col("centroid")
    cos = c.withColumn("cosine", dot(v, m) / (F.sqrt(dot(v, v)) * F.sqrt(dot(m, m)) + F.lit(1e-12))).drop("centroid")
    return cos.withColumn("rn", F.row_number().over(Window.partitionBy(topic).orderBy(F.desc(F.round("cosine", 9)), order))).where("rn = 1").drop("rn")


def tokens(rows: DataFrame, text: str, stop: DataFrame | None = None, *keep: str) -> DataFrame:
    """A row per token: runs of two word characters or more, lower-cased, without stop words."""
    e = rows.select(*keep, F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))).alias("token"))
    return e if stop is None else e.join(stop.select(F.col("word").alias("token")), "token", "left_anti")


def keywords(toks: DataFrame, topic: str, most: int = 10) -> DataFrame:
    """topic, rank, word, weight: share in the topic x ln(1 + average topic length / frequency).

    Counts are written once, and all else is of them: tokens, which may be a cut of long texts, are made once only.
    """
    scratch = Scratch(toks.sparkSession, "keywords")
    tf = scratch.keep(toks.groupBy(topic, "token").agg(F.count("*").alias("n")), "counts")
    size = tf.groupBy(topic).agg(F.sum("n").alias("total"))
    mean = size.agg(F.avg("total").alias("a"))  # one row
    freq = tf.withColumn("f", F.sum("n").over(Window.partitionBy("token")))
    w = freq.join(size, topic).crossJoin(F.broadcast(mean)).select(topic, F.col("token").alias("word"), (F.col("n") / F.col("total") * F.log(1 + F.col("a") / F.col("f"))).alias("weight"))
    r = w.withColumn("rank", F.row_number().over(Window.partitionBy(topic).orderBy(F.desc(F.round("weight", 12)), "word")))
    return r.where(F.col("rank") <= most).select(topic, "rank", "word", "weight")


def keyword_pick(rows: DataFrame, topic: str, summary: str, order: str, words: DataFrame) -> DataFrame:
    """The summary of each topic with the greatest sum of weights of contained keywords + 0.15 x their share.

    words: topic, keywords (array<struct<word,weight>>).  The first of equals; without keywords, the longest.
    """
    j = rows.join(words, topic, "left")
    s = t.match_form(summary)
    inside = F.filter("keywords", lambda k: (t.match_form(k["word"]) != "") & F.contains(s, t.match_form(k["word"])))
    score = F.aggregate(inside, F.lit(0.0), lambda a, k: a + k["weight"].cast("double")) + 0.15 * F.size(inside) / F.greatest(F.size("keywords"), F.lit(1))
    value = F.when(F.coalesce(F.size("keywords"), F.lit(0)) > 0, score).otherwise(F.length(summary).cast("double"))
    r = j.withColumn("score", value).withColumn("rn", F.row_number().over(Window.partitionBy(topic).orderBy(F.desc(F.round("score", 9)), order)))
    return r.where("rn = 1").select(topic, F.col(summary).alias("key_event"), "score")


def topic_info(rows: DataFrame, topic: str, words: DataFrame, text: str, order: str) -> DataFrame:
    """Topic, count, name and the first three texts, outliers included; words: topic, words (array)."""
    g = rows.groupBy(topic).agg(F.count("*").alias("count"), F.slice(ordered(text, order), 1, 3).alias("docs"))
    return g.join(words, topic, "left").withColumn("name", F.concat_ws("_", F.col(topic).cast("string"), F.slice("words", 1, 4)))


#: Vectors in a cell, at the least and at the most, and cells in between: each vector goes to as many tasks as there are cells.
CELL, CELLS, MOST = 2000, 24, 50_000
#: Vectors a side of the products that are held at once.
TILE = 1000


def cells_of(n: int) -> int:
    """Cells for so many vectors: no more than CELLS, so that the shuffle grows with the vectors, until a cell would be too large."""
    return max(1, min(-(-n // CELL), CELLS), -(-n // MOST))


def _linked(least: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Of a pair of cells, or of a cell and itself, links of each vector to the first of its component: no more rows than vectors, however many are alike."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        m = np.array(rows["__v"].tolist(), np.float64)
        left = rows["cell"].to_numpy() == rows["i"].to_numpy()
        a = np.flatnonzero(left)
        same = len(a) == len(m)
        b = a if same else np.flatnonzero(~left)
        if same and rows["i"].iloc[0] != rows["j"].iloc[0]:
            b = b[:0]  # a block without vectors in the other cell
        root = np.arange(len(m))
        for x in range(0, len(a), TILE):
            for y in range(x if same else 0, len(b), TILE):
                p, q = a[x : x + TILE], b[y : y + TILE]
                i, j = np.nonzero(m[p] @ m[q].T >= least)
                i, j = root[p[i]], root[q[j]]
                while len(i := i[(differ := i != j)]):
                    j = j[differ]
                    np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
                    while (root[root] != root).any():
                        root = root[root]
                    i, j = root[i], root[j]
        node = rows["node"].to_numpy()
        out = pd.DataFrame({"u": node, "v": node[root]})
        return out[out["u"] != out["v"]]

    return run


def density_topics(rows: DataFrame, key: str, vector: str, scratch: Scratch, least: float = 0.8, min_size: int = 5, block_col: str | None = None) -> DataFrame:
    """Default clusterer: connected components at a cosine threshold within blocks, of min_size or more; others are -1.

    All vectors of a block, or all if no block is given, are compared with each other: cell by cell, n^2 / 2 products in all.
    A topic is named by its least key, so equal input gives equal labels.
    """
    v = rows.select(F.col(key).cast("long").alias("key"), unit(vector).alias("__v"), (F.col(block_col) if block_col else F.lit(0)).alias("block"))
    known = v.where("key is not null and __v is not null and block is not null").select("block", F.size("__v").alias("size"), "__v", F.xxhash64("key").alias("node"))
    cells = cells_of(known.count())
    cell, other = F.pmod(F.col("node"), F.lit(cells)), F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))
    met = known.withColumn("cell", cell).withColumn("other", other).withColumn("i", F.least("cell", "other")).withColumn("j", F.greatest("cell", "other"))
    links = scratch.keep(met.groupBy("block", "size", "i", "j").applyInPandas(_linked(least), "u long, v long"), "density")
    if links.isEmpty():
        return v.select(F.col("key").alias(key), F.lit(-1).cast("long").alias("topic_id"))
    labels = contract(links, scratch)
    keyed = v.select("key").join(labels, F.xxhash64("key") == F.col("node"), "left")
    big = keyed.where("comp is not null").groupBy("comp").agg(F.count("*").alias("n"), F.min("key").alias("least")).where(F.col("n") >= min_size)
    return keyed.join(big, "comp", "left").select(F.col("key").alias(key), F.coalesce("least", F.lit(-1).cast("long")).alias("topic_id"))


def report_topics(topics: DataFrame, members: DataFrame, texts: DataFrame, *, most_texts: int = 25, most_ids: int = 50) -> DataFrame:
    """topic, name, count, keywords, original_texts, news_ids for the report.

    topics: topic, name, count, keywords (text with bars); members: topic, pos, news_id; texts: news_id, row_no, summary (the
    last of an id wins).
    """
    last = texts.groupBy("news_id").agg(F.max_by("summary", "row_no").alias("summary"))
    m = members.join(last, "news_id", "left")
    w = Window.partitionBy("topic").orderBy("pos")
    m = m.withColumn("rn", F.row_number().over(w)).withColumn("has", t.non_empty("summary")).withColumn("tn", F.sum(F.col("has").isNotNull().cast("int")).over(w))
    g = m.groupBy("topic").agg(ordered(F.when((F.col("tn") <= most_texts) & F.col("has").isNotNull(), F.col("has")), "pos").alias("original_texts"), ordered(F.when(F.col("rn") <= most_ids, F.col("news_id")), "pos").alias("news_ids"))
    return topics.select("topic", "name", t.safe_int("count").alias("count"), t.keyword_list("keywords").alias("keywords")).where((t.safe_str("name") != "") & (F.lower("name") != "nan")).join(g, "topic", "left")
