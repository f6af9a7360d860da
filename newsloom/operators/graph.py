"""Industry co-occurrence: contexts, NPMI edges, evidence, communities and graph tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as t
from .select import numbered

MIN_COOC, MIN_NPMI = 2, 0.05
#: Edges that one task may get for the search for communities.
MOST_EDGES = 500_000


def news_industries(mapped: DataFrame, explicit: DataFrame) -> DataFrame:
    """Distinct (news_id, industry) from company codes and from named industries."""
    return mapped.select("news_id", "industry").union(explicit.select("news_id", "industry")).where("news_id is not null and industry is not null").distinct()


def entity_rows(events: DataFrame, kinds: tuple[str, ...] = ("company", "industry")) -> DataFrame:
    """Events of the entity types that the graph has; concepts are left out."""
    return events.where(F.col("etype").isin(*kinds))


def typed_contexts(**members: DataFrame) -> DataFrame:
    """All contexts of several kinds of topics (topic_id, item), each kind by its name: ids of different kinds stay apart."""
    parts = [df.select(F.lit(kind).alias("topic_type"), "topic_id", "item") for kind, df in members.items()]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.withColumn("context", F.concat_ws(":", "topic_type", F.col("topic_id").cast("string")))


def contexts(members: DataFrame, context: str, item: str) -> DataFrame:
    """Distinct (context, item) of contexts with two items or more."""
    d = members.select(F.col(context).alias("context"), F.col(item).alias("item")).where("context is not null and item is not null").distinct()
    many = d.groupBy("context").agg(F.count("*").alias("n")).where("n >= 2").select("context")
    return d.join(many, "context", "left_semi")


def npmi(ctx: DataFrame) -> DataFrame:
    """a < b, cooc, npmi = ln(p_ab / (p_a p_b)) / -ln p_ab; null where p_ab is 1.

    Contexts hold distinct industries, whose number is bounded; the pairs are counted map-side before the shuffle.
    """
    n = ctx.agg(F.count_distinct("context").alias("n"))
    single = ctx.groupBy("item").agg(F.count("*").alias("c"))
    pairs = ctx.alias("x").join(ctx.alias("y"), F.col("x.context") == F.col("y.context")).where("x.item < y.item").groupBy(F.col("x.item").alias("a"), F.col("y.item").alias("b")).agg(F.count("*").alias("cooc"))
    p = pairs.join(single.select(F.col("item").alias("a"), F.col("c").alias("ca")), "a").join(single.select(F.col("item").alias("b"), F.col("c").alias("cb")), "b").crossJoin(F.broadcast(n))  # n has one row
    pmi = F.log(F.col("cooc") * F.col("n") / (F.col("ca") * F.col("cb")))
    return p.select("a", "b", "cooc", F.try_divide(pmi, -F.log(F.col("cooc") / F.col("n"))).alias("npmi"))


def sorted_edges(edges: DataFrame, scratch) -> DataFrame:
    """Edges with their place by npmi and count, the greatest first, then by names; unknown npmi comes last."""
    keyed = edges.withColumn("__n", F.coalesce(-F.round("npmi", 12), F.lit(9.0))).withColumn("__c", -F.col("cooc"))
    return numbered(keyed, ["__n", "__c", "a", "b"], "place", scratch).drop("__n", "__c")


def co_occur(edges: DataFrame, evidence_rows: DataFrame) -> DataFrame:
    """One table of CO_OCCUR edges a -> b: npmi, count, and the ids and titles that speak for them."""
    return edges.select("a", "b", "cooc", "npmi").join(evidence_rows.select("a", "b", "n_news", "news_ids", "titles"), ["a", "b"], "left")


def write_communities(nodes: DataFrame, key: str, found: DataFrame) -> DataFrame:
    """Nodes with the community and its size; nodes in none keep nulls.  found: item, community, community_size."""
    return nodes.drop("community", "community_size").join(found.select(F.col("item").alias(key), "community", "community_size"), key, "left")


def strong(edges: DataFrame, cooc: int = MIN_COOC, least: float = MIN_NPMI) -> DataFrame:
    return edges.where((F.col("cooc") >= cooc) & (F.col("npmi") >= least))


def evidence(ctx: DataFrame, news: DataFrame, titles: DataFrame, *, ids: int = 500, look: int = 300, show: int = 12) -> DataFrame:
    """Per pair of industries: number of news of shared contexts, the first ids sorted as strings, and titles of the first ones.

    news: (context, news_id); titles: (news_id, title).  Ids are ranked, so no array is longer than what is shown.
    """
    pairs = ctx.alias("x").join(ctx.alias("y"), F.col("x.context") == F.col("y.context")).where("x.item < y.item").select(F.col("x.context").alias("context"), F.col("x.item").alias("a"), F.col("y.item").alias("b"))
    linked = pairs.join(news, "context").select("a", "b", F.col("news_id").cast("string").alias("news_id")).distinct()
    count = linked.groupBy("a", "b").agg(F.count("*").alias("n_news"))
    w = Window.partitionBy("a", "b").orderBy("news_id")
    first = linked.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= ids)  # the limit also holds before the shuffle
    named = first.join(titles.select(F.col("news_id").cast("string").alias("news_id"), t.non_empty("title").alias("title")), "news_id", "left")
    arr = F.array_sort(F.collect_list(F.struct("rn", "news_id", "title")))
    g = named.groupBy("a", "b").agg(arr.alias("all")).join(count, ["a", "b"])
    shown = F.slice(F.filter(F.col("all"), lambda x: (x["rn"] <= look) & x["title"].isNotNull()), 1, show)
    return g.select("a", "b", "n_news", F.array_join(F.transform("all", lambda x: x["news_id"]), ",").alias("news_ids"), F.array_join(F.transform(shown, lambda x: x["title"]), " || ").alias("titles"))


def most_frequent(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The most frequent value of each key, ties by the first row; nulls don't count."""
    n = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col("first"))).alias(value))


def greedy_communities(edges: list[tuple[str, str, float]]) -> dict[str, int]:
    """Greedy modularity: merge the two communities that gain most until none gains; ids by falling size, then first name."""
    total = sum(w for *_, w in edges)
    if total <= 0:
        return {}
    nodes = sorted({x for a, b, _ in edges for x in (a, b)})
    links: dict[str, dict[str, float]] = {x: {} for x in nodes}
    for a, b, w in edges:
        links[a][b] = links[a].get(b, 0.0) + w
        links[b][a] = links[b].get(a, 0.0) + w
    share = {x: sum(links[x].values()) / (2 * total) for x in nodes}
    group = {x: [x] for x in nodes}
    while True:
        best = max(((w / total - 2 * share[a] * share[b], a, b) for a in links for b, w in links[a].items() if a < b), key=lambda g: (round(g[0], 12), [-ord(c) for c in g[1]], [-ord(c) for c in g[2]]), default=None)
        if best is None or best[0] <= 1e-12:
            break
        _, a, b = best
        for c, w in links.pop(b).items():
            del links[c][b]
            if c != a:
                links[a][c] = links[a].get(c, 0.0) + w
                links[c][a] = links[a][c]
        share[a] += share.pop(b)
        group[a] += group.pop(b)
    ordered = sorted(group.values(), key=lambda g: (-len(g), min(g)))
    return {x: i for i, g in enumerate(ordered) for x in g}


def communities(edges: DataFrame, weight: str = "npmi") -> DataFrame:
    """item, community, community_size.  The nodes are industries, of which there are a bounded number, so one task does it.

    More than ``MOST_EDGES`` edges raise ValueError: they are more than one task should get.
    """
    if edges.limit(MOST_EDGES + 1).count() > MOST_EDGES:
        raise ValueError(f"more than {MOST_EDGES} edges; raise the thresholds of strong()")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        found = greedy_communities(list(zip(f["a"], f["b"], f["w"].astype(float), strict=True)))
        return pd.DataFrame({"item": list(found), "community": list(found.values())}, columns=["item", "community"])

    one = edges.select("a", "b", F.col(weight).alias("w")).where("w > 0").withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "item string, community int")
    return one.withColumn("community_size", F.count("*").over(Window.partitionBy("community")))


def duplicates(nodes: DataFrame, *key: str) -> DataFrame:
    """Keys that break uniqueness; empty if the nodes are right."""
    return nodes.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Old and new nodes, one per key: the first new row of a key replaces the old one."""
    w = Window.partitionBy(key).orderBy(order)
    first = new.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return first.unionByName(old.join(first.select(key), key, "left_anti"), allowMissingColumns=True)


def relate(edges: DataFrame, left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Distinct edges whose both ends are there."""
    a = edges.join(left.select(F.col(left_key)).distinct(), left_key, "left_semi")
    return a.join(right.select(F.col(right_key)).distinct(), right_key, "left_semi").select(*edges.columns).distinct()
