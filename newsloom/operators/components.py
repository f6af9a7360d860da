"""Connected components by contraction, in joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """The links of a task, less those that close a cycle; each names the root of its tree."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := root.setdefault(x, x)) != x:
            root[x] = root[p]
            x = root[x]
        return x

    for b in batches:
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    pairs = [(x, find(x)) for x in root if find(x) != x]
    if pairs:
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


#: Parts that the rows of a key are dealt to where one key may have a large share of them.
SALTS = 8


def salted(left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Joins on a key that may be hot on the left: its rows are dealt out by another column, and the right side is there for each part."""
    one = left.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    many = right.withColumn("__salt", F.explode(F.array(*(F.lit(i) for i in range(SALTS)))))
    return one.join(many, [key, "__salt"], how).drop("__salt")


def contract(links: DataFrame, scratch) -> DataFrame:
    """Labels (node, comp) of all nodes of links (u, v): comp is one node of the component, the same for all of it.

    Each step sends every node to its least neighbour and renames the links.  Nodes should be hashes: in a random order a
    step shrinks what is left by a constant factor.  Every step is written to the shared scratch folder.
    """
    edges = scratch.keep(links.select("u", "v").mapInArrow(_forest, "u long, v long"), "edges")
    labels = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = scratch.keep(both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("p")), "parents")
        if labels is None:
            labels = parent.select(F.col("u").alias("node"), F.col("p").alias("comp"))
        else:
            moved = salted(labels, parent.withColumnRenamed("u", "comp"), "comp", "node", "left")
            labels = scratch.keep(moved.select("node", F.coalesce("p", "comp").alias("comp")), "labels")
        half = salted(edges, parent, "u", "v").select(F.col("p").alias("a"), F.col("v").alias("u"))
        renamed = salted(half, parent, "u", "a").select(F.col("a").alias("u"), F.col("p").alias("v")).where("u <> v").distinct()
        edges = scratch.keep(renamed, "edges")
        if edges.isEmpty():
            return labels
