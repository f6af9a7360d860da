"""Sinks: one dataset per table, written by the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import xlsx

#: Rows that a graph connector gets at a time.
GRAPH_BATCH = 2000


def csv(df: DataFrame, path: str, *, bom: bool = False, only_if_rows: bool = False) -> bool:
    """CSV with a header; nested columns are joined by a comma and a blank.  With only_if_rows, no rows write nothing."""
    if only_if_rows and df.isEmpty():
        return False
    flat = df.select(*(F.array_join(c, ", ").alias(c) if t.startswith("array<") else F.col(c) for c, t in df.dtypes))
    names = [f"﻿{c}" if bom and i == 0 else c for i, c in enumerate(flat.columns)]
    flat.toDF(*names).write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return True


def json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def excel(df: DataFrame, path: str) -> None:
    """A workbook with one sheet of text cells, in one task: more rows than a sheet can hold raise ValueError.

    The bytes go through Hadoop's file system, so that any store that Spark writes to will do.
    """
    most = xlsx.MOST_ROWS - 1
    names = df.columns
    flat = df.select(*(F.array_join(c, ", ").alias(c) if t.startswith("array<") else F.col(c).cast("string").alias(c) for c, t in df.dtypes))
    if flat.limit(most + 1).count() > most:
        raise ValueError(f"a sheet holds {most} rows; write Parquet or CSV instead")
    spark = df.sparkSession
    content = xlsx.workbook(names, (list(r) for r in flat.toLocalIterator()))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def sheets(path: str, **tables: DataFrame) -> None:
    """A dataset for each sheet of what was a workbook."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def graph(path: str, nodes: dict[str, DataFrame], edges: dict[str, DataFrame]) -> None:
    """A dataset for each kind of node and edge; writing again replaces them, so it may be repeated."""
    for kind, group in (("nodes", nodes), ("edges", edges)):
        for name, df in group.items():
            df.write.mode("overwrite").parquet(f"{path}/{kind}/{name}")


def in_batches(df: DataFrame, send: Callable[[list[dict]], None], size: int = GRAPH_BATCH) -> None:
    """Gives an external connector the rows of each partition, so many at a time."""

    def run(rows: Iterable) -> None:
        batch: list[dict] = []
        for r in rows:
            batch.append(r.asDict(recursive=True))
            if len(batch) == size:
                send(batch)
                batch = []
        if batch:
            send(batch)

    df.foreachPartition(run)
