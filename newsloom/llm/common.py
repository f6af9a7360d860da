"""Shared plumbing of the training-data operators.

Rows travel to Python as Arrow batches; texts are handled as UTF-8 bytes, so that ASCII rules
(lower-casing A-Z, ASCII white space, code-point counts) are exact and cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import Scratch, checkpoint_dir  # noqa: F401

#: Rows per Arrow batch: with very long texts a batch must still fit a Python worker.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def raw_texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | object) -> DataFrame:
    """mapInArrow with a function of one batch; batches without rows never reach it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def fold_bytes(df: DataFrame, column: str, dtype: str, merge: Callable[[np.ndarray, np.ndarray], np.ndarray], scratch: Scratch | None = None) -> np.ndarray | None:
    """Merges equal-length binary arrays, one a task, in two levels, so that no task and not the driver gets one from each task.

    The frame must read written rows, or a scratch folder be given to write them first: the levels are narrow, and would
    else pull the work above them into their few tasks.
    """
    schema = f"{column} binary"

    def some(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column(0):
                if (v := x.as_py()) is not None:
                    a = np.frombuffer(v, dtype)
                    total = a.copy() if total is None else merge(total, a)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=[column])

    small = df.select(column).where(F.col(column).isNotNull())
    if scratch is not None:
        small = scratch.keep(small, "folded")
    n = max(1, int(small.rdd.getNumPartitions() ** 0.5))
    rows = small.coalesce(n).mapInArrow(some, schema).coalesce(1).mapInArrow(some, schema).collect()
    if scratch is not None:
        scratch.drop("folded")
    return np.frombuffer(bytes(rows[0][0]), dtype).copy() if rows else None
