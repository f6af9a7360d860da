"""Stateless news steps on streams, and exact deduplication within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.select import time_range


def filter_stream(stream: DataFrame, column: str, low: str, high: str) -> DataFrame:
    """The time filter, unchanged: it keeps no state."""
    return time_range(stream, column, low, high)


def distinct_stream(stream: DataFrame, keys: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """The first of equal keys among rows that are less late than the delay; state is dropped behind the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
