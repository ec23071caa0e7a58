"""Joining a small keyed table to a large one, with the size checked."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tickloom.session import materialize

BROADCAST_BYTES = 64 * 1024 * 1024


def attach(df: DataFrame, small: DataFrame, on: list[str], how: str = "left",
           row_bytes: int | None = None, max_bytes: int = BROADCAST_BYTES, stored: bool = False) -> DataFrame:
    """Join per-key results to the rows they came from.

    `small` is computed once and counted. While rows times `row_bytes` (default: a generous
    width per column) stay within `max_bytes` it is broadcast, so a key with a large share
    of the rows is not shuffled into one task. Beyond that the join shuffles, and adaptive
    execution splits skewed partitions. `stored` says that `small` is read from a table.
    """
    kept = small if stored else materialize(small)
    width = row_bytes or 48 * len(kept.columns)
    if kept.count() * width <= max_bytes:
        return df.join(F.broadcast(kept), on, how)
    return df.join(kept.hint("shuffle_merge"), on, how)
