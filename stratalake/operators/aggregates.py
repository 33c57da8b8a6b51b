"""Sums, counts and joining per-key results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_per_key(df: DataFrame, keys: str | Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Sum columns per key; ``sums`` maps input column to output name.

    Several sums cost one pass and one shuffle. Each task sums its own rows
    first, so a hot key sends one row per task, not all its rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for c, name in sums.items()])


def combine_on_key(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Inner join with one copy of the key columns.

    Two results grouped by the same keys are already partitioned by them, so the
    join adds no shuffle of its own.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right, keys, "inner")


def count_rows(df: DataFrame, name: str = "row_count") -> DataFrame:
    """Row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))
