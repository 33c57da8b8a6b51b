"""One row per key, statistics per key, and the top rows overall."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Filtering ``row_number`` to 1 lets Spark keep one row per key and task before
    the shuffle, so a hot key does not reach one task whole. Order by enough
    columns to make the choice repeatable.
    """
    if not order_by:
        raise ValueError("without an order the row kept is arbitrary")
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def _statistics(value: str) -> list[Column]:
    return [
        F.avg(value).alias("avg"),
        F.sum(value).alias("sum"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.stddev(value).alias("stddev"),
    ]


def with_key_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every row with ``avg, sum, min, max, stddev`` of ``value`` over its key.

    A window over the key would gather and sort each key's rows in one task.
    Grouping first (with partial sums) and joining the result back lets Spark
    broadcast small statistics, or split the partitions of a hot key. Null keys
    form a group of their own, as they do in a window; the null-safe comparison
    also has the statistics shuffled for the join, without which Spark would not
    split the other side.
    """
    stats_key = f"__{key}"
    stats = df.groupBy(F.col(key).alias(stats_key)).agg(*_statistics(value))
    return df.join(stats, F.col(key).eqNullSafe(F.col(stats_key)), "inner").drop(stats_key)


def summarise_per_key(df: DataFrame, key: str, value: str, label: str) -> DataFrame:
    """One row per key: a label, and ``avg, sum, min, max, stddev`` of ``value``.

    Equal to ``with_key_stats`` reduced to one row per key, in one aggregation.
    If a key has several labels the smallest is taken.
    """
    return df.groupBy(key).agg(F.min(label).alias(label), *_statistics(value))


def top_k(df: DataFrame, by: str, k: int, tie_break: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values follow ``tie_break``.

    Runs as a per-task top-k whose winners are merged, never as a full sort.
    """
    return df.orderBy(F.desc(by), F.asc(tie_break)).limit(k)
