"""Keeping the rows (or messages) that a lookup table knows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import fresh_dir

_SALT = "__salt"
_KEY = "__lookup_key"


@dataclass(frozen=True)
class Snapshot:
    """The distinct keys a lookup had at one time, stored and measured."""

    keys: DataFrame
    rows: int
    size: int

    def fits(self, rows: int, size: int) -> bool:
        return self.rows <= rows and self.size <= size


def snapshot(lookup: DataFrame, lookup_key: str) -> Snapshot:
    """Store the distinct keys of ``lookup`` as they are now.

    What is measured is what is joined, however the lookup changes meanwhile.
    """
    spark = lookup.sparkSession
    path = fresh_dir(spark, "lookup-keys")
    keys = lookup.select(F.col(lookup_key).alias(_KEY)).where(F.col(_KEY).isNotNull()).distinct()
    keys.write.parquet(path)
    stored = spark.read.schema(keys.schema).parquet(path)
    width = F.octet_length(F.col(_KEY).cast("string"))
    seen = stored.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b"))
    row = seen.first()
    return Snapshot(stored, row.n, row.b)


def matching_batch(
    batch: DataFrame,
    keys: Snapshot,
    key: str,
    broadcast_rows: int = 1_000_000,
    broadcast_bytes: int = 64 * 1024 * 1024,
    salts: int = 16,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """The rows of a bounded frame, such as one batch of a stream, whose key is in ``keys``.

    Keys within the limits are broadcast, and the batch is not shuffled. Beyond them both
    sides are shuffled. The batch's keys are then counted (a count a key and task before
    that shuffle), and those with more than ``hot_rows`` rows are spread over ``salts``
    partitions; only they are copied on the side of the keys.
    """
    if keys.fits(broadcast_rows, broadcast_bytes):
        return batch.join(F.broadcast(keys.keys), F.col(key) == F.col(_KEY), "left_semi")
    counted = batch.groupBy(F.col(key).alias("__hot")).count()
    # At most the batch's rows divided by hot_rows.
    hot = counted.where((F.col("count") > hot_rows) & F.col("__hot").isNotNull()).select("__hot")
    is_hot = F.col("__hot").isNotNull()
    marked = batch.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
    # The salt follows the input partition: stable when a task is run again, and
    # identical rows still spread.
    salt = F.when(is_hot, F.spark_partition_id() % salts).otherwise(0)
    salted = marked.withColumn(f"{_SALT}_left", salt).drop("__hot")
    every = F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(0))
    spread = keys.keys.join(F.broadcast(hot), F.col(_KEY) == F.col("__hot"), "left").select(
        _KEY, F.explode(every).alias(_SALT)
    )
    condition = (F.col(key) == F.col(_KEY)) & (F.col(f"{_SALT}_left") == F.col(_SALT))
    return salted.join(spread.hint("merge"), condition, "left_semi").drop(f"{_SALT}_left")


def keep_matching(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    broadcast_rows: int = 1_000_000,
    broadcast_bytes: int = 64 * 1024 * 1024,
    salts: int = 16,
) -> DataFrame:
    """Left semi join of a stream or table with a static lookup.

    The distinct lookup keys are measured first. If they are at most
    ``broadcast_rows`` and ``broadcast_bytes`` they are broadcast and the large
    side is not shuffled. Beyond that both sides are shuffled; each lookup key is
    sent to ``salts`` partitions and the rows of a hot key are spread over them.
    Repeated lookup keys never multiply rows.

    The lookup is measured when the join is set up and read again for every batch
    of a stream; ``matching_batch`` measures it for each batch instead.
    """
    keys = lookup.select(F.col(lookup_key).alias(_KEY)).where(F.col(_KEY).isNotNull()).distinct()
    if fits(keys, broadcast_rows, broadcast_bytes):
        return df.join(F.broadcast(keys), F.col(key) == F.col(_KEY), "left_semi")
    spread = keys.select(_KEY, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(_SALT))
    # The salt follows the input partition: stable when a task is run again, and
    # identical rows still spread.
    salted = df.withColumn(f"{_SALT}_left", F.spark_partition_id() % salts)
    condition = (F.col(key) == F.col(_KEY)) & (F.col(f"{_SALT}_left") == F.col(_SALT))
    return salted.join(spread.hint("merge"), condition, "left_semi").drop(f"{_SALT}_left")


def fits(keys: DataFrame, rows: int, size: int) -> bool:
    """Whether a one-column batch frame stays within the limits; reads little beyond them."""
    width = F.octet_length(F.col(keys.columns[0]).cast("string"))
    seen = (
        keys.limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        .first()
    )
    return seen["rows"] <= rows and seen["bytes"] <= size
