"""Streaming results kept in a table by key: a batch writes what it changed.

A complete result is written anew with every batch, however little has changed. Here a
stream in update mode hands out the keys that changed, and these are upserted into a
dataset partitioned by a column of the result, such as the day of a window: the bytes a
batch writes follow its partitions, not the whole result. Sort the table when it is read.

A batch that is repeated after a failure upserts the same values again, which changes
nothing. Parts that a batch replaced are no longer listed by the table; ``expired_parts``
names them for a retention rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sinks.feeds import shown_version
from ..sinks.merge import upsert
from ..sinks.partitioned import PART, create_partitioned, files_of
from .runs import shuffle_partitions


def run_merged(
    stream: DataFrame,
    checkpoint: str,
    root: str,
    table: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    finish: Callable[[DataFrame], DataFrame] | None = None,
    state_partitions: int | None = None,
    comment: str | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to the result so far, one row for each of ``keys``, then return.

    ``stream`` is an aggregation without order; ``finish`` is applied to what a batch
    changed and adds the partition columns if the stream has none. They are among the keys.
    """
    spark = stream.sparkSession
    shape = finish or (lambda rows: rows)

    def merge(changed: DataFrame, batch_id: int) -> None:
        upsert(shape(changed), table, keys, root)

    if not spark.catalog.tableExists(table):
        empty = shape(spark.createDataFrame([], stream.schema))
        create_partitioned(empty, table, root, partition_by, comment)
    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
    )
    with shuffle_partitions(spark, state_partitions):
        query = writer.start()
    query.awaitTermination()
    # The batches ran in a session of their own; this one may remember the files before.
    spark.catalog.refreshTable(table)
    return query


def expired_parts(spark: SparkSession, table: str) -> DataFrame:
    """The folders of a partitioned dataset that its view no longer lists: ``folder``."""
    shown = spark.read.parquet(shown_version(spark, table)).select(PART)
    folder = F.regexp_replace(F.input_file_name(), "/[^/]+$", "").alias("folder")
    stored = spark.table(files_of(table)).select(PART, folder).distinct()
    return stored.join(shown, PART, "left_anti").select("folder")
