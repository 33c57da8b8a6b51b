"""Running streams to the end of what is available now.

Progress lives in the checkpoint: running again handles only new input, and a
run that broke off continues where it stopped.

A stream with state keeps the number of partitions it was first started with.
``state_partitions`` sets it for one stream: a few thousand windows need far fewer
than ``spark.sql.shuffle.partitions`` on a large cluster, and each costs a task and
a file in every batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sinks.tables import add_columns, describe, publish_version


def run_once(
    stream: DataFrame,
    checkpoint: str,
    path: str,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    state_partitions: int | None = None,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append everything new to Parquet files at ``path``, then return.

    The file sink lists the files of each finished batch, so a batch that is
    repeated after a failure does not show up twice. With ``table`` the files
    are also registered under that name, with the comment and properties; columns that
    the table has not yet are added to it and are null in the rows it has.
    """
    spark = stream.sparkSession
    if table and spark.catalog.tableExists(table):
        add_columns(spark, table, stream.schema)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffle_partitions(spark, state_partitions):
        query = writer.toTable(table) if table else writer.start()
    query.awaitTermination()
    if table:
        describe(spark, table, comment, properties)
    return query


def run_complete(
    stream: DataFrame,
    checkpoint: str,
    path: str,
    table: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    state_partitions: int | None = None,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Keep ``table`` equal to the whole result so far, then return.

    Each batch writes a new version under ``path`` and moves the table to it. A
    repeated batch writes the same version again. ``finish`` is applied to the
    result before it is written; it may aggregate again, as the stream cannot.
    """
    spark = stream.sparkSession

    def publish(result: DataFrame, version: int | str) -> None:
        rows = finish(result) if finish else result
        path_of = f"{path}/batch-{version}"
        publish_version(rows, table, path_of, comment=comment, properties=properties)

    writer = (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(publish)
    )
    with shuffle_partitions(spark, state_partitions):
        query = writer.start()
    query.awaitTermination()
    # The batches ran in a session of their own; this one may remember the version before.
    if spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
    else:
        publish(spark.createDataFrame([], stream.schema), "none")
    return query


@contextmanager
def shuffle_partitions(spark: SparkSession, count: int | None) -> Iterator[None]:
    """The setting a stream takes over when it starts, put back afterwards."""
    if count is None:
        yield
        return
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, count)
    try:
        yield
    finally:
        spark.conf.set(key, before)
