"""Incremental scans: each run sees only what earlier runs have not.

``max_files`` and ``max_bytes`` bound one micro-batch; a run-once trigger then
works through a backlog in several batches instead of one unbounded batch.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from ..functions.timing import stamp_arrival
from ..sinks.feeds import feed_of
from ..sinks.tables import REPLACED, table_properties

# A batch size for long backlogs: what earlier batches did is kept if a later one fails.
BACKLOG_BYTES = 1 << 40

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# Columns every queue message arrives with, whatever the connector.
ENVELOPE = {
    "messageId": "string",
    "payload": "binary",
    "publishTimestampInMillis": "bigint",
}


def stream_binary_files(
    spark: SparkSession,
    path: str,
    glob: str = "*",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """One row per new file, whole content in ``content``."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    return _bounded(reader, max_files, max_bytes).option("pathGlobFilter", glob).load(path)


def stream_text_lines(
    spark: SparkSession,
    path_glob: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """One row per line of every new file matching the glob."""
    return _bounded(spark.readStream.format("text"), max_files, max_bytes).load(path_glob)


def stream_xml_rows(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType | str,
    glob: str = "*.xml",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """One row per ``row_tag`` element of every new file.

    Unlike ``stream_binary_files`` no document has to fit in a value.
    """
    reader = spark.readStream.format("xml").option("rowTag", row_tag).schema(schema)
    return _bounded(reader, max_files, max_bytes).option("pathGlobFilter", glob).load(path)


def stream_table(
    spark: SparkSession,
    name: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Rows appended to a table; of a tracked one, the rows it had and those of upserts since.

    Rows of other tables that have been replaced would come again, all of them, so such a
    table is refused: track its changes (``sinks.track_changes``), or read it as a table.
    """
    feed = feed_of(spark, name)
    if feed is not None:
        reader = _bounded(spark.readStream, max_files, max_bytes)
        return reader.schema(spark.table(name).schema).parquet(f"{feed}/*")
    if REPLACED in table_properties(spark, name):
        raise ValueError(f"the rows of {name} have been replaced, which a stream cannot follow")
    return _bounded(spark.readStream, max_files, max_bytes).table(name)


def stream_envelopes(
    spark: SparkSession,
    source_format: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Queue messages as ``messageId, payload, publishTimestampInMillis, eventTime``.

    ``source_format`` names any stream source that delivers those columns: a
    queue connector on the class path with its own ``options`` (subscription,
    credentials), or a file format with a ``path`` and ``schema``.
    """
    reader = spark.readStream.format(source_format).options(**dict(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    messages = reader.load(path) if path else reader.load()
    missing = set(ENVELOPE) - set(messages.columns)
    if missing:
        raise ValueError(f"not a message source, missing {sorted(missing)}")
    envelope = messages.select(*[F.col(c).cast(t).alias(c) for c, t in ENVELOPE.items()])
    return stamp_arrival(envelope)


def _bounded(
    reader: DataStreamReader, max_files: int | None, max_bytes: int | None
) -> DataStreamReader:
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader
