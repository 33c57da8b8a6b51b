"""Change feeds: what upserts did to a table, for streams to follow.

An upsert replaces files, which a stream over them cannot follow. A tracked table
has a folder beside it to which every upsert adds the rows it was given, in a folder of
their own; it begins with the rows that the table had. ``sources.stream_table`` reads it.

What an upsert is about to show is noted on the table first, the rows join the feed once
it is shown, and then the note goes. Whoever comes next after a driver was lost in
between, upsert or stream, looks whether the noted version is the one shown and, if it
is, completes the feed before anything reads it.
"""

from __future__ import annotations

import posixpath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from .tables import describe, partition_columns, table_properties

FEED = "stratalake.feed"
#: What a partitioned dataset shows (``partitioned``).
MANIFEST = "stratalake.manifest"
_ROWS, _VERSION = "stratalake.pending_rows", "stratalake.pending_version"


def track_changes(spark: SparkSession, name: str, path: str) -> None:
    """Keep a feed of table ``name`` in the folder ``path`` from now on.

    Rows that are added in other ways than by upserts are not in it.
    """
    if partition_columns(spark, name):
        raise ValueError(f"{name} is changed partition by partition; use create_partitioned")
    rows = spark.table(name)
    rows.write.mode("overwrite").parquet(f"{path}/change=begin")
    _describe(spark, name, {FEED: path})


def feed_of(spark: SparkSession, name: str) -> str | None:
    """The folder of a table's feed, complete, if the table is tracked."""
    properties = table_properties(spark, name)
    if FEED not in properties:
        return None
    complete(spark, name)
    return properties[FEED]


def begin(spark: SparkSession, name: str, rows: str, version: str) -> None:
    """Note that the rows stored at ``rows`` lead to ``version``."""
    if FEED in table_properties(spark, name):
        _describe(spark, name, {_ROWS: rows, _VERSION: version})


def complete(spark: SparkSession, name: str) -> None:
    """Add the rows of a noted version that is shown to the feed; forget the note."""
    properties = table_properties(spark, name)
    if not properties.get(_VERSION):
        return
    if properties[_VERSION] == shown_version(spark, name):
        rows = spark.read.schema(spark.table(name).schema).parquet(properties[_ROWS])
        change = f"{properties[FEED]}/change={posixpath.basename(properties[_VERSION])}"
        # Files are moved into place one by one: fewer rows are those of a run that broke off.
        if _count(spark, rows, change) != rows.count():
            rows.write.mode("overwrite").parquet(change)
    _describe(spark, name, {_ROWS: "", _VERSION: ""})


def shown_version(spark: SparkSession, name: str) -> str:
    """The path of the files, or of the manifest, that a table shows."""
    manifest = table_properties(spark, name).get(MANIFEST)
    if manifest:
        return manifest
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
    return detail["data_type"].removeprefix("file:")


def _count(spark: SparkSession, like: DataFrame, path: str) -> int:
    try:
        return spark.read.schema(like.schema).parquet(path).count()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def _describe(spark: SparkSession, name: str, properties: dict[str, str]) -> None:
    if MANIFEST in table_properties(spark, name):
        pairs = ", ".join(f"'{key}'='{value}'" for key, value in properties.items())
        spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ({pairs})")
    else:
        describe(spark, name, properties=properties)
