"""Writing files and tables.

Tables are Parquet files at a location plus a catalog entry. A change that
replaces rows writes a new version in a folder of its own and then moves the
catalog entry to it: readers keep the version they started with, and a job that
fails half-way leaves the table as it was.

A table has one writer at a time. One that a stream appends to keeps a list of
the files that count, so only that stream may write to it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import fresh_dir

#: Set on a table whose rows have been replaced: a stream cannot follow that by its files.
REPLACED = "stratalake.rows_replaced"


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` while several results are computed from it, then let it go.

    Partitions that do not fit in memory go to disk; those lost with an executor
    are computed again.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def stored(df: DataFrame) -> Iterator[DataFrame]:
    """``reused`` by way of Parquet files, for a frame that is large beside the executors' memory.

    Nothing of it stays in memory, where it would take the room of what is computed from it,
    and on disk it is compressed.
    """
    path = fresh_dir(df.sparkSession, "stored")
    df.write.parquet(path, compression="zstd")
    yield df.sparkSession.read.schema(df.schema).parquet(path)


def overwrite_files(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    watch: Callable[[DataFrame], DataFrame] | None = None,
    gathered: bool = False,
) -> None:
    """Replace the files at ``path``.

    With ``partition_by``, rows are first brought together by those columns so
    that a task does not write a small file into every folder. ``rebalance``
    rather than ``repartition``: it splits a value that holds much of the data
    over several tasks. Partition by columns with few values only. ``gathered`` says that
    the frame has done so itself.

    ``watch`` may observe the rows as they are written. It is applied after that shuffle:
    the tasks that write count once, those before it again if what they left is lost.
    """
    if partition_by and not gathered:
        df = df.hint("rebalance", *partition_by)
    writer = (watch(df) if watch else df).write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType | None = None,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Register the Parquet files at ``path`` under ``name``, in place of what it named.

    The new entry is made beside the old one and then takes its name; if anything fails,
    the old entry is back under it. If the driver is lost between the two renames, the name
    is without a table until ``recover_table``, or the next registration, puts the old one
    back. The files are not touched. Without a ``schema`` the columns are taken from
    them, and partition values that look like numbers become numbers.
    """
    recover_table(spark, name)
    columns = ""
    if schema is not None:
        columns = f" ({nullable_ddl(schema)})"
    clauses = f" LOCATION '{sql_text(path)}'"
    if schema is not None and partition_by:
        clauses = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}){clauses}"
    if comment:
        clauses += f" COMMENT '{sql_text(comment)}'"
    if properties:
        clauses += f" TBLPROPERTIES ({property_list(properties)})"
    entry = _beside(name, "new")
    spark.sql(f"CREATE TABLE {entry}{columns} USING parquet{clauses}")
    try:
        if partition_columns(spark, entry):
            spark.catalog.recoverPartitions(entry)
        _take_name(spark, entry, name)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")
        raise


def _take_name(spark: SparkSession, entry: str, name: str) -> None:
    """Rename ``entry`` to ``name``, whose present entry goes once that has worked."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {entry} RENAME TO {name}")
        return
    old = _beside(name, "old")
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {entry} RENAME TO {name}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    spark.sql(f"DROP TABLE {old}")


def recover_table(spark: SparkSession, name: str) -> bool:
    """Put the table that a registration was replacing back under its name, if a driver was
    lost in between, and remove what that registration left; whether the table exists."""
    old, new = (_left_beside(spark, name, label) for label in ("old", "new"))
    if not spark.catalog.tableExists(name) and old:
        spark.sql(f"ALTER TABLE {old.pop()} RENAME TO {name}")
    # Entries only: the files of external tables stay.
    for entry in old + new:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")
    return spark.catalog.tableExists(name)


def _left_beside(spark: SparkSession, name: str, label: str) -> list[str]:
    """Entries that ``_beside`` named and that are still there."""
    database, _, table = name.replace("`", "").rpartition(".")
    within = f"IN {database} " if database else ""
    listed = spark.sql(f"SHOW TABLES {within}LIKE '{table.lower()}_{label}_*'").collect()
    own = re.compile(rf"{re.escape(table)}_{label}_[0-9a-f]{{12}}", re.IGNORECASE)
    prefix = f"{database}." if database else ""
    return sorted(prefix + row.tableName for row in listed if own.fullmatch(row.tableName))


def _beside(name: str, label: str) -> str:
    """A name of its own in the same database."""
    suffix = f"_{label}_{uuid.uuid4().hex[:12]}"
    return f"{name[:-1]}{suffix}`" if name.endswith("`") else f"{name}{suffix}"


def publish_version(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Write ``df`` to the folder ``path`` and make it the content of table ``name``.

    A comment or property the table already has stays unless a new one is given.
    """
    overwrite_files(df, path, partition_by)
    return show_version(df, name, path, partition_by, comment, properties)


def show_version(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Make the files at ``path``, which hold the rows of ``df``, the content of a table."""
    spark = df.sparkSession
    exists = spark.catalog.tableExists(name)
    movable = (
        exists
        and not partition_by
        and not partition_columns(spark, name)
        and _same_columns(spark.table(name), df)
    )
    if exists:
        properties = {**(properties or {}), REPLACED: "true"}
    if not movable:
        if exists:
            comment = comment or spark.catalog.getTable(name).description
            properties = {**table_properties(spark, name), **properties}
        register_table(spark, name, path, df.schema, partition_by, comment, properties)
        return spark.table(name)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{sql_text(path)}'")
    describe(spark, name, comment, properties)
    return spark.table(name)


def materialize(
    df: DataFrame,
    name: str,
    root: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Store a declared dataset as table ``name`` in a new folder under ``root``.

    Returns the stored table, so that whatever is built on it does not compute
    it again.
    """
    return publish_version(df, name, new_version(root, name), partition_by, comment, properties)


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties of a table or view."""
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def describe(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Give a table a comment and properties; what is not given stays."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{sql_text(comment)}'")
    if properties:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({property_list(properties)})")


def declare_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for use in SQL without storing it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_evolving(df: DataFrame, name: str) -> DataFrame:
    """Append by column name; columns new to the table are added to it.

    Only the catalog entry changes for that: stored files are not rewritten and
    readers need not merge file schemas. Missing values are null on either side.
    """
    spark = df.sparkSession
    add_columns(spark, name, df.schema)
    given = {column.lower() for column in df.columns}
    aligned = df.select(
        *[
            F.col(f"`{field.name}`")
            if field.name.lower() in given
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in spark.table(name).schema.fields
        ]
    )
    partition_by = partition_columns(spark, name)
    if partition_by:
        aligned = aligned.hint("rebalance", *partition_by)
    aligned.write.insertInto(name)
    return spark.table(name)


def add_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Add the columns of ``schema`` that table ``name`` lacks to its catalog entry.

    A column that both have must be of one type.
    """
    known = {field.name.lower(): field for field in spark.table(name).schema.fields}
    for field in schema.fields:
        existing = known.get(field.name.lower())
        if existing is not None and existing.dataType != field.dataType:
            raise TypeError(
                f"{field.name} is {existing.dataType.simpleString()} in {name}, "
                f"not {field.dataType.simpleString()}"
            )
    added = [field for field in schema.fields if field.name.lower() not in known]
    if added:
        columns = nullable_ddl(T.StructType(added))
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")


def table_detail(spark: SparkSession, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Files, bytes and rows of a table, in total or per partition.

    Reads file metadata columns only. Each file is first reduced to one row.
    """
    files = (
        spark.table(name)
        .groupBy(*by, F.col("_metadata.file_path").alias("file"))
        .agg(
            F.max(F.col("_metadata.file_size")).alias("bytes"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("bytes").alias("size_in_bytes"),
        F.sum("rows").alias("num_rows"),
    )


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [column.name for column in spark.catalog.listColumns(name) if column.isPartition]


def _same_columns(left: DataFrame, right: DataFrame) -> bool:
    def columns(df: DataFrame) -> list[tuple[str, str]]:
        return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]

    return columns(left) == columns(right)


def nullable_ddl(schema: T.StructType) -> str:
    """The columns as SQL, all of them nullable."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).toDDL()


def new_version(root: str, name: str) -> str:
    return f"{root}/{name}/v-{uuid.uuid4().hex[:12]}"


def property_list(properties: Mapping[str, str]) -> str:
    return ", ".join(f"'{sql_text(k)}'='{sql_text(v)}'" for k, v in properties.items())


def sql_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
