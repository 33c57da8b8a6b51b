"""Batch scans of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines. Without a schema the files are read twice, once to infer it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def query_json_path(
    spark: SparkSession, path: str, query: str = "SELECT * FROM {source}"
) -> DataFrame:
    """SQL over JSON files named by path; ``{source}`` stands for the files."""
    if "`" in path:
        raise ValueError("a path in SQL cannot contain a backtick")
    return spark.sql(query.replace("{source}", f"json.`{path}`"))


def read_xml_rows(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """One row per ``row_tag`` element.

    Elements are streamed out of each file, so files may be larger than a value
    can be. A file is one task: parallelism comes from the number of files.
    Without a schema the files are read twice, once to infer it.

    A malformed element gives nulls. A file that is not text in its encoding fails
    the job, so that nothing of it is lost unseen.
    """
    reader = spark.read.format("xml").option("rowTag", row_tag)
    reader = reader.option("ignoreCorruptFiles", False)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row per file: path, modificationTime, length, content.

    A file has to fit in one value (2 GB); use ``read_xml_rows`` beyond that.
    """
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)


def read_evolving(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Parquet files whose columns have grown over time; older rows get nulls.

    Without a schema the footer of every file is read to merge them. Name the
    columns once there are many files.
    """
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def with_source_path(df: DataFrame, column: str = "path") -> DataFrame:
    """Add the file each row was read from. Apply it right after the scan."""
    return df.withColumn(column, F.col("_metadata.file_path"))
