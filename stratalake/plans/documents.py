"""XML documents of any shape, streamed with the file each came from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions.decode import bytes_to_text, infer_xml_files, parse_xml
from ..sources.files import with_source_path
from ..sources.streams import BACKLOG_BYTES, stream_binary_files


def inferred_schema(spark: SparkSession, files: str, root_tag: str) -> T.StructType:
    """Schema of the documents in a folder, from all of them."""
    return infer_xml_files(spark, f"{files}/*.xml", root_tag)


def with_lineage(
    spark: SparkSession, files: str, schema: T.StructType, max_bytes: int | None = BACKLOG_BYTES
) -> DataFrame:
    """Stream of ``payload, path``: each new document parsed, and its file."""
    stream = with_source_path(stream_binary_files(spark, files, "*.xml", max_bytes=max_bytes))
    return stream.select(parse_xml(bytes_to_text("content"), schema).alias("payload"), "path")
