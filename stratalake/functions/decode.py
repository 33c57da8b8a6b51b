"""Turning raw bytes and documents into typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from operator import itemgetter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bytes_to_text(column: str | Column) -> Column:
    """UTF-8 bytes as text.

    A plain cast stays in generated code and, unlike ``decode``, does not fail
    the job on bytes that are not valid UTF-8.
    """
    return _column(column).cast("string")


def infer_xml_schema(
    texts: DataFrame,
    column: str,
    row_tag: str,
) -> T.StructType:
    """One schema that fits every document in a text column.

    Each partition infers its own part and the parts are merged, so only the
    schema reaches the driver. The whole column is read, and goes through Python;
    documents that are files are better inferred by ``infer_xml_files``.
    """
    reader = texts.sparkSession.read.option("rowTag", row_tag)
    documents = texts.select(column).where(F.col(column).isNotNull())
    # The reader's only entry point for documents held in a column is an RDD of strings.
    return reader.xml(documents.rdd.map(itemgetter(0))).schema


def infer_xml_files(spark: SparkSession, path: str, row_tag: str) -> T.StructType:
    """One schema that fits every ``row_tag`` element of the files.

    The files are read by the JVM, element by element: no Python, and no document held
    as one value.
    """
    return spark.read.option("rowTag", row_tag).xml(path).schema


def parse_xml(
    column: str | Column,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
) -> Column:
    """One struct per document.

    Malformed documents give nulls; a ``_corrupt_record`` string field in the
    schema keeps their text. A value that does not fit its type costs the rest of
    the document; read elements with ``read_xml_rows``, or declare doubtful fields
    as strings, where that is too much. The parser reads every field of the schema, used or
    not, so pass a schema reduced with ``narrow_schema`` when few are needed.
    """
    return F.from_xml(_column(column), _struct(schema), dict(options or {}))


def parse_json(
    column: str | Column,
    schema: T.StructType | str,
    options: Mapping[str, str] | None = None,
) -> Column:
    """One struct per JSON text or UTF-8 payload."""
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    return F.from_json(bytes_to_text(column), ddl, dict(options or {}))


def narrow_schema(schema: T.StructType, paths: Iterable[str]) -> T.StructType:
    """The part of a nested schema that leads to the given dotted paths.

    Arrays are passed through, so ``Items.Item.Price`` works whether ``Item`` is
    one struct or many. A path that ends on a struct keeps all of it.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    missing = set(wanted) - set(schema.fieldNames())
    if missing:
        raise ValueError(f"no such field: {sorted(missing)}")
    return T.StructType(
        [
            T.StructField(
                field.name, _narrow_type(field.dataType, wanted[field.name]), field.nullable
            )
            for field in schema.fields
            if field.name in wanted
        ]
    )


def _narrow_type(data_type: T.DataType, paths: list[str]) -> T.DataType:
    if "" in paths:
        return data_type
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_narrow_type(data_type.elementType, paths), data_type.containsNull)
    if isinstance(data_type, T.StructType):
        return narrow_schema(data_type, paths)
    raise ValueError(f"{paths} lead into a {data_type.simpleString()}")


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
