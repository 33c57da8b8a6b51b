"""XML schemas that are kept and widened from run to run.

Inferring a schema reads every file. Here each file is read for that once: a stream over
the folder hands out the files that are new, their schema is inferred and merged with the
one that is kept, and the result is stored beside the stream's checkpoint.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .streams import stream_binary_files

#: Files whose names go to the reader at a time.
FILES_PER_BATCH = 10_000

#: Types from narrow to wide; of two in a row the later one holds both.
_WIDER = (
    (T.LongType(), T.DecimalType(38, 0), T.DoubleType()),
    (T.DateType(), T.TimestampType()),
)


def merge_schemas(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds values of both: of structs the fields of either, an
    element that repeats in one of them as an array, of types that do not widen a string.

    The order of the arguments makes no difference but for that of the fields, which is
    by name, as the reader's own inference has it.
    """
    if left == right:
        return left
    if isinstance(left, T.NullType) or isinstance(right, T.NullType):
        return right if isinstance(left, T.NullType) else left
    if isinstance(left, T.ArrayType) or isinstance(right, T.ArrayType):
        one, other = (t.elementType if isinstance(t, T.ArrayType) else t for t in (left, right))
        return T.ArrayType(merge_schemas(one, other))
    if isinstance(left, T.StructType) or isinstance(right, T.StructType):
        return _merge_structs(_as_struct(left), _as_struct(right))
    for chain in _WIDER:
        if left in chain and right in chain:
            return chain[max(chain.index(left), chain.index(right))]
    return T.StringType()


def _as_struct(data_type: T.DataType) -> T.StructType:
    """An element that has text only where another has attributes or children, too."""
    if isinstance(data_type, T.StructType):
        return data_type
    return T.StructType([T.StructField("_VALUE", data_type)])


def _merge_structs(left: T.StructType, right: T.StructType) -> T.StructType:
    types = {field.name: field.dataType for field in left.fields}
    for field in right.fields:
        known = types.get(field.name)
        types[field.name] = merge_schemas(known, field.dataType) if known else field.dataType
    return T.StructType([T.StructField(name, types[name]) for name in sorted(types)])


def kept_xml_schema(
    spark: SparkSession,
    files: str,
    row_tag: str,
    store: str,
    glob: str = "*.xml",
    files_per_batch: int = FILES_PER_BATCH,
) -> T.StructType:
    """The schema of the ``row_tag`` elements of all files that have ever been in ``files``.

    ``store`` keeps it; only files that have come since the last run are read.
    """

    def widen(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [row.path for row in batch.select("path").collect()]
        if not paths:
            return
        found = session.read.option("rowTag", row_tag).xml(paths).schema
        before = _stored(session, store, batch_id)
        merged = merge_schemas(before, found) if before else found
        row = [(batch_id, merged.json())]
        stored = session.createDataFrame(row, "batch_id bigint, schema string").coalesce(1)
        stored.write.mode("overwrite").parquet(f"{store}/schema/{batch_id}")

    names = stream_binary_files(spark, files, glob, max_files=files_per_batch).select("path")
    query = (
        names.writeStream.option("checkpointLocation", f"{store}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(widen)
        .start()
    )
    query.awaitTermination()
    return _stored(spark, store) or T.StructType()


def _stored(spark: SparkSession, store: str, before: int | None = None) -> T.StructType | None:
    """The latest schema, or the latest from before a batch, which may be a repeated one."""
    try:
        rows = (
            spark.read.schema("batch_id bigint, schema string")
            .option("recursiveFileLookup", True)
            .parquet(f"{store}/schema")
        )
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        latest = rows.agg(F.max_by("schema", "batch_id")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return T.StructType.fromJson(json.loads(latest)) if latest else None
