"""What several operators share: reading tables, storing intermediates, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_dir

#: Texts are handled in slices of about this many bytes, so that a batch of very
#: long texts needs no more memory than one of many short ones.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: a cut in its lineage.

    A lost executor costs a reread of files every machine sees, not a recomputation.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, null texts as empty ones; other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE_BYTES`` of text, one row at least."""
    for batch in batches:
        start, held = 0, 0
        for i, size in enumerate(_lengths(batch.column(column))):
            if held and held + size > SLICE_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def _lengths(texts: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_pylist()
