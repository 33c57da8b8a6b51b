"""Upserts: rows of a table replaced by key, others inserted."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_name
from . import feeds, partitioned
from .tables import (
    new_version,
    overwrite_files,
    partition_columns,
    publish_version,
    recover_table,
    register_table,
    sql_text,
)


def upsert(source: DataFrame, name: str, keys: str | Sequence[str], root: str) -> DataFrame:
    """Update the rows of table ``name`` whose keys occur in ``source``, insert the rest.

    Null keys match nothing: they stay in the table and are inserted from the
    source. Two source rows for one existing row raise an error.

    The source is used several times, so it is written out first: it is computed
    once, and Spark knows its size. The joins read the table on the left and the
    source on the right. A small source is broadcast and the table not shuffled;
    if both are large, a hot key of the table can be split.

    The table is rewritten. Of a partitioned dataset (``create_partitioned``) partitioned by
    some of the keys only the partitions that occur in the source are read and written, and
    they are shown together. A plain table partitioned by some of the keys is changed
    partition by partition: use a dataset where readers must not see some of them early.

    If the table is tracked (``track_changes``) the source's rows join its feed.
    """
    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    recover_table(spark, name)
    feeds.complete(spark, name)
    target = spark.table(name)
    extra = [c for c in target.columns if c not in source.columns]
    if extra:
        raise ValueError(f"the source lacks {extra}")
    staged = new_version(root, f"{name}-source")
    # Values take the table's types, as in an insert.
    overwrite_files(
        source.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields]), staged
    )
    source = spark.read.schema(target.schema).parquet(staged)
    dataset_by = partitioned.partitioned_by(spark, name)
    if dataset_by:
        return _upsert_dataset(source, staged, name, keys, root, dataset_by)
    version = new_version(root, name)
    partition_by = partition_columns(spark, name)
    if not set(partition_by) <= set(keys) or not partition_by:
        merged = _merged(target, source, keys, name)
        feeds.begin(spark, name, staged, version)
        shown = publish_version(merged, name, version, partition_by)
        feeds.complete(spark, name)
        return shown

    # One row per folder. As literals they keep the other folders from being read.
    touched = [
        F.struct(*[F.lit(row[c]).cast(target.schema[c].dataType).alias(c) for c in partition_by])
        for row in source.select(*partition_by).distinct().collect()
    ]
    if not touched:
        return target
    affected = target.where(F.struct(*partition_by).isin(touched))
    overwrite_files(_merged(affected, source, keys, name), version, partition_by)
    _move_partitions(spark, name, version, partition_by)
    return spark.table(name)


def _upsert_dataset(
    source: DataFrame,
    staged: str,
    name: str,
    keys: Sequence[str],
    root: str,
    partition_by: Sequence[str],
) -> DataFrame:
    """``upsert`` into a partitioned dataset: new parts first, then one change to show them."""
    spark = source.sparkSession
    if not set(partition_by) <= set(keys):
        raise ValueError(f"a row would move between partitions: {partition_by} are no keys")
    affected, kept = partitioned.touched(source, name)
    merged = _merged(affected, source, keys, name)
    manifest = partitioned.replace_parts(merged, kept, name, root)
    feeds.begin(spark, name, staged, manifest)
    shown = partitioned.show_manifest(spark, name, manifest)
    feeds.complete(spark, name)
    return shown


def _merged(target: DataFrame, source: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows of ``target`` after the upsert of ``source``, which has the same columns."""
    repeated = source.groupBy(*keys).count().where(F.col("count") > 1).select(*keys)
    # Repeated new rows are fine, so the table is asked only if there are any.
    if not repeated.isEmpty() and not target.join(repeated, keys, "left_semi").isEmpty():
        raise ValueError(f"several source rows for one row of {name}")

    change = source.select(
        *[F.col(c).alias(f"__key_{c}") for c in keys],
        F.struct(*target.columns).alias("__change"),
    )
    matches = [F.col(c) == F.col(f"__key_{c}") for c in keys]
    changed = F.col("__change").isNotNull()
    updated = target.join(change, matches, "left").select(
        *[
            F.when(changed, F.col("__change")[c]).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    found = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    found = found.select(*[F.col(c).alias(f"__found_{c}") for c in keys])
    # No key found is null. The null-safe comparison has them shuffled for this join,
    # without which Spark would not split the rows of a hot new key.
    known = [F.col(c).eqNullSafe(F.col(f"__found_{c}")) for c in keys]
    inserted = source.join(found, known, "left_anti")
    return updated.unionByName(inserted)


def _move_partitions(
    spark: SparkSession, name: str, path: str, partition_by: Sequence[str]
) -> None:
    """Point the partitions found under ``path`` at their folders there."""
    scanned = fresh_name("moved")
    register_table(spark, scanned, path, spark.table(name).schema, partition_by)
    folders = [row[0] for row in spark.sql(f"SHOW PARTITIONS {scanned}").collect()]
    spark.sql(f"DROP TABLE {scanned}")
    for folder in folders:
        pairs = [part.split("=", 1) for part in folder.split("/")]
        values = ", ".join(f"`{c}`='{sql_text(unquote(v))}'" for c, v in pairs)
        location = f"LOCATION '{sql_text(path)}/{sql_text(folder)}'"
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({values}) {location}")
        spark.sql(f"ALTER TABLE {name} PARTITION ({values}) SET {location}")
    spark.catalog.refreshTable(name)


def create_or_upsert(
    source: DataFrame, name: str, keys: str | Sequence[str], root: str
) -> DataFrame:
    """``upsert`` into table ``name``, or create it from ``source`` if there is none."""
    if source.sparkSession.catalog.tableExists(name):
        return upsert(source, name, keys, root)
    return publish_version(source, name, new_version(root, name))
