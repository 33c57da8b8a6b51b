"""Partitioned datasets whose changed partitions are shown by one catalog change.

The rows lie in the table ``<name>_files``, partitioned by the given columns and by
``part_id``, which is new for every partition at every upsert. A manifest, a small Parquet
folder, lists the part that counts for each partition, and ``<name>`` is a view of the
rows whose part is in its manifest. An upsert writes new parts for the partitions that
its source touches, and a new manifest; replacing the view then shows all of them at
once. Until then, and if the driver is lost, readers see what they saw before.

Partitions are chosen by joins with the manifest, for which Spark prunes the folders when
the join runs. Parts that no manifest lists any more stay for a retention rule, so that
readers of an older view can finish.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .feeds import MANIFEST
from .tables import (
    new_version,
    nullable_ddl,
    overwrite_files,
    property_list,
    sql_text,
    table_properties,
)

PART = "part_id"
_BY = "stratalake.partition_by"
#: Partitions that one statement adds to the catalog.
_STATEMENT = 500


def create_partitioned(
    df: DataFrame,
    name: str,
    root: str,
    partition_by: Sequence[str],
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Store ``df`` as the partitioned dataset ``name``; its files lie under ``root``."""
    spark = df.sparkSession
    if PART in (column.lower() for column in df.columns):
        raise ValueError(f"{PART} is the column that tells parts apart")
    plain = [field for field in df.schema.fields if field.name not in partition_by]
    by = [df.schema[column] for column in partition_by]
    files = T.StructType([*plain, *by, T.StructField(PART, T.StringType())])
    spark.sql(
        f"CREATE TABLE {files_of(name)} ({nullable_ddl(files)}) USING parquet "
        f"PARTITIONED BY ({', '.join(f'`{c}`' for c in [*partition_by, PART])}) "
        f"LOCATION '{sql_text(f'{root}/{name}/files')}'"
    )
    stored = {**(properties or {}), _BY: ",".join(partition_by)}
    parts = _write_parts(df, name, root, partition_by)
    return _show(spark, name, root, df.columns, parts, stored, comment)


def partitioned_by(spark: SparkSession, name: str) -> list[str]:
    """The partition columns of a partitioned dataset; none for anything else."""
    by = table_properties(spark, name).get(_BY)
    return by.split(",") if by else []


def files_of(name: str) -> str:
    return f"{name[:-1]}_files`" if name.endswith("`") else f"{name}_files"


def touched(source: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(the rows of the partitions that ``source`` has, the manifest without these).

    ``source`` is small enough to be read twice, such as a stored one.
    """
    spark = source.sparkSession
    properties = table_properties(spark, name)
    by = properties[_BY].split(",")
    manifest = spark.read.parquet(properties[MANIFEST])
    wanted = source.select(*by).distinct().select(*[F.col(c).alias(f"__{c}") for c in by])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    kept = manifest.join(wanted, same, "left_anti")
    parts = manifest.join(wanted, same, "left_semi").select(PART).where(F.col(PART) > "")
    files = spark.table(files_of(name)).withColumnRenamed(PART, "__part")
    rows = files.join(parts, F.col("__part") == F.col(PART), "left_semi").drop("__part")
    return rows.select(*spark.table(name).columns), kept


def replace_parts(merged: DataFrame, kept: DataFrame, name: str, root: str) -> str:
    """Write new parts with the rows of ``merged``; the manifest of these and the ``kept``."""
    by = partitioned_by(merged.sparkSession, name)
    parts = _write_parts(merged, name, root, by)
    return _write_manifest(kept.unionByName(parts), name, root)


def show_manifest(spark: SparkSession, name: str, manifest: str) -> DataFrame:
    """Make the parts of ``manifest`` the content of the dataset: one change of the catalog."""
    return _replace_view(
        spark,
        name,
        spark.table(name).columns,
        {**table_properties(spark, name), MANIFEST: manifest},
        spark.catalog.getTable(name).description,
    )


def _write_parts(df: DataFrame, name: str, root: str, partition_by: Sequence[str]) -> DataFrame:
    """Write the rows as new parts, known to the catalog; the manifest's rows for them."""
    spark = df.sparkSession
    upsert_id = uuid.uuid4().hex[:12]
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in partition_by])), 256)
    part = F.concat(F.lit(f"{upsert_id}-"), F.substring(digest, 1, 32))
    columns = [c for c in df.columns if c not in partition_by]
    path = f"{root}/{name}/files/u-{upsert_id}"
    rows = df.select(*columns, *partition_by, part.alias(PART))
    # One task a partition, or several for a large one; folders are known from the paths.
    overwrite_files(rows, path, [*partition_by, PART])
    schema = spark.table(files_of(name)).schema
    written = spark.read.schema(schema).parquet(path)
    parts = written.select(*partition_by, PART).distinct()
    _add_partitions(spark, name, path, parts, partition_by)
    return parts


def _add_partitions(
    spark: SparkSession, name: str, path: str, parts: DataFrame, partition_by: Sequence[str]
) -> None:
    """Tell the catalog of the new folders: as many names as the write made folders."""
    # Folders as URIs, in which the escapes that are part of their names are escaped again.
    folder = F.regexp_extract(F.input_file_name(), rf"/({partition_by[0]}=.*)/[^/]+$", 1)
    spec = F.concat_ws(
        ", ",
        *[F.concat(F.lit(f"`{c}`="), _literal(F.col(c))) for c in [*partition_by, PART]],
    )
    schema = spark.table(files_of(name)).schema
    found = (
        spark.read.schema(schema)
        .parquet(path)
        .select(spec.alias("spec"), folder.alias("folder"))
        .distinct()
        .collect()
    )
    for start in range(0, len(found), _STATEMENT):
        listed = " ".join(
            f"PARTITION ({row.spec}) LOCATION '{sql_text(path)}/{sql_text(unquote(row.folder))}'"
            for row in found[start : start + _STATEMENT]
        )
        spark.sql(f"ALTER TABLE {files_of(name)} ADD IF NOT EXISTS {listed}")


def _literal(column: Column) -> Column:
    """A partition value as SQL text."""
    text = F.regexp_replace(column.cast("string"), r"(['\\])", r"\\$1")
    return F.when(column.isNull(), F.lit("null")).otherwise(F.concat(F.lit("'"), text, F.lit("'")))


def _write_manifest(parts: DataFrame, name: str, root: str) -> str:
    path = f"{new_version(root, name)}-manifest"
    parts.write.parquet(path)
    return path


def _show(
    spark: SparkSession,
    name: str,
    root: str,
    columns: Sequence[str],
    parts: DataFrame,
    properties: Mapping[str, str],
    comment: str | None,
) -> DataFrame:
    manifest = _write_manifest(parts, name, root)
    return _replace_view(spark, name, columns, {**properties, MANIFEST: manifest}, comment)


def _replace_view(
    spark: SparkSession,
    name: str,
    columns: Sequence[str],
    properties: Mapping[str, str],
    comment: str | None,
) -> DataFrame:
    manifest = properties[MANIFEST]
    if "`" in manifest:
        raise ValueError("a path in SQL cannot contain a backtick")
    described = f"COMMENT '{sql_text(comment)}' " if comment else ""
    # Every part has a name; the condition has Spark prune folders by those of the manifest.
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} {described}TBLPROPERTIES ({property_list(properties)}) AS "
        f"SELECT {', '.join(f'`{c}`' for c in columns)} FROM {files_of(name)} "
        f"WHERE {PART} IN (SELECT {PART} FROM parquet.`{manifest}` WHERE {PART} > '')"
    )
    return spark.table(name)
