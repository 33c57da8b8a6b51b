from __future__ import annotations

import os

import pytest
from frames import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.scratch import fresh_name
from stratalake.sinks import tables
from stratalake.sinks import (
    append_evolving,
    create_or_upsert,
    declare_view,
    materialize,
    overwrite_files,
    publish_version,
    register_table,
    reused,
    stored,
    table_detail,
    upsert,
)

KEYED = "k int, v int"


def frame(spark, *data, schema=KEYED):
    return spark.createDataFrame(list(data), schema)


def test_upsert_updates_and_inserts(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 10), (2, 20)), name, f"{folder}/first")
    assert rows(upsert(frame(spark, (2, 21), (3, 30)), name, "k", folder)) == [
        (1, 10),
        (2, 21),
        (3, 30),
    ]
    assert rows(spark.table(name)) == [(1, 10), (2, 21), (3, 30)]


def test_upsert_keeps_null_keys_of_both_sides(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 10), (None, 1)), name, f"{folder}/first")
    result = upsert(frame(spark, (1, None), (None, 2)), name, "k", folder)
    assert rows(result) == [(1, None), (None, 1), (None, 2)]


def test_upsert_updates_every_copy_of_a_row(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 10), (1, 11), (2, 20)), name, f"{folder}/first")
    assert rows(upsert(frame(spark, (1, 5)), name, "k", folder)) == [(1, 5), (1, 5), (2, 20)]


def test_upsert_refuses_two_changes_of_one_row(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 10)), name, f"{folder}/first")
    with pytest.raises(ValueError, match="several source rows"):
        upsert(frame(spark, (1, 11), (1, 12)), name, "k", folder)
    assert rows(spark.table(name)) == [(1, 10)]
    # New rows may repeat: they match nothing.
    result = upsert(frame(spark, (2, 1), (2, 2)), name, "k", folder)
    assert rows(result) == [(1, 10), (2, 1), (2, 2)]


def test_upsert_by_two_keys_ignores_column_order(spark, folder):
    name = fresh_name("t")
    publish_version(
        frame(spark, ("a", 1, 10), ("a", 2, 20), schema="x string, y int, v int"),
        name,
        f"{folder}/first",
    )
    change = frame(spark, (21, 2, "a"), (30, 2, "b"), schema="v int, y int, x string")
    result = upsert(change, name, ["x", "y"], folder)
    assert rows(result) == [("a", 1, 10), ("a", 2, 21), ("b", 2, 30)]
    with pytest.raises(ValueError, match="lacks"):
        upsert(change.drop("v"), name, ["x", "y"], folder)


pairs = st.dictionaries(st.integers(0, 6), st.integers(0, 99), max_size=5)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_upsert_twice_is_upsert_once(spark, tmp_path_factory, old, new):
    folder, name = str(tmp_path_factory.mktemp("upsert")), fresh_name("t")
    publish_version(frame(spark, *old.items()), name, f"{folder}/first")
    for _ in range(2):
        assert rows(upsert(frame(spark, *new.items()), name, "k", folder)) == sorted(
            {**old, **new}.items(), key=repr
        )


def test_upsert_rewrites_only_the_partitions_it_touches(spark, folder):
    name, schema = fresh_name("t"), "day string, k int, v int"
    data = [("a/b 1", 1, 10), ("it's 2", 1, 20), ("it's 2", 2, 21), ("3%", 1, 30), (None, 1, 40)]
    publish_version(frame(spark, *data, schema=schema), name, f"{folder}/first", ["day"])
    first = f"{folder}/first"
    change = frame(
        spark, ("it's 2", 2, 99), ("it's 2", 3, 1), ("new=4", 1, 1), (None, 1, 5), schema=schema
    )
    result = upsert(change, name, ["day", "k"], folder)
    assert rows(result.select("day", "k", "v")) == sorted(
        [
            ("3%", 1, 30),
            ("a/b 1", 1, 10),
            ("it's 2", 1, 20),
            ("it's 2", 2, 99),
            ("it's 2", 3, 1),
            ("new=4", 1, 1),
            (None, 1, 40),
            (None, 1, 5),
        ],
        key=repr,
    )
    from_first = result.where(F.col("_metadata.file_path").contains(first))
    assert rows(from_first.select("day")) == [("3%",), ("a/b 1",)]
    assert rows(upsert(change.limit(0), name, ["day", "k"], folder)) == rows(result)


def test_untouched_partitions_are_not_read(spark, folder):
    data = spark.range(20).selectExpr("id", "CAST(id % 5 AS int) AS a", "'x' AS b")
    name = fresh_name("t")
    publish_version(data, name, f"{folder}/t", ["a", "b"])
    touched = [F.struct(F.lit(1).alias("a"), F.lit("x").alias("b"))]
    some = spark.table(name).where(F.struct("a", "b").isin(touched))
    plan = physical_plan(some)
    assert "PartitionFilters: [struct(a" in plan and "(1 paths)" in plan
    assert some.count() == 4


def test_upsert_by_other_keys_may_move_rows_between_partitions(spark, folder):
    name, schema = fresh_name("t"), "part string, k int"
    data = frame(spark, ("a", 1), ("b", 2), schema=schema)
    publish_version(data, name, f"{folder}/1", ["part"], "by part", {"team": "x"})
    result = upsert(frame(spark, ("b", 1), schema=schema), name, "k", folder)
    assert rows(result.select("part", "k")) == [("b", 1), ("b", 2)]
    assert rows(spark.table(name).where("part = 'a'")) == []
    assert spark.catalog.getTable(name).description == "by part"
    assert dict(rows(spark.sql(f"SHOW TBLPROPERTIES {name}")))["team"] == "x"


def test_create_or_upsert(spark, folder):
    name = fresh_name("t")
    assert rows(create_or_upsert(frame(spark, (1, 1)), name, "k", folder)) == [(1, 1)]
    assert rows(create_or_upsert(frame(spark, (1, 2)), name, "k", folder)) == [(1, 2)]


def test_small_change_does_not_shuffle_the_table(spark, folder):
    # The joins of ``upsert`` read the table on the left: with a small right side
    # they are broadcast joins.
    frame(spark, (1, 1)).write.parquet(f"{folder}/small")
    spark.range(10).selectExpr("CAST(id AS int) k", "1 AS v").write.parquet(f"{folder}/table")
    table, small = spark.read.parquet(f"{folder}/table"), spark.read.parquet(f"{folder}/small")
    for how in ("left_semi", "left"):
        plan = physical_plan(table.join(small, "k", how))
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_new_version_leaves_the_old_files(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 1)), name, f"{folder}/one")
    earlier = spark.read.parquet(f"{folder}/one")
    publish_version(frame(spark, (2, 2)), name, f"{folder}/two")
    assert rows(spark.table(name)) == [(2, 2)]
    assert rows(earlier) == [(1, 1)]


def test_new_version_may_have_other_columns(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 1)), name, f"{folder}/one")
    publish_version(frame(spark, ("x",), schema="s string"), name, f"{folder}/two")
    assert rows(spark.table(name)) == [("x",)]
    for number, partition_by in enumerate((["k"], [], ["v"])):
        data = frame(spark, (number, 5))
        publish_version(data, name, f"{folder}/partitioned-{number}", partition_by)
        assert rows(spark.table(name).select("k", "v")) == [(number, 5)]


def test_partitioned_files_are_pruned(spark, folder):
    data = spark.range(100).selectExpr("id", "CAST(id % 4 AS string) AS part")
    overwrite_files(data, folder + "/t", partition_by=["part"])
    folders = sorted(entry for entry in os.listdir(folder + "/t") if "=" in entry)
    assert folders == [f"part={i}" for i in range(4)]
    one = spark.read.parquet(folder + "/t").where("part = '2'")
    assert one.count() == 25
    assert "PartitionFilters: [isnotnull(part" in physical_plan(one)


def test_partitioned_table_and_its_detail(spark, folder):
    name = fresh_name("t")
    data = spark.range(90).selectExpr("id", "CAST(id % 3 AS string) AS part")
    stored = materialize(data, name, folder, comment="it's stored", partition_by=["part"])
    assert stored.count() == 90
    total = table_detail(spark, name).first()
    files = [
        os.path.getsize(os.path.join(where, file))
        for where, _, names in os.walk(folder)
        for file in names
        if file.endswith(".parquet")
    ]
    assert total["num_files"] == len(files)
    assert total["size_in_bytes"] == sum(files)
    assert total["num_rows"] == 90
    by_part = table_detail(spark, name, by=["part"])
    assert rows(by_part.select("part", "num_rows")) == [("0", 30), ("1", 30), ("2", 30)]


def test_comment_and_properties_are_kept(spark, folder):
    name = fresh_name("t")
    materialize(frame(spark, (1, 1)), name, folder, "it's a table", {"owner's": "x\\y"})
    assert spark.catalog.getTable(name).description == "it's a table"
    properties = dict(rows(spark.sql(f"SHOW TBLPROPERTIES {name}")))
    assert properties["owner's"] == "x\\y"
    materialize(frame(spark, (2, 2)), name, folder, "again", {"owner's": "z"})
    assert rows(spark.table(name)) == [(2, 2)]
    assert spark.catalog.getTable(name).description == "again"
    assert dict(rows(spark.sql(f"SHOW TBLPROPERTIES {name}")))["owner's"] == "z"


def test_register_replaces_the_entry_but_not_the_files(spark, folder):
    name = fresh_name("t")
    overwrite_files(frame(spark, (1, 1)), f"{folder}/one")
    overwrite_files(frame(spark, (2, 2)), f"{folder}/two")
    register_table(spark, name, f"{folder}/one")
    register_table(spark, name, f"{folder}/two")
    assert rows(spark.table(name)) == [(2, 2)]
    assert rows(spark.read.parquet(f"{folder}/one")) == [(1, 1)]


def test_appending_adds_columns_and_keeps_rows(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 1)), name, f"{folder}/t")
    append_evolving(frame(spark, ("x", 2), schema="s string, K int"), name)
    append_evolving(frame(spark, (3, 3)), name)
    assert rows(spark.table(name).select("k", "v", "s")) == [
        (1, 1, None),
        (2, None, "x"),
        (3, 3, None),
    ]
    with pytest.raises(TypeError, match="v is int"):
        append_evolving(frame(spark, (4, "four"), schema="k int, v string"), name)


def test_appending_to_a_partitioned_table(spark, folder):
    name = fresh_name("t")
    data = frame(spark, (1, "a"), (2, "b"), schema="k int, part string")
    publish_version(data, name, f"{folder}/t", partition_by=["part"])
    later = frame(spark, ("c", 3, 9), schema="part string, k int, extra int")
    appended = append_evolving(later, name)
    assert rows(appended.select("k", "part", "extra")) == [
        (1, "a", None),
        (2, "b", None),
        (3, "c", 9),
    ]


def test_view_is_not_stored(spark):
    name = fresh_name("v")
    assert rows(declare_view(frame(spark, (1, 1)), name)) == [(1, 1)]
    assert spark.catalog.getTable(name).isTemporary


def test_reused_frame_is_released(spark):
    df = frame(spark, (1, 1))
    with reused(df) as kept:
        assert kept.storageLevel.useMemory and kept.storageLevel.useDisk
        assert kept.count() == 1
    assert not df.storageLevel.useMemory


def test_stored_frame_is_read_from_files(spark):
    shape = "id bigint, s struct<a int, b array<string>>, t string"
    df = frame(spark, (1, (None, None), "x"), (2, None, None), (3, (3, ["y", None]), ""), schema=shape)
    with stored(df.withColumn("r", F.rand())) as kept:
        assert kept.columns == ["id", "s", "t", "r"] and "Scan parquet" in physical_plan(kept)
        assert rows(kept) == rows(kept)
        assert rows(kept.drop("r")) == rows(df)
        assert not kept.storageLevel.useMemory


def test_a_driver_lost_between_renames_leaves_a_table_to_recover(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, (1, 10)), name, f"{folder}/first")
    old, new = f"{name}_old_0123456789ab", f"{name}_new_0123456789ab"
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"CREATE TABLE {new} USING parquet LOCATION '{folder}/first'")
    spark.sql(f"CREATE TABLE {name}_old_of_mine (k int) USING parquet")
    assert tables.recover_table(spark, name)
    assert rows(spark.table(name)) == [(1, 10)]
    left = [row.tableName for row in spark.sql(f"SHOW TABLES LIKE '{name}*'").collect()]
    assert sorted(left) == [name, f"{name}_old_of_mine"]
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    assert rows(upsert(frame(spark, (1, 11)), name, "k", folder)) == [(1, 11)]
    spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    register_table(spark, name, f"{folder}/first")
    assert rows(spark.table(name)) == [(1, 10)]
    assert tables.recover_table(spark, fresh_name("none")) is False


def test_failed_registration_leaves_the_table(spark, folder, monkeypatch):
    name = publish_version(frame(spark, (1, 10)), "kept_entry", f"{folder}/first")
    before = sorted(map(tuple, name.collect()))
    def broken(spark, entry):
        raise RuntimeError("no catalog")

    monkeypatch.setattr(tables, "partition_columns", broken)
    with pytest.raises(RuntimeError):
        register_table(spark, "kept_entry", f"{folder}/first")
    assert sorted(map(tuple, spark.table("kept_entry").collect())) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_entry_")]
