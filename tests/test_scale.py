"""Skewed input and plan shapes."""

from __future__ import annotations

import os
import re

import pytest
from frames import physical_plan, rows
from pyspark.sql import functions as F

from stratalake import landing
from stratalake.operators import with_key_stats
from stratalake.plans import purchase_orders as po
from stratalake.queries import ALL
from stratalake.scratch import fresh_dir, scratch_root
from stratalake.sinks.merge import _merged
from stratalake.sinks.tables import overwrite_files
from stratalake.sources import read_binary_files, read_json, read_xml_rows, with_source_path


@pytest.fixture
def skewed(spark, tmp_path):
    """Tables in which one order and one part hold a third of the lines."""
    sf_dir = str(tmp_path)
    for name in ("orders", "customer", "nation", "part"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(
            f"{sf_dir}/{name}.parquet"
        )
    third = F.pmod(F.xxhash64("l_orderkey", "l_extendedprice"), F.lit(3))
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.withColumns(
        {
            "l_orderkey": F.when(third == 0, F.lit(7)).otherwise(F.col("l_orderkey")),
            "l_partkey": F.when(third == 1, F.lit(3)).otherwise(F.col("l_partkey")),
        }
    ).write.parquet(f"{sf_dir}/lineitem.parquet")
    return sf_dir


def test_large_order_is_split_and_summed_whole(spark, skewed):
    elements = landing.order_elements(spark, skewed, items_per_element=50)
    sizes = elements.select("_PurchaseOrderNumber", F.size("Items.Item").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] < 150
    assert sizes.where("_PurchaseOrderNumber = 7").count() > 20
    expected = (
        spark.read.parquet(f"{skewed}/lineitem.parquet")
        .groupBy("l_orderkey")
        .agg(F.round(F.sum("l_extendedprice"), 2))
    )
    orders = elements.withColumn("_OrderDate", F.col("_OrderDate").cast("date"))
    totals = po.totals(po.detail(orders, fan_out=False)).where("Total_Price IS NOT NULL")
    assert rows(totals.withColumn("Total_Price", F.round("Total_Price", 2))) == rows(expected)


def test_lines_are_shuffled_once_for_their_orders(spark, skewed, settings):
    """Finding the large orders moves counts only, however large their estimate is."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = physical_plan(landing.order_elements(spark, skewed, items_per_element=50))
    joins = [line for line in plan.splitlines() if "large_order" in line and "Join" in line]
    assert len(joins) == 2 and all("BroadcastHashJoin" in line for line in joins)


def test_order_files_have_a_line_per_element_and_little_space(spark, skewed, folder):
    elements = landing.order_elements(spark, skewed)
    landing.write_order_files(elements, f"{folder}/files", 100)
    lines = spark.read.text(f"{folder}/files").where("value LIKE ' %'")
    spaces = F.length(F.regexp_extract("value", "^( *)<", 1))
    assert lines.agg(F.max(spaces)).first()[0] == 4
    back = po.read_orders(spark, f"{folder}/files")
    dated = elements.withColumn("_OrderDate", F.col("_OrderDate").cast("date"))
    names = back.columns
    assert back.exceptAll(dated.select(*names)).isEmpty()
    assert dated.select(*names).exceptAll(back).isEmpty()


def test_rows_are_read_from_packed_order_files(spark, skewed):
    """What readers of rows need is stored once, compressed, and none of it is lost."""
    path = landing.packed_order_files(spark, skewed)
    names = [name for name in os.listdir(path) if name.startswith("part-")]
    assert names and all(name.endswith(".xml.gz") for name in names)
    plain = spark.read.text(path).agg(F.sum(F.length("value") + 1)).first()[0]
    assert 5 * sum(os.path.getsize(f"{path}/{name}") for name in names) < plain
    elements = landing.order_elements(spark, skewed)
    dated = elements.withColumn("_OrderDate", F.col("_OrderDate").cast("date"))
    back = po.read_orders(spark, path)
    assert back.count() == elements.count()
    assert po.detail(back).exceptAll(po.detail(dated)).isEmpty()


@pytest.mark.parametrize("name", ["row_count", "po_quantities", "part_window_stats", "po_chain"])
def test_queries_of_rows_write_no_plain_order_files(spark, skewed, monkeypatch, name):
    packings = []
    write = landing.write_order_files

    def watched(*args, **options):
        packings.append(options.get("packed", False))
        write(*args, **options)

    monkeypatch.setattr(landing, "write_order_files", watched)
    assert ALL[name].run(spark, skewed).count() > 0
    assert packings == [True]


def test_lines_are_moved_flat(spark, skewed, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = physical_plan(landing.order_elements(spark, skewed))
    moved = re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, l_share", plan).start()
    assert "collect_list" in plan[:moved] and "collect_list" not in plan[moved:]


def test_large_orders_are_counted_exactly(spark):
    counts = {1: 51, 2: 50, 3: 120, None: 90, **{k: 4 for k in range(10, 400)}}
    keys = [(key,) for key, n in counts.items() for _ in range(n)]
    lines = spark.createDataFrame(keys, "l_orderkey bigint").repartition(3)
    assert rows(landing._large_orders(lines, 50)) == [(1, 2), (3, 3)]
    assert landing._large_orders(lines.limit(0), 50).isEmpty()


def test_documents_hold_nothing_between_elements_of_an_order(spark, skewed):
    """Files that are read as documents spend no bytes on lines, and lose no element."""
    path = landing.order_files(spark, skewed)
    names = [name for name in os.listdir(path) if name.startswith("part-")]
    assert names and all(name.endswith(".xml") for name in names)
    texts = spark.read.text(path, wholetext=True)
    assert texts.where(F.col("value").rlike(r">\s+<(?!/?PurchaseOrder)")).isEmpty()
    packed = po.read_orders(spark, landing.packed_order_files(spark, skewed))
    whole = po.summary(po.bronze(read_binary_files(spark, path, "*.xml")))
    assert whole.count() == packed.count()
    assert po.detail(whole).exceptAll(po.detail(packed)).isEmpty()
    assert po.detail(packed).exceptAll(po.detail(whole)).isEmpty()


def test_spoilt_deliveries_are_written_from_stored_orders(spark, monkeypatch):
    """The orders are built from lines once, not for each of the files written."""
    plans = []
    write = landing.write_order_files

    def watched(elements, path, orders_per_file):
        plans.append(physical_plan(elements))
        write(elements, path, orders_per_file)

    monkeypatch.setattr(landing, "write_order_files", watched)
    ALL["po_bronze_bad_records"].run(spark, "/root/testdata/sf0.001")
    assert len(plans) == 2
    assert not any("Join" in plan or "collect_list" in plan for plan in plans)


def test_details_by_state_move_items_nested(spark):
    schema = po.ORDER_SCHEMA.simpleString()
    item = "named_struct('_PartNumber', {}, 'ProductName', 'p', 'Quantity', 1D, 'Price', 2D)"
    orders = spark.sql(f"""
        SELECT o.* FROM (SELECT explode(array(
          named_struct('_PurchaseOrderNumber', 1L, '_OrderDate', date'2024-01-01',
            'Address', array(named_struct('_Type', 'S', 'Name', 'a', 'State', 'X'),
                             named_struct('_Type', 'B', 'Name', 'b', 'State', 'Y')),
            'Items', named_struct('Item', array({item.format('7L')}, {item.format('8L')}))),
          named_struct('_PurchaseOrderNumber', NULL, '_OrderDate', NULL,
            'Address', array(named_struct('_Type', 'S', 'Name', 'a', 'State', NULL)),
            'Items', NULL),
          named_struct('_PurchaseOrderNumber', 1L, '_OrderDate', NULL,
            'Address', NULL, 'Items', NULL))) AS o)""")
    orders = orders.select(*[F.col(f.name).cast(f.dataType) for f in po.ORDER_SCHEMA.fields])
    assert schema == orders.schema.simpleString()
    gathered = landing.details_by_state(orders)
    assert gathered.columns == po.detail(orders).columns
    assert rows(gathered) == rows(po.detail(orders)) and gathered.count() == 5
    plan = physical_plan(gathered)
    # From the top: items become rows after the shuffle, addresses before.
    assert plan.index("explode(Item") < plan.index("Exchange") < plan.index("Address")


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def put(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_partition_is_written_by_several_tasks(spark, folder, settings):
    settings(
        spark__sql__shuffle__partitions="40",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB",
    )
    part = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('p', id % 20) END"
    data = spark.range(60_000).selectExpr("id", f"{part} AS part", "uuid() AS pad")
    overwrite_files(data.repartition(8), folder + "/t", partition_by=["part"])

    def files(part):
        return len([f for f in os.listdir(f"{folder}/t/part={part}") if f.endswith(".parquet")])

    assert files("hot") > 2
    assert files("p1") == 1
    assert spark.read.parquet(folder + "/t").count() == 60_000


def test_hot_key_is_split_in_every_large_join(spark, folder, settings):
    """A third of the rows share one key; no join may leave them to one task."""
    rows_in = 60_000
    key = "CASE WHEN id % 3 = 0 THEN 7 ELSE id END"
    hot = spark.range(rows_in).selectExpr(f"{key} AS k", "CAST(id AS double) AS v", "uuid() AS pad")
    hot.repartition(8).write.parquet(f"{folder}/hot")
    spark.range(rows_in).selectExpr("id AS k", "-1.0 AS v", "uuid() AS pad").write.parquet(
        f"{folder}/changes"
    )
    table, changes = spark.read.parquet(f"{folder}/hot"), spark.read.parquet(f"{folder}/changes")
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    stats = with_key_stats(table, "k", "v")
    merged = _merged(table, changes, ["k"], "t")
    inserted = _merged(changes.where("k <> 7"), table, ["k"], "t")
    for df, join in ((stats, "Inner"), (merged, "LeftOuter"), (inserted, "LeftAnti")):
        df.foreach(lambda row: None)
        split = [line for line in physical_plan(df).splitlines() if "(skew=true)" in line]
        assert any(f", {join}" in line for line in split), (join, split)


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical_plan(ALL["filter_eq"].run(spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_mktsegment:string>" in plan


def test_totals_read_two_columns(spark):
    name = landing.order_details(spark, "/root/testdata/sf0.001")
    plan = physical_plan(po.totals(spark.table(name)))
    assert "ReadSchema: struct<Price:double,_PurchaseOrderNumber:bigint>" in plan
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_part_summary_groups_without_a_sort(spark):
    details = spark.createDataFrame([], "_PartNumber bigint, ProductName string, Quantity double")
    plan = physical_plan(po.part_summary(details))
    assert "Window" not in plan


def test_rows_know_their_file(spark, folder):
    spark.range(3).write.json(folder + "/json")
    named = with_source_path(read_json(spark, folder + "/json"))
    assert named.where("path LIKE '%.json'").count() == 3
    elements = spark.range(3).selectExpr("id AS _id", "'x' AS a")
    elements.write.format("xml").option("rowTag", "r").save(folder + "/xml")
    named = with_source_path(read_xml_rows(spark, folder + "/xml", "r", "_id bigint"))
    assert named.where("path LIKE '%.xml'").count() == 3


class Settings:
    """Stands in for a session: only its settings are asked."""

    def __init__(self, **values):
        self.values = {key.replace("__", "."): value for key, value in values.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    shared = Settings(
        spark__app__id="app-1", spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/"
    )
    assert scratch_root(shared) == "hdfs:///shared/stratalake/app-1"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Settings(spark__app__id="app-2", spark__master="yarn"))
    alone = Settings(spark__app__id="local-3", spark__master="local[2]")
    assert scratch_root(alone) == scratch_root(alone)


def test_scratch_is_where_the_cluster_says(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert scratch_root(spark).startswith(configured)
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
