"""Writing, registering, merging and evolving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import landing
from ..operators.aggregates import sum_per_key
from ..plans.purchase_orders import ORDER, PART, detail, read_orders
from ..scratch import fresh_dir, fresh_name
from ..sinks.feeds import shown_version, track_changes
from ..sinks.merge import create_or_upsert, upsert
from ..sinks.partitioned import create_partitioned
from ..sinks.tables import (
    append_evolving,
    overwrite_files,
    publish_version,
    register_table,
    reused,
    table_detail,
)
from ..sources.streams import stream_table
from ..streaming.runs import run_once
from .registry import Registry

registry = Registry()


@registry.check("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def overwrite_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = landing.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    path = fresh_dir(spark, "overwritten")
    overwrite_files(orders.where("o_orderstatus = 'F'"), path)
    overwrite_files(orders, path)
    return spark.read.parquet(path)


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, l_partkey AS _PartNumber,
           l_quantity AS Quantity, kind AS _Type, n_name AS State
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    CROSS JOIN (VALUES ('Shipping'), ('Billing')) AS address(kind)""")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = spark.table(landing.order_details(spark, sf_dir))
    path = fresh_dir(spark, "by-state")
    overwrite_files(details, path, partition_by=["State"])
    return spark.read.parquet(path).select(
        "_PurchaseOrderNumber", "_PartNumber", "Quantity", "_Type", "State"
    )


@registry.check("""
    SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer GROUP BY c_mktsegment""")
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = landing.table(spark, sf_dir, "customer")
    old, new, name = fresh_dir(spark, "old"), fresh_dir(spark, "new"), fresh_name("customers")
    overwrite_files(customers.where("c_acctbal < 0"), old)
    register_table(spark, name, old)
    overwrite_files(customers, new)
    register_table(spark, name, new, comment="All customers")
    return spark.sql(f"""
        SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM {name} GROUP BY c_mktsegment""")


@registry.check("""
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -o_totalprice END AS o_totalprice
    FROM orders""")
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of status F and P, updated by changed ones of status P and O."""
    orders = landing.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    name = fresh_name("orders")
    root = fresh_dir(spark, "upsert")
    publish_version(orders.where("o_orderstatus <> 'O'"), name, f"{root}/first")
    changes = orders.where("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    return upsert(changes, name, "o_orderkey", root)


@registry.check("""
    SELECT o_orderkey, o_orderpriority, o_orderstatus,
           CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderkey % 3 = 0
                THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
    FROM orders""")
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority without some of two priorities, then changed and new ones of these."""
    orders = landing.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"
    )
    name, root = fresh_name("orders_by_priority"), fresh_dir(spark, "partitioned")
    of_two = F.col("o_orderpriority").isin("1-URGENT", "5-LOW")
    stored = orders.where(~of_two | (F.col("o_orderkey") % 4 != 1))
    create_partitioned(stored, name, root, ["o_orderpriority"])
    signed = F.when(F.col("o_orderkey") % 3 == 0, -F.col("o_totalprice"))
    changes = orders.where(of_two).withColumn(
        "o_totalprice", F.coalesce(signed, F.col("o_totalprice"))
    )
    return upsert(changes, name, ["o_orderkey", "o_orderpriority"], root)


@registry.check("""
    SELECT 'plain' AS kind, o_orderkey, o_orderstatus, o_totalprice
    FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT 'plain', o_orderkey, o_orderstatus, -o_totalprice
    FROM orders WHERE o_orderstatus <> 'F'
    UNION ALL SELECT 'partitioned', o_orderkey, o_orderstatus, o_totalprice
    FROM orders WHERE o_orderstatus <> 'O'
    UNION ALL SELECT 'partitioned', o_orderkey, o_orderstatus, -o_totalprice
    FROM orders WHERE o_orderstatus <> 'F'""")
def stream_after_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a table and of a partitioned dataset by streams, before and after an upsert."""
    orders = landing.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    first = orders.where("o_orderstatus <> 'O'")
    changes = orders.where("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    copies = []
    for kind in ("plain", "partitioned"):
        name, root = fresh_name(f"orders_{kind}"), fresh_dir(spark, kind)
        if kind == "plain":
            publish_version(first, name, f"{root}/first")
        else:
            create_partitioned(first, name, root, ["o_orderstatus"])
        track_changes(spark, name, f"{root}/feed")
        checkpoint, copy = fresh_dir(spark, "checkpoint"), fresh_dir(spark, "copy")
        for change in (None, changes, None):
            if change is not None:
                upsert(change, name, ["o_orderkey", "o_orderstatus"], root)
            run_once(stream_table(spark, name), checkpoint, copy)
        copies.append(spark.read.parquet(copy).withColumn("kind", F.lit(kind)))
    return copies[0].unionByName(copies[1])


@registry.check("""
    SELECT l_orderkey AS order_number,
           round(coalesce(sum(l_extendedprice) FILTER (l_returnflag = 'N'),
                          sum(l_extendedprice) FILTER (l_returnflag = 'R'),
                          sum(l_extendedprice) FILTER (l_returnflag = 'A')), 2) AS total
    FROM lineitem GROUP BY l_orderkey""",
    name="create_or_upsert",
)
def totals_created_then_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = landing.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "order_number")
    name, root = fresh_name("totals"), fresh_dir(spark, "create-or-upsert")
    for flag in ("A", "R", "N"):
        flagged = lines.where(F.col("l_returnflag") == flag)
        totals = sum_per_key(flagged, "order_number", {"l_extendedprice": "total"})
        stored = create_or_upsert(totals, name, "order_number", root)
    return stored.withColumn("total", F.round("total", 2))


@registry.check("""
    SELECT event_id, event_type, value,
           CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props
    FROM events""")
def evolve_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier events without ``props``, then later ones with it."""
    events = landing.table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    name = fresh_name("events")
    publish_version(
        events.where(early).select("event_id", "event_type", "value"),
        name,
        fresh_dir(spark, "evolving"),
    )
    later = events.where(~early).select("props", "value", "event_type", "event_id")
    return append_evolving(later, name).select("event_id", "event_type", "value", "props")


@registry.check("""
    SELECT n_name AS State, 2 * count(*) AS num_rows, true AS files_agree, true AS bytes_agree
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY n_name""",
    name="table_detail",
)
def detail_rows_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by SQL; files and bytes by a listing of the table's folder."""
    name = landing.order_details(spark, sf_dir)
    details = table_detail(spark, name, by=["State"])
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(shown_version(spark, name))
        .groupBy(F.regexp_extract("path", "/State=([^/]+)/", 1).alias("State"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    )
    return details.join(listed, "State").select(
        "State",
        "num_rows",
        (F.col("num_files") == F.col("files")).alias("files_agree"),
        (F.col("size_in_bytes") == F.col("bytes")).alias("bytes_agree"),
    )


@registry.check("""
    SELECT 'order' AS kind, o_orderkey AS number, 2 * sum(l_quantity) AS quantity
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    UNION ALL
    SELECT 'part', l_partkey, 2 * sum(l_quantity)
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY l_partkey""")
def reused_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sums of rows that are parsed once and kept while both are written."""
    path = fresh_dir(spark, "sums")
    orders = read_orders(spark, landing.packed_order_files(spark, sf_dir))
    with reused(detail(orders).select(ORDER, PART, "Quantity")) as kept:
        for kind, key in (("order", ORDER), ("part", PART)):
            sums = sum_per_key(kept, key, {"Quantity": "quantity"})
            sums.select(
                F.lit(kind).alias("kind"), F.col(key).alias("number"), "quantity"
            ).write.mode("append").parquet(path)
    return spark.read.parquet(path)
