"""Test tables turned into the inputs the plans read.

Order tables become purchase-order XML, events become queue envelopes and click
JSON. Everything is written by Spark jobs, once per application and table
folder, and no job gathers more than one bounded element in a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.timing import utc_instant
from .plans import messages, purchase_orders
from .scratch import application_id, fresh_dir, fresh_name
from .sinks.tables import overwrite_files, show_version
from .sources.schemas import kept_xml_schema
from .sources.streams import stream_envelopes
from .streaming.runs import run_once

DOCUMENT_TAG = "PurchaseOrders"
ORDER_TAG = "PurchaseOrder"
SEGMENT = "BUILDING"
CELL_AREAS = 50
ENVELOPE_SCHEMA = "messageId bigint, payload binary, publishTimestampInMillis bigint"

# Larger orders are written as several elements with the same number.
ITEMS_PER_ELEMENT = 10_000
# At most some 60 MB of XML: a file is one value to the parser of whole documents.
ORDERS_PER_FILE = 50_000

_made: dict[tuple[str, str, str], str] = {}


def _once(make: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    def made(spark: SparkSession, sf_dir: str) -> str:
        key = (application_id(spark), sf_dir, make.__name__)
        if key not in _made:
            _made[key] = make(spark, sf_dir)
        return _made[key]

    made.__name__ = make.__name__
    made.__doc__ = make.__doc__
    return made


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_elements(
    spark: SparkSession, sf_dir: str, items_per_element: int = ITEMS_PER_ELEMENT
) -> DataFrame:
    """Orders as nested rows, ready to be written as XML elements.

    The items of an order are collected into one row. An order with more than
    ``items_per_element`` items becomes several rows, each with its share of the
    items. Rows are grouped and joined by order and share, so neither a row nor a
    task has to hold a very large order.

    The orders to split are broadcast: there is at most one for every
    ``items_per_element`` lines, and the lines need no shuffle to find them.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"
    )
    large = F.broadcast(_large_orders(lines.select("l_orderkey"), items_per_element))
    share = F.coalesce(F.pmod(F.xxhash64("line_id"), F.col("shares")), F.lit(0))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    shared = (
        lines.withColumn("line_id", F.monotonically_increasing_id())
        .join(large, F.col("l_orderkey").eqNullSafe(F.col("large_order")), "left")
        .select(*lines.columns, share.alias("l_share"))
    )
    collected = (
        shared.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        # Lines are moved flat, which takes fewer bytes than lists of one.
        .repartition("l_orderkey", "l_share")
        .groupBy("l_orderkey", "l_share")
        .agg(
            F.collect_list(
                F.struct(
                    F.col("l_partkey").alias("_PartNumber"),
                    F.col("p_name").alias("ProductName"),
                    F.col("l_quantity").alias("Quantity"),
                    F.col("l_extendedprice").alias("Price"),
                )
            ).alias("Item")
        )
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    last_share = F.coalesce(F.col("shares") - 1, F.lit(0))
    headers = (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(large, F.col("o_orderkey") == F.col("large_order"), "left")
        .withColumn("o_share", F.explode(F.sequence(F.lit(0).cast("bigint"), last_share)))
    )
    same = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("o_share") == F.col("l_share"))

    def address(kind: str) -> Column:
        return F.struct(
            F.lit(kind).alias("_Type"),
            F.col("c_name").alias("Name"),
            F.col("n_name").alias("State"),
        )

    return (
        headers.join(collected, same, "left")
        # A few nations: their names are not moved with the orders.
        .join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        # A share of a large order may have drawn no item; an order without any stays.
        .where(F.col("Item").isNotNull() | F.col("shares").isNull())
        .select(
            F.col("o_orderkey").alias("_PurchaseOrderNumber"),
            # A date attribute would be written as a day number.
            F.col("o_orderdate").cast("date").cast("string").alias("_OrderDate"),
            F.array(address("Shipping"), address("Billing")).alias("Address"),
            F.when(F.col("Item").isNotNull(), F.struct("Item")).alias("Items"),
        )
    )


def _large_orders(lines: DataFrame, items_per_element: int) -> DataFrame:
    """Orders with more lines than an element has, and the elements they are written as.

    Lines are counted by groups of orders first, of half an element's lines on average. Only
    the orders of groups with more than an element's lines are counted one by one.
    """
    groups = max(1, 2 * lines.count() // items_per_element)
    group = F.pmod(F.xxhash64("l_orderkey"), F.lit(groups))
    orders = lines.where(F.col("l_orderkey").isNotNull())
    full = (
        orders.groupBy(group.alias("full_group"))
        .count()
        .where(F.col("count") > items_per_element)
        .select("full_group")
    )
    return (
        orders.join(F.broadcast(full), group == F.col("full_group"), "left_semi")
        .groupBy(F.col("l_orderkey").alias("large_order"))
        .count()
        .where(F.col("count") > items_per_element)
        .select("large_order", F.ceil(F.col("count") / items_per_element).alias("shares"))
    )


def write_order_files(
    elements: DataFrame, path: str, orders_per_file: int, lines: bool = True, packed: bool = False
) -> None:
    """Orders as XML files with a ``PurchaseOrders`` root each.

    ``lines`` gives each element a line of its own, otherwise each order has one. ``packed``
    compresses the files.
    """
    (
        elements.write.format("xml")
        .option("rootTag", DOCUMENT_TAG)
        .option("rowTag", ORDER_TAG)
        .option("maxRecordsPerFile", orders_per_file)
        # A space a level instead of four.
        .option("indent", " " if lines else "")
        .option("compression", "gzip" if packed else "none")
        .save(path)
    )


def _all_orders(spark: SparkSession, sf_dir: str, path: str, **layout: bool) -> str:
    # A file is read by one task, so small data still makes a file per core.
    orders = table(spark, sf_dir, "orders").count()
    per_core = math.ceil(orders / spark.sparkContext.defaultParallelism)
    per_file = min(max(per_core, 1), ORDERS_PER_FILE)
    write_order_files(order_elements(spark, sf_dir), path, per_file, **layout)
    return path


@_once
def order_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders as ``.xml`` files, an order a line, for readers of whole documents."""
    return _all_orders(spark, sf_dir, fresh_dir(spark, "order-files"), lines=False)


@_once
def packed_order_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders as ``.xml.gz`` files, an element a line.

    Readers of rows and of lines unpack a file as they go through it, and a file is one task
    to them either way. As ``.xml`` it takes some ten times the disk.
    """
    return _all_orders(spark, sf_dir, fresh_dir(spark, "packed-order-files"), packed=True)


@_once
def order_schema(spark: SparkSession, sf_dir: str) -> str:
    """Folder that keeps the inferred schema of the order files."""
    store = fresh_dir(spark, "order-schema")
    kept_xml_schema(spark, order_files(spark, sf_dir), ORDER_TAG, store)
    return store


@_once
def order_details(spark: SparkSession, sf_dir: str) -> str:
    """Name of a stored detail table, by state, for the gold steps to read."""
    orders = purchase_orders.read_orders(spark, packed_order_files(spark, sf_dir))
    details = details_by_state(orders)
    name = fresh_name("order_details")
    path = fresh_dir(spark, name)
    overwrite_files(details, path, ["State"], gathered=True)
    show_version(details, name, path, ["State"])
    return name


def details_by_state(orders: DataFrame) -> DataFrame:
    """``purchase_orders.detail``, with the rows of a state brought together.

    Orders are moved while their items are still nested: what an order has once, such as
    its number, date and name, is shuffled once per address and not with every item.
    """
    by_address = purchase_orders.addresses(orders).hint("rebalance", "State")
    return purchase_orders.items(by_address)


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as queue messages with a JSON payload."""
    payload = F.struct(
        F.col("user_id").cast("string").alias("subscriber_id"),
        F.col("event_type").alias("userequipment_model_name"),
        F.when(F.col("event_type") == "error", "BYE")
        .when(F.col("event_type") == "signup", "BYE_T")
        .otherwise(F.upper("event_type"))
        .alias("message_name"),
        F.pmod("user_id", F.lit(CELL_AREAS)).cast("int").alias("cell_area"),
        F.col("value").cast("float").alias("controlplane_response_time_usec"),
        F.concat(F.col("ts").cast("string"), F.lit("Z")).alias("cal_timestamp_time"),
        F.col("ts").cast("date").cast("string").alias("create_ts"),
    )
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("messageId"),
        F.to_json(payload).cast("binary").alias("payload"),
        F.unix_millis(utc_instant("ts")).alias("publishTimestampInMillis"),
    )


@_once
def envelope_files(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "envelopes")
    event_envelopes(spark, sf_dir).write.parquet(path)
    return path


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope stream."""
    return stream_envelopes(
        spark, "parquet", path=envelope_files(spark, sf_dir), schema=ENVELOPE_SCHEMA
    )


def reference_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("bus_object_id"),
        F.col("c_mktsegment").alias("bus_object_typ_cd"),
    )


@_once
def silver_messages(spark: SparkSession, sf_dir: str) -> str:
    """Name of a stored silver table for the gold streams to read."""
    reference = messages.reference_view(reference_objects(spark, sf_dir), SEGMENT)
    stream = messages.silver(messages.decoded(envelopes(spark, sf_dir)), reference)
    name = fresh_name("silver_messages")
    run_once(stream, fresh_dir(spark, "checkpoint"), fresh_dir(spark, name), name)
    return name


# Messages and reference objects of the chain are delivered twice: what came before this
# day, and objects with even numbers, first.
CHAIN_SPLIT = "2024-01-16 00:00:00"


@_once
def message_chain(spark: SparkSession, sf_dir: str) -> str:
    """Suffix of the tables of a message chain that was run for two deliveries and for none."""
    root, arrivals = fresh_dir(spark, "chain"), fresh_dir(spark, "arrivals")
    objects = fresh_dir(spark, "objects")
    suffix = fresh_name("chain")
    sent = event_envelopes(spark, sf_dir)
    split = F.unix_millis(utc_instant(F.lit(CHAIN_SPLIT).cast("timestamp_ntz")))
    early = F.col("publishTimestampInMillis") < split
    even = F.col("bus_object_id").cast("bigint") % 2 == 0
    known = reference_objects(spark, sf_dir)

    def reference() -> DataFrame:
        return messages.reference_view(
            spark.read.schema(known.schema).parquet(objects), SEGMENT
        )

    for delivered, objects_too in ((early, even), (~early, ~even), (None, None)):
        if delivered is not None:
            sent.where(delivered).write.mode("append").parquet(arrivals)
            known.where(objects_too).write.mode("append").parquet(objects)
        stream = stream_envelopes(spark, "parquet", path=arrivals, schema=ENVELOPE_SCHEMA)
        cores = spark.sparkContext.defaultParallelism
        messages.run_chain(spark, stream, reference, root, suffix, cores)
    return suffix


@_once
def click_files(spark: SparkSession, sf_dir: str) -> str:
    """Clicks per page and referrer as JSON, counts as text, some pages unknown."""
    page = F.when(F.col("event_type") != "error", F.col("event_type"))
    path = fresh_dir(spark, "clicks")
    (
        table(spark, sf_dir, "events")
        .groupBy(
            page.alias("curr_title"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("prev_title"),
        )
        .agg(F.count(F.lit(1)).cast("string").alias("n"))
        .write.json(path)
    )
    return path


@_once
def event_json_files(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON lines in one folder per event type."""
    path = fresh_dir(spark, "event-json")
    (
        table(spark, sf_dir, "events")
        .select(
            "event_id",
            "user_id",
            "value",
            "props",
            F.col("ts").cast("string").alias("ts"),
            "event_type",
        )
        .hint("rebalance", "event_type")
        .write.partitionBy("event_type")
        .json(path)
    )
    return path
