"""Scans, streams and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import landing
from ..functions.decode import bytes_to_text
from ..operators.aggregates import count_rows
from ..scratch import fresh_dir, fresh_name
from ..sinks.tables import materialize
from ..sources.files import (
    query_json_path,
    read_binary_files,
    read_json,
    read_xml_rows,
    with_source_path,
)
from ..sources.schemas import kept_xml_schema
from ..sources.streams import stream_binary_files, stream_table, stream_text_lines
from ..streaming.runs import run_once
from .registry import Registry

registry = Registry()


@registry.check("SELECT event_id, user_id, event_type, value, props, ts FROM events")
def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_json(spark, landing.event_json_files(spark, sf_dir))
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )


@registry.check("""
    SELECT event_type, count(*) AS events, round(sum(value), 2) AS total
    FROM events GROUP BY event_type""")
def json_path_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_json_path(
        spark,
        landing.event_json_files(spark, sf_dir),
        """SELECT event_type, count(*) AS events, round(sum(value), 2) AS total
           FROM {source} GROUP BY event_type""",
    )


@registry.check("""
    SELECT o_orderkey AS order_number, CAST(o_orderdate AS DATE) AS order_date,
           count(l_orderkey) AS items
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL""")
def xml_rowtag_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept schema is as of the files; were there new ones, these alone would be inferred."""
    files, store = landing.order_files(spark, sf_dir), landing.order_schema(spark, sf_dir)
    schema = kept_xml_schema(spark, files, landing.ORDER_TAG, store)
    orders = read_xml_rows(spark, files, landing.ORDER_TAG, schema)
    return orders.groupBy(
        F.col("_PurchaseOrderNumber").alias("order_number"),
        F.col("_OrderDate").alias("order_date"),
    ).agg(F.sum(F.coalesce(F.size("Items.Item"), F.lit(0))).alias("items"))


def _items_in(files: DataFrame) -> DataFrame:
    """Items found in file contents, and whether each length is that of its content."""
    return files.agg(
        F.sum(F.regexp_count(bytes_to_text("content"), F.lit("<Item "))).alias("items"),
        F.bool_and(F.col("length") == F.octet_length("content")).alias("lengths_agree"),
    )


@registry.check("SELECT count(*) AS items, true AS lengths_agree FROM lineitem")
def binary_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items_in(read_binary_files(spark, landing.order_files(spark, sf_dir), "*.xml"))


@registry.check(
    "SELECT count(*) AS items, true AS lengths_agree FROM lineitem", name="stream_binary_files"
)
def stream_binary_files_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = stream_binary_files(spark, landing.order_files(spark, sf_dir), "*.xml")
    out = fresh_dir(spark, "binary-files")
    run_once(stream, fresh_dir(spark, "checkpoint"), out)
    return _items_in(spark.read.parquet(out))


@registry.check("""
    WITH counts AS (
      SELECT (SELECT count(*) FROM lineitem) AS items, (SELECT count(*) FROM orders) AS orders,
             (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS filled,
             (SELECT count(*) FROM lineitem JOIN part ON p_partkey = l_partkey) AS named)
    SELECT tag, lines FROM (
      SELECT unnest(['Item', '/Item', 'Quantity', 'Price', 'ProductName', 'PurchaseOrder',
                     '/PurchaseOrder', 'Address', '/Address', 'Name', 'State', 'Items', '/Items'])
               AS tag,
             unnest([items, items, items, items, named, orders, orders, 2 * orders, 2 * orders,
                     2 * orders, 2 * orders, filled, filled]) AS lines
      FROM counts)
    WHERE lines > 0""",
    name="stream_text_lines",
)
def stream_text_lines_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = stream_text_lines(spark, f"{landing.packed_order_files(spark, sf_dir)}/*.xml.gz")
    out = fresh_dir(spark, "text-lines")
    run_once(lines, fresh_dir(spark, "checkpoint"), out)
    # The first tag of a line. What a file has once is not in the SQL, which knows no files.
    tag = F.regexp_extract("value", r"^\s*<(\??/?\w+)", 1)
    once = ["?xml", landing.DOCUMENT_TAG, f"/{landing.DOCUMENT_TAG}"]
    return (
        spark.read.parquet(out)
        .groupBy(tag.alias("tag"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .where(~F.col("tag").isin(once))
    )


@registry.check("""
    SELECT CAST(event_id AS VARCHAR) AS message_id,
           epoch_us(ts) // 1000 AS publish_ms, true AS has_payload, true AS stamped
    FROM events""")
def stream_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "bronze-messages")
    run_once(landing.envelopes(spark, sf_dir), fresh_dir(spark, "checkpoint"), out)
    return spark.read.parquet(out).select(
        F.col("messageId").alias("message_id"),
        F.col("publishTimestampInMillis").alias("publish_ms"),
        (F.octet_length("payload") > 0).alias("has_payload"),
        F.col("eventTime").isNotNull().alias("stamped"),
    )


@registry.check("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("orders")
    materialize(landing.table(spark, sf_dir, "orders"), name, fresh_dir(spark, "tables"))
    return spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@registry.check("SELECT event_id, user_id, event_type, value FROM events")
def stream_table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = fresh_name("events"), fresh_name("events_copy")
    materialize(landing.table(spark, sf_dir, "events"), source, fresh_dir(spark, "tables"))
    run_once(
        stream_table(spark, source),
        fresh_dir(spark, "checkpoint"),
        fresh_dir(spark, target),
        target,
    )
    return spark.table(target).select("event_id", "user_id", "event_type", "value")


@registry.check("""
    SELECT doc_id, length(text) AS characters, md5(text) AS digest FROM documents""")
def binary_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = landing.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").cast("binary").alias("content")
    )
    texts = stored.select("doc_id", bytes_to_text("content").alias("text"))
    return texts.select(
        "doc_id",
        F.length("text").cast("bigint").alias("characters"),
        F.md5("text").alias("digest"),
    )


@registry.check("""
    SELECT event_type AS folder, true AS is_json, count(*) AS events
    FROM events GROUP BY event_type""")
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_source_path(
        read_json(spark, landing.event_json_files(spark, sf_dir), "event_id bigint")
    )
    return events.groupBy(
        F.regexp_extract("path", r"event_type=(\w+)/[^/]+$", 1).alias("folder"),
        F.col("path").endswith(".json").alias("is_json"),
    ).agg(F.count(F.lit(1)).alias("events"))


@registry.check("""
    SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = landing.table(spark, sf_dir, "customer")
    return customers.where(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@registry.check("""
    SELECT 2 * count(*) AS row_count
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(spark.table(landing.order_details(spark, sf_dir)))
