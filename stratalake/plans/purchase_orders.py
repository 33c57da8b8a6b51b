"""Purchase orders: XML documents to order, line and part tables.

bronze   one struct per document
summary  one row per order
detail   one row per order, address and item
gold     totals and quantities per order, statistics per part
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decode import bytes_to_text, narrow_schema, parse_xml
from ..functions.elements import parse_elements
from ..operators.aggregates import combine_on_key, sum_per_key
from ..operators.flatten import explode_keep, explode_only, items_as_rows, promote_struct
from ..operators.ranking import summarise_per_key
from ..sinks.tables import materialize, stored
from ..sources.files import read_xml_rows, with_source_path
from ..sources.streams import BACKLOG_BYTES, stream_binary_files, stream_xml_rows
from ..streaming.declared import Declared, run_declared
from ..streaming.runs import run_once

ORDER = "_PurchaseOrderNumber"
PART = "_PartNumber"

# Elements that may repeat are declared as arrays: a schema inferred from
# documents that happen to hold one item would keep only the last of several.
ITEM_TYPE = (
    T.StructType()
    .add("_PartNumber", "long")
    .add("ProductName", "string")
    .add("Quantity", "double")
    .add("Price", "double")
)
ADDRESS_TYPE = (
    T.StructType().add("_Type", "string").add("Name", "string").add("State", "string")
)
ORDER_SCHEMA = (
    T.StructType()
    .add("_PurchaseOrderNumber", "long")
    .add("_OrderDate", "date")
    .add("Address", T.ArrayType(ADDRESS_TYPE))
    .add("Items", T.StructType().add("Item", T.ArrayType(ITEM_TYPE)))
)
DOCUMENT_SCHEMA = T.StructType().add("PurchaseOrder", T.ArrayType(ORDER_SCHEMA))


def document_schema(fields: Iterable[str]) -> T.StructType:
    """The document schema reduced to some order fields, given as dotted paths."""
    return narrow_schema(DOCUMENT_SCHEMA, [f"PurchaseOrder.{field}" for field in fields])


def bronze(files: DataFrame, schema: T.StructType = DOCUMENT_SCHEMA) -> DataFrame:
    """Binary files (batch or stream) to one ``payload`` struct per document."""
    texts = files.select(bytes_to_text("content").alias("text"))
    return texts.select(parse_xml("text", schema).alias("payload"))


def run_bronze(
    spark: SparkSession,
    files: str,
    checkpoint: str,
    path: str,
    table: str,
    schema: T.StructType = DOCUMENT_SCHEMA,
    max_bytes: int | None = BACKLOG_BYTES,
) -> DataFrame:
    """Parse the files that arrived since the last run and append them to ``table``.

    A value that does not fit its type costs the rest of its document, as ``parse_xml``
    says; in ``run_orders`` it costs a field of one order, and ``run_checked_bronze`` loses
    nothing.
    """
    stream = stream_binary_files(spark, files, "*.xml", max_bytes=max_bytes)
    run_once(bronze(stream, schema), checkpoint, path, table)
    return spark.table(table)


def run_checked_bronze(
    spark: SparkSession,
    files: str,
    checkpoint: str,
    root: str,
    orders: str,
    quarantine: str,
    log: str,
    max_bytes: int | None = BACKLOG_BYTES,
    glob: str = "*.xml",
) -> tuple[DataFrame, DataFrame]:
    """Append the orders of newly arrived files to one table and what is no order to another.

    Each order is parsed by itself, once. One with a value that does not fit, or that is not
    well-formed, goes to ``quarantine`` as it stands: ``path``, ``place`` in the document,
    ``problem``, ``element``; so does a file that is no XML. Both tables get a batch once.
    """
    stream = with_source_path(stream_binary_files(spark, files, glob, max_bytes=max_bytes))
    texts = stream.select("path", bytes_to_text("content").alias("text"))
    parsed = parse_elements(texts, "text", "PurchaseOrder", ORDER_SCHEMA)
    # A batch is kept in files for the two tables, without the texts of what was parsed.
    text = F.when(F.col("problem").isNotNull(), F.col("element"))
    parsed = parsed.withColumn("element", text)

    def good(batch: DataFrame) -> DataFrame:
        return batch.where("payload IS NOT NULL").select("payload.*", "path")

    def bad(batch: DataFrame) -> DataFrame:
        return batch.where("problem IS NOT NULL").select("path", "place", "problem", "element")

    run_declared(
        parsed,
        checkpoint,
        [
            Declared(orders, f"{root}/{orders}", good, comment="Orders as parsed"),
            Declared(quarantine, f"{root}/{quarantine}", bad, comment="What is no order"),
        ],
        log,
        keep=stored,
    )
    return spark.table(orders), spark.table(quarantine)


def read_orders(
    spark: SparkSession, files: str, schema: T.StructType = ORDER_SCHEMA
) -> DataFrame:
    """``summary`` straight from files, without whole documents in between.

    Orders are streamed out of each file, so memory does not grow with its size,
    and a bad value costs a field of one order, not a document. Add a
    ``_corrupt_record`` string field to the schema to see the text of bad orders.
    """
    return read_xml_rows(spark, files, "PurchaseOrder", schema)


def run_orders(
    spark: SparkSession,
    files: str,
    checkpoint: str,
    path: str,
    table: str,
    max_bytes: int | None = BACKLOG_BYTES,
) -> DataFrame:
    """Append the orders of the files that arrived since the last run to ``table``."""
    stream = stream_xml_rows(spark, files, "PurchaseOrder", ORDER_SCHEMA, max_bytes=max_bytes)
    run_once(stream, checkpoint, path, table)
    return spark.table(table)


def summary(bronze_rows: DataFrame) -> DataFrame:
    """One row per order element, order fields as columns."""
    documents = promote_struct(bronze_rows, "payload")
    return promote_struct(explode_only(documents, "PurchaseOrder"), "col")


def addresses(orders: DataFrame) -> DataFrame:
    """One row per order and address."""
    return promote_struct(explode_keep(orders, "Address"), "col")


def items(orders: DataFrame) -> DataFrame:
    """One row per item, item fields as columns; orders without items stay."""
    nested = promote_struct(orders, "Items")
    return promote_struct(items_as_rows(nested, "Item"), "Item")


def detail(orders: DataFrame, fan_out: bool = True) -> DataFrame:
    """One row per order, address and item.

    Item values then occur once per address, and sums over them are multiplied
    accordingly. ``fan_out=False`` leaves addresses out: one row per item.
    """
    return items(addresses(orders) if fan_out else orders.drop("Address"))


def totals(details: DataFrame) -> DataFrame:
    return sum_per_key(details, ORDER, {"Price": "Total_Price"})


def quantities(details: DataFrame) -> DataFrame:
    return sum_per_key(details, ORDER, {"Quantity": "Total_Items_Ordered"})


def part_summary(details: DataFrame) -> DataFrame:
    return summarise_per_key(details, PART, "Quantity", "ProductName")


def combined(order_totals: DataFrame, order_quantities: DataFrame) -> DataFrame:
    return combine_on_key(order_totals, order_quantities, ORDER)


def combined_in_one_pass(details: DataFrame) -> DataFrame:
    """``combined`` straight from the details: one scan, one shuffle, no join."""
    known = details.where(F.col(ORDER).isNotNull())
    return sum_per_key(
        known, ORDER, {"Price": "Total_Price", "Quantity": "Total_Items_Ordered"}
    )


def item_count() -> Column:
    """Items of an order row that has not been flattened."""
    return F.coalesce(F.size("Items.Item"), F.lit(0))


def chain(orders: DataFrame, root: str, suffix: str) -> dict[str, DataFrame]:
    """The declared datasets, each stored and built on the stored ones."""

    def declare(
        step: str, df: DataFrame, comment: str, partition_by: tuple[str, ...] = ()
    ) -> DataFrame:
        return materialize(df, f"{step}_{suffix}", root, comment, partition_by=partition_by)

    raw = declare("po_raw", orders, "Orders as parsed from the documents")
    by_address = declare("po_addresses", addresses(raw), "Orders by address")
    details = declare("po_details", items(by_address), "Orders by address and item")
    # Both sums in one pass; the three datasets below only choose columns and rows of it.
    sums = declare(
        "po_sums",
        sum_per_key(details, ORDER, {"Price": "Total_Price", "Quantity": "Total_Items_Ordered"}),
        "Sums of each order",
    )
    order_totals = declare("po_totals", sums.drop("Total_Items_Ordered"), "Price total of each order")
    order_quantities = declare("po_quantities", sums.drop("Total_Price"), "Items in each order")
    parts = declare("po_parts", part_summary(details), "Quantity statistics of each part")
    both = declare(
        "po_combined", sums.where(F.col(ORDER).isNotNull()), "Totals and quantities"
    )
    return {
        "raw": raw,
        "addresses": by_address,
        "details": details,
        "totals": order_totals,
        "quantities": order_quantities,
        "parts": parts,
        "combined": both,
    }
