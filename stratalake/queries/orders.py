"""Purchase orders from XML to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import landing
from ..functions.decode import bytes_to_text, infer_xml_schema, narrow_schema, parse_xml
from ..operators.flatten import explode_keep, explode_only, promote_struct
from ..operators.ranking import first_per_key, with_key_stats
from ..plans import documents
from ..plans import purchase_orders as po
from ..scratch import fresh_dir, fresh_name
from ..sinks.tables import overwrite_files
from ..sources.files import read_binary_files
from ..streaming.runs import run_once
from .registry import Registry

registry = Registry()

# Order x address x item. Orders without lines keep a row with null item values.
DETAIL = """
    WITH detail AS (
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, kind, c_name, n_name,
             l_partkey, p_name, l_quantity, l_extendedprice
      FROM orders
      JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey
      LEFT JOIN lineitem ON l_orderkey = o_orderkey
      LEFT JOIN part ON p_partkey = l_partkey
      CROSS JOIN (VALUES ('Shipping'), ('Billing')) AS address(kind))
"""
PART_STATS = """
    round(avg(l_quantity), 4) AS avg, round(sum(l_quantity), 2) AS sum,
    min(l_quantity) AS min, max(l_quantity) AS max, round(stddev_samp(l_quantity), 4) AS stddev
"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_binary_files(spark, landing.order_files(spark, sf_dir), "*.xml")


def _documents(
    spark: SparkSession, sf_dir: str, schema: T.StructType = po.DOCUMENT_SCHEMA
) -> DataFrame:
    return po.bronze(_files(spark, sf_dir), schema)


def _orders(
    spark: SparkSession, sf_dir: str, schema: T.StructType = po.ORDER_SCHEMA
) -> DataFrame:
    return po.read_orders(spark, landing.packed_order_files(spark, sf_dir), schema)


def _details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(landing.order_details(spark, sf_dir))


def _rounded(df: DataFrame, **places: int) -> DataFrame:
    """Floating sums depend on the order of addition, so they are compared rounded."""
    return df.withColumns({name: F.round(name, digits) for name, digits in places.items()})


def _rounded_stats(df: DataFrame) -> DataFrame:
    return _rounded(df, avg=4, sum=2, stddev=4)


@registry.check("""
    SELECT field, type FROM (VALUES
      ('PurchaseOrder.Address.Name', 'string'),
      ('PurchaseOrder.Address.State', 'string'),
      ('PurchaseOrder.Address._Type', 'string'),
      ('PurchaseOrder.Items.Item.Price', 'double'),
      ('PurchaseOrder.Items.Item.ProductName', 'string'),
      ('PurchaseOrder.Items.Item.Quantity', 'double'),
      ('PurchaseOrder.Items.Item._PartNumber', 'bigint'),
      ('PurchaseOrder._OrderDate', 'date'),
      ('PurchaseOrder._PurchaseOrderNumber', 'bigint')) AS t(field, type)
    WHERE EXISTS (SELECT 1 FROM lineitem)""")
def xml_infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _files(spark, sf_dir).select(bytes_to_text("content").alias("text"))
    schema = infer_xml_schema(texts, "text", landing.DOCUMENT_TAG)
    return spark.createDataFrame(list(_leaves(schema)), "field string, type string")


def _leaves(data_type: T.DataType, path: str = ""):
    if isinstance(data_type, T.ArrayType):
        yield from _leaves(data_type.elementType, path)
    elif isinstance(data_type, T.StructType):
        for field in data_type.fields:
            yield from _leaves(field.dataType, f"{path}.{field.name}" if path else field.name)
    else:
        yield path, data_type.simpleString()


@registry.check("""
    SELECT l_orderkey AS order_number, count(*) AS items, round(sum(l_extendedprice), 2) AS price
    FROM lineitem GROUP BY l_orderkey""")
def xml_parse_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Only the fields in use are parsed.
    schema = po.document_schema([po.ORDER, "Items.Item.Price"])
    texts = _files(spark, sf_dir).select(bytes_to_text("content").alias("text"))
    payloads = texts.select(parse_xml("text", schema).alias("payload"))
    order = payloads.select(F.explode("payload.PurchaseOrder").alias("order"))
    lines = order.select(
        F.col(f"order.{po.ORDER}").alias("order_number"),
        F.explode("order.Items.Item.Price").alias("price"),
    )
    summed = lines.groupBy("order_number").agg(
        F.count(F.lit(1)).alias("items"), F.sum("price").alias("price")
    )
    return _rounded(summed, price=2)


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, CAST(o_orderdate AS DATE) AS _OrderDate,
           l_partkey AS _PartNumber, p_name AS ProductName,
           l_quantity AS Quantity, l_extendedprice AS Price
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey""",
    name="promote_struct",
)
def promote_struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).drop("Address")
    items = explode_keep(promote_struct(orders, "Items"), "Item", "item")
    return promote_struct(items, "item")


@registry.check("""
    SELECT o_orderkey AS order_number, count(l_orderkey) AS items
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    name="explode_only",
)
def explode_only_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = po.document_schema([po.ORDER, f"Items.Item.{po.PART}"])
    payloads = promote_struct(_documents(spark, sf_dir, schema), "payload")
    orders = explode_only(payloads, "PurchaseOrder")
    return orders.groupBy(F.col(f"col.{po.ORDER}").alias("order_number")).agg(
        F.sum(F.coalesce(F.size("col.Items.Item"), F.lit(0))).alias("items")
    )


@registry.check(f"""
    SELECT o_orderkey AS order_number, kind, c_name AS name, n_name AS state
    FROM orders JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey
    CROSS JOIN (VALUES ('Shipping'), ('Billing')) AS address(kind)
    LEFT JOIN (SELECT l_orderkey, ceil(count(*) / {landing.ITEMS_PER_ELEMENT}) AS elements
               FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
    -- A very large order is written as several elements.
    CROSS JOIN range(CAST(coalesce(elements, 1) AS BIGINT))""",
    name="explode_keep",
)
def explode_keep_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = po.document_schema([po.ORDER, "Address"])
    orders = po.summary(_documents(spark, sf_dir, schema))
    return explode_keep(orders, "Address", "address").select(
        F.col(po.ORDER).alias("order_number"),
        F.col("address._Type").alias("kind"),
        F.col("address.Name").alias("name"),
        F.col("address.State").alias("state"),
    )


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, CAST(o_orderdate AS DATE) AS _OrderDate,
           2 AS addresses, count(l_orderkey) AS items
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY ALL""")
def po_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = po.summary(_documents(spark, sf_dir))
    return orders.groupBy(po.ORDER, "_OrderDate").agg(
        F.max(F.size("Address")).alias("addresses"), F.sum(po.item_count()).alias("items")
    )


@registry.check(
    DETAIL
    + """
    SELECT l_partkey AS _PartNumber, p_name AS ProductName, l_quantity AS Quantity,
           l_extendedprice AS Price, kind AS _Type, c_name AS Name, n_name AS State,
           o_orderkey AS _PurchaseOrderNumber, o_orderdate AS _OrderDate
    FROM detail"""
)
def po_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.detail(_orders(spark, sf_dir))


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, round(sum(l_extendedprice), 2) AS Total_Price
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def po_totals_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow_schema(po.ORDER_SCHEMA, [po.ORDER, "Items.Item.Price"])
    return _rounded(po.totals(po.items(_orders(spark, sf_dir, schema))), Total_Price=2)


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, round(2 * sum(l_extendedprice), 2) AS Total_Price
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def po_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(po.totals(_details(spark, sf_dir)), Total_Price=2)


@registry.check("""
    SELECT o_orderkey AS _PurchaseOrderNumber, 2 * sum(l_quantity) AS Total_Items_Ordered
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def po_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return po.quantities(_details(spark, sf_dir))


COMBINED = """
    SELECT o_orderkey AS _PurchaseOrderNumber,
           round(2 * sum(l_extendedprice), 2) AS Total_Price,
           2 * sum(l_quantity) AS Total_Items_Ordered
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""


@registry.check(COMBINED)
def po_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = _details(spark, sf_dir)
    return _rounded(po.combined(po.totals(details), po.quantities(details)), Total_Price=2)


@registry.check(COMBINED)
def po_combined_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(po.combined_in_one_pass(_details(spark, sf_dir)), Total_Price=2)


@registry.check(COMBINED)
def po_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = po.chain(_orders(spark, sf_dir), fresh_dir(spark, "po-chain"), fresh_name("run"))
    return _rounded(stored["combined"], Total_Price=2)


@registry.check(
    DETAIL
    + f"""
    SELECT l_partkey AS _PartNumber, min(p_name) AS ProductName, {PART_STATS}
    FROM detail GROUP BY l_partkey"""
)
def po_part_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_stats(po.part_summary(_details(spark, sf_dir)))


@registry.check(
    DETAIL
    + f"""
    , stats AS (SELECT l_partkey AS part, {PART_STATS} FROM detail GROUP BY l_partkey)
    SELECT o_orderkey AS _PurchaseOrderNumber, kind AS _Type, l_partkey AS _PartNumber,
           l_quantity AS Quantity, avg, sum, min, max, stddev
    FROM detail JOIN stats ON l_partkey IS NOT DISTINCT FROM part"""
)
def part_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _details(spark, sf_dir).select(po.ORDER, "_Type", po.PART, "Quantity")
    return _rounded_stats(with_key_stats(lines, po.PART, "Quantity"))


@registry.check(
    DETAIL
    + """
    SELECT l_partkey AS _PartNumber, p_name AS ProductName,
           o_orderkey AS _PurchaseOrderNumber, l_quantity AS Quantity, l_extendedprice AS Price
    FROM detail
    QUALIFY row_number() OVER (
      PARTITION BY l_partkey ORDER BY o_orderkey, l_quantity, l_extendedprice) = 1""",
    name="first_per_key",
)
def first_row_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _details(spark, sf_dir).select(po.PART, "ProductName", po.ORDER, "Quantity", "Price")
    return first_per_key(lines, po.PART, [po.ORDER, "Quantity", "Price"])


@registry.check("""
    SELECT o_orderkey AS order_number, count(l_orderkey) AS items,
           round(sum(l_extendedprice), 2) AS price
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def po_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("bronze_orders")
    stored = po.run_bronze(
        spark,
        landing.order_files(spark, sf_dir),
        fresh_dir(spark, "checkpoint"),
        fresh_dir(spark, name),
        name,
    )
    lines = po.items(po.summary(stored).drop("Address"))
    priced = lines.groupBy(F.col(po.ORDER).alias("order_number")).agg(
        F.count(po.PART).alias("items"), F.sum("Price").alias("price")
    )
    return _rounded(priced, price=2)


@registry.check(COMBINED)
def po_order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("orders")
    stored = po.run_orders(
        spark,
        landing.order_files(spark, sf_dir),
        fresh_dir(spark, "checkpoint"),
        fresh_dir(spark, name),
        name,
    )
    return _rounded(po.combined_in_one_pass(po.detail(stored)), Total_Price=2)


@registry.check("""
    SELECT o_orderkey AS order_number, count(l_orderkey) AS items, true AS from_xml_file
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def xml_stream_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = landing.order_files(spark, sf_dir)
    schema = documents.inferred_schema(spark, files, landing.DOCUMENT_TAG)
    out = fresh_dir(spark, "documents")
    run_once(documents.with_lineage(spark, files, schema), fresh_dir(spark, "checkpoint"), out)
    orders = explode_keep(promote_struct(spark.read.parquet(out), "payload"), "PurchaseOrder")
    return orders.groupBy(F.col(f"col.{po.ORDER}").alias("order_number")).agg(
        F.sum(F.coalesce(F.size("col.Items.Item"), F.lit(0))).alias("items"),
        F.bool_and(F.col("path").endswith(".xml")).alias("from_xml_file"),
    )


# Orders whose number this divides have a quantity that is no number, in their first item;
# an order that the other divides comes once more, cut off, in a file of its own kind.
BAD_VALUE, CUT_OFF = 7, 50


@registry.check(f"""
    WITH items AS (
      SELECT o_orderkey AS order_number, count(l_orderkey) AS items
      FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    SELECT order_number,
           CASE WHEN order_number % {BAD_VALUE} = 0 AND items > 0 THEN NULL ELSE items END AS items,
           CASE WHEN order_number % {BAD_VALUE} = 0 AND items > 0
                THEN 'does not fit: Items.Item.Quantity=many' END AS problem,
           CASE WHEN order_number % {CUT_OFF} = 0 THEN 1 ELSE 0 END AS cut_off
    FROM items""")
def po_bronze_bad_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with bad orders among good ones, in two deliveries; nothing is lost."""
    key = F.col(po.ORDER)
    # Built once: both deliveries, and the orders cut off in each, are parts of it.
    built = fresh_dir(spark, "elements")
    overwrite_files(landing.order_elements(spark, sf_dir), built)
    elements = spark.read.parquet(built)
    quantity = F.col("Items.Item")
    spoilt = F.transform(
        quantity,
        lambda item, i: item.withField(
            "Quantity",
            F.when((key % BAD_VALUE == 0) & (i == 0), F.lit("many")).otherwise(
                item["Quantity"].cast("string")
            ),
        ),
    )
    items = F.when(F.col("Items").isNotNull(), F.struct(spoilt.alias("Item"))).alias("Items")
    orders = elements.select(po.ORDER, "_OrderDate", "Address", items)
    # A closed order comes between two that are not: none of them takes another along.
    open_order = F.format_string('<PurchaseOrder PurchaseOrderNumber="%d"><Items>', key)
    cut = elements.where(key % CUT_OFF == 0).select(F.concat(F.lit("<A>"), open_order))

    files, checkpoint = fresh_dir(spark, "spoilt"), fresh_dir(spark, "checkpoint")
    root, log = fresh_dir(spark, "bronze"), fresh_dir(spark, "log")
    tables = fresh_name("po_orders"), fresh_name("po_quarantine")
    for name, part in (("first", key % 2 == 0), ("second", key % 2 != 0)):
        landing.write_order_files(orders.where(part), f"{files}/{name}", landing.ORDERS_PER_FILE)
        cut.where(part).write.text(f"{files}/{name}-cut")
        good, bad = po.run_checked_bronze(
            spark, f"{files}/*", checkpoint, root, *tables, log, glob="*.{xml,txt}"
        )
    counted = good.groupBy(key.alias("order_number")).agg(F.sum(po.item_count()).alias("items"))
    number = F.regexp_extract("element", r'PurchaseOrderNumber="(\d+)"', 1).cast("bigint")
    listed = bad.select(number.alias("order_number"), "problem")
    misfits = listed.where("problem <> 'not well-formed'")
    lost = listed.where("problem = 'not well-formed'").groupBy("order_number").count()
    return (
        counted.join(misfits, "order_number", "full")
        .join(lost, "order_number", "left")
        .select(
            "order_number",
            "items",
            "problem",
            F.coalesce("count", F.lit(0)).alias("cut_off"),
        )
    )
