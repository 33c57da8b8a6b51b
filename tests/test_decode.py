from __future__ import annotations

import pytest
from frames import physical_plan, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import (
    bytes_to_text,
    infer_xml_files,
    infer_xml_schema,
    narrow_schema,
    parse_json,
    parse_xml,
    utc_instant,
    utc_wall_clock,
)
from stratalake.operators import explode_keep
from stratalake.plans import messages
from stratalake.plans import purchase_orders as po
from stratalake.plans.documents import inferred_schema
from stratalake.sources import read_binary_files

GAUGES = """<gauges>
  <gauge><site>Ford</site><level unit="cm" checked="true">140</level></gauge>
  <gauge><level unit="m"/></gauge>
  <gauge><level unit="cm">87</level></gauge>
</gauges>"""
LONE = """<gauges><gauge><level unit="mm">12</level></gauge></gauges>"""


def texts(spark, *documents):
    return spark.createDataFrame([(d,) for d in documents], "text string")


GAUGE_SCHEMA = (
    "struct<gauge:array<struct<level:struct<_VALUE:bigint,_checked:boolean,_unit:string>,"
    "site:string>>>"
)


def test_inferred_schema_fits_every_document(spark):
    schema = infer_xml_schema(texts(spark, LONE, GAUGES, None), "text", "gauges")
    assert schema.simpleString() == GAUGE_SCHEMA


def test_schema_of_files_is_that_of_their_texts(spark, folder):
    for name, document in (("one", LONE), ("many", GAUGES)):
        with open(f"{folder}/{name}.xml", "w") as file:
            file.write(document)
    assert infer_xml_files(spark, f"{folder}/*.xml", "gauges").simpleString() == GAUGE_SCHEMA
    assert inferred_schema(spark, folder, "gauges").simpleString() == GAUGE_SCHEMA


def test_empty_element_keeps_its_attribute(spark):
    documents = texts(spark, GAUGES)
    schema = infer_xml_schema(documents, "text", "gauges")
    gauges = documents.select(F.explode(parse_xml("text", schema).getField("gauge")).alias("g"))
    assert rows(gauges.select("g.level._VALUE", "g.level._unit", "g.site")) == [
        (140, "cm", "Ford"),
        (87, "cm", None),
        (None, "m", None),
    ]


def test_one_or_many_items_parse_alike(spark):
    one = "<PurchaseOrder><Items><Item PartNumber='1'/></Items></PurchaseOrder>"
    many = (
        "<PurchaseOrder><Items><Item PartNumber='1'/><Item PartNumber='2'/></Items></PurchaseOrder>"
    )
    documents = texts(spark, f"<P>{one}</P>", f"<P>{many}{one}</P>", "<P></P>")
    payloads = documents.select(parse_xml("text", po.DOCUMENT_SCHEMA).alias("payload"))
    assert po.items(po.summary(payloads).drop("Address")).where("_PartNumber > 0").count() == 4


def test_bad_document_is_kept_aside(spark):
    schema = T.StructType(
        po.DOCUMENT_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())]
    )
    parsed = texts(spark, "<P><PurchaseOrder>", "<P/>").select(
        parse_xml("text", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("p")
    )
    assert rows(parsed.select("p._corrupt_record")) == [("<P><PurchaseOrder>",), (None,)]


def test_bad_files_cost_a_field_or_the_rest_of_a_document(spark, folder):
    order = (
        "<PurchaseOrder PurchaseOrderNumber='{}'><Address><State>X</State></Address>"
        "<Items><Item PartNumber='1'><Price>{}</Price></Item></Items></PurchaseOrder>"
    )
    files = {
        "good": order.format(1, 2.5),
        "bad-value": order.format(2, 2.5) + order.format(3, "abc") + order.format(5, 2.5),
        "cut-off": order.format(4, 2.5)[:-30],
    }
    for name, orders in files.items():
        with open(f"{folder}/{name}.xml", "w") as file:
            file.write(f"<PurchaseOrders>{orders}</PurchaseOrders>")
    schema = T.StructType(
        po.ORDER_SCHEMA.fields + [T.StructField("_corrupt_record", T.StringType())]
    )
    # Fields that are not read are not parsed: keep all of them before asking which are bad.
    by_order = po.read_orders(spark, folder, schema).persist()
    sound = by_order.where("_corrupt_record IS NULL AND _PurchaseOrderNumber IS NOT NULL")
    assert rows(sound.select("_PurchaseOrderNumber")) == [(1,), (2,), (5,)]
    aside = by_order.where("_corrupt_record LIKE '%abc%'")
    assert rows(aside.select("_PurchaseOrderNumber", "Items")) == [(3, None)]

    by_order.unpersist()
    # A file that is not text at all.
    with open(f"{folder}/no-text.xml", "wb") as file:
        file.write(b"\xff\xfe\x00")
    with pytest.raises(Exception, match="(?i)charset|malformed|corrupt|encod|xml"):
        po.read_orders(spark, folder).collect()
    by_document = po.summary(po.bronze(read_binary_files(spark, folder, "*.xml")))
    assert rows(by_document.select("_PurchaseOrderNumber")) == [(1,), (2,)]


def test_bytes_that_are_not_text_do_not_fail(spark):
    data = spark.createDataFrame([(b"gr\xc3\xbc\xc3\x9fe",), (b"\xff\xfe",), (None,)], "b binary")
    decoded = [row[0] for row in data.select(bytes_to_text("b")).collect()]
    assert decoded[0] == "grüße" and decoded[1] is not None and decoded[2] is None


def test_bad_json_gives_nulls(spark):
    data = spark.createDataFrame([(b'{"a": 1, "b": "x"}',), (b"{oops",)], "payload binary")
    parsed = data.select(parse_json("payload", "a INT, b STRING").alias("j")).select("j.a", "j.b")
    assert rows(parsed) == [(1, "x"), (None, None)]


def test_narrow_schema_keeps_only_the_paths(spark):
    schema = po.document_schema(["_PurchaseOrderNumber", "Items.Item.Price"])
    assert schema.simpleString() == (
        "struct<PurchaseOrder:array<struct<_PurchaseOrderNumber:bigint,"
        "Items:struct<Item:array<struct<Price:double>>>>>>"
    )
    with pytest.raises(ValueError, match="no such field"):
        narrow_schema(po.ORDER_SCHEMA, ["Item"])
    with pytest.raises(ValueError, match="lead into"):
        narrow_schema(po.ORDER_SCHEMA, ["_OrderDate.year"])


def test_documents_are_parsed_once(spark):
    payloads = texts(spark, "<P/>").select(parse_xml("text", po.DOCUMENT_SCHEMA).alias("payload"))
    assert physical_plan(po.detail(po.summary(payloads))).count("from_xml(") == 1
    exploded = explode_keep(payloads.select("payload.PurchaseOrder"), "PurchaseOrder")
    assert physical_plan(exploded).count("from_xml(") == 1


def test_messages_are_decoded_once(spark):
    envelopes = spark.createDataFrame(
        [("1", b"{}", 0)], "messageId string, payload binary, publishTimestampInMillis bigint"
    )
    decoded = messages.decoded(envelopes)
    assert physical_plan(decoded).count("from_json(") == 1
    assert len(decoded.columns) == 52 + 3
    assert decoded.columns[-3:] == ["eventId", "publishTimestampInMillis", "eventTime"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The third is skipped by New York clocks, the second and last are shown twice.
        walls = [
            "2024-01-01 00:00:07.179575",
            "2024-11-03 01:30:00",
            "2024-03-10 02:30:00",
            "2024-11-03 05:30:00",
        ]
        data = spark.createDataFrame([(w,) for w in walls], "w string")
        wall = F.col("w").cast("timestamp_ntz")
        instant = utc_instant(wall)
        result = data.select(
            (utc_wall_clock(instant) == wall).alias("same"),
            F.unix_micros(instant).alias("micros"),
        ).collect()
        assert all(row["same"] for row in result)
        assert result[0]["micros"] == 1_704_067_207_179_575
        assert result[2]["micros"] == 1_710_037_800_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
