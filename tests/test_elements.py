"""Documents taken apart: what is good arrives, what is not is listed."""

from __future__ import annotations

import os

import pytest
from frames import physical_plan, rows
from pyspark.sql import types as T

from stratalake.functions import parse_elements, split_elements
from stratalake.plans import purchase_orders as po
from stratalake.scratch import fresh_name, scratch_root
from stratalake.sinks import read_log
from stratalake.streaming import declared as streams

SCHEMA = "_n int, day date, part struct<_w double, size array<int>>, label string"
GOOD = '<box n="1"><day>2024-02-03</day><part w="1.5"><size>1</size><size>2</size></part></box>'


def parsed(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    return parse_elements(docs, "text", "box", T.StructType.fromDDL(SCHEMA))


def test_elements_are_cut_out(spark):
    text = f"<?xml version='1.0'?>\n<boxes>\n {GOOD}\n<box n='2'/><boxer/>\n<box   >x</box >tail</boxes>"
    docs = spark.createDataFrame([(7, text)], "id int, text string")
    assert rows(split_elements(docs, "text", "box")) == [
        (7, 1, GOOD),
        (7, 2, "<box n='2'/>"),
        (7, 3, "<box   >x</box >"),
    ]


@pytest.mark.parametrize(
    ("element", "problem"),
    [
        ('<box n="x"><label>a</label></box>', "does not fit: _n=x"),
        ("<box><day>soon</day><label>a</label></box>", "does not fit: day=soon"),
        (
            '<box><part w="wide"><size>1</size><size>two</size><size>two</size></part></box>',
            "does not fit: part._w=wide, part.size=two",
        ),
        ("<box><label>a</box>", "not well-formed"),
        ("<box><label>cut o", "not well-formed"),
        ("<box n=1></box>", "not well-formed"),
    ],
)
def test_a_bad_element_costs_itself(spark, element, problem):
    found = parsed(spark, f"<boxes>{GOOD}{element}{GOOD}</boxes>").orderBy("place").collect()
    assert [r.problem for r in found] == [None, problem, None]
    assert found[1].element == element and found[1].payload is None
    for r in (found[0], found[2]):
        assert (r.payload._n, r.payload.day.isoformat(), r.payload.part.size) == (1, "2024-02-03", [1, 2])


def test_documents_without_elements(spark):
    found = parsed(spark, "<boxes/>", "no xml <", "", None, GOOD, "﻿" + GOOD)
    assert [(r.id, r.place, r.problem is None, r.payload is None) for r in found.orderBy("id").collect()] == [
        (0, 0, True, True),
        (1, 0, False, True),
        (2, 0, False, True),
        (3, 0, False, True),
        (4, 1, True, False),
        (5, 1, True, False),
    ]


def test_places_count_elements_only(spark):
    texts = ["<box/>", "<a/><box/> <box>x", "<box/><box/>", "<boxer/>", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    assert rows(split_elements(docs, "text", "box")) == [
        (0, 1, "<box/>"),
        (1, 1, "<box/>"),
        (1, 2, "<box>x"),
        (2, 1, "<box/>"),
        (2, 2, "<box/>"),
        (3, 0, "<boxer/>"),
        (4, 0, ""),
        (5, 0, ""),
    ]


def test_no_row_holds_the_pieces_of_a_document(spark):
    docs = spark.createDataFrame([(1, GOOD)], "id int, text string")
    plan = physical_plan(split_elements(docs, "text", "box"))
    assert plan.count("split(") == 1 and "Generate posexplode(split(" in plan


def test_many_elements_with_bad_ones_take_time_in_proportion(spark):
    element = '<box n="{}"><label>a &lt; b</label></box>'
    text = "".join(element.format("x" if i % 100 == 0 else i) for i in range(60_000))
    found = parsed(spark, f"<boxes>{text}</boxes>")
    counts = found.groupBy("problem").count()
    assert rows(counts) == [("does not fit: _n=x", 600), (None, 59_400)]


def test_batches_of_orders_are_kept_in_files(spark, folder, monkeypatch):
    """Neither a batch nor the texts of what was parsed wait in memory for the second table."""
    os.mkdir(f"{folder}/in")
    with open(f"{folder}/in/a.xml", "w") as file:
        file.write(f"<PurchaseOrders>{order(1)}{order(2, 'dear')}</PurchaseOrders>")

    def kept(*_):
        raise AssertionError("kept in memory")

    monkeypatch.setattr(type(spark.range(1)), "persist", kept)
    names = fresh_name("orders"), fresh_name("bad")
    good, bad = po.run_checked_bronze(
        spark, f"{folder}/in", f"{folder}/checkpoint", folder, *names, f"{folder}/log"
    )
    assert rows(good.select(po.ORDER)) == [(1,)]
    assert bad.where("element LIKE '<PurchaseOrder %dear%</PurchaseOrder>'").count() == 1
    batches = spark.read.parquet(f"{scratch_root(spark)}/stored-*").where(f"path LIKE '%{folder}%'")
    assert rows(batches.selectExpr("payload IS NULL", "element IS NULL")) == [
        (False, True),
        (True, False),
    ]


def order(number, price="2.5", close="</PurchaseOrder>"):
    return (
        f'<PurchaseOrder PurchaseOrderNumber="{number}" OrderDate="2024-01-01"><Items>'
        f'<Item PartNumber="4"><Price>{price}</Price></Item></Items>{close}'
    )


def test_both_tables_get_a_batch_once(spark, folder, monkeypatch):
    files, names = f"{folder}/in", (fresh_name("orders"), fresh_name("bad"))
    os.mkdir(files)

    def deliver(name, *orders):
        with open(f"{files}/{name}.xml", "w") as file:
            file.write(f"<PurchaseOrders>{''.join(orders)}</PurchaseOrders>")

    def run():
        return po.run_checked_bronze(
            spark, files, f"{folder}/checkpoint", folder, *names, f"{folder}/log"
        )

    deliver("a", order(1), order(2, "dear"), order(3))
    with monkeypatch.context() as patch:
        plain = streams._store

        def stops(batch, dataset, *rest):
            if dataset.name == names[1]:
                raise RuntimeError("driver lost")
            plain(batch, dataset, *rest)

        patch.setattr(streams, "_store", stops)
        with pytest.raises(Exception, match="driver lost"):
            run()
    run()
    deliver("b", order(4, close=""), order(5))
    good, bad = run()
    assert rows(good.select(po.ORDER, "batch_id")) == [(1, 0), (3, 0), (5, 1)]
    assert rows(bad.select("place", "problem", "batch_id")) == [
        (1, "not well-formed", 1),
        (2, "does not fit: Items.Item.Price=dear", 0),
    ]
    assert bad.where("element LIKE '%dear%' AND path LIKE '%a.xml'").count() == 1
    counts = read_log(spark, f"{folder}/log").select("dataset", "batch_id", "row_count")
    assert rows(counts) == sorted([(names[0], 0, 2), (names[0], 1, 1), (names[1], 0, 1), (names[1], 1, 1)], key=repr)
