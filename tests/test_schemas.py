"""Schemas that widen from run to run, and results that are kept by key."""

from __future__ import annotations

import os

import pytest
from frames import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.scratch import fresh_name
from stratalake.sinks import partitioned
from stratalake.sources import kept_xml_schema, merge_schemas, read_xml_rows, schemas
from stratalake.streaming import expired_parts, merged, run_merged, sliding_distinct


def deliver(folder, name, *boxes):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/{name}.xml", "w") as file:
        file.write(f"<boxes>{''.join(boxes)}</boxes>")


def test_only_new_files_are_inferred(spark, folder, monkeypatch):
    inferred = []
    plain = merge_schemas

    def schema():
        return kept_xml_schema(spark, f"{folder}/in", "box", f"{folder}/store").simpleString()

    deliver(folder, "a", '<box n="1"><size>2</size></box>')
    assert schema() == "struct<_n:bigint,size:bigint>"
    # A file that has been seen may go: the schema stays.
    os.remove(f"{folder}/in/a.xml")
    deliver(folder, "b", '<box n="2"><size>2.5</size><size>3</size></box>')
    monkeypatch.setattr(schemas, "merge_schemas", lambda *a: inferred.append(a) or plain(*a))
    assert schema() == "struct<_n:bigint,size:array<double>>"
    assert schema() == "struct<_n:bigint,size:array<double>>"
    inferred = [found for _, found in inferred if isinstance(found, T.StructType)]
    assert [i.simpleString() for i in inferred] == ["struct<_n:bigint,size:array<double>>"]
    deliver(folder, "c", "<box><size>x</size><label lang='en'>l</label></box>")
    assert schema() == (
        "struct<_n:bigint,label:struct<_VALUE:string,_lang:string>,size:array<string>>"
    )
    kept = kept_xml_schema(spark, f"{folder}/in", "box", f"{folder}/store")
    assert rows(read_xml_rows(spark, f"{folder}/in", "box", kept).select("_n", "size")) == [
        (2, ["2.5", "3"]),
        (None, ["x"]),
    ]


def test_batches_of_files_and_a_repeated_batch(spark, folder, monkeypatch):
    for i in range(5):
        deliver(folder, f"f{i}", f'<box k{i}="1"/>')
    os.makedirs(f"{folder}/none")
    assert kept_xml_schema(spark, f"{folder}/none", "box", f"{folder}/empty") == T.StructType()

    def schema():
        return kept_xml_schema(spark, f"{folder}/in", "box", f"{folder}/store", files_per_batch=2)

    with monkeypatch.context() as patch:
        calls = []

        def fails(*args):
            calls.append(args)
            if len(calls) == 2:
                raise RuntimeError("driver lost")
            return merge_schemas(*args)

        patch.setattr(schemas, "merge_schemas", fails)
        with pytest.raises(Exception, match="driver lost"):
            schema()
    assert schema().fieldNames() == [f"_k{i}" for i in range(5)]


def test_the_merge_is_that_of_one_inference(spark, folder):
    boxes = [
        '<box n="1"><d>2024-01-01</d><v>1</v></box>',
        '<box n="x"><d>2024-01-01T00:00:00</d><v>1.5</v><v>2</v></box>',
        "<box><in><a>1</a></in><w u='m'>3</w></box>",
        "<box><in><a>1</a><a>2</a><b>true</b></in><w>4</w></box>",
    ]
    for i, box in enumerate(boxes):
        deliver(f"{folder}/one", f"f{i}", box)
    whole = spark.read.option("rowTag", "box").xml(f"{folder}/one/in").schema
    step = kept_xml_schema(
        spark, f"{folder}/one/in", "box", f"{folder}/store", files_per_batch=1
    )
    assert step.simpleString() == whole.simpleString()


LEAVES = st.sampled_from(
    [T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DateType(),
     T.TimestampType(), T.NullType(), T.DecimalType(38, 0)]
)
TYPES = st.recursive(
    LEAVES,
    lambda inner: st.one_of(
        inner.filter(lambda t: not isinstance(t, T.ArrayType)).map(T.ArrayType),
        st.dictionaries(st.sampled_from("abc"), inner, min_size=1).map(
            lambda d: T.StructType([T.StructField(k, d[k]) for k in sorted(d)])
        ),
    ),
    max_leaves=6,
)


@settings(max_examples=200, deadline=None)
@given(TYPES, TYPES)
def test_merging_is_symmetric_and_settles(left, right):
    both = merge_schemas(left, right)
    assert both == merge_schemas(right, left)
    assert merge_schemas(both, right) == both == merge_schemas(left, both)


def events(spark, *pairs):
    return spark.createDataFrame(list(pairs), "m int, v string").select(
        F.timestamp_seconds(F.col("m") * 60).alias("at"), "v"
    )


class Counted:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.name = spark, folder, fresh_name("counted")

    def run(self, *pairs):
        if pairs:
            events(self.spark, *pairs).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema("at timestamp, v string").parquet(f"{self.folder}/in")
        return run_merged(
            sliding_distinct(stream, "at", "v", "n", "60 minutes", "60 minutes", ordered=False),
            f"{self.folder}/checkpoint", f"{self.folder}/t", self.name, ["day", "window"], ["day"],
            finish=lambda rows: rows.withColumn("day", F.col("window.start").cast("date")),
            state_partitions=2, comment="Hours",
        )

    def hours(self):
        hour = (F.unix_seconds("window.start") / 3600).cast("int")
        return sorted(map(tuple, self.spark.table(self.name).select(hour, "n").collect()))


def test_a_batch_writes_what_it_changed(spark, folder):
    counted = Counted(spark, folder)
    counted.run((1, "a"), (70, "a"), (1500, "a"), (3000, "b"))
    assert counted.hours() == [(0, 1), (1, 1), (25, 1), (50, 1)]
    before = files(f"{folder}/t")
    counted.run((2, "b"), (2, "a"))
    assert counted.hours() == [(0, 2), (1, 1), (25, 1), (50, 1)]
    written = [f for f in files(f"{folder}/t") - before if "day=" in f and "/files/" in f]
    assert written and all("day=1970-01-01" in f for f in written)
    gone = [row.folder for row in expired_parts(spark, counted.name).collect()]
    assert len(gone) == 1 and "day=1970-01-01" in gone[0]
    counted.run()
    assert counted.hours() == [(0, 2), (1, 1), (25, 1), (50, 1)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_repeated_batch_changes_nothing(spark, folder, monkeypatch, when):
    counted = Counted(spark, folder)
    counted.run((1, "a"), (1500, "a"))
    with monkeypatch.context() as patch:
        plain = merged.upsert

        def fails(*args):
            if when == "after":
                plain(*args)
            raise RuntimeError("driver lost")

        patch.setattr(merged, "upsert", fails)
        with pytest.raises(Exception, match="driver lost"):
            counted.run((2, "b"), (1501, "c"))
    counted.run()
    assert counted.hours() == [(0, 2), (25, 2)]


def files(folder):
    return {os.path.join(p, f) for p, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}
