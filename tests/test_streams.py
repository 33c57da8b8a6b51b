from __future__ import annotations

import os
from datetime import datetime

import pytest
from frames import rows
from pyspark.sql import functions as F

from stratalake.functions import stamp_arrival
from stratalake.operators import keep_matching
from stratalake.scratch import fresh_name
from stratalake.sources import (
    stream_binary_files,
    stream_envelopes,
    stream_table,
    stream_text_lines,
    stream_xml_rows,
)
from stratalake.streaming import (
    pane_sketches,
    run_complete,
    run_once,
    sliding_distinct,
    tumbling_distinct,
    windows_from_panes,
)

AT = "at timestamp, v int"


def day(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-01-01 {text}")


def places(folder):
    return (f"{folder}/{name}" for name in ("in", "out", "checkpoint"))


def deliver(spark, path, *data, schema=AT):
    spark.createDataFrame(list(data), schema).write.mode("append").parquet(path)


def test_rerun_reads_only_what_is_new(spark, folder):
    source, out, checkpoint = places(folder)
    counts = []
    for new in ([(1,), (2,)], [], [(3,)]):
        if new:
            deliver(spark, source, *new, schema="v int")
        run_once(spark.readStream.schema("v int").parquet(source), checkpoint, out)
        counts.append(spark.read.parquet(out).count())
    assert counts == [2, 2, 3]


def test_bounded_batches_read_everything(spark, folder):
    source, out, checkpoint = places(folder)
    for name in ("a", "b", "c"):
        line = spark.createDataFrame([(name,)], "value string").coalesce(1)
        line.write.mode("append").text(source)
    query = run_once(stream_text_lines(spark, source, max_files=1), checkpoint, out)
    assert rows(spark.read.parquet(out)) == [("a",), ("b",), ("c",)]
    assert len(query.recentProgress) >= 3
    with pytest.raises(ValueError, match="not both"):
        stream_text_lines(spark, source, max_files=1, max_bytes=1)


def test_late_rows_are_dropped(spark, folder):
    source, out, checkpoint = places(folder)

    def run():
        stream = spark.readStream.schema(AT).parquet(source)
        return run_once(tumbling_distinct(stream, "at", "v", "n"), checkpoint, out)

    def starts():
        return [row[0] for row in rows(spark.read.parquet(out).select("time.start"))]

    deliver(spark, source, (day("00:01"), 1), (day("00:30"), 1))
    run()
    assert starts() == [day("00:00")]
    deliver(spark, source, (day("00:02"), 2), (day("00:26"), 2), (day("01:00"), 2))
    query = run()
    assert starts() == [day("00:00"), day("00:25"), day("00:30")]
    dropped = sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
    assert dropped == 1


def test_state_partitions_are_the_streams_own(spark, folder):
    source, out, checkpoint = places(folder)
    deliver(spark, source, (day("00:01"), 1), (day("00:30"), 1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    stream = tumbling_distinct(spark.readStream.schema(AT).parquet(source), "at", "v", "n")
    run_once(stream, checkpoint, out, state_partitions=3)
    assert sorted(f for f in os.listdir(f"{checkpoint}/state/0") if f.isdigit()) == ["0", "1", "2"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_complete_stream_equals_the_batch_result(spark, folder):
    source, out, checkpoint = places(folder)
    name = fresh_name("windows")
    for minutes in (range(0, 60, 7), range(30, 120, 11)):
        deliver(spark, source, *[(day(f"{m // 60:02}:{m % 60:02}"), m % 4) for m in minutes])
        stream = spark.readStream.schema(AT).parquet(source)
        run_complete(sliding_distinct(stream, "at", "v", "n"), checkpoint, out, name)
        batch = sliding_distinct(spark.read.parquet(source), "at", "v", "n")
        assert rows(spark.table(name)) == rows(batch)
    starts = [row[0] for row in batch.select("window.start").collect()]
    assert starts == sorted(starts) and len(set(starts)) == len(starts)


def test_panes_add_up_to_the_sliding_windows(spark, folder):
    source, out, checkpoint = places(folder)
    name = fresh_name("windows")
    for minutes in (range(0, 300, 7), range(30, 500, 11)):
        data = [(day(f"{m // 60:02}:{m % 60:02}"), m % 13 or None) for m in minutes]
        deliver(spark, source, *data)
        stream = spark.readStream.schema(AT).parquet(source)
        run_complete(
            pane_sketches(stream, "at", "v"),
            checkpoint,
            out,
            name,
            finish=lambda panes: windows_from_panes(panes, "n"),
        )
        batch = spark.read.parquet(source)
        exact = batch.groupBy(F.window("at", "60 minutes", "10 minutes").alias("window")).agg(
            F.count_distinct("v").alias("n")
        )
        assert rows(spark.table(name)) == rows(exact)
        assert rows(windows_from_panes(pane_sketches(batch, "at", "v"), "n")) == rows(exact)


def test_complete_run_continues_after_a_failure(spark, folder):
    source, out, checkpoint = places(folder)
    name = fresh_name("windows")
    deliver(spark, source, (day("00:01"), 1), (day("00:02"), 2))

    def broken(panes):
        raise RuntimeError("cannot finish")

    def run(finish):
        stream = pane_sketches(spark.readStream.schema(AT).parquet(source), "at", "v")
        run_complete(stream, checkpoint, out, name, finish=finish)

    with pytest.raises(Exception, match="cannot finish"):
        run(broken)
    assert not spark.catalog.tableExists(name)
    for _ in range(2):
        run(lambda panes: windows_from_panes(panes, "n", panes_per_window=1))
        assert rows(spark.table(name).select("window.start", "n")) == [(day("00:00"), 2)]


def test_complete_run_without_input_leaves_an_empty_table(spark, folder):
    source, out, checkpoint = places(folder)
    deliver(spark, source, schema=AT)
    name = fresh_name("windows")
    stream = spark.readStream.schema(AT).parquet(source + "/*/none")
    run_complete(sliding_distinct(stream, "at", "v", "n"), checkpoint, out, name)
    assert spark.table(name).columns == ["window", "n"]
    assert spark.table(name).count() == 0


def test_sliding_windows_overlap(spark):
    one = spark.createDataFrame([(day("01:05"), 1)], AT)
    windows = sliding_distinct(one, "at", "v", "n").select("window.start", "window.end", "n")
    assert [row[0].strftime("%H:%M") for row in windows.collect()] == [
        "00:10",
        "00:20",
        "00:30",
        "00:40",
        "00:50",
        "01:00",
    ]


def test_table_is_streamed_into_a_copy(spark, folder):
    source, target = fresh_name("source"), fresh_name("target")
    for part in ([(1,)], [(2,), (3,)]):
        data = spark.createDataFrame(part, "v int")
        data.write.mode("append").option("path", folder + "/source").saveAsTable(source)
        run_once(stream_table(spark, source, max_files=1), folder + "/c", folder + "/target", target)
    assert rows(spark.table(target)) == [(1,), (2,), (3,)]


def test_binary_and_xml_streams(spark, folder):
    source, out, checkpoint = places(folder)
    orders = spark.createDataFrame([(1, "a"), (2, "b")], "_id int, name string")
    tags = {"rootTag": "all", "rowTag": "one"}
    orders.coalesce(1).write.format("xml").options(**tags).save(source)
    run_once(stream_binary_files(spark, source, "*.xml"), checkpoint, out)
    files = spark.read.parquet(out)
    assert files.count() == 1
    assert files.select(F.col("content").cast("string").contains('<one id="1">')).first()[0]
    streamed = stream_xml_rows(spark, source, "one", "_id int, name string")
    run_once(streamed, checkpoint + "-xml", out + "-xml")
    assert rows(spark.read.parquet(out + "-xml")) == [(1, "a"), (2, "b")]


def test_envelopes_come_from_any_source(spark, folder):
    source, out, checkpoint = places(folder)
    schema = "messageId bigint, payload binary, publishTimestampInMillis bigint, extra int"
    deliver(spark, source, (7, b"{}", 5, 1), schema=schema)
    stream = stream_envelopes(spark, "parquet", path=source, schema=schema)
    assert stream.columns == ["messageId", "payload", "publishTimestampInMillis", "eventTime"]
    run_once(stream, checkpoint, out)
    assert spark.read.parquet(out).where("eventTime IS NOT NULL").first()["messageId"] == "7"
    with pytest.raises(ValueError, match="missing"):
        stream_envelopes(spark, "parquet", path=source, schema="messageId bigint")


def test_arrival_stamp_replaces_the_earlier_one(spark):
    old = spark.createDataFrame([(day("00:00"),)], "eventTime timestamp")
    stamped = stamp_arrival(old)
    assert stamped.columns == ["eventTime"]
    assert stamped.first()[0] > day("00:00")


LOOKUP = [("a",), ("a",), ("c",), (None,)]


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1}, {"broadcast_bytes": 0}])
def test_matching_rows_are_kept_once(spark, limits):
    lookup = spark.createDataFrame(LOOKUP, "id string")
    data = [("a", 1), ("a", 1), ("b", 2), (None, 3), ("c", 4)] * 20
    messages = spark.createDataFrame(data, "subscriber string, v int").repartition(5)
    kept = keep_matching(messages, lookup, "subscriber", "id", **limits)
    assert kept.columns == ["subscriber", "v"]
    assert rows(kept) == [("a", 1)] * 40 + [("c", 4)] * 20
    broadcast = "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
    assert broadcast == (not limits)


@pytest.mark.parametrize("limits", [{}, {"broadcast_rows": 1}])
def test_stream_is_matched_like_a_table(spark, folder, limits):
    source, out, checkpoint = places(folder)
    lookup = spark.createDataFrame(LOOKUP, "id string")
    data = [("a", 1), ("b", 2), ("c", 3), (None, 4)]
    deliver(spark, source, *data, schema="s string, v int")
    stream = spark.readStream.schema("s string, v int").parquet(source)
    run_once(keep_matching(stream, lookup, "s", "id", **limits), checkpoint, out)
    assert rows(spark.read.parquet(out)) == [("a", 1), ("c", 3)]
