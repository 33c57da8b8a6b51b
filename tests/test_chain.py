"""The message chain: layers that go on where they stopped, lookups that grow, small state."""

from __future__ import annotations

import json

import pytest
from frames import physical_plan, rows
from pyspark.sql import functions as F

from stratalake import landing
from stratalake.operators import keep_matching, matching_batch, snapshot
from stratalake.plans import messages
from stratalake.scratch import fresh_name
from stratalake.sources import stream_envelopes
from stratalake.streaming import closed_sliding_distinct, run_once, sliding_distinct

REFERENCE = "bus_object_id string, bus_object_typ_cd string"


class Queue:
    """A folder of messages, reference objects that grow, and the chain over both."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.suffix = spark, folder, fresh_name("t")
        self.objects: list[str] = []

    def send(self, *messages_):
        """(id, subscriber, name, minute) each."""
        data = [
            (i, json.dumps({
                "subscriber_id": who, "message_name": name, "cell_area": minute,
                "userequipment_model_name": name,
                "cal_timestamp_time": f"2024-01-01T{minute // 60:02}:{minute % 60:02}:00Z",
            }).encode(), 1000 * i)
            for i, who, name, minute in messages_
        ]
        df = self.spark.createDataFrame(data, landing.ENVELOPE_SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{self.folder}/in")

    def run(self, **options):
        stream = stream_envelopes(
            self.spark, "parquet", path=f"{self.folder}/in", schema=landing.ENVELOPE_SCHEMA
        )
        self.names = messages.run_chain(
            self.spark, stream, self.reference, f"{self.folder}/chain", self.suffix, 2, **options
        )

    def reference(self):
        return self.spark.createDataFrame([(o, "x") for o in self.objects], REFERENCE)

    def ids(self, layer):
        ids = self.spark.table(self.names[layer]).select(F.col("eventId").cast("int"))
        return sorted(map(tuple, ids.collect()))


@pytest.mark.parametrize("limit", [1_000_000, 1])
def test_each_run_moves_what_is_new(spark, folder, limit):
    queue = Queue(spark, folder)
    queue.objects = ["a", "b"]
    queue.send((1, "a", "BYE", 1), (2, "c", "BYE", 2), (3, "b", "HELLO", 3))
    queue.run(broadcast_rows=limit)
    assert queue.ids("decoded") == [(1,), (2,), (3,)]
    assert queue.ids("silver") == [(1,), (3,)] and queue.ids("published") == [(1,)]
    # An object that is known from now on: for new messages, not for those that have passed.
    queue.objects.append("c")
    queue.send((4, "c", "BYE_T", 4), (5, "d", "BYE", 5))
    queue.run(broadcast_rows=limit)
    queue.run(broadcast_rows=limit)
    assert queue.ids("silver") == [(1,), (3,), (4,)]
    assert queue.ids("published") == [(1,), (4,)]
    description = spark.catalog.getTable(queue.names["published"]).description
    assert description == "Ended sessions, for others"


@pytest.mark.parametrize("broken", messages.LAYERS[2:])
def test_a_chain_that_breaks_off_goes_on(spark, folder, monkeypatch, broken):
    queue = Queue(spark, folder)
    queue.objects = ["a"]
    queue.send(*[(i, "a", "BYE", 7 * i) for i in range(20)])
    with monkeypatch.context() as patch:
        target = "run_declared" if broken == "silver" else "run_once"
        plain = getattr(messages, target)

        def fails(stream, checkpoint, *args, **kwargs):
            done = plain(stream, checkpoint, *args, **kwargs)
            if checkpoint.endswith(broken):
                raise RuntimeError("driver lost")
            return done

        patch.setattr(messages, target, fails)
        with pytest.raises(RuntimeError, match="driver lost"):
            queue.run()
    queue.run()
    assert queue.ids("silver") == queue.ids("published") == [(i,) for i in range(20)]
    windows = spark.table(queue.names["device_models"])
    # The last message is of minute 133: hours that end by minute 123 are over.
    assert windows.count() == 12 == windows.select("window").distinct().count()


def test_payloads_are_parsed_once(spark, folder):
    queue = Queue(spark, folder)
    queue.send((1, "a", "BYE", 1))
    stream = stream_envelopes(
        spark, "parquet", path=f"{folder}/in", schema=landing.ENVELOPE_SCHEMA
    )
    batch = spark.read.schema(landing.ENVELOPE_SCHEMA).parquet(f"{folder}/in")
    assert stream.isStreaming
    plan = physical_plan(messages.decoded(batch.withColumn("eventTime", F.current_timestamp())))
    assert plan.count("from_json") == 1


def lookup(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "bus_object_id string")


def test_side_is_chosen_by_what_is_measured(spark):
    batch = spark.range(100).select((F.col("id") % 10).cast("string").alias("k"))
    small = snapshot(lookup(spark, "1", "2", "2", None), "bus_object_id")
    assert (small.rows, small.size) == (2, 2)
    near = matching_batch(batch, small, "k")
    assert "BroadcastHashJoin" in physical_plan(near) and near.count() == 20
    far = matching_batch(batch, small, "k", broadcast_rows=1, hot_rows=5)
    assert "SortMergeJoin" in physical_plan(far) and far.count() == 20
    wide = matching_batch(batch, small, "k", broadcast_bytes=1)
    assert "SortMergeJoin" in physical_plan(wide) and wide.count() == 20


def test_only_hot_keys_are_spread(spark):
    hot = spark.range(0, 3000, 1, 8).select(F.lit("h").alias("k"))
    batch = hot.unionByName(spark.range(200).select(F.col("id").cast("string").alias("k")))
    batch = batch.unionByName(spark.createDataFrame([(None,)], "k string"))
    keys = snapshot(lookup(spark, "h", *map(str, range(0, 200, 2)), "gone"), "bus_object_id")
    found = matching_batch(batch, keys, "k", broadcast_rows=1, salts=4, hot_rows=1000)
    assert found.columns == ["k"]
    assert rows(found.groupBy("k").count().where("k = 'h'")) == [("h", 3000)]
    assert found.count() == 3100
    # The optimizer may fold copies, so they are counted in the join's right side.
    assert rows(keep_matching(batch, keys.keys, "k", "__lookup_key").groupBy("k").count()) == rows(
        found.groupBy("k").count()
    )


def test_a_snapshot_does_not_change(spark, folder):
    lookup(spark, "1").write.parquet(f"{folder}/objects")
    stored = spark.read.schema("bus_object_id string").parquet(f"{folder}/objects")
    keys = snapshot(stored, "bus_object_id")
    lookup(spark, "2").write.mode("append").parquet(f"{folder}/objects")
    batch = spark.createDataFrame([("1",), ("2",)], "k string")
    assert rows(matching_batch(batch, keys, "k")) == [("1",)]
    again = snapshot(spark.read.schema("bus_object_id string").parquet(f"{folder}/objects"), "bus_object_id")
    assert rows(matching_batch(batch, again, "k")) == [("1",), ("2",)]


def events(spark, *minutes):
    return spark.createDataFrame([(m, f"v{m % 4}") for m in minutes], "m int, v string").select(
        F.timestamp_seconds(F.col("m") * 60).alias("at"), "v"
    )


def test_closed_windows_are_the_windows(spark):
    df = events(spark, *range(0, 400, 7))
    closed = closed_sliding_distinct(df, "at", "v", "n")
    assert rows(closed) == rows(sliding_distinct(df, "at", "v", "n"))


def test_closed_windows_leave_the_state(spark, folder):
    schema = "at timestamp, v string"
    sizes = []
    for day in range(3):
        minutes = range(day * 1440, (day + 1) * 1440, 5)
        events(spark, *minutes).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = run_once(
            closed_sliding_distinct(stream, "at", "v", "n"),
            f"{folder}/checkpoint", f"{folder}/out", state_partitions=2,
        )
        sizes.append(sum(op.numRowsTotal for op in query.lastProgress.stateOperators))
    # Panes and windows that are open, however many days there were.
    assert max(sizes) <= 12 and sizes[0] == sizes[-1]
    found = spark.read.parquet(f"{folder}/out")
    end = F.timestamp_seconds(F.lit((3 * 1440 - 5 - 10) * 60))
    every = sliding_distinct(events(spark, *range(0, 3 * 1440, 5)), "at", "v", "n")
    assert rows(found) == rows(every.where(F.col("window.end") <= end))
