from __future__ import annotations

import os

import pytest
from frames import rows

from stratalake.operators import (
    Rule,
    constraint_sql,
    expectation_report,
    guard,
    observe_rules,
    observe_stream,
    stream_counts,
    violations,
)
from stratalake.plans import clicks
from stratalake.streaming import run_once

RULES = (Rule("has_name", "name IS NOT NULL"), Rule("positive", "n > 0", fatal=True))


def frame(spark, *data):
    return spark.createDataFrame(list(data), "name string, n int")


def test_report_counts_nulls_as_violations(spark):
    df = frame(spark, ("a", 1), (None, 2), ("b", None), ("c", 0))
    assert rows(expectation_report(df, RULES)) == [("has_name", 4, 1), ("positive", 4, 2)]


def test_warning_keeps_rows_and_failure_stops(spark):
    good = frame(spark, ("a", 1), (None, 2))
    assert rows(guard(good, RULES)) == rows(good)
    for bad in (0, None):
        with pytest.raises(Exception, match="expectation positive violated"):
            guard(frame(spark, ("a", 1), ("b", bad)), RULES).collect()


def test_failure_survives_a_later_projection(spark):
    with pytest.raises(Exception, match="expectation positive violated"):
        guard(frame(spark, ("a", 0)), RULES).select("name").collect()


def test_failed_write_publishes_nothing(spark, folder):
    guarded = guard(frame(spark, *[("a", i) for i in range(100)]), RULES)
    with pytest.raises(Exception, match="expectation positive violated"):
        guarded.write.parquet(folder + "/out")
    assert not os.path.exists(folder + "/out/_SUCCESS")


def test_sql_form_is_the_same_check(spark):
    frame(spark, ("a", 1)).createOrReplaceTempView("good_rows")
    frame(spark, ("a", None)).createOrReplaceTempView("bad_rows")
    condition = constraint_sql(RULES)
    assert spark.sql(f"SELECT * FROM good_rows WHERE {condition}").count() == 1
    with pytest.raises(Exception, match="expectation positive violated"):
        spark.sql(f"SELECT * FROM bad_rows WHERE {condition}").collect()
    assert constraint_sql(RULES[:1]) == "true"
    quoted = constraint_sql([Rule("is_x", "name = 'x'", fatal=True)])
    with pytest.raises(Exception, match="expectation is_x violated"):
        spark.sql(f"SELECT * FROM good_rows WHERE {quoted}").collect()


def test_violations_are_observed_while_writing(spark, folder):
    df, observation = observe_rules(frame(spark, (None, 1), ("b", 0), ("c", 3)), RULES, "clicks")
    df.write.parquet(folder + "/out")
    assert violations(observation, RULES) == {"has_name": 1, "positive": 1}


def test_violations_are_observed_in_a_stream(spark, folder):
    source, out, checkpoint = (f"{folder}/{name}" for name in ("in", "out", "checkpoint"))
    batches = 8
    for _ in range(batches):
        frame(spark, (None, 1), ("b", 0), ("c", -3), ("d", 4)).coalesce(1).write.mode(
            "append"
        ).parquet(source)
    stream = spark.readStream.schema("name string, n int").option("maxFilesPerTrigger", 1)
    observed = observe_stream(stream.parquet(source), RULES, "quality")
    # A query remembers fewer batches than there are.
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        with stream_counts(spark, RULES, "quality") as counts:
            query = run_once(observed, checkpoint, out)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) <= 3
    assert counts.violations() == {"has_name": batches, "positive": 2 * batches}
    assert counts.rows() == spark.read.parquet(out).count() == 4 * batches


def test_stream_batch_with_a_violation_publishes_nothing(spark, folder):
    source, out, checkpoint = (f"{folder}/{name}" for name in ("in", "out", "checkpoint"))
    schema = "name string, n int"

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        run_once(guard(stream, RULES), checkpoint, out)

    frame(spark, ("a", 1)).write.mode("append").parquet(source)
    run()
    frame(spark, ("b", 2), ("c", -1)).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="expectation positive violated"):
        run()
    assert rows(spark.read.parquet(out)) == [("a", 1)]
    # The batch that failed is read once more, and its rows arrive once.
    run_once(spark.readStream.schema(schema).parquet(source), checkpoint, out)
    assert rows(spark.read.parquet(out)) == [("a", 1), ("b", 2), ("c", -1)]


def test_clicks_refuse_counts_that_are_no_numbers(spark):
    raw = spark.createDataFrame([("p", "12", "q"), (None, "3", "r")], clicks.RAW_SCHEMA)
    assert rows(clicks.prepared(raw)) == [("p", "q", 12), (None, "r", 3)]
    for count in ("0", "x", None):
        bad = spark.createDataFrame([("p", count, "q")], clicks.RAW_SCHEMA)
        with pytest.raises(Exception, match="expectation valid_count violated"):
            clicks.prepared(bad).collect()
