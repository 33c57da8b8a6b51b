"""Declared datasets and the log of their rules, also where a run breaks off."""

from __future__ import annotations

import os

import pytest
from frames import rows

from stratalake.operators import Rule
from stratalake.plans import clicks
from stratalake.scratch import fresh_name
from stratalake.sinks import declare, declare_sql, declared, read_log, rule_totals
from stratalake.streaming import Declared, run_declared
from stratalake.streaming import declared as streams

RULES = (Rule("has_name", "name IS NOT NULL"), Rule("positive", "n > 0", fatal=True))
SCHEMA = "name string, n int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def logged(spark, log):
    entries = read_log(spark, log).where("rule IS NOT NULL")
    return rows(entries.select("dataset", "batch_id", "rule", "row_count", "violations"))


def test_rules_are_counted_by_the_write(spark, folder):
    name, log = fresh_name("d"), f"{folder}/log"
    stored = declare(
        frame(spark, ("a", 1), (None, 2), (None, 3)), name, folder, log, RULES, comment="Named"
    )
    assert rows(stored) == rows(spark.table(name)) == [("a", 1), (None, 2), (None, 3)]
    assert spark.catalog.getTable(name).description == "Named"
    assert logged(spark, log) == [(name, 0, "has_name", 3, 2), (name, 0, "positive", 3, 0)]


def test_the_write_scans_once(spark, folder):
    """The rows are read by one job: an accumulator sees each of them once."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def watched(n):
        seen.add(1)
        return n

    df = spark.range(100).select(F.lit("a").alias("name"), watched(F.col("id") + 1).alias("n"))
    declare(df, fresh_name("d"), folder, f"{folder}/log", RULES[:1])
    assert seen.value == 100


def test_partitioned_rows_are_counted_after_their_shuffle(spark, folder):
    name, log = fresh_name("d"), f"{folder}/log"
    df = frame(spark, *[("abc"[i % 3], i + 1) for i in range(90)])
    declare(df, name, folder, log, RULES, partition_by=["name"])
    assert spark.table(name).count() == 90
    assert {r[3] for r in logged(spark, log)} == {90}


def test_a_fatal_violation_leaves_table_and_log_alone(spark, folder):
    name, log = fresh_name("d"), f"{folder}/log"
    declare(frame(spark, ("a", 1)), name, folder, log, RULES)
    before = logged(spark, log)
    with pytest.raises(Exception, match="expectation positive violated"):
        declare(frame(spark, ("a", 0)), name, folder, log, RULES)
    assert rows(spark.table(name)) == [("a", 1)] and logged(spark, log) == before


def test_empty_and_sql_datasets(spark, folder):
    name, log = fresh_name("d"), f"{folder}/log"
    empty = frame(spark).where("false") if False else spark.createDataFrame([], SCHEMA)
    assert rows(declare(empty, name, folder, log, RULES)) == []
    assert {r[3:] for r in logged(spark, log)} == {(0, 0)}
    sql = declare_sql(
        spark, "SELECT 'x' AS name, CAST(:n AS INT) AS n", f"{name}_sql", folder, log,
        args={"n": 4}, rules=RULES,
    )
    assert rows(sql) == [("x", 4)]
    totals = rule_totals(read_log(spark, log)).where(f"dataset = '{name}_sql'")
    assert rows(totals.select("rule", "fatal", "row_count", "violations")) == [
        ("has_name", False, 1, 0),
        ("positive", True, 1, 0),
    ]


class Arrivals:
    """A folder of arriving rows and a stream over it into two tables."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.log = f"{folder}/log"
        self.raw, self.clean = fresh_name("raw"), fresh_name("clean")

    def add(self, *data):
        frame(self.spark, *data).coalesce(1).write.mode("append").json(f"{self.folder}/in")

    def run(self, checkpoint="checkpoint"):
        stream = self.spark.readStream.schema(SCHEMA).json(f"{self.folder}/in")
        datasets = [
            Declared(self.raw, f"{self.folder}/{self.raw}"),
            Declared(
                self.clean, f"{self.folder}/{self.clean}", lambda b: b.where("n <> 5"), RULES,
                comment="Clean", properties={"layer": "silver"},
            ),
        ]
        return run_declared(stream, f"{self.folder}/{checkpoint}", datasets, self.log)

    def clean_rows(self):
        return rows(self.spark.table(self.clean).select("name", "n"))


def test_stream_counts_every_batch_once(spark, folder):
    arrivals = Arrivals(spark, folder)
    arrivals.add(("a", 1), (None, 2), ("x", 5))
    arrivals.run()
    arrivals.run()
    arrivals.add((None, 3), (None, 4))
    arrivals.run()
    clean = arrivals.clean
    assert logged(spark, arrivals.log) == [
        (clean, 0, "has_name", 2, 1),
        (clean, 0, "positive", 2, 0),
        (clean, 1, "has_name", 2, 2),
        (clean, 1, "positive", 2, 0),
    ]
    assert arrivals.clean_rows() == [("a", 1), (None, 2), (None, 3), (None, 4)]
    assert spark.table(arrivals.raw).count() == 5
    assert rows(spark.table(clean).groupBy("batch_id").count()) == [(0, 2), (1, 2)]
    assert spark.catalog.getTable(clean).description == "Clean"


@pytest.mark.parametrize("broken", ["write_counted", "record", "partition", "second table"])
def test_a_run_that_breaks_off_is_done_again_once(spark, folder, monkeypatch, broken):
    arrivals = Arrivals(spark, folder)
    arrivals.add(("a", 1), (None, 2))
    with monkeypatch.context() as patch:
        if broken in ("write_counted", "record"):
            plain, calls = getattr(streams, broken), []

            def fails(*args, **kwargs):
                calls.append(plain(*args, **kwargs))
                raise RuntimeError("driver lost")

            patch.setattr(streams, broken, fails)
        else:
            plain_store = streams._store

            def stops(batch, dataset, run, batch_id, log):
                if broken == "partition":
                    patch.setattr(streams, "sql_text", lambda text: 1 / 0)
                if broken == "second table" and dataset.name == arrivals.clean:
                    raise RuntimeError("driver lost")
                plain_store(batch, dataset, run, batch_id, log)

            patch.setattr(streams, "_store", stops)
        with pytest.raises(Exception):
            arrivals.run()
    assert arrivals.clean_rows() == []
    written = {p for p, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}
    arrivals.run()
    arrivals.run()
    assert arrivals.clean_rows() == [("a", 1), (None, 2)]
    assert rows(spark.table(arrivals.raw).select("n")) == [(1,), (2,)]
    assert logged(spark, arrivals.log) == [
        (arrivals.clean, 0, "has_name", 2, 1),
        (arrivals.clean, 0, "positive", 2, 0),
    ]
    assert written <= {p for p, _, files in os.walk(folder) for f in files if f.endswith(".parquet")}


def test_a_fatal_row_stops_the_stream_until_it_is_gone(spark, folder):
    arrivals = Arrivals(spark, folder)
    arrivals.add(("a", 1))
    arrivals.run()
    arrivals.add(("b", 0))
    with pytest.raises(Exception, match="expectation positive violated"):
        arrivals.run()
    assert arrivals.clean_rows() == [("a", 1)]
    assert {r[1] for r in logged(spark, arrivals.log)} == {0}


def test_another_checkpoint_is_refused(spark, folder):
    arrivals = Arrivals(spark, folder)
    arrivals.add(("a", 1))
    arrivals.run()
    with pytest.raises(ValueError, match="is fed by the checkpoint"):
        arrivals.run("other")
    assert arrivals.clean_rows() == [("a", 1)]


def test_a_new_column_is_added(spark, folder):
    name, log = fresh_name("grown"), f"{folder}/log"
    for i, schema in enumerate((SCHEMA, SCHEMA + ", more int")):
        data = [("a", i)] if i == 0 else [("b", i, 7)]
        spark.createDataFrame(data, schema).write.mode("append").json(f"{folder}/in")
        stream = spark.readStream.schema(schema).json(f"{folder}/in")
        run_declared(stream, f"{folder}/c", [Declared(name, f"{folder}/t")], log)
    assert rows(spark.table(name).select("name", "n", "more")) == [("a", 0, None), ("b", 1, 7)]


def test_clicks_with_a_bad_count_stop(spark, folder):
    raw = spark.createDataFrame([("p", "3", "q"), ("p", "none", "r")], clicks.RAW_SCHEMA)
    with pytest.raises(Exception, match="expectation valid_count violated"):
        clicks.declared_chain(raw, "p", folder, f"{folder}/log", fresh_name("run"))
    good = clicks.declared_chain(raw.limit(1), "p", folder, f"{folder}/log", fresh_name("run"))
    assert rows(good["top"]) == [("q", 3)]
    assert declared.recorded(spark, f"{folder}/log", "no such", "run", 0) is False
