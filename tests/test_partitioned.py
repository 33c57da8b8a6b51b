"""Partitioned datasets and change feeds, also where the driver is lost."""

from __future__ import annotations

import datetime
import os

import pytest
from frames import physical_plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratalake.scratch import fresh_name
from stratalake.sinks import (
    create_partitioned,
    feeds,
    materialize,
    merge,
    partitioned,
    publish_version,
    track_changes,
    upsert,
)
from stratalake.sources import stream_table
from stratalake.streaming import run_once

SCHEMA = "p string, k int, v int"


def frame(spark, *data, schema=SCHEMA):
    return spark.createDataFrame(list(data), schema)


def dataset(spark, folder, *data, schema=SCHEMA, by=("p",)):
    name = fresh_name("d")
    create_partitioned(frame(spark, *data, schema=schema), name, folder, by, comment="Rows")
    return name


def files(folder):
    return {f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_upsert_changes_its_partitions_alone(spark, folder):
    name = dataset(spark, folder, ("a", 1, 10), ("a", 2, 20), ("b", 1, 30), ("c", 9, 90))
    parts = dict(rows(spark.table(partitioned.files_of(name)).select("p", "part_id").distinct()))
    result = upsert(frame(spark, ("a", 2, 21), ("a", 3, 31), ("d", 1, 1)), name, ["p", "k"], folder)
    expected = [
        ("a", 1, 10), ("a", 2, 21), ("a", 3, 31), ("b", 1, 30), ("c", 9, 90), ("d", 1, 1),
    ]
    assert rows(result) == rows(spark.table(name)) == expected
    now = rows(spark.read.parquet(feeds.shown_version(spark, name)))
    assert {p for p, part in now if part == parts.get(p)} == {"b", "c"}
    assert result.columns == ["p", "k", "v"]
    assert spark.catalog.getTable(name).description == "Rows"


def test_partitions_are_pruned_when_the_join_runs(spark, folder):
    name = dataset(spark, folder, *[(p, 1, 1) for p in "abcdef"])
    source = frame(spark, ("b", 1, 2), ("x", 1, 1))
    source.write.parquet(f"{folder}/source")
    affected, kept = partitioned.touched(spark.read.parquet(f"{folder}/source"), name)
    plan = physical_plan(affected)
    assert "dynamicpruning" in plan and "part_id" in plan
    assert rows(affected) == [("b", 1, 1)]
    assert [p for p, _ in rows(kept)] == list("acdef")
    assert "dynamicpruning" in physical_plan(spark.table(name))
    # Readers' own conditions reach the folders too.
    assert "PartitionFilters: [isnotnull(p" in physical_plan(spark.table(name).where("p = 'c'"))


def test_values_that_folders_escape(spark, folder):
    odd = ["", " ", "a/b", "it's", "x=y", "100%", "back\\slash", "é", 'quo"te', None, "null", "a b"]
    name = dataset(spark, folder, *[(p, i, 0) for i, p in enumerate(odd)])
    before = rows(spark.table(name))
    assert len(before) == len(odd)
    stored = {p for p, _, _ in before}
    # Folders have one name for null and for empty text.
    assert stored == set(odd) - {""}
    changed = [(p, i, 1) for i, p in enumerate(odd) if p]
    result = upsert(frame(spark, *changed, (None, 77, 1)), name, ["p", "k"], folder)
    assert rows(result.where("v = 1 AND p IS NOT NULL").select("p", "k")) == sorted(
        [(p, i) for p, i, _ in changed], key=repr
    )
    assert rows(result.where("p IS NULL").select("k", "v")) == [(0, 0), (77, 1), (9, 0)]


def test_typed_and_several_partition_columns(spark, folder):
    schema = "day date, n bigint, k int, v int"
    days = [datetime.date(2024, 1, d) for d in (1, 2)]
    data = [(d, n, 1, 0) for d in days for n in (1, 2)]
    name = dataset(spark, folder, *data, schema=schema, by=("day", "n"))
    change = frame(spark, (days[0], 2, 1, 5), (days[1], 3, 1, 6), schema=schema)
    result = upsert(change, name, ["day", "n", "k"], folder)
    assert result.schema.simpleString() == "struct<day:date,n:bigint,k:int,v:int>"
    assert rows(result.select("day", "n", "v")) == [
        (days[0], 1, 0), (days[0], 2, 5), (days[1], 1, 0), (days[1], 2, 0), (days[1], 3, 6),
    ]


def test_rows_that_would_move_or_repeat_are_refused(spark, folder):
    name = dataset(spark, folder, ("a", 1, 1))
    with pytest.raises(ValueError, match="no keys"):
        upsert(frame(spark, ("b", 1, 2)), name, "k", folder)
    with pytest.raises(ValueError, match="several source rows"):
        upsert(frame(spark, ("a", 1, 2), ("a", 1, 3)), name, ["p", "k"], folder)
    with pytest.raises(ValueError, match="tells parts apart"):
        create_partitioned(frame(spark, ("a", 1, "x"), schema="p string, k int, part_id string"),
                           fresh_name("d"), folder, ["p"])
    assert rows(spark.table(name)) == [("a", 1, 1)]
    assert rows(upsert(frame(spark, ("a", 1, 2)).limit(0), name, ["p", "k"], folder)) == [("a", 1, 1)]


STEPS = ("overwrite_files", "_add_partitions", "_write_manifest", "_replace_view")


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("step", STEPS)
def test_a_lost_driver_shows_all_or_nothing(spark, folder, monkeypatch, step, when):
    name = dataset(spark, folder, ("a", 1, 10), ("b", 1, 10), ("c", 1, 10))
    track_changes(spark, name, f"{folder}/feed")
    run_once(stream_table(spark, name), f"{folder}/checkpoint", f"{folder}/copy")
    change = frame(spark, ("a", 1, 11), ("b", 2, 20))
    with monkeypatch.context() as patch:
        plain = getattr(partitioned, step)

        def fails(*args, **kwargs):
            if when == "after":
                plain(*args, **kwargs)
            raise RuntimeError("driver lost")

        patch.setattr(partitioned, step, fails)
        with pytest.raises(RuntimeError, match="driver lost"):
            upsert(change, name, ["p", "k"], folder)
    old = [("a", 1, 10), ("b", 1, 10), ("c", 1, 10)]
    new = [("a", 1, 11), ("b", 1, 10), ("b", 2, 20), ("c", 1, 10)]
    shown = (step, when) == ("_replace_view", "after")
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name)) == (new if shown else old)
    # The stream sees the change if and only if readers do, and once.
    changes = [("a", 1, 11), ("b", 2, 20)]
    for _ in range(2):
        run_once(stream_table(spark, name), f"{folder}/checkpoint", f"{folder}/copy")
        expected = sorted(old + changes) if shown else old
        assert rows(spark.read.parquet(f"{folder}/copy")) == expected
    assert rows(upsert(change, name, ["p", "k"], folder)) == new
    run_once(stream_table(spark, name), f"{folder}/checkpoint", f"{folder}/copy")
    expected = sorted(old + changes * (2 if shown else 1))
    assert rows(spark.read.parquet(f"{folder}/copy")) == expected


@pytest.mark.parametrize("step", ["publish_version", "feeds.complete"])
def test_a_plain_table_and_its_feed_agree(spark, folder, monkeypatch, step):
    name = fresh_name("t")
    publish_version(frame(spark, ("a", 1, 10)), name, f"{folder}/first")
    track_changes(spark, name, f"{folder}/feed")
    change = frame(spark, ("a", 1, 11), ("b", 2, 20))
    with monkeypatch.context() as patch:
        if step == "publish_version":
            patch.setattr(merge, "publish_version", lambda *a, **k: 1 / 0)
        else:
            calls = []

            def complete(spark, name, plain=feeds.complete):
                calls.append(name)
                return plain(spark, name) if len(calls) == 1 else 1 / 0

            patch.setattr(merge.feeds, "complete", complete)
        with pytest.raises(ZeroDivisionError):
            upsert(change, name, ["p", "k"], folder)
    shown = step == "feeds.complete"
    run_once(stream_table(spark, name), f"{folder}/checkpoint", f"{folder}/copy")
    changes = [("a", 1, 11), ("b", 2, 20)] if shown else []
    assert rows(spark.read.parquet(f"{folder}/copy")) == [("a", 1, 10), *changes]
    assert rows(spark.table(name)) == ([("a", 1, 11), ("b", 2, 20)] if shown else [("a", 1, 10)])


def test_a_feed_that_was_written_in_part_is_written_again(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, ("a", 1, 10)), name, f"{folder}/first")
    track_changes(spark, name, f"{folder}/feed")
    upsert(frame(spark, ("a", 1, 11), ("b", 2, 20)), name, ["p", "k"], folder)
    version = os.path.basename(feeds.shown_version(spark, name))
    staged = f"{folder}/staged"
    frame(spark, ("a", 1, 11), ("b", 2, 20)).write.parquet(staged)
    change = f"{folder}/feed/change={version}"
    frame(spark, ("a", 1, 11)).write.mode("overwrite").parquet(change)
    feeds.begin(spark, name, staged, feeds.shown_version(spark, name))
    assert feeds.feed_of(spark, name) == f"{folder}/feed"
    assert rows(spark.read.parquet(change)) == [("a", 1, 11), ("b", 2, 20)]
    written = files(change)
    feeds.begin(spark, name, staged, feeds.shown_version(spark, name))
    feeds.complete(spark, name)
    assert files(change) == written


def test_a_stream_over_replaced_rows_is_refused(spark, folder):
    name = fresh_name("t")
    materialize(frame(spark, ("a", 1, 1)), name, folder)
    run_once(stream_table(spark, name), f"{folder}/checkpoint", f"{folder}/copy")
    upsert(frame(spark, ("a", 1, 2)), name, ["p", "k"], folder)
    with pytest.raises(ValueError, match="have been replaced"):
        stream_table(spark, name)
    again = fresh_name("t")
    materialize(frame(spark, ("a", 1, 1)), again, folder)
    materialize(frame(spark, ("b", 1, 1)), again, folder)
    with pytest.raises(ValueError, match="have been replaced"):
        stream_table(spark, again)


def test_a_table_changed_by_partitions_cannot_be_tracked(spark, folder):
    name = fresh_name("t")
    publish_version(frame(spark, ("a", 1, 1)), name, f"{folder}/first", ["p"])
    with pytest.raises(ValueError, match="use create_partitioned"):
        track_changes(spark, name, f"{folder}/feed")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.tuples(st.sampled_from("abc"), st.integers(0, 3)), st.integers(0, 9), max_size=8),
    st.lists(
        st.dictionaries(st.tuples(st.sampled_from("abcd"), st.integers(0, 3)), st.integers(0, 9), max_size=5),
        min_size=1, max_size=2,
    ),
)
def test_upserts_are_those_of_a_dictionary(spark, tmp_path_factory, start, changes):
    folder = str(tmp_path_factory.mktemp("d"))
    name = dataset(spark, folder, *[(*key, v) for key, v in start.items()])
    for change in changes:
        start = start | change
        upsert(frame(spark, *[(*key, v) for key, v in change.items()]), name, ["p", "k"], folder)
    assert rows(spark.table(name)) == sorted((*key, v) for key, v in start.items())
