from __future__ import annotations

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stratalake.operators import explode_keep, explode_only, items_as_rows, promote_struct


def test_promoted_fields_come_first(spark):
    df = spark.createDataFrame([(1, (2, "x"))], "a int, s struct<b: int, c: string>")
    assert promote_struct(df, "s").columns == ["b", "c", "a"]
    assert rows(promote_struct(df, "s")) == [(2, "x", 1)]


def test_null_struct_gives_null_fields(spark):
    df = spark.createDataFrame([(1, None)], "a int, s struct<b: int>")
    assert rows(promote_struct(df, "s")) == [(None, 1)]


def test_name_clash_is_refused_or_prefixed(spark):
    df = spark.createDataFrame([(1, (2,))], "a int, s struct<A: int>")
    with pytest.raises(ValueError, match="already are columns"):
        promote_struct(df, "s")
    assert promote_struct(df, "s", prefix="s_").columns == ["s_A", "a"]
    with pytest.raises(TypeError, match="not a struct"):
        promote_struct(df, "a")


def test_struct_may_share_a_field_name_with_itself(spark):
    df = spark.createDataFrame([((1,),)], "s struct<s: int>")
    assert rows(promote_struct(df, "s")) == [(1,)]


def test_explode_drops_rows_without_elements_but_keeps_null_elements(spark):
    df = spark.createDataFrame([(1, [10, None]), (2, []), (3, None)], "k int, v array<int>")
    assert rows(explode_only(df, "v")) == [(10,), (None,)]
    assert rows(explode_keep(df, "v")) == [(1, 10), (1, None)]
    with pytest.raises(ValueError, match="K already is a column"):
        explode_keep(df, "v", alias="K")
    assert rows(explode_keep(df, "v", alias="v")) == [(1, 10), (1, None)]


def test_items_as_rows_takes_arrays_and_structs(spark):
    data = [(1, [(5,), (6,)]), (2, None), (3, [])]
    many = items_as_rows(spark.createDataFrame(data, "k int, i array<struct<p: int>>"), "i")
    assert rows(many.select("k", "i.p")) == [(1, 5), (1, 6), (2, None), (3, None)]
    single = spark.createDataFrame([(1, (5,)), (2, None)], "k int, i struct<p: int>")
    assert rows(items_as_rows(single, "i").select("k", "i.p")) == [(1, 5), (2, None)]


arrays_or_none = st.one_of(st.none(), st.lists(st.integers(0, 9), max_size=5))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(arrays_or_none, min_size=1, max_size=8))
def test_one_row_per_element(spark, arrays):
    df = spark.createDataFrame(list(enumerate(arrays)), "k int, v array<int>")
    expected = sorted((k, e) for k, array in enumerate(arrays) for e in array or [])
    assert rows(explode_keep(df, "v")) == expected
