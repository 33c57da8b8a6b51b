"""Distinct counts over event-time windows, for streams and tables alike.

Counts are sketches of fixed size, merged per task before the shuffle: neither
the state nor a crowded window grows with the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sliding_distinct(
    df: DataFrame,
    time: str,
    value: str,
    output: str,
    length: str = "60 minutes",
    slide: str = "10 minutes",
    watermark: str | None = None,
    rsd: float | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Distinct values per overlapping window, ordered by window start.

    Without a ``watermark`` a stream keeps every window it has seen. Ordering a
    stream needs complete output (``run_complete``); without order a stream may hand out
    the windows that a batch changed (``run_merged``).
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    counted = df.groupBy(F.window(time, length, slide).alias("window")).agg(
        _distinct(value, rsd).alias(output)
    )
    return counted.orderBy(F.col("window.start")) if ordered else counted


def tumbling_distinct(
    df: DataFrame,
    time: str,
    value: str,
    output: str,
    length: str = "5 minutes",
    watermark: str | None = "10 minutes",
    rsd: float | None = None,
) -> DataFrame:
    """Distinct values per back-to-back window, in a column named ``time``.

    With a watermark a stream emits a window once it is closed and drops rows
    that arrive for a closed window.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    return df.groupBy(F.window(time, length).alias("time")).agg(
        _distinct(value, rsd).alias(output)
    )


def pane_sketches(
    df: DataFrame,
    time: str,
    value: str,
    pane: str = "10 minutes",
    watermark: str | None = None,
    lg_k: int = 12,
) -> DataFrame:
    """A mergeable sketch of the distinct values in each back-to-back pane.

    The cheap half of a sliding count: a row goes into one pane, not into every
    window that covers it, and a stream keeps one state per pane.
    """
    if watermark:
        df = df.withWatermark(time, watermark)
    return df.groupBy(F.window(time, pane).alias("pane")).agg(
        F.hll_sketch_agg(value, lg_k).alias("sketch")
    )


def windows_from_panes(panes: DataFrame, output: str, panes_per_window: int = 6) -> DataFrame:
    """Distinct values per window of several panes, sliding by one, ordered by start.

    The result of ``sliding_distinct`` from ``pane_sketches``. Counts up to a few
    hundred are exact; beyond, the error is about 1.6% with the default ``lg_k``.
    """
    start, end = F.unix_micros("pane.start"), F.unix_micros("pane.end")
    back = F.explode(F.sequence(F.lit(0), F.lit(panes_per_window - 1))).alias("back")
    placed = panes.select("sketch", start.alias("start"), (end - start).alias("width"), back)
    opened = F.col("start") - F.col("back") * F.col("width")
    window = F.struct(
        F.timestamp_micros(opened).alias("start"),
        F.timestamp_micros(opened + panes_per_window * F.col("width")).alias("end"),
    )
    counted = placed.groupBy(window.alias("window")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(output)
    )
    return counted.orderBy(F.col("window.start"))


def closed_sliding_distinct(
    df: DataFrame,
    time: str,
    value: str,
    output: str,
    length: str = "60 minutes",
    slide: str = "10 minutes",
    watermark: str = "10 minutes",
    lg_k: int = 12,
) -> DataFrame:
    """Distinct values per overlapping window, each window once it is closed.

    Two aggregations under one watermark: a row goes into the pane of length ``slide``
    that it falls into, and a closed pane's sketch into the windows that cover it. A
    stream drops a pane or a window from its state when the watermark passes its end, so
    the state holds the open ones only, whatever has been seen; rows for a closed pane
    are too late. Use append output; ``length`` is a multiple of ``slide``.
    """
    panes = pane_sketches(df, time, value, slide, watermark, lg_k)
    return panes.groupBy(F.window("pane", length, slide).alias("window")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(output)
    )


def _distinct(value: str, rsd: float | None) -> Column:
    return F.approx_count_distinct(value) if rsd is None else F.approx_count_distinct(value, rsd)
