"""Event-time windows over tables and streams.

Tables use long arithmetic on ``ts_ms``; a sliding window is counted in panes
first (one pane per slide), so that rows are never copied once per window, only
pane totals are. Streams use the built-in ``window`` on the watermarked ``ts``
column, which lets Spark drop finished windows from its state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.time import window_start, window_starts

START, END = "window_start_ms", "window_end_ms"
_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
PAGE_VIEWS = {"pv": ("count", "*")}


def _time_column(size_ms: int, slide_ms: int | None) -> Column:
    size = f"{size_ms} milliseconds"
    return F.window("ts", size, f"{slide_ms} milliseconds") if slide_ms else F.window("ts", size)


def _bounds() -> list[Column]:
    return [
        F.unix_millis(F.col("window.start")).alias(START),
        F.unix_millis(F.col("window.end")).alias(END),
    ]


def event_time_counts(
    stream: DataFrame, keys: Sequence[str], size_ms: int, slide_ms: int | None = None
) -> DataFrame:
    """``window, keys, pv`` of a stream. The ``window`` column carries the watermark, which
    a further aggregate in the same query needs."""
    window = _time_column(size_ms, slide_ms).alias("window")
    return stream.groupBy(window, *keys).agg(F.count("*").alias("pv"))


def window_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    size_ms: int,
    slide_ms: int | None = None,
    measures: Mapping[str, tuple[str, str] | Column] = PAGE_VIEWS,
) -> DataFrame:
    """Reduce each window of each key: ``measures`` maps a name to (count|sum|min|max, column)
    or to any aggregate, built-in or a grouped-aggregate UDF.

    Gives ``keys``, the measures and the window bounds. With no key, one row per window.
    Panes are used where totals are known to merge; any other aggregate sees the rows of
    each window, copied once per window they lie in.
    """
    keys = list(keys)
    if any(isinstance(m, Column) for m in measures.values()):
        return _any_aggregate(df, keys, size_ms, slide_ms, measures)
    if df.isStreaming:
        aggs = [_FIRST[kind](column).alias(n) for n, (kind, column) in measures.items()]
        windowed = df.groupBy(*keys, _time_column(size_ms, slide_ms).alias("window")).agg(*aggs)
        return windowed.select(*keys, *_bounds(), *measures)

    slide_ms = slide_ms or size_ms
    pane_ms = gcd(size_ms, slide_ms)
    panes = df.groupBy(*keys, window_start(F.col("ts_ms"), pane_ms).alias("__pane")).agg(
        *[_FIRST[kind](column).alias(n) for n, (kind, column) in measures.items()]
    )
    if pane_ms == size_ms:
        totals = panes.withColumnRenamed("__pane", START)
    else:
        copied = panes.withColumn(
            START, F.explode(window_starts(F.col("__pane"), size_ms, slide_ms))
        )
        totals = copied.groupBy(*keys, START).agg(
            *[_MERGE[kind](n).alias(n) for n, (kind, _) in measures.items()]
        )
    return totals.select(*keys, START, (F.col(START) + size_ms).alias(END), *measures)


def _any_aggregate(df, keys, size_ms, slide_ms, measures) -> DataFrame:
    aggs = [
        (m if isinstance(m, Column) else _FIRST[m[0]](m[1])).alias(n) for n, m in measures.items()
    ]
    if df.isStreaming:
        windowed = df.groupBy(*keys, _time_column(size_ms, slide_ms).alias("window")).agg(*aggs)
        return windowed.select(*keys, *_bounds(), *measures)
    starts = window_starts(F.col("ts_ms"), size_ms, slide_ms or size_ms)
    totals = df.withColumn(START, F.explode(starts)).groupBy(*keys, START).agg(*aggs)
    return totals.select(*keys, START, (F.col(START) + size_ms).alias(END), *measures)


def page_and_visitor_counts(
    df: DataFrame, user: str, size_ms: int, slide_ms: int | None = None
) -> DataFrame:
    """Page views and distinct visitors of each window over all keys.

    Rows are first counted per visitor, so one busy window or visitor is spread
    over all tasks; no task holds the visitors of a window.
    """
    if df.isStreaming:
        window = _time_column(size_ms, slide_ms).alias("window")
        per_user = df.groupBy(window, user).agg(F.count("*").alias("pv"))
        counts = per_user.groupBy("window").agg(F.sum("pv").alias("pv"), F.count(user).alias("uv"))
        return counts.select(*_bounds(), "pv", "uv")
    per_user = window_aggregate(df, [user], size_ms, slide_ms)
    return per_user.groupBy(START, END).agg(
        F.sum("pv").alias("pv"), F.count(user).alias("uv")
    )


def unique_visitors(df: DataFrame, user: str, size_ms: int, slide_ms: int | None = None) -> DataFrame:
    """Distinct visitors of each window."""
    return page_and_visitor_counts(df, user, size_ms, slide_ms).drop("pv")
