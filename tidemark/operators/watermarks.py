"""Watermarks in a bounded table, as each row would have met them.

A row sees the watermark left by the rows that arrived before it: their largest
event time, less the allowed disorder and 1 ms.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.routing import union_all
from tidemark.plans.chunks import Chunks
from tidemark.plans.scans import prefix_scan

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def with_watermark_seen(
    df: DataFrame,
    order: Sequence[str],
    delay_ms: int = 0,
    ts_ms: str = "ts_ms",
    name: str = "watermark_ms",
    chunks: Chunks | None = None,
) -> DataFrame:
    """Add the watermark each row sees; null before the first row has passed."""
    scanned = prefix_scan(
        df, order, {name: ("max", F.col(ts_ms))}, inclusive=False, chunks=chunks
    )
    return scanned.withColumn(name, F.col(name) - F.lit(delay_ms + 1))


def with_union_watermark_seen(
    df: DataFrame,
    order: Sequence[str],
    source: str,
    sources: Sequence[str],
    delay_ms: int = 0,
    ts_ms: str = "ts_ms",
    name: str = "watermark_ms",
) -> DataFrame:
    """The watermark of a union: that of its slowest source, null until all have started."""
    marks = {
        f"__wm_{i}": ("max", F.when(F.col(source) == s, F.col(ts_ms)))
        for i, s in enumerate(sources)
    }
    scanned = prefix_scan(df, order, marks, inclusive=False)
    started = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in marks])
    slowest = F.least(*marks) if len(marks) > 1 else F.col(next(iter(marks)))
    return scanned.withColumn(
        name, F.when(started, slowest - F.lit(delay_ms + 1))
    ).drop(*marks)


def union_streams(*streams: DataFrame) -> DataFrame:
    """Streams of one schema in one query, under the watermark of the slowest: what all of
    them have passed. A stream that stands still holds windows and timers open."""
    streams[0].sparkSession.conf.set(POLICY, "min")
    return union_all(*streams)


def time_note(
    user: Column, special: Column, watermark_ms: Column, ts_ms: Column
) -> Column:
    """Text on a row's time context: full for one user, short for the others."""
    mark = F.coalesce(watermark_ms.cast("string"), F.lit("none"))
    short = F.concat(F.lit("watermark="), mark)
    full = F.concat(short, F.lit(", timestamp="), ts_ms.cast("string"))
    return F.when(user == special, full).otherwise(short)
