"""Late rows: window counts that fire again, and a side output for the rest.

A row is late for a window if some earlier arrival has already carried the
watermark past the window's end. So instead of a running maximum over all rows,
it is enough to know, for every window, the first arrival that closes it and the
first that drops it: a table with one row per window, made from cells as long as the
greatest common divisor of all durations. Rows meet that table in a
join on the window and are classified in place, with no sort or shuffle of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import window_start, window_starts
from tidemark.operators.accumulators import Accumulator, finished, merged, partials, running_accumulate
from tidemark.operators.windows import END, START
from tidemark.plans.scans import first_arrivals, prefix_scan
from tidemark.session import cut_lineage

ON_TIME, LATE, DROPPED = "on_time", "late", "dropped"
CLASS = "lateness"
BROADCAST_WINDOWS = 500_000


def window_deadlines(
    df: DataFrame,
    order: Sequence[str],
    size_ms: int,
    slide_ms: int | None = None,
    delay_ms: int = 0,
    lateness_ms: int = 0,
) -> DataFrame:
    """Per window, ``__closes`` and ``__drops``: the arrivals that end its two phases.

    An arrival is a struct of the ``order`` columns; null means it never came.
    """
    slide_ms = slide_ms or size_ms
    cell_ms = gcd(gcd(size_ms, slide_ms), gcd(delay_ms, lateness_ms))
    arrival = F.struct(*order)
    cells = cut_lineage(
        df.where(F.col("ts_ms").isNotNull()).groupBy(window_start(F.col("ts_ms"), cell_ms).alias("cell")).agg(
            F.min(arrival).alias("first")
        )
    )
    windows = cells.select(
        F.explode(window_starts(F.col("cell"), size_ms, slide_ms)).alias(START)
    ).distinct()
    # A window [s, e) closes at the first arrival with ts_ms >= e + delay, and is
    # dropped at the first with ts_ms >= e + delay + lateness; both are cell borders.
    marks = windows.select(
        START,
        F.explode(
            F.create_map(
                F.lit("__closes"), F.col(START) + F.lit(size_ms + delay_ms),
                F.lit("__drops"), F.col(START) + F.lit(size_ms + delay_ms + lateness_ms),
            )
        ).alias("mark", "cell"),
    )
    reached = first_arrivals(cells, marks.select("cell"), "cell")
    return (
        marks.join(reached, "cell")
        .groupBy(START)
        .agg(
            F.max(F.when(F.col("mark") == "__closes", F.col("arrival"))).alias("__closes"),
            F.max(F.when(F.col("mark") == "__drops", F.col("arrival"))).alias("__drops"),
        )
    )


def _by_window(df: DataFrame, deadlines: DataFrame) -> DataFrame:
    """Join on the window; broadcast only a table counted to be small."""
    deadlines = cut_lineage(deadlines)
    if deadlines.count() <= BROADCAST_WINDOWS:
        deadlines = F.broadcast(deadlines)
    return df.join(deadlines, START, "left")


def _class(order: Sequence[str]) -> Column:
    arrival = F.struct(*order)
    return (
        F.when(F.col(START).isNull() | (F.col("__drops") < arrival), DROPPED)
        .when(F.col("__closes") < arrival, LATE)
        .otherwise(ON_TIME)
    )


def classify(
    df: DataFrame,
    order: Sequence[str],
    size_ms: int,
    slide_ms: int | None = None,
    delay_ms: int = 0,
    lateness_ms: int = 0,
) -> DataFrame:
    """One row per row and window of it, with ``lateness``: on_time, late or dropped.

    A row without time is in no window and counts as dropped.
    """
    deadlines = window_deadlines(df, order, size_ms, slide_ms, delay_ms, lateness_ms)
    starts = window_starts(F.col("ts_ms"), size_ms, slide_ms or size_ms)
    assigned = df.withColumn(START, F.explode_outer(starts) if slide_ms else starts[0])
    return _by_window(assigned, deadlines).withColumn(CLASS, _class(order)).drop(
        "__closes", "__drops"
    )


def side_output(
    df: DataFrame,
    order: Sequence[str],
    size_ms: int,
    slide_ms: int | None = None,
    delay_ms: int = 0,
    lateness_ms: int = 0,
) -> DataFrame:
    """Rows that came too late for every window of theirs, and rows without time.

    The newest window of a row is dropped last, so it alone decides.
    """
    deadlines = window_deadlines(df, order, size_ms, slide_ms, delay_ms, lateness_ms)
    newest = window_start(F.col("ts_ms"), slide_ms or size_ms)
    return (
        _by_window(df.withColumn(START, newest), deadlines)
        .where(_class(order) == DROPPED)
        .select(*df.columns)
    )


def refiring_counts(
    classified: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size_ms: int,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Window counts of each firing, from the output of :func:`classify`.

    ``first``: rows on time, once per key and window. ``refire``: one row per late
    row, in arrival order, with the count so far. ``order`` names the late row and
    is null for the first firing.
    """
    group = [*keys, START]
    kept = classified.where(F.col(CLASS) != DROPPED)
    # The on-time total of a window is one more addend in front of its late rows.
    first = (
        kept.where(F.col(CLASS) == ON_TIME).groupBy(*group).agg(F.count("*").alias("__n"))
    )
    late = kept.where(F.col(CLASS) == LATE).select(
        *group, *order, F.lit(1).cast("bigint").alias("__n")
    )
    lowest = F.lit(-(2**63)).cast("bigint")
    opening = first.select(*group, *[lowest.alias(c) for c in order], "__n", F.lit(True).alias("__first"))
    addends = cut_lineage(late.withColumn("__first", F.lit(False)).unionByName(opening))
    counted = prefix_scan(
        addends, order, {"pv": ("sum", F.col("__n"))}, group, chunk_rows=chunk_rows
    )
    shown = [F.when(~F.col("__first"), F.col(c)).alias(c) for c in order]
    return counted.select(
        *group,
        (F.col(START) + size_ms).alias(END),
        F.when(F.col("__first"), "first").otherwise("refire").alias("firing"),
        *shown,
        "pv",
    )


def refirings(
    classified: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size_ms: int,
    accumulator: Accumulator,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Each firing of each window, with what ``accumulator`` makes of the rows so far; from
    the output of :func:`classify`.

    ``first`` and ``refire`` as in :func:`refiring_counts`, with the columns of the
    accumulator's result in place of the count.
    """
    group = [*keys, START]
    rows = classified.drop(CLASS)
    on_time = rows.where(classified[CLASS] == ON_TIME)
    late = cut_lineage(rows.where(classified[CLASS] == LATE))
    openings = cut_lineage(merged(partials(on_time, group, accumulator), group, accumulator, done=False))
    return firings(openings, openings, late, keys, order, size_ms, accumulator, chunk_rows)


def firings(
    firsts: DataFrame,
    openings: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    size_ms: int,
    accumulator: Accumulator,
    chunk_rows: int | None = None,
) -> DataFrame:
    """First firings of the windows in ``firsts`` and one firing per row of ``late``, on top of
    what ``openings`` hold."""
    group, results = [*keys, START], T.StructType.fromDDL(accumulator.schema).names
    again = running_accumulate(late, group, order, accumulator, openings, chunk_rows)
    end = (F.col(START) + size_ms).alias(END)
    once = finished(firsts, group, accumulator).select(
        *group, end, F.lit("first").alias("firing"), *[F.lit(None).cast("bigint").alias(c) for c in order], *results
    )
    more = again.select(*group, end, F.lit("refire").alias("firing"), *order, *results)
    return once.unionByName(more)
