"""Sequence patterns per key: matches may overlap, every start may match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scans import following


def strict_sequence(
    df: DataFrame,
    key: str,
    conditions: Sequence[Column],
    order: Sequence[str],
    ts_ms: str = "ts_ms",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Rows that meet ``conditions`` one right after the other.

    Gives the key, ``order`` of the first row and ``ts_1`` .. ``ts_n``.
    """
    steps = len(conditions)
    flags = {f"__ok_{i}": F.coalesce(c, F.lit(False)) for i, c in enumerate(conditions, start=1)}
    columns = list(dict.fromkeys([key, *order, ts_ms]))
    flagged = df.select(*columns, *[c.alias(n) for n, c in flags.items()])
    values = [ts_ms, *[f"__ok_{i}" for i in range(2, steps + 1)]]
    looked = following(flagged, order, [key], values, steps - 1, chunk_rows=chunk_rows)
    hit = F.col("__ok_1")
    for i in range(2, steps + 1):
        hit = hit & F.col(f"next_{i - 1}.__ok_{i}")
    return looked.where(hit).select(*_match(key, order, ts_ms, steps))


def relaxed_times(
    df: DataFrame,
    key: str,
    condition: Column,
    times: int,
    order: Sequence[str],
    ts_ms: str = "ts_ms",
    chunk_rows: int | None = None,
) -> DataFrame:
    """``times`` rows that meet ``condition``, whatever other rows lie between."""
    columns = list(dict.fromkeys([key, *order, ts_ms]))
    kept = df.where(condition).select(*columns)
    looked = following(kept, order, [key], [ts_ms], times - 1, chunk_rows=chunk_rows)
    return looked.where(F.col(f"next_{times - 1}").isNotNull()).select(
        *_match(key, order, ts_ms, times)
    )


def _match(key: str, order: Sequence[str], ts_ms: str, steps: int) -> list[Column]:
    first = [F.col(c) for c in order if c != ts_ms]
    later = [F.col(f"next_{i - 1}.{ts_ms}").alias(f"ts_{i}") for i in range(2, steps + 1)]
    return [F.col(key), *first, F.col(ts_ms).alias("ts_1"), *later]


def match_map(steps: dict[str, Column]) -> Column:
    """A match as a map from step name to its list of events."""
    parts = [p for name, event in steps.items() for p in (F.lit(name), F.array(event))]
    return F.create_map(*parts)


def alert_text(user: Column, times: Sequence[Column]) -> Column:
    """One line on a match."""
    return F.concat_ws(" ", user.cast("string"), F.lit("failed at"), *[t.cast("string") for t in times])
