"""Epoch-millisecond time."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_ms(ts_ntz: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp, whatever the session zone."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return F.timestamp_diff("MILLISECOND", origin, ts_ntz)


def window_start(ts_ms: Column, size_ms: int) -> Column:
    """Start of the epoch-aligned half-open window of ``size_ms``."""
    return ts_ms - F.pmod(ts_ms, F.lit(size_ms))


def window_starts(ts_ms: Column, size_ms: int, slide_ms: int) -> Column:
    """Starts of every sliding window that holds ``ts_ms``."""
    newest = window_start(ts_ms, slide_ms)
    copies = -(-size_ms // slide_ms)
    if copies == 1 and slide_ms <= size_ms:
        return F.array(newest)
    steps = F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))
    starts = F.transform(steps, lambda i: newest - i * slide_ms)
    if size_ms % slide_ms == 0:
        return starts
    return F.filter(starts, lambda s: s > ts_ms - F.lit(size_ms))
