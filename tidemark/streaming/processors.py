"""Keyed state and timers on streams.

Use with :func:`process`. Rows come in Arrow batches; state of a key is small and
bounded. Rows behind the watermark are dropped by Spark before they get here.

A timer set for ``t`` fires when the watermark reaches ``t``. The original jobs
fire one millisecond later in event time, so event timers are set at ``t + 1``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators import windows
from tidemark.operators.topn import NO_URL
from tidemark.session import ROCKSDB_PROVIDER, STATE_STORE

#: Parts in which the urls of a window are ranked before they meet.
PARTS = 64


def process(
    stream: DataFrame,
    keys: Sequence[str],
    processor: StatefulProcessor,
    schema: str,
    time_mode: str = "None",
    output_mode: str = "Append",
) -> DataFrame:
    """Apply a processor per key. Keyed state needs the RocksDB state store, set here."""
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB_PROVIDER)
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode=output_mode,
        timeMode=time_mode,
    )


def _value(state, default=None):
    return state.get()[0] if state.exists() else default


class TimeContext(StatefulProcessor):
    """Each row with the watermark and the clock time it met."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            yield batch[self.columns].assign(
                watermark_ms=timerValues.getCurrentWatermarkInMs(),
                processing_ms=timerValues.getCurrentProcessingTimeInMs(),
            )

    def close(self) -> None:
        pass


class Timers(StatefulProcessor):
    """One timer per row, ``after_ms`` past its event time or the clock.

    Gives ``key columns, kind, at_ms``: an ``input`` row per row, a ``fired`` row per
    timer. Timers of a key at one time are one timer.
    """

    def __init__(self, keys: Sequence[str], after_ms: int, event_time: bool = True):
        self.keys, self.after_ms, self.event_time = list(keys), after_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def _rows(self, key, kind: str, times) -> pd.DataFrame:
        at = np.asarray(times, dtype=np.int64)
        held = {n: pd.Series([v] * len(at), dtype=object) for n, v in zip(self.keys, key)}
        return pd.DataFrame({**held, "kind": kind, "at_ms": at})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            if self.event_time:
                times = batch["ts_ms"].to_numpy()
                timers = times + self.after_ms + 1
            else:
                now = timerValues.getCurrentProcessingTimeInMs()
                times = np.full(len(batch), now)
                timers = times + self.after_ms
            for timer in np.unique(timers):
                self.handle.registerTimer(int(timer))
            yield self._rows(key, "input", times)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs() - (1 if self.event_time else 0)
        yield self._rows(key, "fired", [at])

    def close(self) -> None:
        pass


def event_timers(stream: DataFrame, keys: Sequence[str], after_ms: int, delay_ms: int = 0) -> DataFrame:
    """What :class:`Timers` gives on event time, for very many rows: built-in state only.

    ``stream`` has ``ts_ms`` and no watermark yet; it is set here, ``delay_ms`` behind. A
    timer is a group of an aggregate, which leaves it when the watermark reaches the timer.
    Every row is an input, late ones too; a timer that the watermark has passed is not set
    again. Rows without a time share one timer without a time per key, fired at once.
    """
    stream.sparkSession.conf.set(STATE_STORE, ROCKSDB_PROVIDER)

    def rows(of: DataFrame, kind: str, at: Column) -> DataFrame:
        return of.select(*keys, F.lit(kind).alias("kind"), at.alias("at_ms"))

    seen = rows(stream, "input", F.col("ts_ms"))
    timer = F.timestamp_millis(F.col("ts_ms") + F.lit(after_ms + 1)).alias("__timer")
    armed = stream.where("ts_ms IS NOT NULL").select(*keys, timer)
    # So far behind the timers is ``delay_ms`` behind the rows.
    armed = armed.withWatermark("__timer", f"{after_ms + 1 + delay_ms} milliseconds")
    passed = armed.groupBy(*keys, "__timer").agg(F.count("*").alias("__rows"))
    fired = rows(passed, "fired", F.unix_millis("__timer") - 1)
    timeless = stream.where("ts_ms IS NULL").select(*keys).dropDuplicates(list(keys))
    return seen.unionByName(fired).unionByName(rows(timeless, "fired", F.lit(None).cast("bigint")))


class PeriodicCounter(StatefulProcessor):
    """Counts a key's rows and reports ``key, timer_ms, cnt`` when its timer fires.

    The first row, and the first after each report, sets the timer; of the rows of one
    micro-batch, that is the earliest.
    """

    def __init__(self, key: str, after_ms: int):
        self.key, self.after_ms = key, after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n bigint")
        self.timer = handle.getValueState("timer", "at bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, first = _value(self.total, 0), None
        for batch in rows:
            n += len(batch)
            earliest = int(batch["ts_ms"].min())
            first = earliest if first is None else min(first, earliest)
        self.total.update((n,))
        if not self.timer.exists() and first is not None:
            at = first + self.after_ms
            self.timer.update((at,))
            self.handle.registerTimer(at + 1)
        yield self._out([], [], [])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        at = expiredTimerInfo.getExpiryTimeInMs() - 1
        yield self._out([key[0]], [at], [_value(self.total, 0)])

    def _out(self, keys: list, times: list, counts: list) -> pd.DataFrame:
        return pd.DataFrame(
            {
                self.key: pd.Series(keys, dtype=object),
                "timer_ms": np.array(times, dtype=np.int64),
                "cnt": np.array(counts, dtype=np.int64),
            }
        )

    def close(self) -> None:
        pass


class TopNBuffer(StatefulProcessor):
    """Top ``n`` of the counts of one window, keyed by its end; padded when it fires.

    Holds the best ``n`` seen so far, never all counts of the window. Feed it with
    candidates (:func:`top_urls`), so that no task sees all counts either.
    """

    def __init__(self, n: int, missing: str):
        self.n, self.missing = n, missing

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", "url string, pv bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = list(self.best.get()) if self.best.exists() else []
        best = [(str(url), int(pv)) for url, pv in held]
        for batch in rows:
            best += [(str(u), int(p)) for u, p in zip(batch["url"], batch["pv"])]
            best = sorted(best, key=lambda row: (-row[1], row[0]))[: self.n]
        self.best.put(best)
        self.handle.registerTimer(int(key[0]))
        yield self._out(key, [], 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        best = [(str(url), int(pv)) for url, pv in self.best.get()]
        self.best.clear()
        yield self._out(key, best, self.n)

    def _out(self, key, best: list, n: int) -> pd.DataFrame:
        padded = best + [(self.missing, 0)] * (n - len(best))
        return pd.DataFrame(
            {
                "window_end_ms": np.full(n, int(key[0]), dtype=np.int64),
                "rank": np.arange(1, n + 1),
                "url": pd.Series([url for url, _ in padded], dtype=object),
                "pv": np.array([pv for _, pv in padded], dtype=np.int64),
            }
        )

    def close(self) -> None:
        pass


def top_urls(
    stream: DataFrame,
    size_ms: int,
    slide_ms: int | None = None,
    n: int = 2,
    missing: str = NO_URL,
    parts: int = PARTS,
) -> DataFrame:
    """``window_end_ms, rank, url, pv``: the ranks 1..n of each window of a stream, once it
    has ended.

    Three stateful operators in one query. Windows are counted per url, and the counts of a
    window that has ended are cut to ``n`` candidates in each of ``parts`` parts, by built-in
    aggregates; a list state per window keeps the best candidates until its timer fires.
    A window leaves the query some micro-batches after the watermark has passed its end.
    """
    counts = windows.event_time_counts(stream, ["url"], size_ms, slide_ms)
    part = F.pmod(F.xxhash64("url"), F.lit(parts)).alias("part")
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("pv")).alias("less"), "url")))
    best = counts.groupBy("window", part).agg(F.slice(ranked, 1, n).alias("best"))
    candidates = best.select(
        F.unix_millis("window.end").alias("window_end_ms"), F.explode("best").alias("one")
    ).select("window_end_ms", "one.url", (-F.col("one.less")).alias("pv"))
    buffer = TopNBuffer(n, missing)
    schema = "window_end_ms bigint, rank bigint, url string, pv bigint"
    return process(candidates, ["window_end_ms"], buffer, schema, "EventTime")
