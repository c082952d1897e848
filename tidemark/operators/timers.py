"""Timers in bounded tables: when each one fires, and what it reports.

Every timer is armed by a row. An event-time timer fires at the first later
arrival that carries the watermark to it; one that is already past when armed
fires when the watermark next moves. Timers still armed at the end of input fire
then. Streams use the processors in :mod:`tidemark.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.chunks import CHUNK, CHUNK_ROWS, plan_chunks
from tidemark.plans.scans import CARRY, prefix_scan, stack
from tidemark.session import cut_lineage

END_OF_INPUT = 2**63 - 1


def _with_firing(
    df: DataFrame,
    keep: Sequence[str],
    order: Sequence[str],
    after_ms: int,
    delay_ms: int,
    chunk_rows: int | None,
) -> DataFrame:
    """Add ``timer_ms``, ``__seen`` (largest event time before the row) and ``__fires``.

    ``__fires`` is a struct of ``order`` and ``ts_ms`` of the arrival that fires the
    timer of the row, null at the end of input.
    """
    columns = list(dict.fromkeys([*keep, *order, "ts_ms"]))
    timer = F.col("ts_ms") + F.lit(after_ms)
    seen = prefix_scan(
        df.select(*columns),
        order,
        {"__seen": ("max", F.col("ts_ms"))},
        inclusive=False,
        chunk_rows=chunk_rows,
    )
    marked = cut_lineage(
        seen.select(
            *columns,
            "__seen",
            timer.alias("timer_ms"),
            F.greatest(timer + F.lit(delay_ms), "__seen", "ts_ms").alias("__passes"),
        ).withColumn("__passes", F.col("__passes") + 1)
    )
    # Only a new maximum moves the watermark, and each maximum comes once. A rise counts for
    # rows at its own time, so it stands behind them; rows of one time are told apart, as
    # after an outlier very many wait for the same rise.
    rises = F.col("__seen").isNull() | (F.col("ts_ms") > F.col("__seen"))
    waiting = marked.withColumn("__tie", F.col(order[-1]).cast("bigint"))
    arrivals = marked.where(rises).select(
        F.col("ts_ms").alias("__passes"),
        F.lit(END_OF_INPUT).alias("__tie"),
        F.struct(*order, "ts_ms").alias("__rise"),
    )
    reached = prefix_scan(
        waiting.unionByName(arrivals, allowMissingColumns=True),
        ["__passes", "__tie"],
        {"__fires": ("min", F.col("__rise"))},
        reverse=True,
        chunk_rows=chunk_rows,
    )
    return reached.where(F.col("__rise").isNull()).drop("__rise", "__tie")


def event_timers(
    df: DataFrame,
    order: Sequence[str],
    after_ms: int = 5_000,
    delay_ms: int = 0,
    keys: Sequence[str] = (),
    chunk_rows: int | None = None,
) -> DataFrame:
    """One timer per row at ``ts_ms + after_ms``; one firing per key and time.

    Gives ``timer_ms``, the arrival that fires it (``fired_by_...``) and the watermark
    at that moment, both null at the end of input.
    """
    fired = _with_firing(df, keys, order, after_ms, delay_ms, chunk_rows)
    return fired.select(
        *keys,
        "timer_ms",
        *[F.col(f"__fires.{c}").alias(f"fired_by_{c}") for c in order],
        (F.col("__fires.ts_ms") - F.lit(delay_ms + 1)).alias("watermark_ms"),
    ).distinct()


def processing_timers(
    df: DataFrame, arrived_ms: str, after_ms: int = 10_000, keys: Sequence[str] = ()
) -> DataFrame:
    """Timers on recorded arrival time: ``after_ms`` later, one per key and time."""
    return df.select(*keys, (F.col(arrived_ms) + F.lit(after_ms)).alias("timer_ms")).distinct()


def periodic_counter(
    df: DataFrame,
    user: str,
    order: Sequence[str],
    after_ms: int = 10_000,
    delay_ms: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Report each user's row count so far, at most once per timer.

    A user's first row arms a timer ``after_ms`` later; when it fires the count is
    reported and the user's next row arms again. The count is never reset.

    Only the first row of a user after the watermark moved can arm, so other rows
    are dropped before the walk: what is left per user is bounded by the number of
    distinct event times. Users with many such rows are walked in chunks.
    """
    at = ["__o0", "__o1"]
    fired = _with_firing(df, [user], order, after_ms, delay_ms, chunk_rows)
    never = F.lit(END_OF_INPUT)
    fired = cut_lineage(
        fired.select(
            user,
            F.col(order[0]).alias("__o0"),
            F.col(order[-1]).alias("__o1"),
            "timer_ms",
            "__seen",
            F.coalesce(F.col(f"__fires.{order[0]}"), never).alias("__f0"),
            F.coalesce(F.col(f"__fires.{order[-1]}"), never).alias("__f1"),
        )
    )
    # ``__seen`` never falls along the order, so its running maximum is the value at
    # the user's previous row.
    counted = prefix_scan(
        fired,
        at,
        {"__before": ("sum", F.lit(1).cast("bigint")), "__prev": ("max", F.col("__seen"))},
        [user],
        inclusive=False,
        chunk_rows=chunk_rows,
    )
    may_arm = F.col("__before").isNull() | ~F.col("__seen").eqNullSafe(F.col("__prev"))
    candidates = cut_lineage(
        counted.where(may_arm)
        .withColumn("__before", F.coalesce("__before", F.lit(0).cast("bigint")))
        .drop("__prev")
    )
    arms = _armed(candidates, user, at, after_ms + delay_ms + 1, chunk_rows)
    totals = df.groupBy(user).agg(F.count("*").alias("__before"))
    ends = totals.select(user, *[never.alias(c) for c in at], "__before")
    next_arm = W.partitionBy(user).orderBy(*at)
    return (
        arms.unionByName(ends, allowMissingColumns=True)
        .withColumn("cnt", F.lead("__before").over(next_arm))
        .where(F.col("timer_ms").isNotNull())
        .select(user, "timer_ms", "cnt")
    )


def _armed(
    candidates: DataFrame, user: str, at: Sequence[str], horizon_ms: int, chunk_rows: int | None
) -> DataFrame:
    """The candidates that arm a timer, found by walking arm -> fire -> next row."""
    chunks = plan_chunks(candidates, at, [user], chunk_rows)
    rows = chunks.assign(candidates)
    pairs = [("__o0", "__o1"), ("__f0", "__f1")]
    stacked = rows.withColumn(CARRY, F.lit(False))
    if chunks.split:
        user_type = candidates.schema[user].dataType
        exit_schema = T.StructType(
            [T.StructField(user, user_type), T.StructField(CHUNK, T.IntegerType())]
            + [T.StructField(c, T.LongType()) for pair in pairs for c in pair]
        )
        exits = (
            rows.where(F.col(CHUNK) > 0)
            .select(user, CHUNK, "__seen", *[c for pair in pairs for c in pair])
            .groupBy(user, CHUNK)
            .applyInPandas(lambda g: _chunk_exits(g, user, horizon_ms), exit_schema)
        )
        pending = _pending(cut_lineage(exits), user, len(chunks.cuts) + 1, chunk_rows)
        stacked = stack(rows, pending)
    # Many small users share a call; a chunk of a hot user has its own.
    shuffles = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calls = max(2 * shuffles, chunks.rows // (chunk_rows or CHUNK_ROWS))
    call = F.when(F.col(CHUNK) > 0, F.xxhash64(user, CHUNK)).otherwise(
        F.pmod(F.xxhash64(user), F.lit(calls))
    )
    arm_schema = T.StructType([candidates.schema[c] for c in (user, *at, "timer_ms", "__before")])
    names = arm_schema.fieldNames()
    return (
        stacked.select(*names, "__f0", "__f1", CHUNK, CARRY)
        .groupBy(call.alias("__call"))
        .applyInPandas(lambda g: _walk(g, user)[names], arm_schema)
    )


def _codes(*pairs: tuple[np.ndarray, np.ndarray]) -> Iterator[np.ndarray]:
    """Number pairs of integers by their order, the same across all given arrays."""
    first = np.concatenate([p[0] for p in pairs]).astype(np.int64)
    second = np.concatenate([p[1] for p in pairs]).astype(np.int64)
    by = np.lexsort((second, first))
    step = (np.diff(first[by]) != 0) | (np.diff(second[by]) != 0)
    codes = np.empty(len(by), dtype=np.int64)
    codes[by] = np.concatenate([[0], np.cumsum(step)])
    return iter(np.split(codes, np.cumsum([len(p[0]) for p in pairs])[:-1]))


def _columns(g: pd.DataFrame, *names: str) -> tuple[np.ndarray, ...]:
    return tuple(g[n].to_numpy(dtype=np.int64) for n in names)


def _walk(g: pd.DataFrame, user: str) -> pd.DataFrame:
    """Rows that arm a timer, for all users and chunks of a call at once."""
    g = g.assign(__part=g.groupby([user, CHUNK], dropna=False).ngroup())
    carried = g[CARRY].to_numpy(dtype=bool)
    rows = g[~carried].sort_values(["__part", "__o0", "__o1"], ignore_index=True)
    held = g[carried]
    at, fires, pending = _codes(
        _columns(rows, "__o0", "__o1"),
        _columns(rows, "__f0", "__f1"),
        _columns(held, "__f0", "__f1"),
    )
    part, n = rows["__part"].to_numpy(dtype=np.int64), len(rows)
    span = 2 * len(g) + 1
    places = part * span + at

    def first_after(of: np.ndarray, code: np.ndarray) -> np.ndarray:
        found = np.searchsorted(places, of * span + code, side="right")
        return np.where(found < np.searchsorted(part, of, side="right"), found, n)

    following = first_after(part, fires)
    starts = np.flatnonzero(np.r_[True, np.diff(part) != 0][:n])
    entered = held["__part"].to_numpy(dtype=np.int64)
    free = starts[~np.isin(part[starts], entered)]
    step = np.concatenate([free, first_after(entered, pending)])
    armed = []
    while len(step := step[step < n]):
        armed.append(step)
        step = following[step]
    return rows.iloc[np.concatenate(armed) if armed else []]


def _chunk_exits(g: pd.DataFrame, user: str, horizon_ms: int) -> pd.DataFrame:
    """Where a walk that enters this chunk at a row has its last timer fire.

    Only rows that a timer from an earlier chunk can lead to are listed: those up to
    the first row that met a watermark ``horizon_ms`` past the chunk's start.
    """
    g = g.sort_values(["__o0", "__o1"], ignore_index=True)
    at, fires = _codes(_columns(g, "__o0", "__o1"), _columns(g, "__f0", "__f1"))
    n = len(at)
    seen = g["__seen"].to_numpy(dtype=float, na_value=-np.inf)
    entries = min(n, int(np.searchsorted(seen, seen[0] + horizon_ms, side="left")) + 1)
    jump = np.append(np.searchsorted(at, fires, side="right"), n)
    last = np.arange(n + 1)
    while (inside := jump < n).any():
        last = np.where(inside, last[jump], last)
        jump = np.where(inside, jump[jump], jump)
    final = last[:entries]
    return pd.DataFrame(
        {
            user: g[user].iloc[:entries],
            CHUNK: g[CHUNK].iloc[:entries],
            "__o0": g["__o0"].iloc[:entries],
            "__o1": g["__o1"].iloc[:entries],
            "__f0": g["__f0"].to_numpy()[final],
            "__f1": g["__f1"].to_numpy()[final],
        }
    )


def _pending(exits: DataFrame, user: str, chunks: int, chunk_rows: int | None) -> DataFrame:
    """The firing still awaited when each chunk of a user starts, if there is one.

    An exit leads to the first one of the user that lies after its firing. The exits on the
    way from a user's first one are found by pointer doubling: each round doubles both how
    far a pointer leads and how many of them are known.
    """
    ends = exits.select(user, F.col("__f0").alias("__o0"), F.col("__f1").alias("__o1"))
    places = cut_lineage(
        exits.select(user, "__o0", "__o1", F.struct("__o0", "__o1").alias("__exit"))
        .unionByName(ends, allowMissingColumns=True)
        .groupBy(user, "__o0", "__o1")
        .agg(F.min("__exit").alias("__exit"))
    )
    after = prefix_scan(
        places, ["__o0", "__o1"], {"__next": ("min", F.col("__exit"))}, [user],
        inclusive=False, reverse=True, chunk_rows=chunk_rows,
    ).where(F.col("__next").isNotNull())
    leads = _joined(
        exits.select(user, F.struct("__o0", "__o1").alias("__from"), F.struct("__f0", "__f1").alias("__to")),
        after.select(user, F.struct("__o0", "__o1").alias("__at"), F.col("__next").alias("__then")),
        user,
    )
    leads = cut_lineage(leads)
    known = cut_lineage(exits.groupBy(user).agg(F.min(F.struct("__o0", "__o1")).alias("__to")))
    for _ in range(chunks.bit_length()):
        steps = leads.select(user, F.col("__from").alias("__at"), F.col("__to").alias("__then"))
        more = cut_lineage(_joined(known, steps, user).select(user, "__to"))
        if more.isEmpty():
            break
        known = cut_lineage(known.unionByName(more))
        leads = cut_lineage(_joined(leads, steps, user))
    on_way = _joined(
        known,
        exits.select(user, F.struct("__o0", "__o1").alias("__at"), F.struct(CHUNK, "__f0", "__f1").alias("__then")),
        user,
    ).select(user, F.col(f"__to.{CHUNK}").alias(CHUNK), F.struct("__to.__f0", "__to.__f1").alias("__held"))
    # One row per chunk and user here: a user's chunks bound each group.
    starts = exits.select(user, CHUNK).distinct()
    last = F.last("__held", ignorenulls=True).over(
        W.partitionBy(user).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        starts.unionByName(on_way, allowMissingColumns=True)
        .groupBy(user, CHUNK)
        .agg(F.max("__held").alias("__held"))
        .withColumn("__held", last)
        .where(F.col("__held").isNotNull())
        .select(user, CHUNK, "__held.__f0", "__held.__f1")
    )


def _joined(pointers: DataFrame, steps: DataFrame, user: str) -> DataFrame:
    """``pointers`` with ``__to`` moved on by ``steps`` (from ``__at`` to ``__then``); those
    that lead nowhere go."""
    steps = steps.withColumnRenamed(user, "__whose")
    same = F.col(user).eqNullSafe(F.col("__whose")) & (F.col("__to") == F.col("__at"))
    return pointers.join(steps, same).drop("__to", "__at", "__whose").withColumnRenamed("__then", "__to")
