"""Window aggregates and window functions that users write.

An :class:`Accumulator` merges, so rows are folded where they are read: each task keeps one
accumulator per key and pane, and only accumulators are shuffled. A busy window costs a
task no more than its own share of the rows. Where very many tasks hold a part of one
window, parts are merged a bounded number at a time. Sliding windows merge panes.

Running results (:func:`running_accumulate`) follow an order, hot keys in chunks. A function
of all rows of a window (:func:`process_windows`) cannot be cut. Its rows come
as an iterator of Arrow batches, so a large window need not fit in memory.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import gcd
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import window_start, window_starts
from tidemark.operators.windows import END, START
from tidemark.plans.chunks import CHUNK, plan_chunks
from tidemark.session import cut_lineage

PANE, PART, HELD = "__pane", "__part", "__held"
_FIRST, _T = "__opens", T.StructType
#: A task hands on what it holds after so many groups or rows.
FLUSH_GROUPS, FLUSH_ROWS = 100_000, 1_000_000
#: So many parts of a window are merged by one task at a time.
FAN_IN = 64


class Accumulator:
    """A window aggregate: subclass it and give the columns of its result as ``schema``.

    ``add`` gets the rows of one window, a batch at a time, and may change what it is given.
    In windows ``merge`` must not depend on the order of parts; in running results
    (:func:`running_accumulate`) it need only be associative, as parts come in order. What is
    held must be picklable.
    """

    schema: str

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, held: Any, rows: pa.RecordBatch) -> Any:
        raise NotImplementedError

    def merge(self, held: Any, other: Any) -> Any:
        raise NotImplementedError

    def finish(self, held: Any) -> tuple:
        raise NotImplementedError


class ViewsAndVisitors(Accumulator):
    """Rows, and the size of the set of visitors; nulls are no visitors."""

    schema = "pv bigint, uv bigint"

    def __init__(self, visitor: str):
        self.visitor = visitor

    def create(self) -> tuple[int, set]:
        return 0, set()

    def add(self, held: tuple[int, set], rows: pa.RecordBatch) -> tuple[int, set]:
        held[1].update(pc.unique(rows.column(self.visitor).drop_null()).to_pylist())
        return held[0] + rows.num_rows, held[1]

    def merge(self, held: tuple[int, set], other: tuple[int, set]) -> tuple[int, set]:
        held[1].update(other[1])
        return held[0] + other[0], held[1]

    def finish(self, held: tuple[int, set]) -> tuple[int, int]:
        return held[0], len(held[1])


class Reduced(Accumulator):
    """Records reduced two at a time: ``function`` gets two records, as dictionaries of the
    columns of ``schema``, and gives one."""

    def __init__(self, schema: str, function: Callable[[dict, dict], dict]):
        self.schema, self.function = schema, function
        self.columns = T.StructType.fromDDL(schema).names

    def create(self) -> None:
        return None

    def add(self, held: dict | None, rows: pa.RecordBatch) -> dict | None:
        for record in rows.select(self.columns).to_pylist():
            held = record if held is None else self.function(held, record)
        return held

    def merge(self, held: dict | None, other: dict | None) -> dict | None:
        return other if held is None else held if other is None else self.function(held, other)

    def finish(self, held: dict) -> tuple:
        return tuple(held[c] for c in self.columns)


def groups_of(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each distinct value of the first ``columns`` columns, null like others."""
    code = np.zeros(batch.num_rows, np.int64)
    for i in range(columns):
        encoded = pc.dictionary_encode(batch.column(i), null_encoding="encode")
        code = code * max(1, len(encoded.dictionary)) + encoded.indices.to_numpy()
        code = np.unique(code, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.diff(code[order], prepend=-1))
    together = batch.take(pa.array(order))
    for start, stop in zip(starts, np.append(starts[1:], len(order))):
        rows = together.slice(start, stop - start)
        yield tuple(rows.column(i)[0].as_py() for i in range(columns)), rows


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _rows(values: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([v[i] for v in values], f.type) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def partials(df: DataFrame, group: Sequence[str], accumulator: Accumulator) -> DataFrame:
    """One accumulator per task and value of ``group``: no rows are shuffled."""
    schema = T.StructType(
        [*_fields(df, group), T.StructField(PART, T.LongType()), T.StructField(HELD, T.BinaryType())]
    )
    arrow, width = _arrow(schema), len(group)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, held = TaskContext.get().partitionId() << 32, 0, {}

        def handed() -> pa.RecordBatch:
            return _rows([(*k, part, pickle.dumps(v)) for k, v in held.items()], arrow)

        for batch in batches:
            for key, mine in groups_of(batch, width):
                before = held[key] if key in held else accumulator.create()
                held[key] = accumulator.add(before, mine)
            rows += batch.num_rows
            if len(held) >= FLUSH_GROUPS or rows >= FLUSH_ROWS:
                yield handed()
                part, rows, held = part + 1, 0, {}
        if held:
            yield handed()

    others = [c for c in df.columns if c not in group]
    return df.select(*group, *others).mapInArrow(fold, schema)


def _merged(parts: DataFrame, group: Sequence[str], accumulator: Accumulator, done: bool) -> DataFrame:
    """One row per value of ``group``: what it holds, or the result if ``done``."""
    result = T.StructType.fromDDL(accumulator.schema) if done else T.StructType([T.StructField(HELD, T.BinaryType())])
    schema = T.StructType([*_fields(parts, group), *result.fields])
    arrow = _arrow(schema)

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, empty = None, True
        for batch in batches:
            for raw in batch.column(batch.schema.get_field_index(HELD)).to_pylist():
                other = pickle.loads(raw)
                held, empty = (other, False) if empty else (accumulator.merge(held, other), False)
        out = tuple(accumulator.finish(held)) if done else (pickle.dumps(held),)
        yield _rows([(*[k.as_py() for k in key], *out)], arrow)

    return parts.groupBy(*group).applyInArrow(merge, schema)


def merged(parts: DataFrame, group: Sequence[str], accumulator: Accumulator, done: bool = True) -> DataFrame:
    """Merge the accumulators of each value of ``group``, no more than about :data:`FAN_IN`
    in one task's group; ``parts`` has ``group``, ``__part`` and ``__held``."""
    group = list(group)
    while True:
        parts = cut_lineage(parts)
        most = parts.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
        if most <= FAN_IN:
            return _merged(parts.drop(PART), group, accumulator, done)
        spread = F.pmod(F.xxhash64(PART), F.lit(-(-most // (FAN_IN // 2)))).cast("long")
        parts = _merged(parts.withColumn(PART, spread), [*group, PART], accumulator, False)


def finished(held: DataFrame, group: Sequence[str], accumulator: Accumulator) -> DataFrame:
    """Results of whole accumulators, one per value of ``group``."""
    schema = T.StructType([*_fields(held, group), *T.StructType.fromDDL(accumulator.schema).fields])
    arrow = _arrow(schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *keys, raw = (c.to_pylist() for c in batch.columns)
            yield _rows([(*k, *accumulator.finish(pickle.loads(r))) for *k, r in zip(*keys, raw)], arrow)

    return held.select(*group, HELD).mapInArrow(finish, schema)


def window_accumulate(
    df: DataFrame,
    keys: Sequence[str],
    size_ms: int,
    accumulator: Accumulator,
    slide_ms: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``keys``, the window bounds and the accumulator's result, for each key and window.

    ``columns`` are those that ``add`` reads (all, if not given). Rows without a time lie in
    no window; null is a key like others.
    """
    if df.isStreaming:
        raise ValueError("a stream's windows are accumulated by streaming.late_windows.LateWindows")
    keys, slide_ms = list(keys), slide_ms or size_ms
    pane_ms = gcd(size_ms, slide_ms)
    read = [c for c in (df.columns if columns is None else columns) if c not in keys]
    rows = df.where(F.col("ts_ms").isNotNull()).select(
        *keys, window_start(F.col("ts_ms"), pane_ms).cast("long").alias(PANE), *read
    )
    # ``add`` sees the key columns too.
    parts = partials(rows, [*keys, PANE], accumulator)
    if pane_ms == size_ms:
        out = merged(parts, [*keys, PANE], accumulator).withColumnRenamed(PANE, START)
    else:
        panes = merged(parts, [*keys, PANE], accumulator, done=False)
        copied = panes.select(
            *keys,
            F.explode(window_starts(F.col(PANE), size_ms, slide_ms)).alias(START),
            F.col(PANE).alias(PART),
            HELD,
        )
        out = merged(copied, [*keys, START], accumulator)
    results = T.StructType.fromDDL(accumulator.schema).names
    return out.select(*keys, START, (F.col(START) + size_ms).alias(END), *results)


def _runs(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Neighbouring rows that agree in the first ``columns`` columns."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for i in range(columns):
        code = pc.dictionary_encode(batch.column(i), null_encoding="encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    starts = np.flatnonzero(new)
    for start, stop in zip(starts, np.append(starts[1:], batch.num_rows)):
        rows = batch.slice(start, stop - start)
        yield tuple(rows.column(i)[0].as_py() for i in range(columns)), rows


def running_accumulate(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    accumulator: Accumulator,
    openings: DataFrame | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """The rows of ``df`` with the accumulator's result over the key's rows up to each.

    ``openings`` gives a key something to start from: ``keys`` and ``__held``, at most once per
    key. Hot keys are cut in chunks along ``order`` (one or two BIGINT columns, nulls first):
    each chunk is folded, what is before a chunk is merged from the chunks before it, and
    all chunks are then followed at once.
    """
    keys, order, results = list(keys), list(order), T.StructType.fromDDL(accumulator.schema)
    others = [c for c in df.columns if c not in keys]
    rows = df.select(*keys, *others, F.lit(None).cast("binary").alias(HELD))
    if openings is not None:
        rows = rows.unionByName(openings.select(*keys, HELD), allowMissingColumns=True)
    rows = rows.withColumn(_FIRST, F.col(HELD).isNotNull())
    chunks = plan_chunks(df, order, keys, chunk_rows)
    chunks_of = [CHUNK] if chunks.split else []
    rows = chunks.assign(rows) if chunks.split else rows
    group = [*keys, *chunks_of]
    along = [*group, F.col(_FIRST).desc(), *order]
    columns = [*group, *others, HELD]
    if chunks.split:
        rows = cut_lineage(rows)
        # Openings come with each key's first chunk.
        summary = _T([*_fields(rows, group), T.StructField(HELD, T.BinaryType())])
        folded = (
            _together(rows.where(F.col(CHUNK) > 0) if keys else rows, group).sortWithinPartitions(*along)
            .select(*columns).mapInArrow(_folding(accumulator, len(group), _arrow(summary)), summary)
        )
        carried = (
            _together(folded, keys).sortWithinPartitions(*group)
            .mapInArrow(_carrying(accumulator, len(keys), _arrow(summary)), summary)
        )
        rows = rows.unionByName(carried.withColumn(_FIRST, F.lit(True)), allowMissingColumns=True)
    whole = _T([*_fields(df, keys), *_fields(df, others), *results.fields])
    walk = _walking(accumulator, len(group), len(keys), len(others), _arrow(whole))
    placed = _together(rows, group).sortWithinPartitions(*along).select(*columns)
    return placed.mapInArrow(walk, whole).select(*df.columns, *results.names)


def _together(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Rows of one group in one partition; without a group that is few rows, or one per chunk."""
    return df.repartition(*group) if group else df.repartition(1)


def _added(accumulator: Accumulator, held: Any, rows: pa.RecordBatch) -> Any:
    """Add rows, or merge what rows bring with them, in order."""
    brought = rows.column(rows.num_columns - 1)
    if brought.null_count == rows.num_rows:
        return accumulator.add(held, rows)
    at = 0
    for i, raw in enumerate(brought.to_pylist()):
        if raw is not None:
            if i > at:
                held = accumulator.add(held, rows.slice(at, i - at))
            held, at = accumulator.merge(held, pickle.loads(raw)), i + 1
    return accumulator.add(held, rows.slice(at)) if at < rows.num_rows else held


def _folding(accumulator: Accumulator, width: int, arrow: pa.Schema):
    """One row per group of sorted rows."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            done = []
            for mine, rows in _runs(batch, width):
                if mine != key:
                    if key is not None:
                        done.append((*key, pickle.dumps(held)))
                    key, held = mine, accumulator.create()
                held = _added(accumulator, held, rows)
            yield _rows(done, arrow)
        if key is not None:
            yield _rows([(*key, pickle.dumps(held))], arrow)

    return fold


def _carrying(accumulator: Accumulator, width: int, arrow: pa.Schema):
    """For each chunk of a key but the first, what the chunks before it hold."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            out = []
            for *mine, chunk, raw in zip(*[c.to_pylist() for c in batch.columns]):
                if mine != key:
                    key, held = mine, None
                else:
                    out.append((*mine, chunk, held))
                mixed = accumulator.create() if held is None else pickle.loads(held)
                held = pickle.dumps(accumulator.merge(mixed, pickle.loads(raw)))
            yield _rows(out, arrow)

    return carry


def _walking(accumulator: Accumulator, width: int, keys: int, others: int, arrow: pa.Schema):
    """The result after each row."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            real, results = [], []
            at = 0
            for mine, rows in _runs(batch, width):
                if mine != key:
                    key, held = mine, accumulator.create()
                brought = rows.column(rows.num_columns - 1).to_pylist()
                for i, raw in enumerate(brought):
                    if raw is None:
                        held = accumulator.add(held, rows.slice(i, 1))
                        real.append(at + i)
                        results.append(tuple(accumulator.finish(held)))
                    else:
                        held = accumulator.merge(held, pickle.loads(raw))
                at += rows.num_rows
            kept = batch.take(pa.array(real, pa.int64()))
            own = [kept.column(i) for i in [*range(keys), *range(width, width + others)]]
            fields = list(arrow)[len(own) :]
            own += [pa.array([r[i] for r in results], f.type) for i, f in enumerate(fields)]
            yield pa.RecordBatch.from_arrays(own, schema=arrow)

    return walk


@dataclass(frozen=True)
class Window:
    """What a window function learns before the rows: the key's values and the bounds."""

    key: tuple
    start_ms: int
    end_ms: int


def process_windows(
    df: DataFrame,
    keys: Sequence[str],
    size_ms: int,
    function: Callable[[Window, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
    slide_ms: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Run ``function`` over the rows of each key and window, a batch at a time.

    It gives batches with the columns of ``schema``; the key and the bounds are put before
    them. Rows come in ``order`` if it is given, and are copied once per window they lie in.
    Rows without a time lie in no window.
    """
    if df.isStreaming:
        raise ValueError("process_windows is for tables")
    keys, slide_ms = list(keys), slide_ms or size_ms
    group = [*keys, START]
    result = T.StructType.fromDDL(schema)
    whole = T.StructType([*_fields(df, keys), T.StructField(START, T.LongType()), T.StructField(END, T.LongType()), *result.fields])
    arrow, names = _arrow(whole), result.names

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *values, start = (k.as_py() for k in key)
        before = [*values, start, start + size_ms]
        for out in function(Window(tuple(values), start, start + size_ms), batches):
            fixed = [pa.array([v] * out.num_rows, f.type) for v, f in zip(before, arrow)]
            own = [out.column(out.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*fixed, *own], schema=arrow)

    starts = window_starts(F.col("ts_ms"), size_ms, slide_ms)
    rows = df.where(F.col("ts_ms").isNotNull()).withColumn(START, F.explode(starts))
    if order:
        rows = rows.repartition(*group).sortWithinPartitions(*group, *order)
    return rows.groupBy(*group).applyInArrow(run, whole)
