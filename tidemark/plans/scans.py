"""Prefix scans and lookahead over chunks.

A plan first counts and samples its input (:func:`plan_chunks`). A scan that is cut then
reads it once for a small summary per chunk (partial aggregation, a few bytes per chunk)
and once for the rows. What a chunk needs from the chunks before it travels as *carry
rows* in the same shuffle as the rows, so there is one full shuffle and no join. Rows whose
order columns are null come first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.plans.chunks import CHUNK, Chunks, plan_chunks
from tidemark.session import cut_lineage

CARRY = "__carry"
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_scan(
    df: DataFrame,
    order: Sequence[str],
    measures: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    *,
    inclusive: bool = True,
    reverse: bool = False,
    chunks: Chunks | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add running ``sum``/``max``/``min`` columns along ``order``, per ``keys`` if given.

    ``measures`` maps an output name to (kind, value). ``inclusive=False`` leaves
    the row itself out; ``reverse=True`` runs from the last row to the first.
    """
    keys = list(keys)
    inputs = {name: f"__in_{name}" for name in measures}
    rows = df.withColumns({inputs[n]: value for n, (_, value) in measures.items()})
    last = 0 if inclusive else -1
    along = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]

    def scanned(source: DataFrame, window: W) -> DataFrame:
        frame = window.rowsBetween(W.unboundedPreceding, last)
        return source.withColumns(
            {n: _AGG[kind](inputs[n]).over(frame) for n, (kind, _) in measures.items()}
        ).drop(*inputs.values())

    chunks = chunks or plan_chunks(df, order, keys, chunk_rows)
    if not chunks.split:
        return scanned(rows, W.partitionBy(*keys).orderBy(*along))

    rows = chunks.assign(rows)
    summary = rows.where(F.col(CHUNK) > 0) if keys else rows
    summary = summary.groupBy(*keys, CHUNK).agg(
        *[_AGG[kind](inputs[n]).alias(inputs[n]) for n, (kind, _) in measures.items()]
    )
    chunk_order = F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
    # At most one summary row per chunk and key: the chunk count bounds each group.
    earlier = (
        W.partitionBy(*keys).orderBy(chunk_order).rowsBetween(W.unboundedPreceding, -1)
    )
    carries = summary.select(
        *keys,
        CHUNK,
        *[_AGG[kind](inputs[n]).over(earlier).alias(inputs[n]) for n, (kind, _) in measures.items()],
    ).where(reduce(or_, [F.col(c).isNotNull() for c in inputs.values()]))
    stacked = stack(rows, carries)
    placed = stacked if keys else chunks.place(stacked)
    window = W.partitionBy(*keys, CHUNK).orderBy(F.col(CARRY).desc(), *along)
    return scanned(placed, window).where(~F.col(CARRY)).drop(CARRY, CHUNK)


def stack(rows: DataFrame, carries: DataFrame) -> DataFrame:
    """Rows and carry rows in one frame, told apart by ``__carry``."""
    return rows.withColumn(CARRY, F.lit(False)).unionByName(
        carries.withColumn(CARRY, F.lit(True)), allowMissingColumns=True
    )


def following(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str],
    values: Sequence[str],
    steps: int,
    *,
    chunks: Chunks | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add ``next_1`` .. ``next_<steps>``: ``values`` of the key's following rows.

    A hot key is cut in chunks; each chunk borrows the first ``steps`` rows of the
    chunks after it.
    """
    keys = list(keys)
    record = F.struct(*values)

    def with_next(source: DataFrame, window: W) -> DataFrame:
        return source.withColumns(
            {f"next_{i}": F.lead(record, i).over(window) for i in range(1, steps + 1)}
        )

    chunks = chunks or plan_chunks(df, order, keys, chunk_rows)
    if not chunks.split:
        return with_next(df, W.partitionBy(*keys).orderBy(*order))

    rows = chunks.assign(df)
    columns = list(dict.fromkeys([*order, *values]))
    rank = F.row_number().over(W.partitionBy(*keys, CHUNK).orderBy(*order))
    heads = (
        rows.where(F.col(CHUNK) > 0)
        .select(*keys, CHUNK, *[c for c in columns if c not in keys])
        .withColumn("__rank", rank)
        .where(F.col("__rank") <= steps)
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct("__rank", *columns))).alias("__heads"))
    )
    later = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(1, steps)
    borrowed = (
        heads.withColumn(
            "__heads", F.slice(F.flatten(F.collect_list("__heads").over(later)), 1, steps)
        )
        .select(*keys, CHUNK, F.explode("__heads").alias("__head"))
        .select(*keys, CHUNK, *[F.col(f"__head.{c}").alias(c) for c in columns if c not in keys])
    )
    window = W.partitionBy(*keys, CHUNK).orderBy(F.col(CARRY).asc(), *order)
    return (
        with_next(stack(rows, borrowed), window)
        .where(~F.col(CARRY))
        .drop(CARRY, CHUNK)
    )


def first_arrivals(
    cells: DataFrame, probes: DataFrame, at: str, chunk_rows: int | None = None
) -> DataFrame:
    """For each distinct probe value, the earliest ``first`` among cells at or above it.

    ``cells`` has columns ``at`` and ``first``, ``probes`` has ``at``. Gives ``at``
    and ``arrival`` for every value of either; null where no cell lies above.
    """
    stacked = cut_lineage(
        cells.select(at, "first")
        .unionByName(probes.select(at), allowMissingColumns=True)
        .groupBy(at)
        .agg(F.min("first").alias("first"))
    )
    reached = prefix_scan(
        stacked, [at], {"arrival": ("min", F.col("first"))}, reverse=True, chunk_rows=chunk_rows
    )
    return reached.select(at, "arrival")
