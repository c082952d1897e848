"""Cut an ordered table into chunks of bounded size.

Running totals, running maxima and row patterns follow an order, over the whole
table or per key. A plain window would put all rows of a key (or all rows of the
table) in one task. Here the order is cut into chunks at quantiles of a bounded
sample, and the chunk of a row is a pure function of its values: every branch of
a plan, and every retry of a task, computes the same chunk.

The sample steers balance only. Whatever it holds, results are exact: cuts and rows
are compared as integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = "__chunk"
CHUNK_ROWS = 1_000_000
SMALL_CHUNK_ROWS = 1_000
MANY_CHUNKS = 100_000
SAMPLE_PER_CHUNK = 20
#: Handing a border to the first search costs the driver time; the second search has the rest.
BORDERS = 4096
#: Takes the place of a null in a cut.
LEAST = -(1 << 63)


@dataclass(frozen=True)
class Chunks:
    """Cuts of ``order`` and, for keyed scans, the hashes of hot keys.

    A cut is a value of the order columns that begins a chunk, so there is one chunk
    more than cuts, numbered without gaps.
    """

    order: tuple[str, ...]
    keys: tuple[str, ...]
    cuts: tuple[tuple[int, ...], ...] = ()
    hot: tuple[int, ...] = ()
    rows: int = 0

    @property
    def split(self) -> bool:
        """False when a plain window is the better plan: no hot key, or few rows in all."""
        return bool(self.hot) if self.keys else bool(self.cuts)

    def place(self, df: DataFrame) -> DataFrame:
        """One task per chunk."""
        return df.repartitionById(len(self.cuts) + 1, F.col(CHUNK))

    def is_hot(self) -> Column:
        keys = ", ".join(f"`{k}`" for k in self.keys)
        return _among(f"xxhash64({keys})", self.hot)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``__chunk``: the number of cuts at or below the row, 0 for keys not hot."""
        placed, chunk = _cuts_below(df, self.order, self.cuts)
        if self.keys:
            chunk = F.when(self.is_hot(), chunk + 1).otherwise(0)
        return placed.withColumn(CHUNK, chunk.cast("int")).drop("__bucket")


def _among(value: str, numbers: Sequence[int]) -> Column:
    """``value IN (...)`` as text, which stays quick to build for thousands of numbers."""
    if not numbers:
        return F.lit(False)
    return F.expr(f"{value} IN ({', '.join(_long(n) for n in numbers)})")


def _long(n: int) -> str:
    return f"{n}L" if n > -(1 << 63) else "(-9223372036854775807L - 1L)"


def _numbers(values: Iterable[int]) -> Column:
    """A constant array, written as one text that the optimizer folds once: quick to plan
    for any number of values."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _cuts_below(
    df: DataFrame, order: Sequence[str], cuts: Sequence[tuple[int, ...]]
) -> tuple[DataFrame, Column]:
    """How many cuts are at or below the row, compared as integers.

    A binary search over at most ``BORDERS`` of them, as doubles, comes first. Rounding
    keeps the order, so only the cuts from the border right below the row up to the next
    one are left to compare. That is one, unless there are many cuts or one value fills
    many chunks; then a second search finds the place.
    """
    if not cuts:
        return df, F.lit(0)
    borders, starts = [], []
    for i, cut in enumerate(cuts):
        if not borders or float(cut[0]) > borders[-1]:
            borders.append(float(cut[0]))
            starts.append(i)
    every = -(-len(borders) // BORDERS)
    borders, starts = borders[::every], [*starts[::every], len(cuts)]
    widest = max(b - a for a, b in zip(starts, starts[1:]))

    bucketizer = Bucketizer(
        splits=[float("-inf"), *borders, float("inf")], inputCol=order[0], outputCol="__bucket"
    )
    placed = bucketizer.transform(df)
    at = F.greatest(F.col("__bucket").cast("int"), F.lit(1))
    row = [F.col(c).cast("bigint") for c in order]
    values = [_numbers(cut[i] for cut in cuts) for i in range(len(order))]

    def reached(place: Column) -> Column:
        cut = [F.get(v, place) for v in values]
        out = cut[-1] <= row[-1]
        for c, r in zip(cut[-2::-1], row[-2::-1]):
            out = (c < r) | ((c == r) & out)
        return F.coalesce(out, F.lit(False))

    first = F.get(_numbers(starts), at - 1)
    if widest == 1:
        below = first + reached(first.cast("int")).cast("bigint")
    else:
        ends = F.struct(first.alias("low"), F.get(_numbers(starts), at).alias("high"))
        below = F.aggregate(
            F.sequence(F.lit(1), F.lit(widest.bit_length())),
            ends,
            lambda held, _: _halved(held, reached),
            lambda held: held["low"],
        )
    # Rows without a place in the order come first.
    outside = F.col(order[0]).isNull() | (F.col("__bucket") < 1)
    return placed, F.when(outside, 0).otherwise(below)


def _halved(held: Column, reached: Callable[[Column], Column]) -> Column:
    """One step of a binary search for the first place that is not ``reached``."""
    middle = F.shiftright(held["low"] + held["high"], 1)
    left = F.struct(held["low"].alias("low"), middle.alias("high"))
    right = F.struct((middle + 1).alias("low"), held["high"].alias("high"))
    return F.when(held["low"] >= held["high"], held).when(reached(middle.cast("int")), right).otherwise(left)


def chunk_count(rows: int, chunk_rows: int) -> int:
    """Chunks for so many rows. Beyond ``MANY_CHUNKS`` of them, their number and their size
    grow alike, as the square root of the rows."""
    count = -(-rows // chunk_rows)
    return isqrt(count * MANY_CHUNKS) if count > MANY_CHUNKS else count


def plan_chunks(
    df: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = (),
    chunk_rows: int | None = None,
    rows: int | None = None,
) -> Chunks:
    """Choose chunk borders for ``df`` from its row count and a bounded sample.

    ``order`` is one or two BIGINT columns that put the rows in a total order, nulls first.
    With ``keys``, only keys with about ``chunk_rows`` rows or more are cut. Collects about
    ``SAMPLE_PER_CHUNK`` triples of numbers per chunk, fewer from ``MANY_CHUNKS`` on.
    """
    order, keys = tuple(order), tuple(keys)
    spark = df.sparkSession
    chunk_rows = chunk_rows or CHUNK_ROWS
    total = df.count() if rows is None else rows
    wanted = chunk_count(total, chunk_rows)
    if not keys:
        wanted = max(wanted, min(total // SMALL_CHUNK_ROWS, spark.sparkContext.defaultParallelism))
    if wanted <= 1:
        return Chunks(order, keys, rows=total)

    picked = df.select(
        (F.xxhash64(*keys) if keys else F.lit(0).cast("long")).alias("h"),
        F.col(order[0]).cast("long").alias("o0"),
        F.coalesce(F.col(order[-1]).cast("long"), F.lit(LEAST)).alias("o1"),
    )
    sampled = max(4 * wanted, min(wanted, MANY_CHUNKS) * SAMPLE_PER_CHUNK)
    fraction = sampled / max(total, 1)
    if fraction < 1.0:
        picked = picked.sample(fraction, seed=11)
    sample = picked.toArrow()

    hot: tuple[int, ...] = ()
    if keys:
        hashes, seen = np.unique(sample["h"].to_numpy(), return_counts=True)
        enough = chunk_rows * min(1.0, fraction) / 2
        hot = tuple(hashes[seen >= max(enough, 2)].tolist())
        if not hot:
            return Chunks(order, keys, rows=total)

    # Rows without a place in the order make no cut.
    sample = sample.filter(pc.is_valid(sample["o0"]))
    first, second = sample["o0"].to_numpy(), sample["o1"].to_numpy()
    by_order = np.lexsort((second, first))
    steps = by_order[np.unique(len(by_order) * np.arange(1, wanted) // wanted)] if len(by_order) else by_order
    picks = zip(first[steps].tolist(), second[steps].tolist())
    cuts = sorted({pick[: len(order)] for pick in picks})
    return Chunks(order, keys, tuple(cuts), hot, total)
