"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Entries become integers, so the scatter ``n * sum(x x') - S S'`` of the distinct vectors is
an integer matrix, summed exactly: partial products per task, then decimals per pair of
dimensions. Its characteristic polynomial is found modulo many primes (a task takes some
primes, reduces the matrix to Hessenberg form and follows its recurrence) and put together
by Chinese remainders. All its roots are real, so the sign changes of a shifted polynomial
count the roots above a point exactly; bisection isolates the largest roots and narrows
them far below double precision. A component is the null vector of the matrix less its
root, by inverse iteration in long fixed-point numbers; roots that stay together are taken
as one root with as many components. One pass over the rows projects them.

The work on the matrix, and what the driver holds, grow with the dimensions only.

Defined cases: rows whose vector is null or holds null or non-finite entries take no part;
shorter vectors are filled up with zeros; repeated vectors count once in the fit and are
returned each; a null vec_id is kept; equal eigenvalues get some orthonormal basis;
directions without variance give no component, so one distinct vector or an empty table
gives no rows; other columns are ignored. An entry too large for 64 times it to stay below
2^55, and a deviation that does not fit a long, are errors.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt, log2, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.topk import usable
from tidemark.session import cut_lineage

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
#: Bits of an eigenvalue beyond its leading one, and of the fixed-point numbers.
ROOT_BITS, FIXED_BITS = 192, 384
#: Integers are multiplied as doubles in limbs of so many bits, so many rows at once.
LIMB_BITS, LIMB_ROWS = 20, 1 << 13
PRIMES_PER_TASK = 16


def whole(vector: Column) -> Column:
    """The integer entries of a usable vector."""

    def entry(c: Column) -> Column:
        scaled = F.lit(SCALE) * c.cast("double")
        return F.when(F.abs(scaled) < float(1 << 55), F.floor(scaled) + SHIFT).otherwise(
            F.raise_error(F.lit("an entry is too large to whiten"))
        )

    return F.transform(vector, entry)


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with what a zero entry becomes."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.full((len(sizes), width), SHIFT, np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """``rows' rows`` as Python integers, of any size."""
    total = np.zeros((rows.shape[1],) * 2, object)
    for at in range(0, len(rows), LIMB_ROWS):
        rest, limbs = rows[at : at + LIMB_ROWS], []
        half = 1 << (LIMB_BITS - 1)
        while not limbs or rest.any():
            low = ((rest + half) & ((1 << LIMB_BITS) - 1)) - half
            limbs.append(low.astype(np.float64))
            rest = (rest - low) >> LIMB_BITS
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB_BITS * (i + j))
    return total


def scatter(distinct: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and the integer scatter, of column ``x``."""
    upper = np.triu_indices(width + 1)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1,) * 2, object)
        for batch in batches:
            rows = matrix_of(batch.column(0), width) - SHIFT
            total += exact_gram(np.hstack([rows, np.ones((len(rows), 1), np.int64)]))
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(upper[0], pa.int32()),
                "j": pa.array(upper[1], pa.int32()),
                "v": pa.array([Decimal(v) for v in total[upper]], pa.decimal128(38, 0)),
            }
        )

    sums = distinct.select("x").mapInArrow(partial, "i int, j int, v decimal(38,0)")
    gram = np.zeros((width + 1,) * 2, object)
    # One number per pair of dimensions, whatever the number of rows.
    for i, j, v in sums.groupBy("i", "j").agg(F.sum("v")).collect():
        gram[i, j] = gram[j, i] = int(v)
    n, s = gram[width, width], gram[:width, width]
    return n, [v + n * SHIFT for v in s], n * gram[:width, :width] - np.outer(s, s)


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every n below 3.2e9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd = n - 1
    while odd % 2 == 0:
        odd //= 2
    for base in (2, 3, 5, 7):
        x, e = pow(base, odd, n), odd
        while e != n - 1 and x not in (1, n - 1):
            x, e = x * x % n, e * 2
        if x != n - 1 and e % 2 == 0:
            return False
    return True


def primes_for(bits: float) -> list[int]:
    """Primes below 2^31, from the top, whose product has more than so many bits."""
    out, n = [], (1 << 31) - 1
    while sum(log2(p) for p in out[-1:]) * len(out) <= bits + 1:
        while not is_prime(n):
            n -= 2
        out.append(n)
        n -= 2
    return out


def polynomial_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """The characteristic polynomial mod ``p``, constant term first, by Hessenberg form."""
    a = (matrix % p).astype(np.int64)
    d = len(a)
    for k in range(d - 2):
        filled = np.flatnonzero(a[k + 1 :, k])
        if not len(filled):
            continue
        pivot = k + 1 + filled[0]
        a[[k + 1, pivot]] = a[[pivot, k + 1]]
        a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor % p).sum(axis=1)) % p
    # Polynomials of the leading blocks.
    block = np.zeros((d + 1, d + 1), np.int64)
    block[0, 0] = 1
    for k in range(d):
        row = np.roll(block[k], 1)
        row = (row - block[k] * a[k, k] % p) % p
        path, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            path = path * int(a[i + 1, i]) % p
            weights[i] = int(a[i, k]) * path % p
        if k:
            row = (row - (weights[:, None] * block[:k] % p).sum(axis=0)) % p
        block[k + 1] = row
    return block[d]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients, constant term first; ``matrix`` has no negative eigenvalue."""
    d, trace = len(matrix), int(sum(matrix[i, i] for i in range(len(matrix))))
    if not trace:
        return [0] * d + [1]
    # The k-th coefficient is largest when all eigenvalues are equal.
    bits = max(log2(comb(d, k)) + k * (log2(trace) - log2(d)) for k in range(d + 1))
    primes = primes_for(bits + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ps = batch.column(0).to_pylist()
            found = [polynomial_mod(matrix, p).tolist() for p in ps]
            yield pa.RecordBatch.from_pydict({"p": pa.array(ps, pa.int64()), "c": pa.array(found, pa.list_(pa.int64()))})

    tasks = -(-len(primes) // PRIMES_PER_TASK)
    asked = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    # As many rows as the bound has words: a matter of the dimensions.
    rows = {r.p: r.c for r in asked.mapInArrow(run, "p long, c array<bigint>").collect()}
    whole_product = prod(primes)
    shares = {p: (whole_product // p) * pow(whole_product // p, -1, p) for p in primes}
    out = []
    for k in range(d + 1):
        c = sum(rows[p][k] * shares[p] for p in primes) % whole_product
        out.append(c if 2 * c < whole_product else c - whole_product)
    return out


def scaled(poly: list[int], e: int) -> list[int]:
    """An integer polynomial whose roots are those of ``poly`` over 2^e."""
    d = len(poly) - 1
    return [c << (e * k if e > 0 else -e * (d - k)) for k, c in enumerate(poly)]


def roots_above(poly: list[int], point: int) -> int:
    """How many roots, with multiplicity, exceed ``point``; all roots must be real."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += point * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(poly: list[int], point: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * point + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], most: int) -> list[tuple[Fraction, int]]:
    """The largest positive roots with their multiplicities, falling: ``most`` or more.

    A point is ``m * 2^e``. An interval is halved till it has one root, then till it is
    narrow by signs alone.
    """
    zeros = next(i for i, c in enumerate(poly) if c)
    poly = poly[zeros:]
    top = 0
    while roots_above(scaled(poly, top), 1):
        top += 1
    out, held = [], 0
    # (m, e, roots above m * 2^e, roots above (m + 1) * 2^e), largest last.
    open_intervals = [(0, top, len(poly) - 1, 0)]
    while open_intervals and held < most:
        m, e, below, above = open_intervals.pop()
        if below - above == 1 or m.bit_length() > ROOT_BITS:
            if below - above == 1:
                m, e = narrowed(poly, m, e)
            out.append((Fraction(2 * m + 1) * Fraction(2) ** (e - 1), below - above))
            held += below - above
            continue
        m, e = 2 * m, e - 1
        middle = roots_above(scaled(poly, e), m + 1)
        if below > middle:
            open_intervals.append((m, e, below, middle))
        if middle > above:
            open_intervals.append((m + 1, e, middle, above))
    return out


def narrowed(poly: list[int], m: int, e: int) -> tuple[int, int]:
    """The interval ``(m, m + 1] * 2^e`` of one simple root, cut to :data:`ROOT_BITS`."""
    right = sign_at(scaled(poly, e), m + 1)
    if not right:
        return ((m + 1) << ROOT_BITS) - 1, e - ROOT_BITS
    while m.bit_length() <= ROOT_BITS:
        m, e = 2 * m, e - 1
        middle = sign_at(scaled(poly, e), m + 1)
        if not middle:
            return ((m + 1) << ROOT_BITS) - 1, e - ROOT_BITS
        if middle != right:
            m += 1
    return m, e


def null_vectors(matrix: np.ndarray, root: Fraction, count: int) -> np.ndarray:
    """``count`` orthonormal vectors of ``matrix`` for a root, as doubles.

    Elimination with row exchange in fixed-point numbers, then inverse iteration; ``count``
    vectors are kept apart by Gram-Schmidt.
    """
    d, one = len(matrix), 1 << FIXED_BITS
    least = max(1, abs(root.numerator) // root.denominator)
    shift = FIXED_BITS - least.bit_length()
    a = (matrix << shift) if shift >= 0 else matrix >> -shift
    diagonal = int(root * Fraction(2) ** shift)
    for i in range(d):
        a[i, i] -= diagonal
    order, factors = list(range(d)), np.zeros((d, d), object)
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        for x in (a, factors):
            x[[k, pivot]] = x[[pivot, k]]
        order[k], order[pivot] = order[pivot], order[k]
        a[k, k] = a[k, k] or 1
        f = (a[k + 1 :, k] << FIXED_BITS) // a[k, k]
        factors[k + 1 :, k] = f
        a[k + 1 :, k:] -= (f[:, None] * a[k, k:]) >> FIXED_BITS
    draw = random.Random(d)
    vectors = [np.array([draw.getrandbits(64) - (1 << 63) for _ in range(d)], object) for _ in range(count)]
    for _ in range(4):
        solved = []
        for y in vectors:
            y = y[order]
            for k in range(d):
                y[k + 1 :] -= (factors[k + 1 :, k] * y[k]) >> FIXED_BITS
            for k in range(d - 1, -1, -1):
                y[k] = (y[k] << FIXED_BITS) // a[k, k]
                y[:k] -= (a[:k, k] * y[k]) >> FIXED_BITS
            for other in solved:
                y = (y << FIXED_BITS) // max(1, max(abs(v) for v in y))
                y -= other * int((other * y).sum() >> FIXED_BITS) >> FIXED_BITS
            y = (y << 2 * FIXED_BITS) // max(1, max(abs(v) for v in y))
            norm = isqrt(int((y * y).sum()))
            solved.append((y << FIXED_BITS) // norm)
        vectors = solved
    out = np.array([[int(v) / one for v in y] for y in vectors])
    return out * np.sign(out[np.arange(count), np.abs(out).argmax(axis=1)])[:, None]


def components(spark: SparkSession, matrix: np.ndarray, most: int) -> tuple[list[Fraction], np.ndarray]:
    """The largest eigenvalues of an integer matrix without negative ones, and their vectors."""
    poly = characteristic_polynomial(spark, matrix)
    roots = largest_roots(poly, most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                found = null_vectors(matrix, *roots[at])
                yield pa.RecordBatch.from_pydict(
                    {"at": pa.array([at] * len(found), pa.int32()), "v": pa.array(found.tolist(), pa.list_(pa.float64()))}
                )

    if not roots:
        return [], np.zeros((0, len(matrix)))
    asked = spark.createDataFrame([(i,) for i in range(len(roots))], "at int").repartition(len(roots))
    rows = asked.mapInArrow(run, "at int, v array<double>").collect()
    vectors = [r.v for i in range(len(roots)) for r in rows if r["at"] == i]
    values = [value for value, count in roots for _ in range(count)]
    return values[:most], np.array(vectors[:most])


def deviations(away: np.ndarray) -> np.ndarray:
    """Sums of squares per row, exact; an error if one does not fit a long."""
    if not away.size or float(np.abs(away).max()) ** 2 * away.shape[1] < 2.0**62:
        return (away * away).sum(axis=1)
    exact = (away.astype(object) ** 2).sum(axis=1)
    if max(exact) >= 1 << 63:
        raise OverflowError("a deviation does not fit a long")
    return exact.astype(np.int64)


def whitened(vectors: DataFrame, most: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = vectors.sparkSession
    held = vectors.where(usable(F.col(vector)))
    width = held.agg(F.max(F.size(vector))).first()[0] or 0
    good = held.select("vec_id", whole(F.col(vector)).alias("x"))
    fill = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x"))
    distinct = cut_lineage(good.select(F.concat("x", fill).alias("x")).distinct())
    n, sums, matrix = scatter(distinct, width) if width else (0, [], np.zeros((0, 0), object))
    values, directions = components(spark, matrix, most) if n else ([], np.zeros((0, width)))
    trace = Fraction(int(sum(matrix[i, i] for i in range(width))))
    explained = [float(v / trace) for v in values]
    # n * x - S is projected, so the eigenvalues are those of the scatter.
    scale = np.array([1 / np.sqrt(float(v)) for v in values])
    large = max(map(abs, sums), default=0) >= 1 << 62

    def projected(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if large or (rows.size and float(np.abs(rows).max()) * n >= 2.0**62):
            away = rows.astype(object) * n - np.array(sums, object)
        else:
            away = rows * n - np.array(sums, np.int64)
        return away, (away.astype(np.float64) @ directions.T) * scale

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, w = projected(matrix_of(batch.column(0), width))
            first += w.sum(axis=0)
            second += w.T @ w
        at = [(i, j) for i in range(k) for j in range(-1, i + 1)]
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array([i for i, _ in at], pa.int32()),
                "j": pa.array([j for _, j in at], pa.int32()),
                "v": pa.array([first[i] if j < 0 else second[i, j] for i, j in at], pa.float64()),
            }
        )

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            away, w = projected(matrix_of(batch.column(1), width))
            ids = np.repeat(np.arange(len(w)), k)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column(0).take(pa.array(ids)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(w))),
                    "deviation": pa.array(np.repeat(deviations(away), k)),
                    "whitened": pa.array(w.ravel()),
                    "explained": pa.array(np.tile(explained, len(w)).astype(np.float64)),
                }
            )

    error = 0.0
    if values:
        sums_of = {
            (r.i, r.j): r.v
            for r in distinct.mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        }
        mean = [sums_of[i, -1] / n for i in range(len(values))]
        error = max(abs(v / n - mean[i] * mean[j] - (i == j)) for (i, j), v in sums_of.items() if j >= 0)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = good.mapInArrow(project, f"vec_id {kind}, component int, deviation long, whitened double, explained double")
    return rows.select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).alias("identity_error"),
    )


@query()
def op11_whitening(spark, folder):
    return whitened(table(spark, folder, "embeddings"))
