"""Whitening against Fractions, determinants and a dense eigen decomposition."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening
from tidemark.llm.whitening import SHIFT

SCHEMA = "vec_id long, embedding array<double>, x string, component string, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 3) for i, v in rows], SCHEMA)


def by_hand(rows, most=16):
    """Rows of the contract from exact sums and numpy's eigenvectors."""
    ok = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in ok), default=0)
    xs = [[int(np.floor(64 * c)) + SHIFT for c in v] + [SHIFT] * (width - len(v)) for _, v in ok]
    fit = sorted(set(map(tuple, xs)))
    n = len(fit)
    sums = [sum(f[j] for f in fit) for j in range(width)]
    centred = np.array([[float(Fraction(n * f[j] - sums[j], n)) for j in range(width)] for f in fit]).reshape(n, width)
    values, vectors = np.linalg.eigh(centred.T @ centred / max(n, 1)) if width else (np.zeros(0), np.zeros((0, 0)))
    best = [k for k in np.argsort(-values) if values[k] > 1e-9 * max(values.max(), 1)][:most]
    out = {}
    for (i, _), x in zip(ok, xs):
        away = [n * a - s for a, s in zip(x, sums)]
        out.setdefault(i, []).append((n, sum(a * a for a in away), [float(np.dot(np.array(away) / n, vectors[:, k]) / np.sqrt(values[k])) for k in best]))
    return out, [values[k] / values.sum() for k in best]


def compare(spark, rows, digits=1e-8):
    want, explained = by_hand(rows)
    got = whitening.whitened(frame(spark, rows)).collect()
    k = len(explained)
    assert len(got) == sum(len(v) for v in want.values()) * k
    per = {}
    for r in got:
        per.setdefault((r.vec_id, r.component), []).append(r)
    signs = np.zeros(k)
    for i, entries in want.items():
        for c in range(1, k + 1):
            mine = per[i, c]
            assert {(r.n, r.deviation) for r in mine} == {(n, d) for n, d, _ in entries}
            assert mine[0].explained == pytest.approx(explained[c - 1], rel=1e-9)
            assert abs(mine[0].identity_error) < 1e-9
            if len(entries) == 1:
                w = entries[0][2][c - 1]
                if not signs[c - 1] and abs(w) > 1e-6:
                    signs[c - 1] = np.sign(w * mine[0].whitened)
                assert mine[0].whitened == pytest.approx(signs[c - 1] * w, abs=digits)


def test_rows(spark):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 1 + j % 5) for j in range(20)]) for i in range(300)]
    compare(spark, rows)
    # Few dimensions, repeated rows, a short vector, rows that take no part.
    rows = [(i % 90, [draw.gauss(0, 3), draw.gauss(1, 1), 5.0]) for i in range(90)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]
    rows += [(500, None), (501, [1.0, None, 2.0]), (502, [1.0, float("nan"), 2.0]), (503, [float("inf")] * 3), (504, [0.25]), (None, [9.0, 1.0, 1.0])]
    compare(spark, rows)


def test_few(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(frame(spark, rows)).collect() == []
    compare(spark, [(1, [1.0, 2.0]), (2, [3.0, -2.0])])


def test_equal_eigenvalues(spark):
    """A cross: every direction has the same variance."""
    rows = [(10 * j + s, [float(3 * (1 if s else -1) * (j == k)) for k in range(5)]) for j in range(5) for s in (0, 1)]
    got = whitening.whitened(frame(spark, rows)).collect()
    assert len(got) == 50 and max(r.identity_error for r in got) < 1e-12
    assert all(r.explained == pytest.approx(0.2, abs=1e-12) for r in got)


def test_close_eigenvalues(spark):
    """Two eigenvalues with a relative gap of about 1e-12 keep their own directions."""
    matrix = np.array([[10**14, 3, 0], [3, 10**14 + 40, 0], [0, 0, 5]], object)
    values, vectors = whitening.components(spark, matrix, 3)
    for value, v in zip(values, vectors):
        exact = [Fraction(x) for x in v]
        for i in range(3):
            away = sum(matrix[i, j] * exact[j] for j in range(3)) - value * exact[i]
            assert abs(away) < 0.1
    half = np.hypot(3, 20)
    assert abs(vectors[0][0]) == pytest.approx(3 / np.hypot(3, 20 + half), rel=1e-12)


def test_polynomial(spark):
    draw = random.Random(9)
    for d in (1, 2, 3, 6):
        base = np.array([[draw.randrange(-(10**9), 10**9) * (draw.random() < 0.6) for _ in range(d)] for _ in range(d)], object)
        matrix = base.T @ base
        poly = whitening.characteristic_polynomial(spark, matrix)
        for x in (-3, 0, 1, 10**12):
            rows = [[Fraction(int(x * (i == j) - matrix[i, j])) for j in range(d)] for i in range(d)]
            det = Fraction(1)
            for k in range(d):
                at = next((i for i in range(k, d) if rows[i][k]), None)
                if at is None:
                    det = Fraction(0)
                    break
                if at != k:
                    rows[k], rows[at], det = rows[at], rows[k], -det
                det *= rows[k][k]
                for i in range(k + 1, d):
                    f = rows[i][k] / rows[k][k]
                    rows[i] = [a - f * b for a, b in zip(rows[i], rows[k])]
            assert sum(c * x**k for k, c in enumerate(poly)) == det


def test_roots():
    poly = [1]
    for root in (3, 3, 3, 7, 1000, 10**30, 10**30 + 1):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    got = whitening.largest_roots(poly, 7)
    assert [m for _, m in got] == [1, 1, 1, 1, 3]
    assert [round(v) for v, _ in got] == [10**30 + 1, 10**30, 1000, 7, 3]
    small = [n for n in range(5000) if n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))]
    assert [n for n in range(5000) if whitening.is_prime(n)] == small and whitening.is_prime((1 << 31) - 1)


def test_exact_gram():
    draw = np.random.default_rng(1)
    for high in (10, 1 << 30, 1 << 55):
        rows = draw.integers(-high, high, (50, 4))
        want = rows.astype(object).T @ rows.astype(object)
        assert (whitening.exact_gram(rows) == want).all()


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whitened(frame(spark, [(1, [1e300]), (2, [1.0])])).collect()
    with pytest.raises(Exception, match="fit a long"):
        whitening.whitened(frame(spark, [(1, [1e14]), (2, [-1e14])])).collect()


def test_table(spark, tmp_path):
    """The registered query over vectors of the tables, copies included."""
    some = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    some.union(some.where("vec_id % 3 = 0")).withColumn("n", F.lit("z")).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op11_whitening(spark, str(tmp_path)).toPandas()
    assert got["n"].iloc[0] == some.select("embedding").distinct().count()
    assert set(got["component"]) == set(range(1, 17)) and got["identity_error"].max() < 1e-10
