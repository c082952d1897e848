import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk


def packed(pack, rows, width, first=0):
    """Of ``(vec_id, components)``."""
    table = pa.table({
        "vec_id": pa.array([i for i, _ in rows], pa.int64()),
        "row": pa.array(range(first, first + len(rows)), pa.int64()),
        "q": pa.array([v for _, v in rows], pa.list_(pa.int64())),
    })
    return topk._Rows(pack(width)((pa.scalar(0),), table).to_pylist()[0], width)


def best_of(blocks, part, k):
    best = tuple(np.full((len(part.ids), k), x, np.int64) for x in (topk.FREE, 0))
    scored = sum(topk._walk(block, part, best) for block in blocks)
    return [[(-int(s), int(i)) for s, i in zip(*line) if s > topk.FREE] for line in zip(*best)], scored


def brute(rows, asked, k):
    """Of whole rows; ``asked`` are numbers of rows."""
    return [sorted((-sum(a * b for a, b in zip(rows[at][1], v)), i) for j, (i, v) in enumerate(rows) if j != at)[:k] for at in asked]


@pytest.mark.parametrize(("width", "size", "kind"), [
    (1, 5, np.float32), (3, 2, np.float32), (6, 300, np.float32), (6, 1 << 20, np.float64), (40, 900, np.float64),
    (4, 1 << 30, np.int64), (9, 0, np.float32),
])
def test_walk_agrees_with_all_pairs(width, size, kind):
    """Few values make ties, many of them on the last place; ids repeat."""
    draw = random.Random(width * 7 + size)
    rows = [(draw.randint(-40, 60), [draw.randint(-size, size) for _ in range(width)]) for _ in range(330)]
    rows[5] = (rows[5][0], [size] * width)
    blocks = [packed(topk._pack_block, rows[a:b], width, a) for a, b in ((0, 150), (150, 151), (151, 330))]
    asked = range(3, 20)
    part = packed(topk._pack_part, rows[3:20], width, 3)
    assert topk._exact(width, max(b.largest for b in blocks), part.largest) is kind
    got, _ = best_of(blocks, part, 5)
    assert got == brute(rows, asked, 5)


def test_walk_ends_before_the_lists_do():
    draw = random.Random(5)
    rows = [(i, [int(draw.gauss(0, 400)) for _ in range(2)]) for i in range(4000)]
    block = packed(topk._pack_block, rows, 2)
    part = packed(topk._pack_part, rows[:10], 2)
    got, scored = best_of([block], part, 5)
    assert got == brute(rows, range(10), 5)
    assert scored < 10 * 4000 / 4


def test_short_and_empty_vectors_fill_up():
    rows = [(1, []), (2, [4]), (3, [1, -2, 3]), (4, [])]
    block, part = (packed(p, rows, 3) for p in (topk._pack_block, topk._pack_part))
    full = [(i, v + [0] * (3 - len(v))) for i, v in rows]
    assert best_of([block], part, 2)[0] == brute(full, range(4), 2)


def test_top_k_broadcasts_nothing(spark, monkeypatch):
    """Queries go to many blocks: what Spark takes them to be before says nothing of their size then."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    monkeypatch.setattr(topk, "REGION_VALUES", 40 * 3 * 2, raising=False)
    draw = random.Random(12)
    rows = [(i, [draw.uniform(-1, 1) for _ in range(3)]) for i in range(2000)]
    found = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3)
    got = sorted(tuple(r) for r in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Broadcast" not in plan
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    asked = range(0, 2000, 20)
    assert got == sorted(
        (q, n + 1, i, -s) for q, best in zip(asked, brute(whole, asked, 3)) for n, (s, i) in enumerate(best)
    )


def test_top_k_where_all_ask(spark):
    """As many queries as rows, one vector among most of them, wide vectors in small blocks."""
    draw = random.Random(4)
    rows = [(i % 190, [1.0] * 70 if i % 3 else [draw.choice([-1.0, 0.5, 1.0]) for _ in range(70)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(df, F.lit(True)).collect())
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    assert got == sorted(
        (rows[at][0], n + 1, i, -s) for at, best in enumerate(brute(whole, range(200), 5)) for n, (s, i) in enumerate(best)
    )
