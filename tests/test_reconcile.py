"""Pairing of repeated keys against a row-by-row walk."""

import random

import pytest

from tests.conftest import rows_of
from tidemark.operators.reconcile import NO_ORDER, NO_PAYMENT, SUCCESS, reconcile

SCHEMA = "order_id string, ts_ms bigint, seq bigint"


def walked(app, payment, limit):
    """One waiting row per key, in time; app orders first at one time."""
    rows = [(k, t, 0, s) for k, t, s in app] + [(k, t, 1, s) for k, t, s in payment]
    out, waiting = [], {}

    def fail(key, side, seq):
        out.append((key, *((seq, None, NO_PAYMENT) if side == 0 else (None, seq, NO_ORDER))))

    for key, ts, side, seq in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[1:]):
        held = waiting.pop(key, None)
        if held and held[1] != side and ts - held[0] <= limit:
            out.append((key, *((seq, held[2]) if side == 0 else (held[2], seq)), SUCCESS))
            continue
        if held:
            fail(key, held[1], held[2])
        waiting[key] = (ts, side, seq)
    for key, (_, side, seq) in waiting.items():
        fail(key, side, seq)
    for key, ts, side, seq in rows:
        if key is None or ts is None:
            fail(key, side, seq)
    return sorted(out, key=repr)


def made(seed, n=1500):
    draw = random.Random(seed)
    rows = ([], [])
    for seq in range(n):
        key = "hot" if draw.random() < 0.4 else draw.choice([None, *[f"o{i}" for i in range(60)]])
        ts = None if draw.random() < 0.05 else draw.randrange(40_000 if key != "hot" else 400_000)
        rows[draw.random() < 0.5].append((key, ts, seq))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk_rows", [None, 60])
def test_repeated_keys(spark, seed, chunk_rows):
    app, payment = made(seed)
    frames = [spark.createDataFrame(rows, SCHEMA).repartition(3) for rows in (app, payment)]
    got = reconcile(*frames, 1_000, "order_id", ["seq"], ["seq"], ["seq"], chunk_rows=chunk_rows)
    want = walked(app, payment, 1_000)
    assert rows_of(got) == want and sum(r[3] == SUCCESS for r in want) > 100
    # Each row once, in all.
    seqs = sorted(s for r in want for s in r[1:3] if s is not None)
    assert seqs == list(range(len(app) + len(payment)))


def test_no_row_is_lost(spark):
    app = spark.createDataFrame([("o1", 1000, 1), ("o1", 100_000, 2)], SCHEMA)
    payment = spark.createDataFrame([("o1", 1500, 3)], SCHEMA)
    got = rows_of(reconcile(app, payment, 5_000))
    assert got == [("o1", 1000, 1500, SUCCESS), ("o1", 100_000, None, NO_PAYMENT)]
    twice = rows_of(reconcile(app.union(app), payment.limit(0), 5_000))
    assert twice == [("o1", t, None, NO_PAYMENT) for t in (1000, 1000, 100_000, 100_000)]
    assert reconcile(app.limit(0), payment.limit(0)).collect() == []


def test_one_shuffle(spark, tmp_path):
    """Without hot keys the pairing is one shuffle of both sides."""
    for side, rows in zip(("a", "p"), made(3)):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / side))
    app, payment = (spark.read.parquet(str(tmp_path / side)) for side in "ap")
    out = reconcile(app, payment, 1_000, "order_id", ["seq"], ["seq"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
