"""Patterns on streams against the same patterns on the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import patterns
from tidemark.streaming.patterns import PatternMatches

SCHEMA = "user string, seq bigint, ts_ms bigint, url string"
DELAY = 300


def made(seed, n=600):
    """Arrivals up to ``DELAY`` out of order; one user holds half of the rows; a few rows lack a time."""
    draw, ts, rows = random.Random(seed), 1000, []
    for seq in range(n):
        ts += draw.choice([0, 0, 5, 30])
        user = "hot" if draw.random() < 0.5 else draw.choice([None, "a", "b", "c"])
        rows.append((user, seq, None if draw.random() < 0.02 else ts, draw.choice(["error", "error", "view", None])))
    return sorted(rows, key=lambda r: (r[2] or 0) + draw.randrange(DELAY))


def cut(rows, n):
    return [rows[len(rows) * i // n : len(rows) * (i + 1) // n] for i in range(n)]


def by_hand(rows, conditions, relaxed):
    """Matches as tuples of rows, key by key."""
    out = []
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user and r[2] is not None), key=lambda r: (r[2], r[1]))
        mine = [r for r in mine if r[3] == "error"] if relaxed else mine
        for i in range(len(mine) - len(conditions) + 1):
            found = mine[i : i + len(conditions)]
            if all(ok(r[3]) for ok, r in zip(conditions, found)):
                out.append((user, found[0][1], *[r[2] for r in found]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("relaxed", [False, True])
@pytest.mark.parametrize("batches,chunk_rows", [(1, None), (4, None), (9, 40)])
def test_equals_table(spark, ordered_stream, tmp_path, relaxed, batches, chunk_rows):
    rows = made(3)
    failed = F.col("url") == "error"
    conditions = [failed] if relaxed else [failed, failed, F.col("url") == "view"]
    sink = PatternMatches(str(tmp_path / "p"), "user", conditions, ["ts_ms", "seq"], DELAY, relaxed, 3, chunk_rows=chunk_rows)
    sink.start(ordered_stream(cut(rows, batches), SCHEMA)).awaitTermination()
    got = rows_of(sink.matches(spark).unionByName(sink.still_open(spark)), "user", "seq", "ts_1", "ts_2", "ts_3")
    steps = [lambda u: u == "error"] * (3 if relaxed else 2) + ([] if relaxed else [lambda u: u == "view"])
    assert got == by_hand(rows, steps, relaxed) and len(got) > 20
    assert sink.late(spark).count() == 0
    table = spark.createDataFrame([r for r in rows if r[2] is not None], SCHEMA)
    if relaxed:
        want = patterns.relaxed_times(table, "user", failed, 3, ["ts_ms", "seq"])
    else:
        want = patterns.strict_sequence(table, "user", conditions, ["ts_ms", "seq"])
    assert got == rows_of(want, "user", "seq", "ts_1", "ts_2", "ts_3")


def test_match_over_batches(spark, ordered_stream, tmp_path):
    """Six rows in six batches; what is carried stays at two rows per key."""
    rows = [("a", i, 1000 * i + 1000, "error") for i in range(6)] + [("b", 9, 9000, "view")]
    sink = PatternMatches(str(tmp_path / "p"), "user", [F.col("url") == "error"] * 3, ["ts_ms", "seq"])
    sink.start(ordered_stream([[r] for r in rows], SCHEMA)).awaitTermination()
    assert [r[1] for r in rows_of(sink.matches(spark), "user", "seq")] == [0, 1, 2, 3]
    held = spark.read.parquet(f"{sink.path}/held/__batch=6")
    assert rows_of(held.where("__carried"), "seq") == [(4,), (5,)] and rows_of(held.where("not __carried"), "seq") == [(9,)]
    assert sink.still_open(spark).collect() == []


def test_late_rows_are_kept_apart(spark, ordered_stream, tmp_path):
    batches = [[("a", 1, 1000, "error")], [("a", 2, 5000, "error")], [("a", 3, 2000, "error"), ("a", 4, 6000, "error")], [("z", 5, 9000, "view")]]
    sink = PatternMatches(str(tmp_path / "p"), "user", [F.col("url") == "error"] * 3, ["ts_ms", "seq"], 100)
    sink.start(ordered_stream(batches, SCHEMA)).awaitTermination()
    assert rows_of(sink.late(spark), "seq") == [(3,)]
    assert rows_of(sink.matches(spark), "user", "ts_1", "ts_2", "ts_3") == [("a", 1000, 5000, 6000)]
    with pytest.raises(ValueError):
        PatternMatches("p", "user", [F.lit(True)] * 2, ["seq"], relaxed=True)
