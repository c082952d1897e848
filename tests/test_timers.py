"""Timers where one arrival, or one user, holds almost everything."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import timers

SCHEMA = "seq bigint, arr bigint, user string, ts_ms bigint"


def replay(rows, after, delay):
    """Reports of the periodic counter, row by row."""
    counts, armed, reports, top = {}, {}, [], None
    for _, _, user, ts in rows:
        counts[user] = counts.get(user, 0) + 1
        armed.setdefault(user, ts + after)
        if top is None or ts > top:
            top = ts
            for u in [u for u, t in armed.items() if t <= top - delay - 1]:
                reports.append((u, armed.pop(u), counts[u]))
    return sorted(reports + [(u, t, counts[u]) for u, t in armed.items()], key=repr)


@pytest.mark.parametrize("after", [1, 30, 700, 5_000])
def test_hot_user_in_many_chunks(spark, after):
    """A user with nine of ten rows, cut in chunks much shorter than ``after_ms``."""
    draw, ts, rows = random.Random(after), 0, []
    for seq in range(2500):
        ts += draw.choice([0, 1, 5])
        user = "hot" if draw.random() < 0.9 else draw.choice([None, "a", "b"])
        rows.append((seq, seq // 3, user, max(0, ts - draw.choice([0, 0, 40]))))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = timers.periodic_counter(df, "user", ["arr", "seq"], after, 10, chunk_rows=25)
    assert rows_of(got, "user", "timer_ms", "cnt") == replay(rows, after, 10)


def test_two_hot_users(spark):
    rows = [(i, i, f"u{i % 2}" if i % 7 else None, 10 * i) for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = timers.periodic_counter(df, "user", ["arr", "seq"], 333, 0, chunk_rows=40)
    assert rows_of(got, "user", "timer_ms", "cnt") == replay(rows, 333, 0)


def test_no_group_of_a_users_exits(spark):
    """What a chunk exits with is joined, not gathered per user."""
    exits = spark.createDataFrame(
        [("u", c, 10 * c, 0, 10 * c + 25, 0) for c in range(1, 200)],
        "user string, __chunk int, __o0 long, __o1 long, __f0 long, __f1 long",
    )
    pending = timers._pending(exits, "user", 200, None)
    assert "FlatMapGroups" not in pending._jdf.queryExecution().executedPlan().toString()
    # The walk takes every third chunk: 1, 4, 7, and each later chunk awaits the last one's firing.
    want = [("u", c, 10 * (c - 1 - (c - 2) % 3) + 25, 0) for c in range(2, 200)]
    assert rows_of(pending) == sorted(want, key=repr)


def test_outlier(spark):
    """One time far ahead comes early; all later timers wait for the same arrival."""
    n = 60_000
    rows = spark.range(n).select(
        F.col("id").alias("seq"),
        F.col("id").alias("arr"),
        F.lit("u").alias("user"),
        F.when(F.col("id") == 100, 10**12).when(F.col("id") == n - 1, 2 * 10**12).otherwise(F.col("id") * 10).alias("ts_ms"),
    )
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fired = timers._with_firing(rows, ["user"], ["arr", "seq"], 500, 0, chunk_rows=5_000)
        sizes = sorted(r["count"] for r in fired.groupBy(F.spark_partition_id()).count().collect())
        got = {r.seq: r["__fires"] for r in fired.where("seq in (0, 99, 100, 101, 50000, 59999)").collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(sizes) >= 10 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert [got[i] and got[i].seq for i in (0, 99, 100, 101, 50_000, 59_999)] == [51, 100, n - 1, n - 1, n - 1, None]
    plan = fired._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
