"""Cuts of an order: nulls, integers beyond doubles, ties, and many of them."""

import random
import time

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import patterns, running, watermarks
from tidemark.plans.chunks import CHUNK, LEAST, Chunks, chunk_count, plan_chunks
from tidemark.plans.scans import prefix_scan

BIG = 1 << 60
SCHEMA = "seq bigint, user string, url string, ts_ms bigint"


def made(kind, n=3000):
    draw = random.Random(kind)
    times = {
        "nulls": lambda: None if draw.random() < 0.25 else draw.randrange(10_000),
        "mostly null": lambda: None if draw.random() < 0.9 else draw.randrange(5),
        "all null": lambda: None,
        "large": lambda: BIG + draw.randrange(300),
        "ties": lambda: draw.choice([7, 7, 7, 7, draw.randrange(20)]),
        "ends": lambda: draw.choice([LEAST, (1 << 63) - 1, 0, -1, draw.randrange(-BIG, BIG)]),
    }[kind]
    # One user holds half of all rows.
    return [(i, draw.choice(["hot", f"u{i % 50}"]), draw.choice(["error", "view"]), times()) for i in range(n)]


KINDS = ["nulls", "mostly null", "all null", "large", "ties", "ends"]


@pytest.mark.parametrize("kind", KINDS)
def test_cuts_follow_the_order(spark, kind):
    df = spark.createDataFrame(made(kind), SCHEMA)
    chunks = plan_chunks(df, ["ts_ms", "seq"], chunk_rows=100)
    rows = chunks.assign(df).orderBy(F.col("ts_ms").asc_nulls_first(), "seq").collect()
    numbers = [r[CHUNK] for r in rows]
    assert numbers == sorted(numbers) and None not in numbers
    below = lambda r: 0 if r.ts_ms is None else sum(c <= (r.ts_ms, r.seq) for c in chunks.cuts)
    assert numbers == [below(r) for r in rows]
    timed = sum(r.ts_ms is not None for r in rows)
    assert len(chunks.cuts) + 1 >= min(25, timed // 20) and all(type(x) is int for c in chunks.cuts for x in c)


@pytest.mark.parametrize("kind", KINDS)
def test_scans_equal_plain_windows(spark, kind):
    df = spark.createDataFrame(made(kind), SCHEMA).repartition(5)
    order = [F.col("ts_ms").asc_nulls_first(), F.col("seq")]
    until = W.partitionBy("user").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    got = running.running_count(df, ["user"], ["ts_ms", "seq"], chunk_rows=100)
    assert rows_of(got, "seq", "cnt") == rows_of(df.select("seq", F.count("*").over(until).alias("cnt")))

    # The sequence number of the row at the top, so that nothing overflows.
    measure = {"top": ("max", F.col("seq"))}
    before = W.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    got = prefix_scan(df, ["ts_ms", "seq"], measure, inclusive=False, chunk_rows=100)
    assert rows_of(got, "seq", "top") == rows_of(df.select("seq", F.max("seq").over(before).alias("top")))

    after = W.partitionBy("user").orderBy(F.col("ts_ms").desc_nulls_last(), F.col("seq").desc())
    after = after.rowsBetween(W.unboundedPreceding, 0)
    got = prefix_scan(df, ["ts_ms", "seq"], measure, ["user"], reverse=True, chunk_rows=100)
    assert rows_of(got, "seq", "top") == rows_of(df.select("seq", F.max("seq").over(after).alias("top")))


@pytest.mark.parametrize("kind", ["nulls", "ties", "large"])
def test_patterns_and_watermarks(spark, kind):
    df = spark.createDataFrame(made(kind), SCHEMA)
    failed = F.col("url") == "error"
    for make in (
        lambda n: patterns.strict_sequence(df, "user", [failed] * 3, ["ts_ms", "seq"], chunk_rows=n),
        lambda n: patterns.relaxed_times(df, "user", failed, 3, ["ts_ms", "seq"], chunk_rows=n),
        lambda n: running.changelog_count(df, "user", "url", ["ts_ms", "seq"], chunk_rows=n),
        lambda n: running.average_of_every(df, "user", "seq", ["ts_ms", "seq"], chunk_rows=n),
    ):
        assert rows_of(make(100)) == rows_of(make(None))
    chunks = plan_chunks(df, ["seq"], chunk_rows=100)
    assert rows_of(watermarks.with_watermark_seen(df, ["seq"], chunks=chunks)) == rows_of(watermarks.with_watermark_seen(df, ["seq"]))


@pytest.mark.parametrize("tied", [False, True])
def test_many_cuts_plan_quickly(spark, tied):
    cuts = tuple((5 if tied else 3 * i, i) for i in range(100_000))
    df = spark.range(1000).select((F.col("id") * 307).alias("seq"), F.lit(5).cast("long").alias("ts_ms") if tied else (F.col("id") * 300 + 1).alias("ts_ms"))
    chunks = Chunks(("ts_ms", "seq"), (), cuts, rows=10**9)
    chunks.assign(df.limit(1)).collect()
    began = time.perf_counter()
    placed = chunks.assign(df)
    placed._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - began < 2
    rows = placed.collect()
    want = {r.seq: min(r.seq + 1, 100_000) if tied else -(-(r.ts_ms + 1) // 3) for r in rows}
    assert all(r[CHUNK] == want[r.seq] for r in rows)


def test_size_grows_with_number():
    """Far beyond a hundred thousand chunks there are more of them, and larger ones."""
    counts = [chunk_count(rows, 10**6) for rows in (10, 10**9, 10**11, 10**13, 10**15)]
    assert counts == [1, 1_000, 100_000, 1_000_000, 10_000_000]
