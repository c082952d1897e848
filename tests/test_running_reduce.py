"""Running results by functions that users write, one key with half of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import accumulators, running

SCHEMA = "seq bigint, user string, url string, ts_ms bigint"


def made(n=900, seed=8):
    draw, ts, rows = random.Random(seed), 0, []
    for seq in range(n):
        ts += draw.choice([0, 1, 3, 50])
        user = "hot" if draw.random() < 0.5 else draw.choice([None, *[f"u{i}" for i in range(20)]])
        rows.append((seq, user, draw.choice(["a", "b", None]), None if draw.random() < 0.05 else ts))
    return rows


ROWS = made()


def joined(a, b):
    """Associative, not commutative, none of sum, least and largest."""
    path = a["path"] + b["path"]
    return {"path": path[:3] + path[max(3, len(path) - 3) :], "low": min(a["low"], b["low"])}


def by_hand(order):
    held, out = {}, []
    for seq, user, url, ts in sorted(ROWS, key=order):
        record = {"path": url or "-", "low": -seq}
        held[user] = joined(held[user], record) if user in held else record
        out.append((user, seq, held[user]["path"], held[user]["low"]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_rows", [None, 40])
def test_running_reduce(spark, chunk_rows):
    rows = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    rows = rows.select("*", F.coalesce("url", F.lit("-")).alias("path"), (-F.col("seq")).alias("low"))
    schema = "path string, low bigint"
    got = running.running_reduce(rows, ["user"], ["seq"], joined, schema, chunk_rows)
    assert rows_of(got, "user", "seq", "path", "low") == by_hand(lambda r: r[0])
    got = running.running_reduce(rows, ["user"], ["ts_ms", "seq"], joined, schema, chunk_rows)
    assert got.columns == ["user", "ts_ms", "seq", "path", "low"]
    assert rows_of(got, "user", "seq", "path", "low") == by_hand(lambda r: (r[3] is not None, r[3] or 0, r[0]))


@pytest.mark.parametrize("chunk_rows", [None, 40])
def test_openings(spark, chunk_rows):
    """Visitors so far, where some keys start with visitors of their own."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    visitors = accumulators.ViewsAndVisitors("url")
    before = spark.createDataFrame([("hot", ["x", "a"]), ("new", ["y"])], "user string, seen array<string>")
    held = before.select("user", F.explode("seen").alias("url"))
    openings = accumulators.merged(accumulators.partials(held, ["user"], visitors), ["user"], visitors, done=False)
    got = accumulators.running_accumulate(rows, ["user"], ["seq"], visitors, openings, chunk_rows)
    seen, views, want = {"hot": {"x", "a"}}, {"hot": 2}, []
    for seq, user, url, ts in ROWS:
        seen.setdefault(user, set()).update({url} - {None})
        views[user] = views.get(user, 0) + 1
        want.append((seq, user, url, ts, views[user], len(seen[user])))
    assert rows_of(got) == sorted(want, key=repr)


def test_records_that_hold_the_key(spark):
    """The two reduces of an active-user count: per user, then over all rows."""
    rows = spark.createDataFrame([(i, "ab"[i % 3 == 0], 1) for i in range(50)], "seq bigint, user string, n bigint")
    add = lambda a, b: {"user": a["user"], "n": a["n"] + b["n"]}
    counts = running.running_reduce(rows, ["user"], ["seq"], add, "user string, n bigint")
    assert counts.columns == ["seq", "user", "n"]
    top = lambda a, b: a if a["n"] > b["n"] else b
    best = running.running_reduce(counts, [], ["seq"], top, "user string, n bigint")
    plain = running.running_leader(rows, "user", "seq")
    assert rows_of(best, "seq", "user", "n") == rows_of(plain, "seq", "user", "cnt")
    assert running.running_reduce(rows.limit(0), ["user"], ["seq"], add, "user string, n bigint").collect() == []


def test_window_reduce(spark):
    """A reduce of two records over windows: the earlier of the longest visits."""
    rows = spark.createDataFrame(ROWS, SCHEMA).where("url is not null and ts_ms is not null")
    longer = lambda a, b: min(a, b, key=lambda r: (-(r["seq"] % 7), r["seq"]))
    got = accumulators.window_accumulate(rows, ["url"], 1000, accumulators.Reduced("seq bigint", longer), 500)
    want = {}
    for seq, _, url, ts in ROWS:
        for start in (ts - ts % 500, ts - ts % 500 - 500) if ts is not None and url else ():
            key = (url, start)
            want[key] = min(want.get(key, seq), seq, key=lambda s: (-(s % 7), s))
    assert rows_of(got, "url", "window_start_ms", "seq") == sorted([(*k, v) for k, v in want.items()], key=repr)
