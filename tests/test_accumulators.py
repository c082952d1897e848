"""Aggregates and functions over windows that users write."""

import random
from collections import defaultdict

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import accumulators
from tidemark.operators.accumulators import Accumulator, ViewsAndVisitors
from tidemark.operators.windows import END, START

SCHEMA = "seq bigint, user string, url string, ts_ms bigint"


def make_rows(n=1200, seed=4):
    """Window [0, 1000) of ``./hot`` holds over half of the rows; some have no time, key or visitor."""
    draw = random.Random(seed)
    rows = []
    for seq in range(n):
        hot = draw.random() < 0.6
        url = "./hot" if hot else draw.choice(["./a", "./b", None])
        ts = draw.randrange(1000) if hot else draw.choice([None, draw.randrange(-500, 5000)])
        rows.append((seq, draw.choice([None, *[f"u{i}" for i in range(40)]]), url, ts))
    return rows


ROWS = make_rows()


def windows_of(ts, size, slide):
    start = ts - ts % slide
    while start > ts - size:
        yield start
        start -= slide


def by_hand(size, slide, keyed=True):
    views, visitors = defaultdict(int), defaultdict(set)
    for _, user, url, ts in ROWS:
        for start in windows_of(ts, size, slide) if ts is not None else ():
            key = (url, start) if keyed else (start,)
            views[key] += 1
            visitors[key] |= {user} - {None}
    return sorted(((*k[:-1], k[-1], k[-1] + size, n, len(visitors[k])) for k, n in views.items()), key=repr)


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(12).persist()


@pytest.mark.parametrize("size,slide", [(1000, None), (1000, 500), (1000, 300)])
def test_views_and_visitors(events, size, slide):
    visitors = ViewsAndVisitors("user")
    got = accumulators.window_accumulate(events, ["url"], size, visitors, slide, ["user"])
    assert got.columns == ["url", START, END, "pv", "uv"]
    assert rows_of(got) == by_hand(size, slide or size)
    got = accumulators.window_accumulate(events, [], size, visitors, slide)
    assert rows_of(got) == by_hand(size, slide or size, keyed=False)


def test_merged_a_few_at_a_time(events, monkeypatch):
    monkeypatch.setattr(accumulators, "FAN_IN", 4)
    monkeypatch.setattr(accumulators, "FLUSH_ROWS", 1)
    got = accumulators.window_accumulate(events, ["url"], 1000, ViewsAndVisitors("user"), 500)
    assert rows_of(got) == by_hand(1000, 500)


def test_hot_window(events):
    """Rows are folded where they are; the hot window leaves each task as one row."""
    group = ["url", accumulators.PANE]
    rows = events.where("ts_ms is not null").select("url", F.floor(F.col("ts_ms") / 1000).alias(accumulators.PANE), "user")
    parts = accumulators.partials(rows, group, ViewsAndVisitors("user"))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("InMemoryTableScan") and "Exchange" not in plan[: plan.index("InMemoryTableScan")]
    hot = parts.where("url = './hot' and __pane = 0").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) == 12 and {r["count"] for r in hot} == {1}
    sizes = sorted(r["count"] for r in parts.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


class Spread(Accumulator):
    """Smallest and largest sequence number and their mean: columns of several types."""

    schema = "low bigint, high bigint, middle double, urls array<string>"

    def create(self):
        return []

    def add(self, held, rows):
        urls = rows.column("url").drop_null().to_pylist()
        return held + [(x, u) for x, u in zip(rows.column("seq").to_pylist(), urls * 1 or [None] * rows.num_rows)]

    def merge(self, held, other):
        return held + other

    def finish(self, held):
        seqs = [x for x, _ in held]
        return min(seqs), max(seqs), (min(seqs) + max(seqs)) / 2, sorted({u for _, u in held if u})


def test_own_accumulator(spark, events):
    got = accumulators.window_accumulate(events.where("url is not null"), ["url"], 10_000, Spread())
    seqs = defaultdict(list)
    for seq, _, url, ts in ROWS:
        if ts is not None and url is not None:
            seqs[url, ts - ts % 10_000].append(seq)
    want = [(u, s, min(x), max(x), (min(x) + max(x)) / 2, [u]) for (u, s), x in seqs.items()]
    assert rows_of(got, "url", START, "low", "high", "middle", "urls") == sorted(want, key=repr)
    nothing = accumulators.window_accumulate(events.limit(0), ["url"], 1000, ViewsAndVisitors("user"))
    assert nothing.collect() == [] and nothing.columns == ["url", START, END, "pv", "uv"]


def longest_gap(window, batches):
    """Rows, visitors and the longest time between neighbours, from rows in order."""
    rows, users, last, gap = 0, set(), None, 0
    for batch in batches:
        times = batch.column("ts_ms").to_pylist()
        assert all(window.start_ms <= t < window.end_ms for t in times)
        for t in times:
            gap, last = max(gap, t - last if last is not None else 0), t
        rows += len(times)
        users.update(pc.unique(batch.column("user").drop_null()).to_pylist())
    yield pa.RecordBatch.from_pydict({"n": [rows], "uv": [len(users)], "gap": [gap]})


@pytest.mark.parametrize("size,slide", [(1000, None), (1000, 300)])
def test_process_windows(events, size, slide):
    got = accumulators.process_windows(
        events, ["url"], size, longest_gap, "n bigint, uv bigint, gap bigint", slide, ["ts_ms"]
    )
    assert got.columns == ["url", START, END, "n", "uv", "gap"]
    times = defaultdict(list)
    for _, _, url, ts in ROWS:
        for start in windows_of(ts, size, slide or size) if ts is not None else ():
            times[url, start].append(ts)
    gaps = {k: max((b - a for a, b in zip(sorted(v), sorted(v)[1:])), default=0) for k, v in times.items()}
    want = [(*r, gaps[r[0], r[1]]) for r in by_hand(size, slide or size)]
    assert rows_of(got) == sorted(want, key=repr)


def test_large_window_comes_in_batches(spark):
    """Five million rows of one window, never more than one Arrow batch at a time."""
    n = 5_000_000

    def sizes(window, batches):
        most = rows = total = 0
        for batch in batches:
            most, rows = max(most, batch.num_rows), rows + batch.num_rows
            total += pc.sum(batch.column("id")).as_py()
        yield pa.RecordBatch.from_pydict({"rows": [rows], "most": [most], "total": [total]})

    rows = spark.range(n).select("id", (F.col("id") % 1000).alias("ts_ms"))
    (got,) = accumulators.process_windows(rows, [], 1000, sizes, "rows bigint, most bigint, total bigint").collect()
    assert (got.rows, got.total) == (n, n * (n - 1) // 2) and got.most <= 10_000


def test_streams_are_refused(ordered_stream):
    stream = ordered_stream([ROWS[:2]], SCHEMA)
    with pytest.raises(ValueError):
        accumulators.window_accumulate(stream, ["url"], 1000, ViewsAndVisitors("user"))
    with pytest.raises(ValueError):
        accumulators.process_windows(stream, ["url"], 1000, longest_gap, "n bigint")
