"""Chunked plans against brute force: one key, or one time, holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import lateness, patterns, running, timers, watermarks
from tidemark.plans.chunks import CHUNK, plan_chunks
from tidemark.plans.scans import prefix_scan

N = 900
SCHEMA = "seq bigint, arr bigint, user string, url string, ts_ms bigint"


def make_rows(seed=5):
    """In-order, late and tied arrivals; user ``hot`` has over a third of the rows."""
    rng = random.Random(seed)
    rows, ts = [], 0
    for seq in range(N):
        ts += rng.choice([0, 0, 1, 7, 40, 400])
        late = rng.choice([0, 0, 0, 50, 3000])
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(30)}"
        arr = 5000 if 300 < seq < 600 else ts + (0 if seq <= 300 else 10_000)
        rows.append((seq, arr, user, rng.choice(["error", "error", "view"]), max(0, ts - late)))
    return rows


ROWS = make_rows()
ARRIVED = sorted(ROWS, key=lambda r: (r[1], r[0]))


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(4).persist()


def test_chunks_are_bounded_and_ordered(events):
    for keys in ([], ["user"]):
        chunks = plan_chunks(events, ["arr", "seq"], keys, chunk_rows=50)
        assert chunks.split
        rows = chunks.assign(events).collect()
        hot = [r for r in rows if not keys or r["user"] == "hot"]
        assert all(r[CHUNK] > 0 for r in hot) or not keys
        ordered = sorted(hot, key=lambda r: (r["arr"], r["seq"]))
        assert [r[CHUNK] for r in ordered] == sorted(r[CHUNK] for r in hot)
        sizes = {}
        for r in hot:
            sizes[r[CHUNK]] = sizes.get(r[CHUNK], 0) + 1
        assert max(sizes.values()) <= 150 and len(sizes) >= 5


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_results_do_not_depend_on_partitions(spark, events, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = rows_of(running.running_count(events, ["user"], ["arr", "seq"], chunk_rows=50), "seq", "cnt")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    seen, expected = {}, []
    for seq, _, user, _, _ in ARRIVED:
        seen[user] = seen.get(user, 0) + 1
        expected.append((seq, seen[user]))
    assert out == sorted(expected, key=repr)


def test_running_leader(events):
    out = running.running_leader(events, "user", "seq", chunk_rows=50)
    counts, best, expected = {}, None, []
    for seq, _, user, _, _ in ROWS:
        counts[user] = counts.get(user, 0) + 1
        if best is None or counts[user] >= best[1]:
            best = (user, counts[user])
        expected.append((seq, *best))
    assert rows_of(out, "seq", "user", "cnt") == sorted(expected, key=repr)


def test_changelog_and_groups(events):
    out = running.changelog_count(events, "user", "url", ["arr", "seq"], chunk_rows=50)
    plain = running.changelog_count(events, "user", "url", ["arr", "seq"])
    assert rows_of(out) == rows_of(plain)
    groups = running.average_of_every(events, "user", "ts_ms", ["arr", "seq"], chunk_rows=50)
    assert rows_of(groups) == rows_of(running.average_of_every(events, "user", "ts_ms", ["arr", "seq"]))


def test_watermark(events):
    out = watermarks.with_watermark_seen(events, ["arr", "seq"], 5, chunks=plan_chunks(events, ["arr", "seq"], chunk_rows=50))
    top, expected = None, []
    for seq, _, _, _, ts in ARRIVED:
        expected.append((seq, None if top is None else top - 6))
        top = ts if top is None else max(top, ts)
    assert rows_of(out, "seq", "watermark_ms") == sorted(expected, key=repr)


def test_reverse_scan_per_key(events):
    out = prefix_scan(
        events, ["arr", "seq"], {"low": ("min", F.col("ts_ms"))}, ["user"], inclusive=False, reverse=True, chunk_rows=50
    )
    low, expected = {}, []
    for seq, _, user, _, ts in reversed(ARRIVED):
        expected.append((seq, low.get(user)))
        low[user] = min(ts, low.get(user, ts))
    assert rows_of(out, "seq", "low") == sorted(expected, key=repr)


@pytest.mark.parametrize("strict", [True, False])
def test_patterns(events, strict):
    failed = F.col("url") == "error"
    if strict:
        out = patterns.strict_sequence(events, "user", [failed] * 3, ["ts_ms", "seq"], chunk_rows=50)
    else:
        out = patterns.relaxed_times(events, "user", failed, 3, ["ts_ms", "seq"], chunk_rows=50)
    expected, by_user = [], {}
    for row in sorted(ROWS, key=lambda r: (r[4], r[0])):
        by_user.setdefault(row[2], []).append(row)
    for user, rows in by_user.items():
        rows = rows if strict else [r for r in rows if r[3] == "error"]
        for a, b, c in zip(rows, rows[1:], rows[2:]):
            if a[3] == b[3] == c[3] == "error":
                expected.append((user, a[0], a[4], b[4], c[4]))
    assert rows_of(out, "user", "seq", "ts_1", "ts_2", "ts_3") == sorted(expected, key=repr)


def test_late_rows_fire_again(events):
    size, delay, late = 2_000, 100, 1_500
    classified = lateness.classify(events, ["arr", "seq"], size, delay_ms=delay, lateness_ms=late)
    out = lateness.refiring_counts(classified, ["user"], ["arr", "seq"], size, chunk_rows=20)
    top, on_time, again, refires = None, {}, {}, []
    for seq, _, user, _, ts in ARRIVED:
        start = ts - ts % size
        mark = None if top is None else top - delay - 1
        top = ts if top is None else max(top, ts)
        key = (user, start)
        if mark is None or mark < start + size - 1:
            on_time[key] = on_time.get(key, 0) + 1
        elif mark < start + size - 1 + late:
            again[key] = again.get(key, 0) + 1
            refires.append((*key, "refire", seq, again[key]))
    expected = [(*k, "first", None, n) for k, n in on_time.items()]
    expected += [(u, s, f, q, n + on_time.get((u, s), 0)) for u, s, f, q, n in refires]
    assert refires
    assert rows_of(out, "user", "window_start_ms", "firing", "seq", "pv") == sorted(expected, key=repr)


def replay_timers(after, delay):
    """Fire position of each row's timer, and the periodic reports, row by row."""
    counts, armed, reports, fires = {}, {}, [], set()
    waiting, mark = [], None
    top = None
    for seq, _, user, _, ts in ARRIVED:
        counts[user] = counts.get(user, 0) + 1
        waiting.append((ts + after, None))
        if user not in armed:
            armed[user] = ts + after
        if top is None or ts > top:
            top = ts
            mark = top - delay - 1
            fires |= {(t, seq, mark) for t, _ in waiting if t <= mark}
            waiting = [w for w in waiting if w[0] > mark]
            for u in [u for u, t in armed.items() if t <= mark]:
                reports.append((u, armed.pop(u), counts[u]))
    fires |= {(t, None, None) for t, _ in waiting}
    reports += [(u, t, counts[u]) for u, t in armed.items()]
    return fires, reports


def test_event_timers(events):
    fires, _ = replay_timers(300, 0)
    out = timers.event_timers(events, ["arr", "seq"], 300, chunk_rows=50)
    assert rows_of(out, "timer_ms", "fired_by_seq", "watermark_ms") == sorted(fires, key=repr)


@pytest.mark.parametrize("after,chunk_rows", [(300, 20), (20, 40), (300, None), (100_000, 20)])
def test_periodic_counter(events, after, chunk_rows):
    _, reports = replay_timers(after, 10)
    out = timers.periodic_counter(events, "user", ["arr", "seq"], after, 10, chunk_rows=chunk_rows)
    assert rows_of(out, "user", "timer_ms", "cnt") == sorted(reports, key=repr)
