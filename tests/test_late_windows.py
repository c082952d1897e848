"""Late firings of accumulators, on tables and streams, against a row-by-row replay."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark.operators import lateness
from tidemark.operators.accumulators import Accumulator, ViewsAndVisitors
from tidemark.streaming.late import LateCounts
from tidemark.streaming.late_windows import LateWindows

SCHEMA = "seq bigint, user string, url string, ts_ms bigint"
SIZE, DELAY, LATENESS = 1_000, 200, 1_500


class MeanOffset(Accumulator):
    """Mean time into the window."""

    schema = "mean double, urls array<string>"

    def create(self):
        return [0, 0, []]

    def add(self, held, rows):
        times = rows.column("ts_ms").to_pylist()
        return [held[0] + len(times), held[1] + sum(t % SIZE for t in times), sorted({*held[2], *rows.column("url").to_pylist()})]

    def merge(self, held, other):
        return [held[0] + other[0], held[1] + other[1], sorted({*held[2], *other[2]})]

    def finish(self, held):
        return held[1] / held[0], held[2]


def made(seed, n=700):
    draw, ts, rows = random.Random(seed), 5_000, []
    for seq in range(n):
        ts += draw.choice([0, 5, 20])
        late = draw.choice([0, 0, 0, 300, 900, 2_000, 4_000])
        user = "hot" if draw.random() < 0.5 else draw.choice([None, "a", "b"])
        rows.append((seq, user, draw.choice("xyz"), None if draw.random() < 0.01 else ts - late))
    return rows


def replay(rows, finish):
    """Firings row by row; ``finish`` makes the result of the rows of a window."""
    top, held, closed, out, side = None, {}, set(), [], []

    def close(limit):
        for key in sorted((k for k in held if k not in closed and (limit is None or k[1] + SIZE + DELAY <= limit)), key=repr):
            closed.add(key)
            out.append((key[0], key[1], "first", None, *finish(held[key])))

    for row in rows:
        seq, user, _, ts = row
        start = None if ts is None else ts - ts % SIZE
        if start is None or (top is not None and start + SIZE + DELAY + LATENESS <= top):
            side.append(seq)
        else:
            late = top is not None and start + SIZE + DELAY <= top
            held.setdefault((user, start), []).append(row)
            if late:
                closed.add((user, start))
                out.append((user, start, "refire", seq, *finish(held[user, start])))
        if ts is not None and (top is None or ts > top):
            top = ts
            close(top)
    close(None)
    return sorted(out, key=repr), sorted(side)


CASES = {
    "mean": (MeanOffset(), lambda rows: (sum(r[3] % SIZE for r in rows) / len(rows), sorted({r[2] for r in rows}))),
    "visitors": (ViewsAndVisitors("url"), lambda rows: (len(rows), len({r[2] for r in rows}))),
}
SHOWN = ["user", "window_start_ms", "firing", "seq"]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("chunk_rows", [None, 15])
def test_table(spark, case, chunk_rows):
    accumulator, finish = CASES[case]
    rows = made(2)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    classified = lateness.classify(table, ["seq"], SIZE, delay_ms=DELAY, lateness_ms=LATENESS)
    got = lateness.refirings(classified, ["user"], ["seq"], SIZE, accumulator, chunk_rows)
    want, _ = replay(rows, finish)
    assert rows_of(got, *SHOWN, *[c for c in got.columns if c in ("mean", "urls", "pv", "uv")]) == want
    assert sum(r[2] == "refire" for r in want) > 50


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("batches", [1, 5])
def test_stream(spark, ordered_stream, tmp_path, case, batches):
    accumulator, finish = CASES[case]
    rows = made(3)
    parts = [rows[len(rows) * i // batches : len(rows) * (i + 1) // batches] for i in range(batches)]
    sink = LateWindows(str(tmp_path / "w"), ["user"], ["seq"], accumulator, SIZE, DELAY, LATENESS)
    sink.start(ordered_stream(parts, SCHEMA)).awaitTermination()
    got = sink.firings(spark).unionByName(sink.still_open(spark))
    want, side = replay(rows, finish)
    assert rows_of(got, *SHOWN, *[c for c in got.columns if c in ("mean", "urls", "pv", "uv")]) == want
    assert sorted(r.seq for r in sink.side(spark).collect()) == side


def test_only_touched_windows_are_rewritten(spark, ordered_stream, tmp_path):
    """A row of one window leaves the folder of another as it lies."""
    batches = [[(1, "a", "x", 100), (2, "a", "x", 1_100)], [(3, "b", "y", 1_150)], [(4, "a", "z", 3_000)], [(5, "a", "z", 150)], [(6, "a", "z", 9_000)]]
    sink = LateWindows(str(tmp_path / "w"), ["user"], ["seq"], ViewsAndVisitors("url"), SIZE, DELAY, LATENESS)
    sink.start(ordered_stream(batches, SCHEMA)).awaitTermination()
    written = [sorted(int(p.name[7:]) for p in (tmp_path / "w" / "windows" / f"__batch={i}").glob("window=*")) for i in range(5)]
    assert written == [[0, 1000], [1000], [3000], [], [9000]]
    manifests = [dict(map(tuple, spark.read.parquet(f"{sink.path}/manifest/__batch={i}").collect())) for i in range(5)]
    assert manifests[1] == {0: 0, 1000: 1} and manifests[2] == {1000: 1, 3000: 2} and manifests[4] == {9000: 4}
    assert sorted(r.seq for r in sink.side(spark).collect()) == [5]


def test_counts_agree(spark, ordered_stream, tmp_path):
    """The same firings as the sink that only counts."""
    rows = made(4, 300)
    parts = [rows[:120], rows[120:200], rows[200:]]
    counts = LateCounts(str(tmp_path / "c"), ["user"], ["seq"], SIZE, DELAY, LATENESS)
    counts.start(ordered_stream(parts, SCHEMA)).awaitTermination()
    sink = LateWindows(str(tmp_path / "w"), ["user"], ["seq"], ViewsAndVisitors("url"), SIZE, DELAY, LATENESS)
    sink.start(ordered_stream(parts, SCHEMA)).awaitTermination()
    mine = sink.firings(spark).unionByName(sink.still_open(spark))
    theirs = counts.firings(spark).unionByName(counts.still_open(spark))
    assert rows_of(mine, *SHOWN, "pv") == rows_of(theirs, *SHOWN, "pv")
