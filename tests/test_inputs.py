"""Two-input processors on streams against row-by-row replays."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_reconcile import walked
from tidemark.operators.reconcile import reconcile
from tidemark.sources.events import with_event_time
from tidemark.streaming import inputs, sinks

SCHEMA = "order_id string, ts_ms bigint, seq bigint"
BOTH = "side int, " + SCHEMA
FAR = 100_000_000
OUT = "order_id string, app_seq bigint, payment_seq bigint, status string"


def made(seed, n=240):
    """Rows of both sides in time; keys repeat, some rows share a time."""
    draw, ts, rows = random.Random(seed), 1000, []
    for seq in range(n):
        ts += draw.choice([0, 0, 3, 40, 400])
        rows.append((int(draw.random() < 0.5), draw.choice(["hot", "hot", "a", "b", "c"]), ts, (1 << 60) + seq))
    return rows


def batches_of(rows, n):
    """Cut at whole times, so that rows of one time come together."""
    cuts = sorted({rows[len(rows) * i // n][2] for i in range(1, n)})
    parts = [[] for _ in range(len(cuts) + 1)]
    for r in rows:
        parts[sum(r[2] >= c for c in cuts)].append(r)
    random.Random(7).shuffle(parts[0])
    return parts


def sides_of(stream):
    timed = with_event_time(stream, "1 second")
    return [timed.where(F.col("side") == i).drop("side") for i in (0, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_reconcile(spark, ordered_stream, seed):
    rows = made(seed)
    ends = [[(0, "end", FAR, 0), (1, "end", FAR, 0)]]
    app, payment = sides_of(ordered_stream(batches_of(rows, 4) + ends, BOTH))
    out = inputs.connect(app, payment, ["order_id"], inputs.Reconcile(300, ["seq"]), OUT, F.col("seq"))
    got = sinks.run_to_table(out, "reconciled").where("order_id <> 'end'")
    tables = [[r[1:] for r in rows if r[0] == i] for i in (0, 1)]
    want = walked(*tables, 300)
    assert rows_of(got) == want and len({r[3] for r in want}) == 3
    frames = [spark.createDataFrame(t, SCHEMA) for t in tables]
    assert rows_of(reconcile(*frames, 300, "order_id", ["seq"], ["seq"], ["seq"])) == want


def test_timers_fire_between_batches(ordered_stream):
    """A row fails once the watermark has passed its limit, before the key's next row comes."""
    batches = [[(0, "a", 1000, 1)], [(0, "x", 9000, 2), (1, "x", 9000, 3)], [(0, "y", 9100, 4), (1, "y", 9100, 5)], [(1, "a", 9200, 6)]]
    app, payment = sides_of(ordered_stream(batches, BOTH))
    out = inputs.connect(app, payment, ["order_id"], inputs.Reconcile(5_000, ["seq"]), OUT)
    got = rows_of(sinks.run_to_table(out, "reconciled"))
    assert got == [("a", 1, None, "failed: no payment"), ("x", 2, 3, "success"), ("y", 4, 5, "success")]


class Ledger(inputs.TwoInputs):
    """Left rows add, right rows report and take away; a quiet key is closed by its timer."""

    def on_left(self, key, row):
        held = self.left["amount"] if self.left else 0
        self.left = Row(**{**row.asDict(), "amount": held + row["amount"]})
        self.set_timer(row["ts_ms"] + 100)
        return []

    def on_right(self, key, row):
        held = self.left["amount"] if self.left else 0
        self.right = row
        return [(*key, "report", held, row["note"])]

    def on_timer(self, key, at_ms):
        out = [(*key, "closed", self.left["amount"], self.right["note"] if self.right else None)]
        self.left = self.right = None
        return out


def test_own_processor(spark, ordered_stream):
    """Sides with different columns and nulls. The row at 300 comes in the batch before the
    watermark passes 120, so it puts the timer off."""
    left_rows = [[("k", 10, 5), ("k", 20, 7)], [("k", 300, 1), ("q", 310, 2)], [("end", FAR, 0)]]
    right_rows = [[("k", 15, "one"), ("k", 25, None)], [("q", 320, "late")], [("end", FAR, "x")]]
    left = with_event_time(ordered_stream(left_rows, "k string, ts_ms bigint, amount bigint"), "1 millisecond")
    right = with_event_time(ordered_stream(right_rows, "k string, ts_ms bigint, note string"), "1 millisecond")
    out = inputs.connect(left, right, ["k"], Ledger(), "k string, kind string, amount bigint, note string")
    got = rows_of(sinks.run_to_table(out, "ledger").where("k <> 'end'"))
    assert got == sorted(
        [("k", "report", 5, "one"), ("k", "report", 12, None), ("k", "closed", 13, None),
         ("q", "report", 2, "late"), ("q", "closed", 2, "late")], key=repr,
    )
