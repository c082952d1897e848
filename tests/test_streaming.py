import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tidemark import catalog
from tidemark.functions.time import window_start
from tidemark.operators import lateness, parsing, reconcile, routing, timers, topn, watermarks, windows
from tidemark.session import fresh_path
from tidemark.sources.custom import EventFeed, FilesFeed, register_feed
from tidemark.sources.events import with_event_time
from tidemark.sources.text import stream_lines
from tidemark.streaming import processors, sinks
from tidemark.streaming.late import LateCounts

EVENT = "seq bigint, user string, url string, ts_ms bigint"
FAR = 10_000_000

CLICKS = [
    (1, "Alice", "./home", 1000),
    (2, "Bob", "./cart", 2000),
    (3, "Alice", "./home", 4000),
    (4, "Bob", "./fav", 11000),
    (5, "Alice", "./cart", 12500),
    (6, "Alice", "./home", 23000),
]
SENTINEL = (99, "end", "end", FAR)


def one_per_batch(rows):
    return [[row] for row in rows]


def test_word_count_updates(spark, tmp_path):
    source = tmp_path / "lines"
    source.mkdir()
    (source / "a.txt").write_text("hello world\nhello spark\n")
    (source / "b.txt").write_text("hello kafka\nhello hadoop\n")
    counts = parsing.word_count(stream_lines(spark, str(source), 1))
    out = sinks.run_to_table(counts, "words", "update", ["word"])
    assert rows_of(out) == [("hadoop", 1), ("hello", 4), ("kafka", 1), ("spark", 1), ("world", 1)]


@pytest.mark.parametrize("slide", [None, 5_000])
def test_windows_equal_batch(spark, ordered_stream, slide):
    stream = ordered_stream([CLICKS[:3], CLICKS[3:], [SENTINEL]], EVENT)
    timed = with_event_time(stream, "0 seconds")
    out = sinks.run_to_table(windows.window_aggregate(timed, ["user"], 10_000, slide), "pv")
    batch = windows.window_aggregate(spark.createDataFrame(CLICKS, EVENT), ["user"], 10_000, slide)
    assert rows_of(out, *batch.columns) == rows_of(batch)


def test_visitors_equal_batch(spark, ordered_stream):
    timed = with_event_time(ordered_stream([CLICKS, [SENTINEL]], EVENT), "0 seconds")
    out = sinks.run_to_table(windows.page_and_visitor_counts(timed, "user", 10_000), "uv")
    batch = windows.page_and_visitor_counts(spark.createDataFrame(CLICKS, EVENT), "user", 10_000)
    assert rows_of(out, *batch.columns) == rows_of(batch)


def test_top_urls_as_windows_close(spark, ordered_stream, tmp_path):
    timed = with_event_time(ordered_stream([CLICKS, [SENTINEL]], EVENT), "1 seconds")
    counts = windows.window_aggregate(timed, ["url"], 10_000, 5_000)
    path = str(tmp_path / "top")
    top = lambda batch: topn.pad_ranks(topn.top_n(batch, 2), 2)
    sinks.start_table(counts, path, transform=top).awaitTermination()
    out = spark.read.parquet(f"{path}/data").drop(sinks.BATCH)
    batch = topn.pad_ranks(topn.top_urls(spark.createDataFrame(CLICKS, EVENT), 10_000, 5_000), 2)
    assert rows_of(out, *batch.columns) == rows_of(batch)


@pytest.mark.parametrize("parts", [1, 64])
def test_top_urls_with_list_state(spark, ordered_stream, parts):
    ends = [[(99 + i, "end", "end", FAR * (i + 1))] for i in range(4)]
    timed = with_event_time(ordered_stream([CLICKS[:3], CLICKS[3:5], CLICKS[5:], *ends], EVENT), "1 seconds")
    ranked = processors.top_urls(timed, 10_000, 5_000, 2, parts=parts)
    out = sinks.run_to_table(ranked, "top").where(f"window_end_ms < {FAR}")
    batch = topn.pad_ranks(topn.top_urls(spark.createDataFrame(CLICKS, EVENT), 10_000, 5_000), 2)
    assert rows_of(out) == rows_of(batch, "window_end_ms", "rank", "url", "pv")


def test_candidates_before_the_list_state(ordered_stream):
    """Counts meet in as many groups as there are parts; the list state gets n of each."""
    timed = with_event_time(ordered_stream([CLICKS], EVENT), "1 seconds")
    plan = processors.top_urls(timed, 10_000, 5_000, 2)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Aggregate") == 2 and "slice(array_sort(collect_list" in plan


def test_event_timers_fire_after_watermark(spark, ordered_stream):
    rows = [(1, "a", "u", 1000), (2, "a", "u", 1000), (3, "a", "u", 6000), (4, "a", "u", 6001)]
    timed = with_event_time(ordered_stream(one_per_batch(rows), EVENT), "0 seconds")
    out = processors.process(
        timed, ["user"], processors.Timers(["user"], 5_000), "user string, kind string, at_ms bigint", "EventTime"
    )
    fired = sinks.run_to_table(out, "timers").where("kind = 'fired'")
    assert rows_of(fired, "at_ms") == [(6000,)]


def test_event_timers_in_built_in_state(spark, ordered_stream):
    rows = [
        (1, "a", "u", 1000), (2, "a", "u", 1000), (3, None, "u", 1001), (4, "a", "u", None), (5, "a", "u", None),
        (6, "b", "u", 1000), (7, "a", "u", 6001), (8, "a", "u", 6000), (9, "a", "u", 6001),
    ]
    out = processors.event_timers(ordered_stream(one_per_batch(rows), EVENT), ["user"], 5_000)
    done = sinks.run_to_table(out, "timers")
    assert rows_of(done.where("kind = 'input'"), "user", "at_ms") == sorted(((r[1], r[3]) for r in rows), key=repr)
    # The timers at 6001 and later are ahead of the watermark when the input ends.
    assert rows_of(done.where("kind = 'fired'"), "user", "at_ms") == [("a", 6000), ("a", None), ("b", 6000)]


def test_event_timers_query_with_nulls(spark, tmp_path):
    rows = [(i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00" if i % 9 else None, i % 4 or None) for i in range(600)]
    events = spark.createDataFrame(rows, "event_id long, at string, user_id long")
    events = events.withColumn("ts", F.to_timestamp_ntz("at")).withColumn("event_type", F.lit("view"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    got = catalog.QUERIES["stream_event_timers"](spark, str(tmp_path))
    at = [None if t is None else 1_704_067_200_000 + i * 60_000 for i, t, _ in rows]
    want = [(u, "input", t) for (_, _, u), t in zip(rows, at)]
    want += {(u, "fired", None if t is None else t + 5 * catalog.HOUR) for (_, _, u), t in zip(rows, at)}
    assert rows_of(got) == sorted(want, key=repr)


def test_processing_timers(spark, ordered_stream, tmp_path):
    out = processors.process(
        ordered_stream(one_per_batch(CLICKS[:3]), EVENT),
        ["user"],
        processors.Timers(["user"], 1, event_time=False),
        "user string, kind string, at_ms bigint",
        "ProcessingTime",
    )
    path = str(tmp_path / "clock")
    # Clock timers keep a stream busy for ever: stop it once all have fired.
    running = sinks.start_table(out, path, available_now=False)
    seen = {}
    try:
        for _ in range(60):
            time.sleep(0.5)
            if list((tmp_path / "clock").glob("data/*/_SUCCESS")):
                done = sinks.read_table(out, path)
                seen = {r["kind"]: r["count"] for r in done.groupBy("kind").count().collect()}
            if seen.get("input") == 3 and seen.get("fired", 0) >= 1:
                break
    finally:
        running.stop()
    assert seen["input"] == 3 and seen["fired"] >= 1


def test_periodic_counter(spark, ordered_stream):
    rows = [
        (1, "a", "u", 1000), (2, "a", "u", 5000), (3, "x", "u", 13000), (4, "x", "u", 13001),
        (5, "a", "u", 14000), (6, "x", "u", 26000), (7, "x", "u", 26001),
    ]
    timed = with_event_time(ordered_stream(one_per_batch(rows), EVENT), "1 seconds")
    out = processors.process(
        timed, ["user"], processors.PeriodicCounter("user", 10_000),
        "user string, timer_ms bigint, cnt bigint", "EventTime",
    )
    got = sinks.run_to_table(out, "periodic").where("user = 'a'")
    replay = timers.periodic_counter(spark.createDataFrame(rows, EVENT), "user", ["seq"], 10_000, 1_000)
    assert rows_of(got, "timer_ms", "cnt") == [(11000, 2), (24000, 3)]
    assert rows_of(replay.where("user = 'a'"), "timer_ms", "cnt") == [(11000, 2), (24000, 3)]


def test_time_context(spark, ordered_stream):
    timed = with_event_time(ordered_stream(one_per_batch(CLICKS[:3]), EVENT), "0 seconds")
    out = processors.process(
        timed, ["user"], processors.TimeContext(["user", "seq"]),
        "user string, seq bigint, watermark_ms bigint, processing_ms bigint", "EventTime",
    )
    seen = rows_of(sinks.run_to_table(out, "context"), "seq", "watermark_ms")
    assert seen == [(1, 0), (2, 1000), (3, 2000)]


def test_reconcile_streams(spark, ordered_stream):
    app = [("order-1", 1000), ("order-2", 2000), ("order-3", 3000), ("order-4", 4000)]
    pay = [("order-1", 1000), ("order-2", 7000), ("order-4", 9001)]
    schema = "order_id string, ts_ms bigint"
    end = [("end", FAR)], [("end2", 2 * FAR)]
    a = with_event_time(ordered_stream([app, *end], schema), "2 seconds")
    p = with_event_time(ordered_stream([pay, *end], schema), "2 seconds")
    out = sinks.run_to_table(reconcile.reconcile(a, p, 5_000), "reconciled")
    batch = reconcile.reconcile(
        spark.createDataFrame(app, schema), spark.createDataFrame(pay, schema), 5_000
    )
    got = [r for r in rows_of(out) if not r[0].startswith("end")]
    assert got == rows_of(batch)


def test_union_streams(spark, ordered_stream):
    """Windows close as the slow side moves on, not before; none of its rows is late."""
    fast = with_event_time(ordered_stream([[(1, "a", "u", 1000)], [(2, "a", "u", 50_000)], [(3, "a", "u", 90_000)]], EVENT), "0 seconds")
    slow = with_event_time(ordered_stream([[(4, "b", "u", 2000)], [(5, "b", "u", 9_999)], [(6, "b", "u", 21_000)]], EVENT), "0 seconds")
    counts = windows.window_aggregate(watermarks.union_streams(fast, slow), ["user"], 10_000)
    out = sinks.run_to_table(counts, "slow")
    assert rows_of(out, "user", "window_start_ms", "pv") == [("a", 0, 1), ("b", 0, 2)]


def test_union_keeps_slow_windows_open(spark, ordered_stream):
    fast = with_event_time(ordered_stream([[(1, "a", "u", 1000)], [(2, "a", "u", 50_000)]], EVENT), "0 seconds")
    slow = with_event_time(ordered_stream([[(3, "b", "u", 2000)], [(4, "b", "u", 9_999)]], EVENT), "0 seconds")
    counts = windows.window_aggregate(routing.union_all(fast, slow), ["user"], 10_000)
    assert rows_of(sinks.run_to_table(counts, "slow")) == []


def test_fan_out_reads_once(spark, ordered_stream, tmp_path):
    path = str(tmp_path / "routes")
    alice, bob = F.col("user") == "Alice", F.col("user") == "Bob"
    routes = {"alice": alice, "bob": bob, "others": ~alice & ~bob}
    sinks.fan_out(ordered_stream([CLICKS, [SENTINEL]], EVENT), path, routes).awaitTermination()
    counts = {label: spark.read.parquet(f"{path}/{label}").count() for label in routes}
    assert counts == {"alice": 4, "bob": 2, "others": 1}


LATE_ROWS = [
    (1, "Alice", "./home", 1000), (2, "Alice", "./cart", 9000), (3, "Alice", "./fav", 12000),
    (4, "Alice", "./home", 5000), (5, "Alice", "./home", 22000), (6, "Alice", "./home", 3000),
    (7, "Bob", "./home", 21000), (8, "Bob", "./home", 13000), (9, "Alice", "./home", 45000),
]


@pytest.mark.parametrize("cuts", [[9], [3, 1, 2, 3]])
def test_late_rows_equal_batch(spark, ordered_stream, tmp_path, cuts):
    batches, start = [], 0
    for n in cuts:
        batches.append(LATE_ROWS[start : start + n])
        start += n
    sink = LateCounts(str(tmp_path / "late"), ["user"], ["seq"], 10_000, 2_000, 10_000)
    sink.start(ordered_stream(batches, EVENT)).awaitTermination()
    opened = sink.still_open(spark, len(cuts) - 1)
    got = rows_of(sink.firings(spark).unionByName(opened), "user", "window_start_ms", "firing", "seq", "pv")
    table = spark.createDataFrame(LATE_ROWS, EVENT)
    classified = lateness.classify(table, ["seq"], 10_000, delay_ms=2_000, lateness_ms=10_000)
    batch = lateness.refiring_counts(classified, ["user"], ["seq"], 10_000)
    assert got == rows_of(batch, "user", "window_start_ms", "firing", "seq", "pv")
    side = lateness.side_output(table, ["seq"], 10_000, delay_ms=2_000, lateness_ms=10_000)
    assert rows_of(sink.side(spark), "seq") == rows_of(side, "seq")


class Counter(EventFeed):
    def latest(self):
        return int(self.options["rows"])

    def rows(self, start, stop):
        return iter([(f"user-{i % 2}", "./home", i * 1000) for i in range(start, stop)])


def test_custom_source(spark):
    register_feed(spark, Counter, "counter")
    stream = spark.readStream.format("counter").option("rows", 5).load()
    out = sinks.run_to_table(stream.groupBy("user").count(), "feed", "update", ["user"])
    assert rows_of(out) == [("user-0", 3), ("user-1", 2)]


def test_custom_source_is_read_by_tasks(spark, monkeypatch):
    """Each split is a task of its own, outside the driver, in batches of bounded size."""
    register_feed(spark, Counter, "counter")
    stream = spark.readStream.format("counter").option("rows", 25_001).load()
    path = fresh_path(spark, "feed")
    part = lambda batch: batch.withColumn("part", F.spark_partition_id())
    sinks.start_table(stream, path, transform=part).awaitTermination()
    rows = spark.read.parquet(f"{path}/data")
    assert sorted(r["count"] for r in rows.groupBy("part").count().collect()) == [6250, 6250, 6250, 6251]
    assert rows.select("ts_ms").distinct().count() == 25_001
    feed = Counter({"rows": "25001"})
    assert feed.splits(7, 7) == [] and feed.splits(0, 3) == [(0, 1), (1, 2), (2, 3)]
    arrow = pa.schema([("user", pa.string()), ("url", pa.string()), ("ts_ms", pa.int64())])
    assert [b.num_rows for b in feed.batches((0, 25_001), arrow)] == [10_000, 10_000, 5_001]


def test_files_feed_goes_on(spark, tmp_path):
    """Files added later are read by the next run, those before are not read again."""
    register_feed(spark, FilesFeed, "files")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "seq bigint, user string, ts timestamp"
    seen = []
    for i in range(3):
        made = spark.range(10 * i, 10 * i + 10).selectExpr("id AS seq", "IF(id % 3 = 0, NULL, 'u') AS user", "timestamp_seconds(id) AS ts")
        made.repartition(4).write.parquet(f"{folder}/{i:03d}")
        stream = spark.readStream.format("files").option("path", folder).option("schema", schema).load()
        sinks.start_table(stream, out).awaitTermination()
        seen.append(sinks.read_table(stream, out).count())
    rows = sinks.read_table(stream, out)
    assert seen == [10, 20, 30] and rows_of(rows) == rows_of(spark.read.parquet(f"{folder}/*"), "seq", "user", "ts")
