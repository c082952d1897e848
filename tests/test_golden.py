from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows_of
from tidemark import schemas
from tidemark.functions import text
from tidemark.operators import lateness, parsing, patterns, reconcile, routing, running
from tidemark.operators import tables, timers, topn, watermarks, windows
from tidemark.sources.events import from_elements
from tidemark.sources.text import read_lines

VISITS = [
    ("Alice", "./cart", 1000), ("Candy", "./home", 2000), ("Candy", "./home", 3000),
    ("Bob", "./order?id=18976", 4000), ("Alice", "./cart", 5000), ("Alice", "./cart", 6000),
]
STRICT_LOGINS = [
    ("user-1", "ip-1", "fail", 1000), ("user-1", "ip-1", "fail", 2000), ("user-2", "ip-2", "fail", 3000),
    ("user-2", "ip-3", "fail", 4000), ("user-2", "ip-4", "success", 5000), ("user-1", "ip-5", "fail", 6000),
    ("user-1", "ip-6", "fail", 7000), ("user-1", "ip-7", "fail", 8000),
]
TIMES_LOGINS = [("user-1", "ip-1", "success", 2000) if r[3] == 2000 else r for r in STRICT_LOGINS]
LATE_LINES = [
    "Alice,./home,1000", "Alice,./cart,9000", "Alice,./fav,12000",
    "Alice,./home,5000", "Alice,./home,22000", "Alice,./home,3000",
]


def failed():
    return F.col("event_type") == "fail"


def visits(spark, rows=VISITS):
    return from_elements(spark, rows, schemas.EVENT)


def test_word_count(spark, tmp_path):
    (tmp_path / "words.txt").write_text("hello world\nhello spark\nhello kafka\nhello hadoop\n")
    counts = parsing.word_count(read_lines(spark, str(tmp_path / "words.txt")))
    assert rows_of(counts) == [("hadoop", 1), ("hello", 4), ("kafka", 1), ("spark", 1), ("world", 1)]


def test_running_word_count(spark):
    words = "hello world hello spark hello kafka hello hadoop".split()
    df = spark.createDataFrame(list(enumerate(words)), "seq bigint, word string")
    out = running.running_count(df, ["word"], ["seq"])
    assert rows_of(out, "word", "cnt") == sorted(
        [("hello", 1), ("world", 1), ("hello", 2), ("spark", 1), ("hello", 3), ("kafka", 1), ("hello", 4), ("hadoop", 1)]
    )


def test_split_keeps_inner_and_drops_trailing_empty_words(spark):
    lines = [("a  b",), ("a ",), ("",), (" ",), (" a",)]
    df = spark.createDataFrame(lines, "value string").select(text.words(F.col("value")).alias("w"))
    assert [r["w"] for r in df.collect()] == [["a", "", "b"], ["a"], [""], [], ["", "a"]]


def test_running_leader(spark):
    out = running.running_leader(visits(spark), "user", "seq")
    assert rows_of(out) == [
        (1, "Alice", 1), (2, "Candy", 1), (3, "Candy", 2), (4, "Candy", 2), (5, "Alice", 2), (6, "Alice", 3),
    ]
    assert rows_of(running.most_active(visits(spark), "user", "seq")) == [("Alice", 3)]
    assert rows_of(running.most_active(visits(spark, VISITS[:5]), "user", "seq")) == [("Alice", 2)]


def test_rich_map(spark):
    expected = [("Alice[./cart]",), ("Candy[./home]",), ("Candy[./home]",)]
    df = visits(spark, VISITS[:3])
    assert rows_of(df.select(parsing.user_and_url(F.col("user"), F.col("url")))) == expected
    mapped = parsing.map_with_lifecycle(
        df, "visit string", lambda r, b: (b["user"] + r[0] + b["url"] + r[1]).to_frame("visit"),
        open=lambda partition: "[]",
    )
    assert rows_of(mapped) == expected


def test_placement(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(1, 11), -1]], "id int")
    parity = F.pmod("id", F.lit(2))
    where = lambda df: {
        r["p"]: sorted(r["ids"])
        for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.collect_list("id").alias("ids")).collect()
    }
    placed = where(routing.place(ids, parity, 2))
    assert placed == {0: [2, 4, 6, 8, 10], 1: [-1, 1, 3, 5, 7, 9]}
    spread = where(routing.place(ids, parity, 2, 3, ["id"]))
    assert all(i % 2 == p % 2 for p, ids_ in spread.items() for i in ids_)


def test_connect(spark):
    one = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    two = spark.createDataFrame([("one",), ("two",), ("three",)], "v string")
    out = routing.connect({"DS1": (one, {"value": F.col("v").cast("string")}), "DS2": (two, {"value": F.col("v")})})
    assert rows_of(out) == sorted([("DS1", "1"), ("DS1", "2"), ("DS1", "3"), ("DS2", "one"), ("DS2", "two"), ("DS2", "three")])


def test_split_and_route(spark):
    df = visits(spark)
    routed = routing.with_route(df, {"a": F.col("user") == "Alice", "b": F.col("user") == "Bob"})
    assert rows_of(routing.take_route(routed, "a"), "seq") == [(1,), (5,), (6,)]
    assert rows_of(routing.take_route(routed, "main"), "user") == [("Candy",), ("Candy",)]
    parts = routing.split_by(df, {"bob": F.col("user") == "Bob"})
    assert rows_of(parts["bob"], "seq") == [(4,)]


def test_reconcile(spark):
    app = from_elements(spark, [(f"order-{i}", "app", i * 1000) for i in (1, 2, 3, 5, 6)], schemas.APP_ORDER)
    paid = [(1, 1000), (2, 2000), (4, 100), (5, 11_000), (6, 11_000)]
    pay = from_elements(spark, [(f"order-{i}", "third-party", "success", t) for i, t in paid], schemas.PAYMENT)
    out = reconcile.reconcile(app, pay)
    ok, no_pay, no_app = reconcile.SUCCESS, reconcile.NO_PAYMENT, reconcile.NO_ORDER
    assert rows_of(out, "order_id", "status") == sorted(
        [("order-1", ok), ("order-2", ok), ("order-3", no_pay), ("order-4", no_app),
         ("order-5", no_pay), ("order-5", no_app), ("order-6", ok)]
    )
    twice = app.unionByName(app.withColumn("ts_ms", F.col("ts_ms") + 1))
    kept = reconcile.latest_per_key(twice, "order_id")
    assert rows_of(kept, "order_id", "ts_ms")[:2] == [("order-1", 1001), ("order-2", 2001)]


def test_patterns(spark):
    strict = lambda rows: rows_of(
        patterns.strict_sequence(
            from_elements(spark, rows, schemas.LOGIN_EVENT), "user_id", [failed()] * 3, ["ts_ms", "seq"]
        ), "user_id", "ts_1", "ts_2", "ts_3")
    assert strict(STRICT_LOGINS) == [
        ("user-1", 1000, 2000, 6000), ("user-1", 2000, 6000, 7000), ("user-1", 6000, 7000, 8000),
    ]
    assert strict(TIMES_LOGINS) == [("user-1", 6000, 7000, 8000)]
    relaxed = patterns.relaxed_times(
        from_elements(spark, TIMES_LOGINS, schemas.LOGIN_EVENT), "user_id", failed(), 3, ["ts_ms", "seq"]
    )
    assert rows_of(relaxed, "user_id", "ts_1", "ts_2", "ts_3") == [
        ("user-1", 1000, 6000, 7000), ("user-1", 6000, 7000, 8000),
    ]
    matched = relaxed.select(
        patterns.match_map({"first": F.struct("ts_1"), "last": F.struct(F.col("ts_3").alias("ts_1"))}).alias("m"),
        patterns.alert_text(F.col("user_id"), [F.col("ts_1"), F.col("ts_2"), F.col("ts_3")]).alias("text"),
    ).orderBy("text").first()
    assert matched["m"]["last"][0]["ts_1"] == 7000
    assert matched["text"] == "user-1 failed at 1000 6000 7000"


def late_clicks(spark):
    lines = spark.createDataFrame(list(enumerate(LATE_LINES, start=1)), "seq bigint, value string")
    return parsing.parse_clicks(lines, keep=("seq",))


def test_watermark_seen(spark):
    seen = watermarks.with_watermark_seen(late_clicks(spark), ["seq"], 2_000)
    assert rows_of(seen, "seq", "watermark_ms") == [
        (1, None), (2, -1001), (3, 6999), (4, 9999), (5, 9999), (6, 19999),
    ]


def test_late_rows(spark):
    late = {"delay_ms": 2_000, "lateness_ms": 10_000}
    df = late_clicks(spark)
    classified = lateness.classify(df, ["seq"], 10_000, **late)
    out = lateness.refiring_counts(classified, ["user"], ["seq"], 10_000)
    assert rows_of(out, "window_start_ms", "firing", "seq", "pv") == sorted(
        [(0, "first", None, 2), (0, "refire", 4, 3), (10_000, "first", None, 1), (20_000, "first", None, 1)], key=repr
    )
    assert rows_of(lateness.side_output(df, ["seq"], 10_000, **late), "seq") == [(6,)]


def test_late_rows_of_sliding_windows(spark):
    df = late_clicks(spark)
    out = lateness.classify(df, ["seq"], 10_000, 5_000, delay_ms=2_000, lateness_ms=3_000)
    assert rows_of(out.where("seq = 4"), "window_start_ms", "lateness") == [(0, "late"), (5000, "on_time")]
    side = lateness.side_output(df, ["seq"], 10_000, 5_000, delay_ms=2_000, lateness_ms=3_000)
    assert rows_of(side, "seq") == [(6,)]


def test_bad_lines(spark):
    lines = spark.createDataFrame([("a,./home,12",), ("a,./home,x",), ("a",)], "value string")
    out = parsing.parse_clicks(lines, strict=False)
    assert rows_of(out, "bad", "ts_ms") == [(False, 12), (True, None), (True, None)]


def test_top_n_with_padding(spark):
    counts = spark.createDataFrame(
        [("./home", 3, 0, 10_000), ("./fav", 2, 0, 10_000), ("./cart", 2, 0, 10_000), ("./home", 1, 5_000, 15_000)],
        schemas.URL_VIEW_COUNT,
    )
    out = topn.pad_ranks(topn.top_n(counts, 2), 2)
    assert rows_of(out, "window_end_ms", "rank", "url", "pv") == [
        (10_000, 1, "./home", 3), (10_000, 2, "./cart", 2), (15_000, 1, "./home", 1), (15_000, 2, "无", 0),
    ]


def test_sliding_window_that_does_not_divide(spark):
    out = windows.window_aggregate(visits(spark), [], 5_000, 2_000)
    builtin = (
        visits(spark).withColumn("ts", F.timestamp_millis("ts_ms"))
        .groupBy(F.window("ts", "5 seconds", "2 seconds").alias("w")).count()
        .select(F.unix_millis("w.start"), F.unix_millis("w.end"), "count")
    )
    assert rows_of(out) == rows_of(builtin)


def test_window_measures(spark):
    out = windows.window_aggregate(
        visits(spark), ["user"], 4_000, 2_000,
        {"pv": ("count", "*"), "first": ("min", "ts_ms"), "last": ("max", "ts_ms"), "total": ("sum", "seq")},
    )
    assert ("Alice", 4000, 8000, 2, 5000, 6000, 11) in rows_of(out)


def test_changelog_skips_unchanged_counts(spark):
    rows = [(1, "a", "x"), (2, "a", None), (3, "a", "y"), (4, "b", None)]
    df = spark.createDataFrame(rows, "seq bigint, user string, url string")
    assert rows_of(running.changelog_count(df, "user", "url", ["seq"]), "seq", "row_kind", "cnt") == [
        (1, "+I", 1), (3, "+U", 2), (3, "-U", 1), (4, "+I", 0),
    ]


def test_timers(spark):
    out = timers.event_timers(visits(spark), ["seq"], 2_000)
    assert rows_of(out, "timer_ms", "fired_by_seq", "watermark_ms") == sorted(
        [(3000, 4, 3999), (4000, 5, 4999), (5000, 6, 5999), (6000, None, None), (7000, None, None), (8000, None, None)], key=repr
    )
    assert rows_of(timers.processing_timers(visits(spark), "ts_ms", 5, ["user"]).where("user = 'Bob'")) == [("Bob", 4005)]


def test_tables(spark):
    view = tables.create_view(visits(spark), "visits_view", ["url", "user"])
    assert view.columns == ["url", "user"]
    named = tables.sql(spark, "SELECT `user`, count(url) AS n FROM visits_view GROUP BY `user`")
    inline = tables.sql(spark, "SELECT `user`, count(url) AS n FROM {t} GROUP BY `user`", t=view)
    assert rows_of(named) == rows_of(inline) == [("Alice", 3), ("Bob", 1), ("Candy", 2)]
    assert rows_of(tables.select_where(visits(spark), ["user", "url"], F.col("user") == "Bob")) == [("Bob", "./order?id=18976")]


def test_rendering(spark):
    one = visits(spark, [("Bob", "./home", 1_650_000_000_050)])
    shown = one.select(
        text.render_event(F.col("user"), F.col("url"), F.col("ts_ms")),
        text.render_url_view_count(F.col("url"), F.col("seq"), F.col("ts_ms"), F.col("ts_ms") + 950),
        text.render_login(F.col("user"), F.lit("ip-1"), F.lit("fail"), F.col("ts_ms")),
    ).first()
    assert tuple(shown) == (
        "Event{user='Bob', url='./home', timestamp=2022-04-15 05:20:00.05}",
        "UrlViewCount{url='./home', count=1, start=2022-04-15 05:20:00.05, end=2022-04-15 05:20:01.0}",
        "LoginEventBean{userId='Bob', ipAddress='ip-1', eventType='fail', timestamp=1650000000050}",
    )


def test_schema_of_literal_rows(spark):
    assert visits(spark).schema["ts_ms"].dataType == T.LongType()
