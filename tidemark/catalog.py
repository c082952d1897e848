"""The registered queries over the given tables.

The tables hold about one event per five minutes, so one second of the original
jobs is read as one hour: windows of 10 h, slides of 2 h and 5 h, delays of 1 h
and 2 h, timers of 5 h and 10 h. ``user`` is the user, ``url`` the event type and
``seq`` the event id. Event ids follow event time, so late rows come from a
permuted arrival column ``arr``.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import render_event, words
from tidemark.functions.time import epoch_ms
from tidemark.operators import accumulators, lateness, parsing, patterns, reconcile, routing, running
from tidemark.operators import tables, timers, topn, watermarks, windows
from tidemark.session import cut_lineage, fresh_path
from tidemark.sources.custom import FilesFeed, register_feed
from tidemark.sources.events import clicks, staged_stream, stream_clicks, stream_table, table, with_event_time
from tidemark.sources.text import lines_of
from tidemark.streaming import inputs, processors, sinks
from tidemark.streaming.late import LateCounts
from tidemark.streaming.late_windows import LateWindows
from tidemark.streaming.patterns import PatternMatches
from tidemark.streaming.running import RunningCounts

#: The user of rows that only end a stream.
END_USER = -1
HOUR = 3_600_000
DAY = 24 * HOUR
ARRIVAL = ("arr", "seq")
LATE = {"size_ms": 10 * HOUR, "delay_ms": 2 * HOUR, "lateness_ms": 10 * HOUR}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

CLICKS = """clicks AS (
  SELECT event_id AS seq, user_id AS "user", event_type AS url, epoch_us(ts) // 1000 AS ts_ms
  FROM events)"""
ARRIVALS = CLICKS + """, arrivals AS (
  SELECT *, ts_ms + (seq * 7919 % 97) * 900000 AS arr FROM clicks)"""


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle:
            ORACLES[run.__name__] = oracle
        return run

    return register


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks with a permuted arrival time."""
    shift = F.pmod(F.col("seq") * 7919, F.lit(97)) * F.lit(900_000)
    return clicks(spark, folder).withColumn("arr", F.col("ts_ms") + shift)


def document_words(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, pos, word``: the words of all lines of each document, in order."""
    lines = F.transform(F.split("text", "\n"), words)
    return table(spark, folder, "documents").select(
        "doc_id", F.posexplode(F.flatten(lines)).alias("pos", "word")
    ).withColumn("pos", F.col("pos").cast("bigint"))


# --- words ---------------------------------------------------------------------

WORDS = """word_lists AS (
  SELECT doc_id, flatten(list_transform(string_split(text, chr(10)), lambda l:
    CASE WHEN l <> '' AND rtrim(l, ' ') = '' THEN [] ELSE string_split(rtrim(l, ' '), ' ') END)) AS ws
  FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM word_lists)"""


@query(f"WITH {WORDS} SELECT word, count(*)::BIGINT AS cnt FROM words GROUP BY word")
def word_count(spark, folder):
    return parsing.word_count(lines_of(table(spark, folder, "documents"), "text"))


@query(f"""WITH {WORDS}
SELECT doc_id, pos::BIGINT AS pos, word,
  count(*) OVER (PARTITION BY word ORDER BY doc_id, pos)::BIGINT AS cnt FROM words""")
def running_word_count(spark, folder):
    words = cut_lineage(document_words(spark, folder))  # read four times, tokenised once
    return running.running_count(words, ["word"], ["doc_id", "pos"])


# --- rows ----------------------------------------------------------------------


@query(f"""WITH {CLICKS} SELECT seq, CAST("user" AS VARCHAR) AS "user", url, ts_ms FROM clicks""")
def parse_csv_events(spark, folder):
    lines = clicks(spark, folder).select(
        "seq", F.concat_ws(",", F.col("user").cast("string"), "url", F.col("ts_ms").cast("string")).alias("value")
    )
    return parsing.parse_clicks(lines, keep=("seq",))


@query(f"""WITH {CLICKS}
SELECT seq, "user" || ',' || url || ',' || ts_ms AS line, ts_ms FROM clicks""")
def line_event_time(spark, folder):
    line = F.concat_ws(",", F.col("user").cast("string"), "url", F.col("ts_ms").cast("string"))
    lines = clicks(spark, folder).select("seq", line.alias("line"))
    return lines.withColumn("ts_ms", parsing.event_time_of_line(F.col("line")))


RICH_MAP = f"""WITH {CLICKS} SELECT seq, "user" || '[' || url || ']' AS visit FROM clicks"""


@query(RICH_MAP)
def rich_map(spark, folder):
    visit = parsing.user_and_url(F.col("user"), F.col("url"))
    return clicks(spark, folder).select("seq", visit.alias("visit"))


@query(RICH_MAP)
def rich_map_lifecycle(spark, folder):
    def visit(brackets: tuple[str, str], rows: pd.DataFrame) -> pd.DataFrame:
        text = rows["user"].astype(str) + brackets[0] + rows["url"] + brackets[1]
        return pd.DataFrame({"seq": rows["seq"], "visit": text})

    picked = clicks(spark, folder).select("seq", "user", "url")
    return parsing.map_with_lifecycle(
        picked, "seq bigint, visit string", visit, open=lambda partition: ("[", "]")
    )


@query(f"""WITH {CLICKS}
SELECT seq, 'Event{{user=''' || "user" || ''', url=''' || url || ''', timestamp=' ||
  strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') || '.' ||
  regexp_replace(lpad(CAST(ts_ms % 1000 AS VARCHAR), 3, '0'), '0{{1,2}}$', '') || '}}' AS line
FROM clicks""")
def render_events(spark, folder):
    line = render_event(F.col("user").cast("string"), F.col("url"), F.col("ts_ms"))
    return clicks(spark, folder).select("seq", line.alias("line"))


@query(f"""WITH {CLICKS} SELECT seq % 2 AS class, count(*)::BIGINT AS n FROM clicks GROUP BY 1""")
def custom_partition(spark, folder):
    splits = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    placed = routing.place(
        clicks(spark, folder).select("seq"), F.pmod("seq", F.lit(2)), 2, splits, ["seq"]
    )
    kept = F.pmod(F.spark_partition_id(), F.lit(2)).cast("bigint")
    return placed.select(kept.alias("class")).groupBy("class").agg(F.count("*").alias("n"))


# --- split and merge -----------------------------------------------------------


@query(f"""WITH {CLICKS}
SELECT 'click' AS part, * FROM clicks WHERE url = 'click'
UNION ALL SELECT 'view', * FROM clicks WHERE url = 'view'
UNION ALL SELECT 'others', * FROM clicks WHERE NOT (url = 'click' OR url = 'view')""")
def split_filter(spark, folder):
    is_click, is_view = F.col("url") == "click", F.col("url") == "view"
    parts = routing.split_by(
        clicks(spark, folder),
        {"click": is_click, "view": is_view, "others": ~is_click & ~is_view},
    )
    return routing.union_all(*[df.select(F.lit(n).alias("part"), "*") for n, df in parts.items()])


@query(f"""WITH {CLICKS}
SELECT *, CASE WHEN url = 'purchase' THEN 'orders' WHEN url = 'error' THEN 'errors'
  ELSE 'main' END AS route FROM clicks""")
def split_route(spark, folder):
    return routing.with_route(
        clicks(spark, folder),
        {"orders": F.col("url") == "purchase", "errors": F.col("url") == "error"},
    )


@query(f"""WITH {CLICKS}
SELECT "user", url, ts_ms FROM clicks
UNION ALL SELECT o_custkey, o_orderstatus, epoch_us(o_orderdate) // 1000 FROM orders""")
def union_all(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user"),
        F.col("o_orderstatus").alias("url"),
        epoch_ms(F.col("o_orderdate")).alias("ts_ms"),
    )
    return routing.union_all(clicks(spark, folder).select("user", "url", "ts_ms"), orders)


@query("""SELECT 'DS1' AS src, CAST(l_linenumber AS VARCHAR) AS value FROM lineitem
UNION ALL SELECT 'DS2', event_type FROM events""")
def connect_tagged(spark, folder):
    return routing.connect(
        {
            "DS1": (table(spark, folder, "lineitem"), {"value": F.col("l_linenumber").cast("string")}),
            "DS2": (table(spark, folder, "events"), {"value": F.col("event_type")}),
        }
    )


# --- running results -----------------------------------------------------------


@query(f"""WITH {CLICKS}
SELECT seq, "user", count(*) OVER (PARTITION BY "user" ORDER BY ts_ms, seq)::BIGINT AS cnt FROM clicks""")
def running_count(spark, folder):
    rows = clicks(spark, folder).select("seq", "user", "ts_ms")
    return running.running_count(rows, ["user"], ["ts_ms", "seq"]).drop("ts_ms")


@query(f"""WITH {CLICKS}
SELECT "user", cnt FROM (SELECT "user", count(*)::BIGINT AS cnt, max(seq) AS last_seq FROM clicks GROUP BY 1)
ORDER BY cnt DESC, last_seq DESC LIMIT 1""")
def most_active_user(spark, folder):
    return running.most_active(clicks(spark, folder), "user", "seq")


@query(f"""WITH {CLICKS}, counted AS (
  SELECT seq, "user", count(*) OVER (PARTITION BY "user" ORDER BY seq) AS cnt FROM clicks),
led AS (SELECT seq, max({{'cnt': cnt, 'seq': seq, 'who': "user"}}) OVER (ORDER BY seq) AS top FROM counted)
SELECT seq, top.who AS "user", top.cnt::BIGINT AS cnt FROM led""")
def running_leader(spark, folder):
    return running.running_leader(clicks(spark, folder), "user", "seq")


@query(f"""WITH {CLICKS}, counted AS (
  SELECT seq, ts_ms, "user", count(*) OVER (PARTITION BY "user" ORDER BY ts_ms, seq) AS n FROM clicks)
SELECT ts_ms, seq, "user", '+I' AS row_kind, n::BIGINT AS cnt FROM counted WHERE n = 1
UNION ALL SELECT ts_ms, seq, "user", '-U', n - 1 FROM counted WHERE n > 1
UNION ALL SELECT ts_ms, seq, "user", '+U', n FROM counted WHERE n > 1""")
def changelog_count(spark, folder):
    return running.changelog_count(clicks(spark, folder), "user", "url", ["ts_ms", "seq"])


@query(f"""WITH {CLICKS}, spaced AS (
  SELECT *, coalesce(ts_ms - lag(ts_ms) OVER (PARTITION BY "user" ORDER BY ts_ms, seq), 0) AS gap FROM clicks)
SELECT "user", ts_ms, seq, first_value(ts_ms) OVER w AS first_ms, ts_ms AS last_ms, max(gap) OVER w AS longest
FROM spaced WINDOW w AS (PARTITION BY "user" ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_reduce(spark, folder):
    def spell(a: dict, b: dict) -> dict:
        longest = max(a["longest"], b["longest"], b["first_ms"] - a["last_ms"])
        return {"first_ms": a["first_ms"], "last_ms": b["last_ms"], "longest": longest}

    at = F.col("ts_ms")
    rows = clicks(spark, folder).select(
        "user", "seq", "ts_ms", at.alias("first_ms"), at.alias("last_ms"), F.lit(0).cast("bigint").alias("longest")
    )
    return running.running_reduce(
        rows, ["user"], ["ts_ms", "seq"], spell, "first_ms bigint, last_ms bigint, longest bigint"
    )


@query(f"""WITH {CLICKS}, grouped AS (
  SELECT "user", ts_ms, (row_number() OVER (PARTITION BY "user" ORDER BY ts_ms, seq) - 1) // 5 AS group_no
  FROM clicks)
SELECT "user", group_no, avg(ts_ms) AS avg_value FROM grouped GROUP BY 1, 2 HAVING count(*) = 5""")
def avg_ts_every5(spark, folder):
    rows = clicks(spark, folder).select("seq", "user", "ts_ms")
    return running.average_of_every(rows, "user", "ts_ms", ["ts_ms", "seq"])


# --- windows and top-N ---------------------------------------------------------


def _windowed(size: int, slide: int) -> str:
    """SQL for one row per click and window of ``size``/``slide`` hours."""
    return f"""{CLICKS}, windowed AS (
  SELECT clicks.*, (ts_ms // {slide * HOUR} - k) * {slide * HOUR} AS window_start_ms,
    (ts_ms // {slide * HOUR} - k) * {slide * HOUR} + {size * HOUR} AS window_end_ms
  FROM clicks, range({size // slide}) AS r(k))"""


@query(f"""WITH {_windowed(10, 10)}
SELECT "user", window_start_ms, window_end_ms, count(*)::BIGINT AS pv FROM windowed GROUP BY ALL""")
def pv_per_user_tumble(spark, folder):
    return windows.window_aggregate(clicks(spark, folder), ["user"], 10 * HOUR)


@query(f"""WITH {_windowed(10, 2)}
SELECT "user", window_start_ms, window_end_ms, count(*)::BIGINT AS pv FROM windowed GROUP BY ALL""")
def pv_per_user_slide(spark, folder):
    return windows.window_aggregate(clicks(spark, folder), ["user"], 10 * HOUR, 2 * HOUR)


@query(f"""WITH {_windowed(10, 10)}
SELECT url, window_start_ms, window_end_ms, count(*)::BIGINT AS pv FROM windowed GROUP BY ALL""")
def pv_per_url_tumble(spark, folder):
    return windows.window_aggregate(clicks(spark, folder), ["url"], 10 * HOUR)


@query(f"""WITH {_windowed(10, 10)}
SELECT window_start_ms, window_end_ms, count(*)::BIGINT AS pv, count(DISTINCT "user")::BIGINT AS uv
FROM windowed GROUP BY ALL""")
def pv_uv_tumble(spark, folder):
    return windows.page_and_visitor_counts(clicks(spark, folder), "user", 10 * HOUR)


@query(f"""WITH {_windowed(10, 10)}
SELECT window_start_ms, window_end_ms, count(DISTINCT "user")::BIGINT AS uv FROM windowed GROUP BY ALL""")
def uv_tumble(spark, folder):
    return windows.unique_visitors(clicks(spark, folder), "user", 10 * HOUR)


RANKED = f"""{_windowed(10, 5)}, counts AS (
  SELECT url, window_start_ms, window_end_ms, count(*)::BIGINT AS pv FROM windowed GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY window_end_ms ORDER BY pv DESC, url) AS rank FROM counts)"""


@query(f"""WITH {RANKED}
SELECT window_start_ms, window_end_ms, rank::BIGINT AS rank, url, pv FROM ranked WHERE rank <= 2""")
def topn_slide(spark, folder):
    return topn.top_urls(clicks(spark, folder), 10 * HOUR, 5 * HOUR, 2)


@query(f"""WITH {RANKED}, slots AS (
  SELECT DISTINCT window_start_ms, window_end_ms, k AS rank FROM counts, range(1, 8) AS r(k))
SELECT window_start_ms, window_end_ms, rank::BIGINT AS rank,
  coalesce(url, '无') AS url, coalesce(pv, 0)::BIGINT AS pv
FROM slots LEFT JOIN ranked USING (window_start_ms, window_end_ms, rank)""")
def topn_padded(spark, folder):
    top = topn.top_urls(clicks(spark, folder), 10 * HOUR, 5 * HOUR, 7)
    return topn.pad_ranks(top, 7)


# --- event time ----------------------------------------------------------------

SEEN = f"""{ARRIVALS}, seen AS (
  SELECT *, max(ts_ms) OVER (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - {2 * HOUR} - 1 AS watermark_ms FROM arrivals)"""


@query(f"""WITH {SEEN}
SELECT seq, ts_ms, watermark_ms, CASE WHEN "user" = 7
  THEN 'watermark=' || coalesce(CAST(watermark_ms AS VARCHAR), 'none') || ', timestamp=' || ts_ms
  ELSE 'watermark=' || coalesce(CAST(watermark_ms AS VARCHAR), 'none') END AS note FROM seen""")
def watermark_annotate(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "user", "ts_ms")
    seen = watermarks.with_watermark_seen(rows, ARRIVAL, 2 * HOUR)
    note = watermarks.time_note(F.col("user"), F.lit(7), F.col("watermark_ms"), F.col("ts_ms"))
    return seen.select("seq", "ts_ms", "watermark_ms", note.alias("note"))


@query(f"""WITH {ARRIVALS}, marks AS (
  SELECT *,
    max(ts_ms) FILTER (url IN ('click', 'view')) OVER w AS a,
    max(ts_ms) FILTER (url NOT IN ('click', 'view')) OVER w AS b
  FROM arrivals WINDOW w AS (ORDER BY arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT seq, ts_ms, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN least(a, b) - 1 END AS watermark_ms
FROM marks""")
def union_watermark(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "url", "ts_ms")
    is_visit = F.col("url").isin("click", "view")
    visits = rows.where(is_visit).withColumn("src", F.lit("visits"))
    others = rows.where(~is_visit).withColumn("src", F.lit("others"))
    both = routing.union_all(visits, others).drop("url")
    marked = watermarks.with_union_watermark_seen(both, ARRIVAL, "src", ["visits", "others"])
    return marked.select("seq", "ts_ms", "watermark_ms")


CLASSIFIED = f"""{SEEN}, classified AS (
  SELECT *, ts_ms // {10 * HOUR} * {10 * HOUR} AS window_start_ms,
    CASE WHEN watermark_ms IS NULL OR watermark_ms < ts_ms // {10 * HOUR} * {10 * HOUR} + {10 * HOUR} - 1 THEN 'on_time'
         WHEN watermark_ms < ts_ms // {10 * HOUR} * {10 * HOUR} + {20 * HOUR} - 1 THEN 'late'
         ELSE 'dropped' END AS lateness FROM seen)"""


@query(f"""WITH {CLASSIFIED} SELECT arr, seq, "user", window_start_ms, lateness FROM classified""")
def late_classify(spark, folder):
    rows = arrivals(spark, folder)
    return lateness.classify(rows, ARRIVAL, **LATE).select(
        "arr", "seq", "user", "window_start_ms", "lateness"
    )


@query(f"""WITH {CLASSIFIED} SELECT seq, "user", url, ts_ms FROM classified WHERE lateness = 'dropped'""")
def late_side_output(spark, folder):
    rows = arrivals(spark, folder)
    return lateness.side_output(rows, ARRIVAL, **LATE).select("seq", "user", "url", "ts_ms")


@query(f"""WITH {CLASSIFIED}, first AS (
  SELECT "user", window_start_ms, count(*) AS pv FROM classified WHERE lateness = 'on_time' GROUP BY 1, 2),
refire AS (
  SELECT c."user", c.window_start_ms, c.arr, c.seq, coalesce(f.pv, 0) + count(*) OVER (
    PARTITION BY c."user", c.window_start_ms ORDER BY c.arr, c.seq) AS pv
  FROM classified c LEFT JOIN first f USING ("user", window_start_ms) WHERE lateness = 'late')
SELECT "user", window_start_ms, window_start_ms + {10 * HOUR} AS window_end_ms,
  'first' AS firing, NULL::BIGINT AS arr, NULL::BIGINT AS seq, pv::BIGINT AS pv FROM first
UNION ALL SELECT "user", window_start_ms, window_start_ms + {10 * HOUR}, 'refire', arr, seq, pv::BIGINT FROM refire""")
def late_refire(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "user", "ts_ms")
    classified = lateness.classify(rows, ARRIVAL, **LATE)
    return lateness.refiring_counts(classified, ["user"], ARRIVAL, 10 * HOUR)


class OffsetAndVisitors(accumulators.Accumulator):
    """Mean time into the window, and distinct users."""

    schema = "mean_offset double, uv bigint"

    def __init__(self, size_ms: int):
        self.size_ms = size_ms

    def create(self) -> tuple[int, int, set]:
        return 0, 0, set()

    def add(self, held: tuple[int, int, set], rows: pa.RecordBatch) -> tuple[int, int, set]:
        held[2].update(rows.column("user").to_pylist())
        offsets = [ts % self.size_ms for ts in rows.column("ts_ms").to_pylist()]
        return held[0] + len(offsets), held[1] + sum(offsets), held[2]

    def merge(self, held: tuple[int, int, set], other: tuple[int, int, set]) -> tuple[int, int, set]:
        return held[0] + other[0], held[1] + other[1], held[2] | other[2]

    def finish(self, held: tuple[int, int, set]) -> tuple[float, int]:
        return held[1] / held[0], len(held[2])


@query(f"""WITH {CLASSIFIED}, kept AS (
  SELECT *, ts_ms - window_start_ms AS away, lateness = 'late' AS late FROM classified WHERE lateness <> 'dropped'),
run AS (
  SELECT *, avg(away) OVER w AS mean_offset, count(DISTINCT "user") OVER w AS uv FROM kept WINDOW w AS (
    PARTITION BY url, window_start_ms ORDER BY late, arr, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT url, window_start_ms, window_start_ms + {10 * HOUR} AS window_end_ms, 'first' AS firing,
  NULL::BIGINT AS arr, NULL::BIGINT AS seq, avg(away) AS mean_offset, count(DISTINCT "user")::BIGINT AS uv
FROM kept WHERE NOT late GROUP BY 1, 2
UNION ALL SELECT url, window_start_ms, window_start_ms + {10 * HOUR}, 'refire', arr, seq, mean_offset, uv::BIGINT
FROM run WHERE late""")
def late_refire_any(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "user", "url", "ts_ms")
    classified = lateness.classify(rows, ARRIVAL, **LATE)
    return lateness.refirings(classified, ["url"], ARRIVAL, 10 * HOUR, OffsetAndVisitors(10 * HOUR))


# --- timers --------------------------------------------------------------------


def _fired(after: int, delay: int) -> str:
    return f"""{ARRIVALS}, maxima AS (
  SELECT *, max(ts_ms) OVER (ORDER BY arr, seq) AS upto,
    row_number() OVER (ORDER BY arr, seq) AS pos FROM arrivals),
armed AS (
  SELECT *, ts_ms + {after * HOUR} AS timer_ms,
    greatest(ts_ms + {(after + delay) * HOUR}, upto) + 1 AS passes FROM maxima),
risen AS (SELECT upto, min(pos) AS pos FROM maxima GROUP BY upto),
steps AS (
  SELECT risen.upto AS reach, risen.pos AS fire_pos, m.arr AS fire_arr, m.seq AS fire_seq
  FROM risen JOIN maxima m ON m.pos = risen.pos)"""


@query(f"""WITH {_fired(5, 0)}
SELECT DISTINCT timer_ms, fire_arr AS fired_by_arr, fire_seq AS fired_by_seq, reach - 1 AS watermark_ms
FROM armed ASOF LEFT JOIN steps ON armed.passes <= steps.reach""")
def event_timers(spark, folder):
    return timers.event_timers(arrivals(spark, folder), ARRIVAL, 5 * HOUR)


@query(f"""WITH {ARRIVALS} SELECT DISTINCT "user", arr + {10 * HOUR} AS timer_ms FROM arrivals""")
def processing_timers(spark, folder):
    return timers.processing_timers(arrivals(spark, folder), "arr", 10 * HOUR, ["user"])


@query(f"""WITH RECURSIVE {_fired(10, 1)},
fires AS (
  SELECT armed.*, coalesce(fire_pos, 9223372036854775807) AS fire_pos,
    row_number() OVER (PARTITION BY "user" ORDER BY pos) AS n
  FROM armed ASOF LEFT JOIN steps ON armed.passes <= steps.reach),
ahead AS (
  SELECT f."user", f.n, f.timer_ms, coalesce(min(g.n), max(t.total) + 1) AS next_n
  FROM fires f
  JOIN (SELECT "user", count(*) AS total FROM fires GROUP BY 1) t ON t."user" = f."user"
  LEFT JOIN fires g ON g."user" = f."user" AND g.pos > f.fire_pos
  GROUP BY f."user", f.n, f.timer_ms),
walk AS (
  SELECT "user", n, timer_ms, next_n FROM ahead WHERE n = 1
  UNION ALL
  SELECT a."user", a.n, a.timer_ms, a.next_n FROM walk w JOIN ahead a ON a."user" = w."user" AND a.n = w.next_n)
SELECT "user", timer_ms, (next_n - 1)::BIGINT AS cnt FROM walk""")
def periodic_counter(spark, folder):
    rows = arrivals(spark, folder)
    return timers.periodic_counter(rows, "user", ARRIVAL, 10 * HOUR, 1 * HOUR)


# --- joins and patterns --------------------------------------------------------


def orders_and_shipments(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders as the app's side, the last shipment of an order as the other side."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), epoch_ms(F.col("o_orderdate")).alias("ts_ms")
    )
    shipments = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), epoch_ms(F.col("l_shipdate")).alias("ts_ms")
    )
    return orders, reconcile.latest_per_key(shipments, "order_id")


@query(f"""WITH app AS (SELECT o_orderkey AS order_id, epoch_us(o_orderdate) // 1000 AS ts_ms FROM orders),
payment AS (
  SELECT l_orderkey AS order_id, max(epoch_us(l_shipdate) // 1000) AS ts_ms FROM lineitem GROUP BY 1)
SELECT coalesce(app.order_id, payment.order_id) AS order_id, app.ts_ms AS app_ts_ms,
  payment.ts_ms AS payment_ts_ms, CASE WHEN payment.order_id IS NULL THEN 'failed: no payment'
    WHEN app.order_id IS NULL THEN 'failed: no app order' ELSE 'success' END AS status
FROM app FULL JOIN payment
  ON app.order_id = payment.order_id AND abs(payment.ts_ms - app.ts_ms) <= {365 * DAY}""")
def reconcile_orders(spark, folder):
    app, payment = orders_and_shipments(spark, folder)
    return reconcile.reconcile(app, payment, 365 * DAY)


#: Purchases as the app's side, errors as the other side: users have many of both.
WAIT = 48 * HOUR

REPEATED = f"""{CLICKS}, sides AS (
  SELECT "user", seq, ts_ms, CASE url WHEN 'purchase' THEN 0 ELSE 1 END AS side,
    row_number() OVER (PARTITION BY "user" ORDER BY ts_ms, url = 'error', seq) AS n
  FROM clicks WHERE url IN ('purchase', 'error')),
walk AS (
  SELECT "user", n, n AS waiting, NULL::BIGINT AS met FROM sides WHERE n = 1
  UNION ALL
  SELECT e."user", e.n,
    CASE WHEN p.side <> e.side AND e.ts_ms - p.ts_ms <= {WAIT} THEN NULL ELSE e.n END,
    CASE WHEN p.side <> e.side AND e.ts_ms - p.ts_ms <= {WAIT} THEN p.n END
  FROM walk w JOIN sides e ON e."user" = w."user" AND e.n = w.n + 1
  LEFT JOIN sides p ON p."user" = w."user" AND p.n = w.waiting),
matches AS (SELECT "user", met AS a, n AS b FROM walk WHERE met IS NOT NULL)
SELECT x."user", CASE x.side WHEN 0 THEN x.seq ELSE y.seq END AS app_seq,
  CASE x.side WHEN 0 THEN y.seq ELSE x.seq END AS payment_seq, 'success' AS status
FROM matches m JOIN sides x ON x."user" = m."user" AND x.n = m.a JOIN sides y ON y."user" = m."user" AND y.n = m.b
UNION ALL SELECT "user", CASE side WHEN 0 THEN seq END, CASE side WHEN 1 THEN seq END,
  CASE side WHEN 0 THEN 'failed: no payment' ELSE 'failed: no app order' END
FROM sides s WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m."user" = s."user" AND s.n IN (m.a, m.b))"""


@query(f"WITH RECURSIVE {REPEATED}")
def reconcile_repeated(spark, folder):
    rows = clicks(spark, folder).select("user", "seq", "ts_ms", "url")
    app, payment = rows.where("url = 'purchase'"), rows.where("url = 'error'")
    return reconcile.reconcile(app, payment, WAIT, "user", ["seq"], ["seq"], ["seq"])


@query("""SELECT o_orderkey AS order_id, o_custkey AS customer, l_linenumber AS line, l_quantity AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey""")
def two_stream_join(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer")
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_quantity").alias("quantity"),
    )
    return reconcile.join_streams(orders, lines, "order_id")


@query(f"""WITH {CLICKS}, looked AS (
  SELECT seq, "user", url, ts_ms, lead(ts_ms, 1) OVER w AS ts_2, lead(ts_ms, 2) OVER w AS ts_3,
    lead(url, 1) OVER w AS url_2, lead(url, 2) OVER w AS url_3
  FROM clicks WINDOW w AS (PARTITION BY "user" ORDER BY ts_ms, seq))
SELECT "user", seq, ts_ms AS ts_1, ts_2, ts_3 FROM looked
WHERE url = 'error' AND url_2 = 'error' AND url_3 = 'error'""")
def cep_strict3(spark, folder):
    failed = F.col("url") == "error"
    return patterns.strict_sequence(clicks(spark, folder), "user", [failed] * 3, ["ts_ms", "seq"])


@query(f"""WITH {CLICKS}, looked AS (
  SELECT seq, "user", ts_ms AS ts_1, lead(ts_ms, 1) OVER w AS ts_2, lead(ts_ms, 2) OVER w AS ts_3
  FROM clicks WHERE url = 'error' WINDOW w AS (PARTITION BY "user" ORDER BY ts_ms, seq))
SELECT "user", seq, ts_1, ts_2, ts_3 FROM looked WHERE ts_3 IS NOT NULL""")
def cep_times3(spark, folder):
    failed = F.col("url") == "error"
    return patterns.relaxed_times(clicks(spark, folder), "user", failed, 3, ["ts_ms", "seq"])


# --- tables and SQL ------------------------------------------------------------


@query(f"""WITH {CLICKS} SELECT "user", url FROM clicks WHERE url = 'click'""")
def sql_select(spark, folder):
    tables.create_view(clicks(spark, folder), "click_table", ["url", "user"])
    return tables.sql(spark, "SELECT `user`, url FROM click_table WHERE url = 'click'")


@query(f"""WITH {CLICKS} SELECT "user", url FROM clicks WHERE "user" = 7""")
def dsl_where(spark, folder):
    return tables.select_where(clicks(spark, folder), ["user", "url"], F.col("user") == 7)


@query(f"""WITH {CLICKS} SELECT "user", count(url)::BIGINT AS cnt FROM clicks GROUP BY 1""")
def sql_count(spark, folder):
    view = clicks(spark, folder).select("url", "user")
    return tables.sql(spark, "SELECT `user`, count(url) AS cnt FROM {t} GROUP BY `user`", t=view)


@query(f"""WITH {CLICKS}, copied AS (
  SELECT "user", url, ts_ms, (ts_ms // {5 * HOUR} - k) * {5 * HOUR} AS window_start_ms
  FROM clicks, (VALUES (0), (1)) AS t(k))
SELECT "user", window_start_ms, window_start_ms + {10 * HOUR} AS window_end_ms,
  avg(ts_ms - window_start_ms) AS mean_offset, count(DISTINCT url)::BIGINT AS kinds
FROM copied WHERE ts_ms < window_start_ms + {10 * HOUR} GROUP BY 1, 2""")
def window_custom_aggregate(spark, folder):
    measures = {
        "mean_offset": F.avg(F.col("ts_ms") - F.col(windows.START)),
        "kinds": F.count_distinct("url"),
    }
    return windows.window_aggregate(clicks(spark, folder), ["user"], 10 * HOUR, 5 * HOUR, measures)


@query(f"""WITH {_windowed(10, 2)}
SELECT url, window_start_ms, window_end_ms, count(*)::BIGINT AS pv, count(DISTINCT "user")::BIGINT AS uv
FROM windowed GROUP BY ALL""")
def window_user_aggregate(spark, folder):
    visitors = accumulators.ViewsAndVisitors("user")
    rows = clicks(spark, folder)
    return accumulators.window_accumulate(rows, ["url"], 10 * HOUR, visitors, 2 * HOUR, ["user"])


@query(f"""WITH {_windowed(10, 5)}, spaced AS (
  SELECT *, ts_ms - lag(ts_ms) OVER (PARTITION BY window_start_ms ORDER BY ts_ms, seq) AS gap FROM windowed)
SELECT window_start_ms, window_end_ms, count(DISTINCT "user")::BIGINT AS uv,
  coalesce(max(gap), 0)::BIGINT AS longest_gap FROM spaced GROUP BY ALL""")
def window_process(spark, folder):
    def visitors_and_gap(window, batches):
        users, last, longest = set(), None, 0
        for batch in batches:
            users.update(pc.unique(batch.column("user")).to_pylist())
            for ts in batch.column("ts_ms").to_pylist():
                longest = max(longest, ts - (ts if last is None else last))
                last = ts
        yield pa.RecordBatch.from_pydict({"uv": [len(users)], "longest_gap": [longest]})

    rows = clicks(spark, folder).select("user", "seq", "ts_ms")
    return accumulators.process_windows(
        rows, [], 10 * HOUR, visitors_and_gap, "uv bigint, longest_gap bigint", 5 * HOUR, ["ts_ms", "seq"]
    )


# --- streams -------------------------------------------------------------------
# Each runs over all input there is and gives back what it wrote.


@query(ORACLES["word_count"])
def stream_word_count(spark, folder):
    counts = parsing.word_count(lines_of(stream_table(spark, folder, "documents"), "text"))
    return sinks.run_to_table(counts, "word-count", "update", ["word"])


@query(ORACLES["pv_per_url_tumble"])
def stream_pv_per_url(spark, folder):
    timed = stream_clicks(spark, folder).withWatermark("ts", "2 hours")
    counts = windows.window_aggregate(timed, ["url"], 10 * HOUR)
    keys = ["url", windows.START, windows.END]
    return sinks.run_to_table(counts, "pv-per-url", "update", keys)


@query(f"""WITH {CLICKS}
SELECT seq, "user", count(*) OVER (PARTITION BY "user" ORDER BY seq)::BIGINT AS cnt FROM clicks""")
def stream_running_count(spark, folder):
    counts = RunningCounts(fresh_path(spark, "running-count"), ["user"], ["seq"])
    counts.start(staged_stream(clicks(spark, folder).select("user", "seq"), ["seq"], 4)).awaitTermination()
    return counts.rows(spark).select("seq", "user", "cnt")


@query(ORACLES["changelog_count"])
def stream_changelog_count(spark, folder):
    counts = RunningCounts(fresh_path(spark, "changelog"), ["user"], ["ts_ms", "seq"], counted="url")
    counts.start(staged_stream(clicks(spark, folder), ["ts_ms", "seq"], 4)).awaitTermination()
    hit = F.col("url").isNotNull().cast("bigint")
    return running.changes_of(counts.rows(spark), ["ts_ms", "seq", "user"], hit)


@query(f"""WITH {CLICKS}
SELECT seq, "user", url, ts_ms, CASE WHEN url = 'purchase' THEN 'orders' WHEN url = 'error' THEN 'errors'
  ELSE 'main' END AS route FROM clicks""")
def stream_split(spark, folder):
    path = fresh_path(spark, "split")
    stream = stream_clicks(spark, folder).drop("ts")
    orders, errors = F.col("url") == "purchase", F.col("url") == "error"
    routes = {"orders": orders, "errors": errors, "main": ~orders & ~errors}
    sinks.fan_out(stream, path, routes).awaitTermination()
    parts = [spark.read.schema(stream.schema).parquet(f"{path}/{label}") for label in routes]
    labelled = [p.withColumn("route", F.lit(r)).drop(sinks.BATCH) for r, p in zip(routes, parts)]
    return routing.union_all(*labelled)


@query(ORACLES["late_refire"])
def stream_late_refire(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "user", "ts_ms")
    sink = LateCounts(fresh_path(spark, "late"), ["user"], ARRIVAL, **LATE)
    sink.start(staged_stream(rows, ARRIVAL, 3)).awaitTermination()
    return sink.firings(spark).unionByName(sink.still_open(spark))


@query(ORACLES["late_refire_any"])
def stream_late_refire_any(spark, folder):
    rows = arrivals(spark, folder).select("arr", "seq", "user", "url", "ts_ms")
    held = OffsetAndVisitors(10 * HOUR)
    sink = LateWindows(fresh_path(spark, "late"), ["url"], ARRIVAL, held, **LATE)
    sink.start(staged_stream(rows, ARRIVAL, 3)).awaitTermination()
    return sink.firings(spark).unionByName(sink.still_open(spark))


#: So far the feed of other events lags behind that of visits.
LAG = 30 * DAY


@query(f"""WITH {CLICKS}, shifted AS (
  SELECT url IN ('click', 'view') AS visit, url, CASE WHEN url IN ('click', 'view') THEN ts_ms ELSE ts_ms - {LAG} END AS ts_ms
  FROM clicks),
mark AS (SELECT min(top) - {2 * HOUR} AS mark FROM (SELECT max(ts_ms) AS top FROM shifted GROUP BY visit)),
counts AS (
  SELECT url, ts_ms // {10 * HOUR} * {10 * HOUR} AS window_start_ms, count(*)::BIGINT AS pv FROM shifted GROUP BY ALL)
SELECT url, window_start_ms, window_start_ms + {10 * HOUR} AS window_end_ms, pv
FROM counts, mark WHERE window_start_ms + {10 * HOUR} <= mark""")
def stream_union_watermark(spark, folder):
    rows = clicks(spark, folder)
    is_visit = F.col("url").isin("click", "view")
    late = rows.where(~is_visit).withColumn("ts_ms", F.col("ts_ms") - LAG)
    sides = [
        with_event_time(staged_stream(side, ["ts_ms"], 3), "2 hours") for side in (rows.where(is_visit), late)
    ]
    counts = windows.window_aggregate(watermarks.union_streams(*sides), ["url"], 10 * HOUR)
    return sinks.run_to_table(counts, "union")


@query(f"WITH {CLICKS} SELECT * FROM clicks")
def stream_custom_feed(spark, folder):
    path = fresh_path(spark, "feed")
    rows = clicks(spark, folder)
    rows.repartition(6).write.parquet(path)
    register_feed(spark, FilesFeed, "files")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    stream = spark.readStream.format("files").option("path", path).option("schema", fields).load()
    return sinks.run_to_table(stream, "feed")


@query(ORACLES["late_side_output"])
def stream_late_side(spark, folder):
    rows = arrivals(spark, folder)
    sink = LateCounts(fresh_path(spark, "late"), ["user"], ARRIVAL, **LATE)
    sink.start(staged_stream(rows, ARRIVAL, 3)).awaitTermination()
    return sink.side(spark).select("seq", "user", "url", "ts_ms")


def ended(rows: DataFrame, after_ms: int, times: int = 1, **last: Column) -> list[DataFrame]:
    """Rows of :data:`END_USER`, one per micro-batch, ever further ahead of all ``rows``."""
    top = rows.agg(F.max("ts_ms").alias("ts_ms"))
    values = {"user": F.lit(END_USER).cast("bigint"), "seq": F.lit(-1).cast("bigint"), **last}
    return [
        top.select((F.col("ts_ms") + i * after_ms).alias("ts_ms"), *[c.alias(n) for n, c in values.items()])
        for i in range(1, times + 1)
    ]


@query(ORACLES["cep_strict3"])
def stream_cep_strict3(spark, folder):
    failed = F.col("url") == "error"
    sink = PatternMatches(fresh_path(spark, "strict"), "user", [failed] * 3, ["ts_ms", "seq"], 2 * HOUR)
    sink.start(staged_stream(clicks(spark, folder), ["seq"], 4)).awaitTermination()
    return sink.matches(spark).unionByName(sink.still_open(spark))


@query(ORACLES["cep_times3"])
def stream_cep_times3(spark, folder):
    failed = F.col("url") == "error"
    sink = PatternMatches(
        fresh_path(spark, "times"), "user", [failed], ["ts_ms", "seq"], 2 * HOUR, relaxed=True, steps=3
    )
    sink.start(staged_stream(clicks(spark, folder), ["seq"], 4)).awaitTermination()
    return sink.matches(spark).unionByName(sink.still_open(spark))


@query(f"""WITH {RANKED}, slots AS (
  SELECT DISTINCT window_end_ms, k AS rank FROM counts, range(1, 8) AS r(k))
SELECT window_end_ms, rank::BIGINT AS rank, coalesce(url, '无') AS url, coalesce(pv, 0)::BIGINT AS pv
FROM slots LEFT JOIN ranked USING (window_end_ms, rank)""")
def stream_topn_padded(spark, folder):
    rows = clicks(spark, folder)
    # The last windows pass three operators, one micro-batch each.
    ends = ended(rows, 100 * DAY, 4, url=F.lit("end"))
    stream = with_event_time(staged_stream(rows, ["ts_ms"], 3, ends=ends), "2 hours")
    ranked = processors.top_urls(stream, 10 * HOUR, 5 * HOUR, 7)
    last = rows.agg(F.max("ts_ms")).first()[0] or 0
    return sinks.run_to_table(ranked, "top").where(F.col("window_end_ms") <= last + 10 * HOUR)


@query(f"""WITH {CLICKS}
SELECT "user", 'input' AS kind, ts_ms AS at_ms FROM clicks
UNION ALL SELECT DISTINCT "user", 'fired', ts_ms + {5 * HOUR} FROM clicks""")
def stream_event_timers(spark, folder):
    rows = clicks(spark, folder)
    ends = ended(rows, 10 * DAY, url=F.lit("end"))
    stream = staged_stream(rows, ["ts_ms"], 3, ends=ends)
    fired = processors.event_timers(stream, ["user"], 5 * HOUR, 2 * HOUR)
    return sinks.run_to_table(fired, "timers").where(~F.col("user").eqNullSafe(END_USER))


@query(f"WITH RECURSIVE {REPEATED}")
def stream_reconcile_state(spark, folder):
    kept = clicks(spark, folder).where("url IN ('purchase', 'error')").select("user", "seq", "ts_ms", "url")
    # A last row of each side, far ahead, moves the watermark past all that wait.
    sides = F.explode(F.array(F.lit("purchase"), F.lit("error")))
    ends = ended(kept, 10 * WAIT, url=sides)
    stream = with_event_time(staged_stream(kept, ["ts_ms"], 4, ends=ends), "1 second")
    app, payment = stream.where("url = 'purchase'"), stream.where("url = 'error'")
    schema = "user bigint, app_seq bigint, payment_seq bigint, status string"
    pairs = inputs.Reconcile(WAIT, ["seq"])
    out = inputs.connect(app.drop("url"), payment.drop("url"), ["user"], pairs, schema, F.col("seq"))
    return sinks.run_to_table(out, "reconcile").where(F.col("user") != END_USER)
