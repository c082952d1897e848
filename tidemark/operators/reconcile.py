"""Matching two streams of one key within a time limit, and plain stream joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.chunks import plan_chunks
from tidemark.plans.scans import following, prefix_scan
from tidemark.session import cut_lineage

SUCCESS = "success"
NO_PAYMENT = "failed: no payment"
NO_ORDER = "failed: no app order"


def latest_per_key(df: DataFrame, key: str, ts_ms: str = "ts_ms") -> DataFrame:
    """The last row per key: a later one takes the place of a waiting one."""
    others = [c for c in df.columns if c != key]
    if others == [ts_ms]:
        return df.groupBy(key).agg(F.max(ts_ms).alias(ts_ms))
    last = F.max(F.struct(ts_ms, *[c for c in others if c != ts_ms])).alias("__last")
    return df.groupBy(key).agg(last).select(key, *[F.col(f"__last.{c}").alias(c) for c in others])


def reconcile(
    app: DataFrame,
    payment: DataFrame,
    timeout_ms: int = 5_000,
    key: str = "order_id",
    app_columns: Sequence[str] = ("ts_ms",),
    payment_columns: Sequence[str] = ("ts_ms",),
    order: Sequence[str] = (),
    chunk_rows: int | None = None,
) -> DataFrame:
    """Each app order and payment once: matched within ``timeout_ms``, or failed.

    On tables keys may repeat. The rows of a key are followed in time, one waiting at most:
    a row of the other side within the limit is its match, any other row fails it and
    waits in its place. Rows of one time are taken app orders first, then by ``order``, a
    number that both sides have (by their values, if not given). Rows without key or time
    fail. On streams keys must be unique per side (else use
    :class:`~tidemark.streaming.inputs.Reconcile`); both sides carry ``ts`` with a
    watermark, and a row fails when the watermark passes its limit.
    """
    if not app.isStreaming:
        sides = _sides(app, payment, key, app_columns, payment_columns, order)
        return _paired(sides, key, timeout_ms, chunk_rows).select(
            key,
            *[F.col(f"app.{c}").alias(f"app_{c}") for c in app_columns],
            *[F.col(f"payment.{c}").alias(f"payment_{c}") for c in payment_columns],
            "status",
        )
    a, p = app.alias("a"), payment.alias("p")
    same = F.col(f"a.{key}") == F.col(f"p.{key}")
    wait = F.expr(f"interval '{timeout_ms / 1000:.3f}' second")
    near = (F.col("p.ts") >= F.col("a.ts") - wait) & (F.col("p.ts") <= F.col("a.ts") + wait)
    return a.join(p, same & near, "full_outer").select(
        F.coalesce(f"a.{key}", f"p.{key}").alias(key),
        *[F.col(f"a.{c}").alias(f"app_{c}") for c in app_columns],
        *[F.col(f"p.{c}").alias(f"payment_{c}") for c in payment_columns],
        _status(F.col(f"a.{key}"), F.col(f"p.{key}")).alias("status"),
    )


def _sides(
    app: DataFrame,
    payment: DataFrame,
    key: str,
    app_columns: Sequence[str],
    payment_columns: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Both sides in one table: ``key``, ``app`` or ``payment``, and their place in time."""

    def side(df: DataFrame, name: str, number: int, columns: Sequence[str]) -> DataFrame:
        tie = F.col(order[0]).cast("bigint") if order else F.xxhash64("ts_ms", *columns)
        return df.select(
            F.col(key),
            (F.col("ts_ms") * 2 + number).alias("__at"),
            tie.alias("__tie"),
            F.struct(*columns).alias(name),
        )

    return side(app, "app", 0, app_columns).unionByName(
        side(payment, "payment", 1, payment_columns), allowMissingColumns=True
    )


def _paired(sides: DataFrame, key: str, timeout_ms: int, chunk_rows: int | None) -> DataFrame:
    """``key, app, payment, status``: matches of the rows of a key, one waiting at most.

    The row that waits is always the one right before. So neighbours of different sides
    within the limit are linked, and of a run of links every other one, from the first, is
    a match.
    """
    along = ["__at", "__tie"]
    known = F.col(key).isNotNull() & F.col("__at").isNotNull()
    rows = sides.where(known)
    chunks = plan_chunks(rows, along, [key], chunk_rows)
    # A plan that is cut reads its input twice per scan.
    step = cut_lineage if chunks.split else lambda df: df
    side, later = F.pmod("__at", F.lit(2)), F.col("next_1")
    looked = following(rows, along, [key], ["__at", "app", "payment"], 1, chunks=chunks)
    apart = F.shiftright(later["__at"], 1) - F.shiftright("__at", 1)
    linked = (F.pmod(later["__at"], F.lit(2)) != side) & (apart <= timeout_ms)
    looked = step(looked.withColumn("__linked", F.coalesce(linked, F.lit(False))))
    numbered = step(
        prefix_scan(looked, along, {"__n": ("sum", F.lit(1).cast("bigint"))}, [key], chunks=chunks)
    )
    broken = F.when(~F.col("__linked"), F.col("__n"))
    scanned = prefix_scan(
        numbered, along, {"__break": ("max", broken)}, [key], inclusive=False, chunks=chunks
    )
    # Links right before the row, one after the other.
    run = F.col("__n") - 1 - F.coalesce("__break", F.lit(0))
    ends, starts = run % 2 == 1, F.col("__linked") & (run % 2 == 0)
    status = F.when(starts, SUCCESS).when(side == 0, NO_PAYMENT).otherwise(NO_ORDER)
    done = scanned.where(~ends).select(
        key,
        F.coalesce("app", F.when(starts, later["app"])).alias("app"),
        F.coalesce("payment", F.when(starts, later["payment"])).alias("payment"),
        status.alias("status"),
    )
    missing = F.when(F.col("app").isNotNull(), NO_PAYMENT).otherwise(NO_ORDER)
    return done.unionByName(sides.where(~known).select(key, "app", "payment", missing.alias("status")))


def _status(app_key: Column, payment_key: Column) -> Column:
    return (
        F.when(payment_key.isNull(), NO_PAYMENT)
        .when(app_key.isNull(), NO_ORDER)
        .otherwise(SUCCESS)
    )


def join_streams(left: DataFrame, right: DataFrame, key: str, within_ms: int | None = None) -> DataFrame:
    """Rows of two tables or streams that share a key.

    ``within_ms`` bounds the time between them, which a stream needs to let state go.
    """
    l, r = left.alias("l"), right.alias("r")
    on = F.col(f"l.{key}") == F.col(f"r.{key}")
    if within_ms is not None:
        if left.isStreaming:
            wait = F.expr(f"interval '{within_ms / 1000:.3f}' second")
            on = on & F.col("r.ts").between(F.col("l.ts") - wait, F.col("l.ts") + wait)
        else:
            on = on & (F.abs(F.col("r.ts_ms") - F.col("l.ts_ms")) <= within_ms)
    extra = [F.col(f"r.{c}") for c in right.columns if c not in left.columns]
    return l.join(r, on).select("l.*", *extra)
