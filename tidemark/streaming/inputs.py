"""Two streams of one key: a processor with state per side and one timer.

Both streams are tagged and put together, so one stateful operator sees the rows of both.
The rows of a key in one micro-batch are put in order (time, left side first, then a tie
column) before the processor gets them one by one; rows of a later micro-batch come after
those of an earlier one. The order is made in memory, so bound the micro-batches at the
source where one key may have very many rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.reconcile import NO_ORDER, NO_PAYMENT, SUCCESS
from tidemark.session import ROCKSDB_PROVIDER, STATE_STORE

LEFT, RIGHT = "left", "right"


class TwoInputs(StatefulProcessor):
    """Subclass it with ``on_left``, ``on_right`` and ``on_timer``; each gives output rows as tuples.

    ``self.left`` and ``self.right`` hold a row of each side, or None. :meth:`set_timer`
    sets the key's one timer, in place of an earlier one; :meth:`clear_timer` takes it away.
    State is read once per key and micro-batch and written only if it has changed.
    """

    #: Set by :func:`connect`.
    sides: dict[str, T.StructType]
    output: list[str]

    def on_left(self, key: tuple, row: Row) -> Iterable[tuple]:
        raise NotImplementedError

    def on_right(self, key: tuple, row: Row) -> Iterable[tuple]:
        raise NotImplementedError

    def on_timer(self, key: tuple, at_ms: int) -> Iterable[tuple]:
        return ()

    def set_timer(self, at_ms: int) -> None:
        self.timer = at_ms

    def clear_timer(self) -> None:
        self.timer = None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = {side: handle.getValueState(side, schema) for side, schema in self.sides.items()}
        self.states["timer"] = handle.getValueState("timer", "at bigint")

    def _row(self, side: str, values: tuple | dict) -> Row:
        names = self.sides[side].names
        return Row(*names)(*([values[n] for n in names] if isinstance(values, dict) else values))

    def _load(self) -> None:
        found = {name: tuple(s.get()) if s.exists() else None for name, s in self.states.items()}
        self.left = self._row(LEFT, found[LEFT]) if found[LEFT] else None
        self.right = self._row(RIGHT, found[RIGHT]) if found[RIGHT] else None
        self.timer = found["timer"][0] if found["timer"] else None
        self.found = found

    def _store(self) -> None:
        timer = None if self.timer is None else (self.timer,)
        now = {LEFT: self.left and tuple(self.left), RIGHT: self.right and tuple(self.right), "timer": timer}
        for name, state in self.states.items():
            if now[name] is None and self.found[name] is not None:
                state.clear()
            elif now[name] != self.found[name]:
                state.update(now[name])
        before = self.found["timer"]
        if timer != before:
            # A timer for t fires when the watermark has passed t.
            if before is not None:
                self.handle.deleteTimer(before[0] + 1)
            if timer is not None:
                self.handle.registerTimer(self.timer + 1)

    def _rows(self, tuples: Iterable[tuple]) -> Iterator[Row]:
        return (Row(**dict(zip(self.output, values))) for values in tuples)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._load()
        out = []
        for row in sorted(rows, key=lambda r: (r["__at"], r["__side"], r["__tie"])):
            if row["__side"] == 0:
                out += self.on_left(tuple(key), self._row(LEFT, row[LEFT]))
            else:
                out += self.on_right(tuple(key), self._row(RIGHT, row[RIGHT]))
        self._store()
        yield from self._rows(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._load()
        at = expiredTimerInfo.getExpiryTimeInMs() - 1
        if self.timer != at:  # another has taken its place
            return
        # It has fired, there is nothing left to delete.
        self.timer, self.found["timer"] = None, None
        self.states["timer"].clear()
        out = list(self.on_timer(tuple(key), at))
        self._store()
        yield from self._rows(out)

    def close(self) -> None:
        pass


def connect(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    processor: TwoInputs,
    schema: str,
    tie: Column | None = None,
    output_mode: str = "Append",
) -> DataFrame:
    """Apply ``processor`` to two streams with ``keys``, ``ts_ms`` and a watermark on ``ts``.

    ``schema`` has the columns of its output. The watermark is that of the slower stream,
    unless the session says otherwise. Rows without a time are left out, as Spark drops them.
    """
    spark, keys = left.sparkSession, list(keys)
    spark.conf.set(STATE_STORE, ROCKSDB_PROVIDER)
    values = {LEFT: left.drop("ts"), RIGHT: right.drop("ts")}
    processor.sides = {side: df.schema for side, df in values.items()}
    processor.output = T.StructType.fromDDL(schema).names

    def tagged(df: DataFrame, name: str, number: int) -> DataFrame:
        own = F.struct(*values[name].columns)
        missing = {side: F.lit(None).cast(s) for side, s in processor.sides.items()}
        return df.where(F.col("ts_ms").isNotNull()).select(
            *keys,
            F.lit(number).alias("__side"),
            F.col("ts_ms").alias("__at"),
            F.coalesce(F.lit(0) if tie is None else tie, F.lit(0)).cast("bigint").alias("__tie"),
            *[(own if side == name else missing[side]).alias(side) for side in (LEFT, RIGHT)],
            "ts",
        )

    both = tagged(left, LEFT, 0).unionByName(tagged(right, RIGHT, 1))
    return both.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode=output_mode, timeMode="EventTime"
    )


class Reconcile(TwoInputs):
    """Pairs rows of two sides as :func:`tidemark.operators.reconcile.reconcile` does on tables.

    Gives the key, then ``columns`` of the left row, of the right row, and the status.
    """

    def __init__(self, timeout_ms: int, columns: Sequence[str] = ("ts_ms",)):
        self.timeout_ms, self.columns = timeout_ms, list(columns)

    def _out(self, key: tuple, left: Row | None, right: Row | None) -> tuple:
        status = SUCCESS if left and right else NO_PAYMENT if left else NO_ORDER
        values = [row[c] if row else None for row in (left, right) for c in self.columns]
        return (*key, *values, status)

    def _meet(self, key: tuple, row: Row, waiting: Row | None, is_left: bool) -> list[tuple]:
        if waiting and row["ts_ms"] - waiting["ts_ms"] <= self.timeout_ms:
            self.left = self.right = None
            self.clear_timer()
            return [self._out(key, row, waiting) if is_left else self._out(key, waiting, row)]
        out = self._give_up(key)
        self.left, self.right = (row, None) if is_left else (None, row)
        self.set_timer(row["ts_ms"] + self.timeout_ms)
        return out

    def _give_up(self, key: tuple) -> list[tuple]:
        out = [self._out(key, self.left, self.right)] if self.left or self.right else []
        self.left = self.right = None
        return out

    def on_left(self, key: tuple, row: Row) -> list[tuple]:
        return self._meet(key, row, self.right, True)

    def on_right(self, key: tuple, row: Row) -> list[tuple]:
        return self._meet(key, row, self.left, False)

    def on_timer(self, key: tuple, at_ms: int) -> list[tuple]:
        return self._give_up(key)
