"""Sequence patterns over the rows of a stream.

Rows are matched once the watermark has passed them, so in event time whatever the order
they came in. A match of n rows may begin in earlier micro-batches: of each key, the last
n - 1 rows that have been matched are carried on. Each micro-batch is matched as a table
(:mod:`tidemark.operators.patterns`), carried rows first, so a row is looked at once and a
hot key is cut in chunks. Every match has a new row, as there are too few carried ones for
a match of their own; so none is found twice.

Micro-batch ``n`` reads what batch ``n - 1`` left and writes its own folders; a batch that
is run again replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import patterns
from tidemark.streaming.sinks import BATCH


@dataclass
class PatternMatches:
    """Matches per key of ``conditions`` one right after the other, or, with ``relaxed``, of
    rows that meet the one condition ``steps`` times whatever lies between.

    Rows at or below the watermark (the largest ``ts_ms`` so far, less ``delay_ms`` and 1 ms) come too
    late and are kept apart (:meth:`late`). Rows without a time are left out.
    """

    path: str
    key: str
    conditions: Sequence[Column]
    order: Sequence[str]
    delay_ms: int = 0
    relaxed: bool = False
    steps: int | None = None
    ts_ms: str = "ts_ms"
    chunk_rows: int | None = None

    def __post_init__(self) -> None:
        self.steps = self.steps or len(self.conditions)
        if self.relaxed and len(self.conditions) != 1:
            raise ValueError("a relaxed pattern repeats one condition")
        self.flags = [f"__meets_{i}" for i in range(len(self.conditions))]

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.take)
        writer = writer.option("checkpointLocation", f"{self.path}/state")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = self._flagged(batch).persist()
        try:
            reached = spark.read.parquet(self._folder("reached", batch_id - 1)).first()[0] if batch_id else None
            top = batch.agg(F.max(self.ts_ms)).first()[0]
            now = max((t for t in (reached, top) if t is not None), default=None)
            passed = F.lit(False) if reached is None else F.col(self.ts_ms) <= reached - self.delay_ms - 1
            self._write(rows.where(passed), "late", batch_id)
            pool = rows.where(~passed).withColumn("__carried", F.lit(False))
            if batch_id:
                held = spark.read.schema(pool.schema).parquet(self._folder("held", batch_id - 1))
                pool = held.unionByName(pool)
            ready = F.lit(False) if now is None else F.col(self.ts_ms) <= now - self.delay_ms - 1
            final = pool.where(F.col("__carried") | ready)
            self._write(self._matched(final), "matches", batch_id)
            waiting = pool.where(~(F.col("__carried") | ready))
            self._write(waiting.unionByName(self._last(final)), "held", batch_id)
            self._write(spark.createDataFrame([(now,)], "reached bigint"), "reached", batch_id)
        finally:
            rows.unpersist()

    def _flagged(self, batch: DataFrame) -> DataFrame:
        columns = list(dict.fromkeys([self.key, *self.order, self.ts_ms]))
        flags = [F.coalesce(c, F.lit(False)).alias(n) for c, n in zip(self.conditions, self.flags)]
        rows = batch.where(F.col(self.ts_ms).isNotNull()).select(*columns, *flags)
        return rows.where(self.flags[0]) if self.relaxed else rows

    def _matched(self, rows: DataFrame) -> DataFrame:
        if self.relaxed:
            return patterns.relaxed_times(
                rows, self.key, F.lit(True), self.steps, self.order, self.ts_ms, self.chunk_rows
            )
        met = [F.col(n) for n in self.flags]
        return patterns.strict_sequence(rows, self.key, met, self.order, self.ts_ms, self.chunk_rows)

    def _last(self, rows: DataFrame) -> DataFrame:
        """The last rows of each key, one less than a match has."""
        newest = W.partitionBy(self.key).orderBy(*[F.col(c).desc() for c in self.order])
        return (
            rows.withColumn("__rank", F.row_number().over(newest))
            .where(F.col("__rank") < self.steps)
            .drop("__rank")
            .withColumn("__carried", F.lit(True))
        )

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/{BATCH}={batch_id}"

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(name, batch_id))

    def matches(self, spark: SparkSession) -> DataFrame:
        """All matches so far."""
        return spark.read.parquet(f"{self.path}/matches").drop(BATCH)

    def late(self, spark: SparkSession) -> DataFrame:
        """Key, order and time of the rows that came too late."""
        return spark.read.parquet(f"{self.path}/late").drop(BATCH, *self.flags)

    def still_open(self, spark: SparkSession) -> DataFrame:
        """What the rows above the watermark would add if the stream ended now."""
        last = spark.read.parquet(f"{self.path}/reached").agg(F.max(BATCH)).first()[0]
        return self._matched(spark.read.parquet(self._folder("held", last)))
