"""Late rows on a stream: windows that fire again, and a side output.

Spark drops late rows without a trace, so windows with lateness are kept in a
table of open windows instead of in operator state. Micro-batch ``n`` reads the
table written by batch ``n - 1`` and writes its own, with its firings and its side
rows. A batch that is run again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.time import window_start
from tidemark.operators import lateness as batch_lateness
from tidemark.operators.lateness import CLASS, DROPPED, LATE, ON_TIME
from tidemark.operators.windows import END, START
from tidemark.plans.scans import prefix_scan
from tidemark.streaming.sinks import BATCH


@dataclass
class LateCounts:
    """Counts per key and tumbling window with ``lateness_ms``, over micro-batches."""

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    size_ms: int
    delay_ms: int = 0
    lateness_ms: int = 0

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.take)
        writer = writer.option("checkpointLocation", f"{self.path}/state")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Classify one micro-batch, fire windows, and hand the open ones on."""
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            windows, reached = self._open_windows(batch, batch_id - 1)
            top = batch.agg(F.max("ts_ms")).first()[0]
            now = max((t for t in (reached, top) if t is not None), default=None)
            if top is None:
                self._write(windows, "windows", batch_id)
                self._write(spark.createDataFrame([(now,)], "reached bigint"), "reached", batch_id)
                return

            rows = self._classify(batch, reached)
            side = rows.where(F.col(CLASS) == DROPPED).select(*batch.columns)
            self._write(side, "side", batch_id)

            group = [*self.keys, START]
            added = (
                rows.where(F.col(CLASS) != DROPPED)
                .groupBy(*group)
                .agg(
                    F.count_if(F.col(CLASS) == ON_TIME).alias("on_time"),
                    F.count_if(F.col(CLASS) == LATE).alias("late"),
                )
                .withColumn("fired", F.lit(False))
            )
            merged = (
                windows.unionByName(added)
                .groupBy(*group)
                .agg(
                    F.sum("on_time").alias("on_time"),
                    F.sum("late").alias("late"),
                    F.max("fired").alias("fired"),
                )
            )
            ends = F.col(START) + F.lit(self.size_ms + self.delay_ms)
            closed = ends <= now
            firsts = merged.where(closed & ~F.col("fired") & (F.col("on_time") > 0)).select(
                *group,
                (F.col(START) + self.size_ms).alias(END),
                F.lit("first").alias("firing"),
                *[F.lit(None).cast("bigint").alias(c) for c in self.order],
                F.col("on_time").alias("pv"),
            )
            firings = firsts.unionByName(self._refirings(rows, windows, added))
            self._write(firings, "firings", batch_id)
            kept = merged.withColumn("fired", F.col("fired") | closed).where(
                ends + F.lit(self.lateness_ms) > now
            )
            self._write(kept, "windows", batch_id)
            self._write(spark.createDataFrame([(now,)], "reached bigint"), "reached", batch_id)
        finally:
            batch.unpersist()

    def _classify(self, batch: DataFrame, reached: int | None) -> DataFrame:
        rows = batch_lateness.classify(
            batch, self.order, self.size_ms,
            delay_ms=self.delay_ms, lateness_ms=self.lateness_ms,
        )
        if reached is None:
            return rows
        # What earlier batches reached holds for every row of this one.
        ends = F.col(START) + F.lit(self.size_ms + self.delay_ms)
        before = F.when(ends + F.lit(self.lateness_ms) <= reached, DROPPED).when(
            ends <= reached, F.when(F.col(CLASS) == DROPPED, DROPPED).otherwise(LATE)
        )
        return rows.withColumn(CLASS, F.coalesce(before, F.col(CLASS)))

    def _refirings(self, rows: DataFrame, windows: DataFrame, added: DataFrame) -> DataFrame:
        """One row per late row: all on-time rows, earlier late rows, and itself."""
        group = [*self.keys, START]
        earlier = (
            windows.select(*group, (F.col("on_time") + F.col("late")).alias("__n"))
            .unionByName(added.select(*group, F.col("on_time").alias("__n")))
            .select(*group, *[F.lit(-(2**63)).cast("bigint").alias(c) for c in self.order], "__n")
            .groupBy(*group, *self.order)
            .agg(F.sum("__n").alias("__n"))
        )
        late = rows.where(F.col(CLASS) == LATE).select(
            *group, *self.order, F.lit(1).cast("bigint").alias("__n")
        )
        counted = prefix_scan(
            late.withColumn("__new", F.lit(True)).unionByName(
                earlier.withColumn("__new", F.lit(False))
            ),
            self.order,
            {"pv": ("sum", F.col("__n"))},
            group,
        )
        return counted.where("__new").select(
            *group,
            (F.col(START) + self.size_ms).alias(END),
            F.lit("refire").alias("firing"),
            *self.order,
            "pv",
        )

    def _open_windows(self, batch: DataFrame, previous: int) -> tuple[DataFrame, int | None]:
        spark = batch.sparkSession
        if previous < 0:
            empty = (
                batch.limit(0)
                .select(*self.keys, window_start(F.col("ts_ms"), self.size_ms).alias(START))
                .selectExpr("*", "0L AS on_time", "0L AS late", "false AS fired")
            )
            return empty, None
        reached = spark.read.parquet(self._folder("reached", previous)).first()[0]
        return spark.read.parquet(self._folder("windows", previous)), reached

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/{BATCH}={batch_id}"

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self._folder(name, batch_id))

    def firings(self, spark: SparkSession) -> DataFrame:
        """All firings so far."""
        return spark.read.parquet(f"{self.path}/firings").drop(BATCH)

    def side(self, spark: SparkSession) -> DataFrame:
        """Rows that came too late."""
        return spark.read.parquet(f"{self.path}/side").drop(BATCH)

    def still_open(self, spark: SparkSession, last_batch: int | None = None) -> DataFrame:
        """What the windows not yet closed would give if the stream ended now."""
        if last_batch is None:
            last_batch = spark.read.parquet(f"{self.path}/reached").agg(F.max(BATCH)).first()[0]
        windows = spark.read.parquet(self._folder("windows", last_batch))
        return windows.where(~F.col("fired") & (F.col("on_time") > 0)).select(
            *self.keys,
            START,
            (F.col(START) + self.size_ms).alias(END),
            F.lit("first").alias("firing"),
            *[F.lit(None).cast("bigint").alias(c) for c in self.order],
            F.col("on_time").alias("pv"),
        )
