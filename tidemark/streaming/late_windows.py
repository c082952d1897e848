"""Late rows on a stream for any accumulator: windows that fire again, and a side output.

Each open window is stored by itself, as the accumulators of its keys. A micro-batch reads
and rewrites only the windows that its rows touch, reads those that close to fire them, and forgets
those past their lateness; all others stay as they lie. Which version of a window
holds is written down per micro-batch (one row per open window), so a batch that is run
again starts from what its predecessor left and replaces what it wrote itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import lateness
from tidemark.operators.accumulators import HELD, PART, Accumulator, finished, merged, partials
from tidemark.operators.lateness import CLASS, DROPPED, LATE, ON_TIME
from tidemark.operators.windows import END, START
from tidemark.session import cut_lineage
from tidemark.streaming.sinks import BATCH

MANIFEST = f"{START} bigint, version bigint"


@dataclass
class LateWindows:
    """Firings per key and tumbling window with ``lateness_ms``, over micro-batches."""

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    accumulator: Accumulator
    size_ms: int
    delay_ms: int = 0
    lateness_ms: int = 0
    chunk_rows: int | None = None

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.take)
        writer = writer.option("checkpointLocation", f"{self.path}/state")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """Classify one micro-batch, fire windows, and hand the open ones on."""
        spark, group = batch.sparkSession, [*self.keys, START]
        batch = batch.persist()
        try:
            reached, versions = self._left_by(spark, batch_id - 1)
            top = batch.agg(F.max("ts_ms")).first()[0]
            now = max((t for t in (reached, top) if t is not None), default=None)
            rows = cut_lineage(self._classified(batch, reached))
            self._write(rows.where(F.col(CLASS) == DROPPED).select(*batch.columns), "side", batch_id)
            on_time = rows.where(F.col(CLASS) == ON_TIME).drop(CLASS)
            late = rows.where(F.col(CLASS) == LATE).drop(CLASS)
            # As many numbers as the batch touches windows.
            touched = {r[0] for r in rows.where(F.col(CLASS) != DROPPED).select(START).distinct().collect()}
            closing = {w for w in touched | versions.keys() if self._closes(w, now) and not self._closes(w, reached)}

            held = self._held(batch, {w: v for w, v in versions.items() if w in touched | closing})
            parts = held.withColumn(PART, F.lit(-1).cast("long")).unionByName(
                partials(on_time, group, self.accumulator)
            )
            openings = cut_lineage(merged(parts, group, self.accumulator, done=False))
            fired = lateness.firings(
                openings.where(self._among(closing)), openings, late, self.keys, self.order,
                self.size_ms, self.accumulator, self.chunk_rows,
            )
            self._write(fired, "firings", batch_id)

            kept = {w for w in touched if now is None or w + self.size_ms + self.delay_ms + self.lateness_ms > now}
            parts = openings.withColumn(PART, F.lit(-1).cast("long")).unionByName(
                partials(late, group, self.accumulator)
            )
            after = merged(parts.where(self._among(kept)), group, self.accumulator, done=False)
            for_windows = after.withColumn("window", F.col(START)).repartition("window")
            for_windows.write.mode("overwrite").partitionBy("window").parquet(self._folder("windows", batch_id))
            left = {w: v for w, v in versions.items() if now is None or w + self.size_ms + self.delay_ms + self.lateness_ms > now}
            left |= dict.fromkeys(kept, batch_id)
            self._write(spark.createDataFrame(sorted(left.items()), MANIFEST), "manifest", batch_id)
            self._write(spark.createDataFrame([(now,)], "reached bigint"), "reached", batch_id)
        finally:
            batch.unpersist()

    def _closes(self, window: int, reached: int | None) -> bool:
        return reached is not None and window + self.size_ms + self.delay_ms <= reached

    def _among(self, windows: set[int]) -> Column:
        return F.col(START).isin(*sorted(windows)) if windows else F.lit(False)

    def _classified(self, batch: DataFrame, reached: int | None) -> DataFrame:
        rows = lateness.classify(
            batch, self.order, self.size_ms, delay_ms=self.delay_ms, lateness_ms=self.lateness_ms
        )
        if reached is None:
            return rows
        # What earlier batches reached holds for every row of this one.
        ends = F.col(START) + F.lit(self.size_ms + self.delay_ms)
        before = F.when(ends + F.lit(self.lateness_ms) <= reached, DROPPED).when(
            (ends <= reached) & (F.col(CLASS) == ON_TIME), LATE
        )
        return rows.withColumn(CLASS, F.coalesce(before, F.col(CLASS)))

    def _left_by(self, spark: SparkSession, batch_id: int) -> tuple[int | None, dict[int, int]]:
        if batch_id < 0:
            return None, {}
        reached = spark.read.parquet(self._folder("reached", batch_id)).first()[0]
        # One row per open window.
        manifest = spark.read.schema(MANIFEST).parquet(self._folder("manifest", batch_id))
        return reached, {r[0]: r[1] for r in manifest.collect()}

    def _held(self, rows: DataFrame, versions: dict[int, int]) -> DataFrame:
        """The accumulators of stored windows; ``rows`` gives the types of the keys."""
        spark = rows.sparkSession
        fields = [T.StructField(k, rows.schema[k].dataType) for k in self.keys]
        schema = T.StructType([*fields, T.StructField(START, T.LongType()), T.StructField(HELD, T.BinaryType())])
        by_batch: dict[int, list[int]] = {}
        for window, version in versions.items():
            by_batch.setdefault(version, []).append(window)
        parts = [
            spark.read.schema(schema).parquet(*[f"{self._folder('windows', v)}/window={w}" for w in ws])
            for v, ws in by_batch.items()
        ]
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)

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

    def still_open(self, spark: SparkSession) -> DataFrame:
        """What the windows not yet closed would give if the stream ended now."""
        last = spark.read.parquet(f"{self.path}/reached").agg(F.max(BATCH)).first()[0]
        reached, versions = self._left_by(spark, last)
        waiting = {w: v for w, v in versions.items() if not self._closes(w, reached)}
        fired = self.firings(spark)
        results = finished(self._held(fired, waiting), [*self.keys, START], self.accumulator)
        return results.withColumns(
            {END: F.col(START) + self.size_ms, "firing": F.lit("first")}
            | {c: F.lit(None).cast("bigint") for c in self.order}
        ).select(*fired.columns)
