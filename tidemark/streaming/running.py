"""Running counts per key on streams, in order, without a task per key.

Each micro-batch is counted as a table (a prefix scan, cut in chunks where a key is
hot) on top of the totals that the batch before left. A batch that is run again
replaces what it wrote. Rows of a later batch come after those of an earlier one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.scans import prefix_scan
from tidemark.streaming.sinks import BATCH


@dataclass
class RunningCounts:
    """Rows of a stream with ``n``, the rows of their key so far, and ``cnt``, those of
    them in which ``counted`` is not null (all, if it is not given)."""

    path: str
    keys: Sequence[str]
    order: Sequence[str]
    counted: str | None = None
    chunk_rows: int | None = None

    def start(self, stream: DataFrame, available_now: bool = True) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.take)
        writer = writer.option("checkpointLocation", f"{self.path}/state")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def take(self, batch: DataFrame, batch_id: int) -> None:
        keys, spark = list(self.keys), batch.sparkSession
        batch = batch.persist()
        try:
            hit = F.lit(1) if self.counted is None else F.col(self.counted).isNotNull().cast("int")
            counted = prefix_scan(
                batch,
                self.order,
                {"n": ("sum", F.lit(1).cast("bigint")), "cnt": ("sum", hit.cast("bigint"))},
                keys,
                chunk_rows=self.chunk_rows,
            )
            added = batch.groupBy(*keys).agg(
                F.count("*").alias("n"), F.sum(hit.cast("bigint")).alias("cnt")
            )
            if batch_id:
                before = spark.read.schema(added.schema).parquet(self._folder("totals", batch_id - 1))
                held = before.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("n").alias("__n"), F.col("cnt").alias("__cnt"))
                same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
                counted = counted.join(held, same, "left").withColumns(
                    {c: F.col(c) + F.coalesce(f"__{c}", F.lit(0)) for c in ("n", "cnt")}
                )
                added = before.unionByName(added).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("cnt").alias("cnt"))
            counted.select(*batch.columns, "n", "cnt").write.mode("overwrite").parquet(
                self._folder("data", batch_id)
            )
            added.write.mode("overwrite").parquet(self._folder("totals", batch_id))
        finally:
            batch.unpersist()

    def _folder(self, name: str, batch_id: int) -> str:
        return f"{self.path}/{name}/{BATCH}={batch_id}"

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows so far."""
        return spark.read.parquet(f"{self.path}/data").drop(BATCH)
