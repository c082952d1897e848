"""Event sources: literal rows, Parquet tables, Parquet folders as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.time import epoch_ms
from tidemark.session import fresh_path


def from_elements(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Literal rows, with ``seq`` holding their order from 1."""
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    with_seq = T.StructType([T.StructField("seq", T.LongType()), *schema.fields])
    return spark.createDataFrame(numbered, with_seq)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_clicks(events: DataFrame) -> DataFrame:
    """``seq, user, url, ts_ms`` view of the ``events`` table."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("user"),
        F.col("event_type").alias("url"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return as_clicks(table(spark, folder, "events"))


def stream_table(
    spark: SparkSession, folder: str, name: str, files_per_batch: int = 1000
) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream."""
    schema = table(spark, folder, name).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    # A stream cannot start from a single file's path, but from a pattern it can.
    return reader.parquet(f"{folder}/{name}.parquet*")


def stream_clicks(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Clicks as a stream, with the TIMESTAMP column ``ts`` that watermarks need."""
    return with_event_time(as_clicks(stream_table(spark, folder, "events", files_per_batch)))


def with_event_time(df: DataFrame, delay: str | None = None) -> DataFrame:
    """Add ``ts`` from ``ts_ms``; on a stream also its watermark, ``delay`` behind."""
    timed = df.withColumn("ts", F.timestamp_millis("ts_ms"))
    return timed.withWatermark("ts", delay) if delay and df.isStreaming else timed


def staged_stream(
    df: DataFrame,
    order: Sequence[str],
    batches: int = 3,
    files_per_batch: int = 1,
    ends: Sequence[DataFrame] = (),
) -> DataFrame:
    """``df`` as a stream that comes in several micro-batches, along ``order``.

    The rows are cut at quantiles of the first order column and written to the shared
    folder batch after batch; the stream takes the files in the order they were written.
    ``ends`` are further micro-batches, such as rows that only move the watermark on.
    """
    spark, path = df.sparkSession, fresh_path(df.sparkSession, "staged")
    steps = [i / batches for i in range(1, batches)]
    (cuts,) = df.agg(F.percentile_approx(order[0], steps)).first()
    cuts = sorted(set(cuts or []))
    part = sum((F.when(F.col(order[0]) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows = df.withColumn("__part", part).persist()
    try:
        for i in range(len(cuts) + 1):
            rows.where(F.col("__part") == i).drop("__part").repartition(files_per_batch).write.parquet(
                f"{path}/{i:03d}"
            )
        for i, end in enumerate(ends, start=len(cuts) + 1):
            end.select(*df.columns).repartition(files_per_batch).write.parquet(f"{path}/{i:03d}")
    finally:
        rows.unpersist()
    reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path}/*")
