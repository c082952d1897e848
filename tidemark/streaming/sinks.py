"""Where streams end: console, tables in the shared folder, several labelled outputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import fresh_path

BATCH = "__batch"


def to_console(stream: DataFrame, label: str, mode: str = "append") -> StreamingQuery:
    """Print a stream; ``label`` names the query."""
    return stream.writeStream.queryName(label).format("console").outputMode(mode).start()


def start_table(
    stream: DataFrame,
    path: str,
    mode: str = "append",
    transform: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    label: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Write each micro-batch to its own folder under ``path``.

    A batch that is run again after a failure replaces its own folder, so every row
    lands once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{path}/data/{BATCH}={batch_id}")

    writer = stream.writeStream.foreachBatch(write).outputMode(mode)
    writer = writer.option("checkpointLocation", f"{path}/state")
    if label:
        writer = writer.queryName(label)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_table(stream: DataFrame, path: str, mode: str = "append", keys: Sequence[str] = ()) -> DataFrame:
    """What a stream has written: appended rows, or the last image of each key."""
    spark = stream.sparkSession
    schema = T.StructType([*stream.schema.fields, T.StructField(BATCH, T.LongType())])
    written = spark.read.schema(schema).parquet(f"{path}/data")
    if mode == "append":
        return written.drop(BATCH)
    values = [c for c in stream.columns if c not in keys]
    last = F.max_by(F.struct(*values), BATCH).alias("__last")
    return written.groupBy(*keys).agg(last).select(*keys, *[f"__last.{c}" for c in values])


def run_to_table(
    stream: DataFrame, label: str, mode: str = "append", keys: Sequence[str] = ()
) -> DataFrame:
    """Run over all input there is now, then give the result as a table."""
    path = fresh_path(stream.sparkSession, label)
    start_table(stream, path, mode).awaitTermination()
    return read_table(stream, path, mode, keys)


def fan_out(
    stream: DataFrame, path: str, routes: Mapping[str, Column], available_now: bool = True
) -> StreamingQuery:
    """One read of a stream, one output table per label (``<path>/<label>``)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for label, condition in routes.items():
                part = batch.where(condition)
                part.write.mode("overwrite").parquet(f"{path}/{label}/{BATCH}={batch_id}")
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", f"{path}/_state")
    return (writer.trigger(availableNow=True) if available_now else writer).start()
