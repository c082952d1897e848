"""Row-wise work: tokenise, parse, render, map with set-up and tear-down."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words


def tokenize(lines: DataFrame, column: str = "value") -> DataFrame:
    """``word, one`` pairs of every line."""
    return lines.select(F.explode(words(F.col(column))).alias("word")).withColumn(
        "one", F.lit(1).cast("bigint")
    )


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Final count per word; on a stream, the updating count."""
    return tokenize(lines, column).groupBy("word").agg(F.sum("one").alias("cnt"))


def parse_clicks(lines: DataFrame, *, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """``user,url,epoch_ms`` lines to columns.

    A bad line fails the job; with ``strict=False`` it gives ``bad = true`` and
    nulls, so that it can be routed aside.
    """
    part = F.split("value", ",")
    ts_ms = F.get(part, F.lit(2)).try_cast("bigint")
    if strict:
        fail = F.raise_error(F.concat(F.lit("bad line: "), F.col("value"))).cast("bigint")
        checked = F.when(F.col("value").isNotNull() & ts_ms.isNull(), fail).otherwise(ts_ms)
        return lines.select(
            *keep,
            F.get(part, F.lit(0)).alias("user"),
            F.get(part, F.lit(1)).alias("url"),
            checked.alias("ts_ms"),
        )
    return lines.select(
        *keep,
        "value",
        F.get(part, F.lit(0)).alias("user"),
        F.get(part, F.lit(1)).alias("url"),
        ts_ms.alias("ts_ms"),
        ts_ms.isNull().alias("bad"),
    )


def event_time_of_line(line: Column) -> Column:
    """Event time of a line that stays text: its third field."""
    return F.element_at(F.split(line, ","), 3).cast("bigint")


def user_and_url(user: Column, url: Column) -> Column:
    """``user[url]``."""
    return F.concat(user.cast("string"), F.lit("["), url, F.lit("]"))


def map_with_lifecycle(
    df: DataFrame,
    schema: str,
    apply: Callable[[Any, pd.DataFrame], pd.DataFrame],
    open: Callable[[int], Any] = lambda partition: None,
    close: Callable[[Any], None] = lambda resource: None,
) -> DataFrame:
    """Map Arrow batches with one ``open`` before and one ``close`` after each task.

    For code that needs a resource per task; plain expressions should stay columns.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open(TaskContext.get().partitionId())
        try:
            for batch in batches:
                yield apply(resource, batch)
        finally:
            close(resource)

    return df.mapInPandas(run, schema)
