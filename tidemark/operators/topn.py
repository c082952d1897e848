"""The N most visited urls of each window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.windows import END, START, window_aggregate

# Fixed value: the name shown at a rank that no url reached.
NO_URL = "无"


def top_n(counts: DataFrame, n: int = 2, item: str = "url", count: str = "pv") -> DataFrame:
    """Ranks 1..n per window by count, ties by name; ``counts`` has one row per item and window."""
    by_rank = W.partitionBy(START, END).orderBy(F.col(count).desc(), F.col(item).asc())
    return (
        counts.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= n)
        .select(START, END, F.col("rank").cast("bigint").alias("rank"), item, count)
    )


def top_urls(
    df: DataFrame, size_ms: int, slide_ms: int | None = None, n: int = 2, item: str = "url"
) -> DataFrame:
    """Top ``n`` of each window, counted per item first."""
    return top_n(window_aggregate(df, [item], size_ms, slide_ms), n, item)


def pad_ranks(
    top: DataFrame, n: int = 2, item: str = "url", count: str = "pv", missing: str = NO_URL
) -> DataFrame:
    """Give every window all ranks 1..n; a missing one gets ``missing`` and count 0."""
    held = top.groupBy(START, END).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", F.struct(item, count)))).alias("__held")
    )
    ranks = F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(n).cast("bigint")))
    found = F.try_element_at("__held", F.col("rank"))
    return held.withColumn("rank", ranks).select(
        START,
        END,
        "rank",
        F.coalesce(found[item], F.lit(missing)).alias(item),
        F.coalesce(found[count], F.lit(0).cast("bigint")).alias(count),
    )
