"""Split one table or stream into several, and bring several into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUTE = "route"


def with_route(df: DataFrame, routes: Mapping[str, Column], rest: str = "main") -> DataFrame:
    """Add ``route``: the first label whose condition holds, else ``rest``."""
    label: Column | None = None
    for name, condition in routes.items():
        label = (F if label is None else label).when(condition, F.lit(name))
    return df.withColumn(ROUTE, F.lit(rest) if label is None else label.otherwise(F.lit(rest)))


def take_route(routed: DataFrame, label: str) -> DataFrame:
    """The rows of one route, as its own table or stream."""
    return routed.where(F.col(ROUTE) == label).drop(ROUTE)


def split_by(df: DataFrame, conditions: Mapping[str, Column]) -> dict[str, DataFrame]:
    """One filtered frame per condition; each is pushed down to its own scan."""
    return {name: df.where(condition) for name, condition in conditions.items()}


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union of frames of one type; duplicates stay.

    On streams the watermark of the union is that of the slowest input, Spark's
    default ``multipleWatermarkPolicy``.
    """
    for other in others:
        first = first.unionByName(other)
    return first


def connect(inputs: Mapping[str, tuple[DataFrame, Mapping[str, Column]]]) -> DataFrame:
    """Bring frames of different types to one set of columns, tagged by ``src``."""
    frames = [
        df.select(F.lit(name).alias("src"), *[c.alias(n) for n, c in columns.items()])
        for name, (df, columns) in inputs.items()
    ]
    return union_all(*frames)


def place(df: DataFrame, target: Column, classes: int, splits: int = 1, spread: Sequence[str] = ()) -> DataFrame:
    """Put each row in the partition its ``target`` class names.

    With ``splits`` > 1 a class fills that many partitions, chosen by the hash of
    ``spread``: partition ``p`` then holds class ``p % classes``, and no class is
    bound to one task.
    """
    slot = target.cast("int")
    if splits > 1:
        piece = F.pmod(F.xxhash64(*spread), F.lit(splits)).cast("int")
        slot = slot + piece * F.lit(classes)
    return df.repartitionById(classes * splits, slot)
