"""Table view: SQL text over frames, projections, filters, changelogs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def create_view(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """A temporary view of chosen columns, in the given order."""
    view = df.select(*columns)
    view.createOrReplaceTempView(name)
    return view


def sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL with frames in braces: ``sql(spark, "select url from {t}", t=df)``."""
    return spark.sql(text, **tables)


def select_where(df: DataFrame, columns: Sequence[str], condition: Column | None = None) -> DataFrame:
    """Projection, then an optional filter on the projected columns."""
    picked = df.select(*columns)
    return picked if condition is None else picked.where(condition)
