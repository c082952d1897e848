"""A reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers that depend on their values alone: equal rows are counted first,
distinct ones are numbered within buckets of their hash, and a bucket starts where the one
before it ends. A Feistel network over pairs (left below ``left_size``, right below
``right_size``) permutes a domain just above the number of rows; a number that leaves the
rows walks on along its cycle until it is back. The permuted number gives shard and slot by
division, so both can be computed for any row number, and the row number for any shard and
slot (:meth:`Permutation.find`).

The law is ``rows``: shards differ by one row at most. Equal texts are therefore not kept
in one shard, as a group of copies may be larger than a shard.

Defined cases: every row counts, repeated ones each; null columns are values like others;
a null text has no bytes and the checksum of an empty one; an empty table gives an empty
result; input columns named ``shard`` or ``slot`` are left out by :func:`sharded`; columns
must be of types that can be grouped.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.session import cut_lineage

SHARDS = 24
#: Half rounds of the network, an even number.
ROUNDS = 8
#: Rows are numbered in at least so many buckets, of about so many rows if that takes more.
LEAST_BUCKETS = 4096
BUCKET_ROWS = 1 << 20
#: So many copies of one row are written out by one task at a time.
COPIES = 4096


def quotient(a: Column, b: Column) -> Column:
    """Integer division of longs, exact at any size."""
    return F.call_function("div", a, b)


class Permutation:
    """A seeded permutation of ``0 .. rows - 1``, as expressions both ways."""

    def __init__(self, spark: SparkSession, rows: int, seed: int = 17):
        self.rows = rows
        self.left_size = max(1, isqrt(max(0, rows - 1)) + 1)
        self.right_size = max(1, -(-rows // self.left_size))
        moduli = (self.left_size, self.right_size)
        self.rounds = [(seed * ROUNDS + i, moduli[i % 2]) for i in range(ROUNDS)]
        self.steps = self._longest_walk(spark)

    def _through(self, number: Column, back: bool = False) -> Column:
        """One pass through the network; ``back`` undoes it."""
        rounds = [F.struct(F.lit(k).cast("long").alias("key"), F.lit(m).cast("long").alias("size")) for k, m in self.rounds]
        size = F.lit(self.right_size).cast("long")
        halves = F.struct(quotient(number, size).alias("u"), F.pmod(number, size).alias("v"))

        def forth(s: Column, r: Column) -> Column:
            turned = F.pmod(s["u"] + F.pmod(F.xxhash64(r["key"], s["v"]), r["size"]), r["size"])
            return F.struct(s["v"].alias("u"), turned.alias("v"))

        def undo(s: Column, r: Column) -> Column:
            turned = F.pmod(s["v"] - F.pmod(F.xxhash64(r["key"], s["u"]), r["size"]), r["size"])
            return F.struct(turned.alias("u"), s["u"].alias("v"))

        if back:
            end = F.aggregate(F.array(*reversed(rounds)), halves, undo)
        else:
            end = F.aggregate(F.array(*rounds), halves, forth)
        return end["u"] * size + end["v"]

    def _longest_walk(self, spark: SparkSession) -> int:
        """Passes until the last number is back among the rows.

        Only numbers from ``rows`` on, fewer than ``left_size``, lie on a walk's way;
        walks enter at those that a row is sent to.
        """
        domain = self.left_size * self.right_size
        steps = 1
        away = spark.range(self.rows, domain).where(self._through(F.col("id"), back=True) < self.rows)
        while away.count():
            away = away.select(self._through(F.col("id")).alias("id")).where(F.col("id") >= self.rows)
            steps += 1
        return steps

    def _walk(self, number: Column, back: bool) -> Column:
        once = self._through(number, back)
        if self.steps == 1:
            return once
        more = F.sequence(F.lit(2), F.lit(self.steps))
        return F.aggregate(
            more, once, lambda at, _: F.when(at < self.rows, at).otherwise(self._through(at, back))
        )

    def place(self, number: Column) -> Column:
        """Where the row with this number goes."""
        return self._walk(number.cast("long"), back=False)

    def find(self, place: Column) -> Column:
        """The number of the row that goes there."""
        return self._walk(place.cast("long"), back=True)


def numbered(df: DataFrame, rows: int) -> DataFrame:
    """``row`` (all columns) and ``number``: 0 to ``rows - 1``, by the values alone.

    Equal rows are told apart by nothing and get neighbouring numbers.
    """
    buckets = max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
    counted = (
        df.select(F.struct("*").alias("row"))
        .groupBy("row")
        .agg(F.count("*").alias("copies"))
        .withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    )
    until = W.partitionBy("bucket").orderBy("row").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = counted.groupBy("bucket").agg(F.sum("copies").alias("held")).select(
        "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start")
    )
    first = F.col("start") + F.sum("copies").over(until) - F.col("copies")
    spans = cut_lineage(
        counted.join(starts, "bucket").select("row", "copies", first.alias("first"))
    )
    end = F.col("first") + F.col("copies") - 1
    few = spans.where(F.col("copies") <= COPIES).select(
        "row", F.explode(F.sequence("first", end)).alias("number")
    )
    many = (
        spans.where(F.col("copies") > COPIES)
        .select("row", end.alias("end"), F.explode(F.sequence("first", end, F.lit(COPIES).cast("long"))).alias("first"))
        .repartition("first")
    )
    last = F.least(F.col("first") + COPIES - 1, "end")
    return few.unionByName(many.select("row", F.explode(F.sequence("first", last)).alias("number")))


def sharded(df: DataFrame, shards: int = SHARDS, seed: int = 17) -> DataFrame:
    """The rows of ``df`` with ``shard`` and ``slot``, gapless from 0 in each shard."""
    df = df.drop("shard", "slot")
    rows = df.count()
    place = Permutation(df.sparkSession, rows, seed).place(F.col("number"))
    placed = numbered(df, rows).select("row", place.alias("place"))
    return placed.select(
        "row.*",
        F.pmod("place", F.lit(shards)).cast("int").alias("shard"),
        quotient(F.col("place"), F.lit(shards).cast("long")).alias("slot"),
    )


@query()
def op13_sharding(spark, folder):
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
