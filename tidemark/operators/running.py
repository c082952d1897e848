"""Running results: one output row per input row, in arrival order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.accumulators import Accumulator, Reduced, running_accumulate
from tidemark.plans.chunks import CHUNK, plan_chunks
from tidemark.plans.scans import prefix_scan


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    order: Sequence[str],
    name: str = "total",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running sum of ``value`` per key."""
    return prefix_scan(df, order, {name: ("sum", value)}, keys, chunk_rows=chunk_rows)


def running_count(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str = "cnt",
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running number of rows per key."""
    one = F.lit(1).cast("bigint")
    return running_sum(df, keys, one, order, name, chunk_rows)


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    function: Callable[[dict, dict], dict],
    schema: str,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Running reduce per key by any associative ``function`` of two records.

    ``schema`` names the columns of a record, all of them columns of ``df``. Gives ``keys``,
    ``order`` and, as ``schema`` says, the record reduced from the key's rows up to each; the
    first row of a key gives its own.
    """
    reduced = Reduced(schema, function)
    renamed = {c: f"__row_{c}" for c in dict.fromkeys([*keys, *order]) if c in reduced.columns}
    rows = df.select(
        *[F.col(c).alias(renamed.get(c, c)) for c in dict.fromkeys([*keys, *order])], *reduced.columns
    )
    own = lambda names: [renamed.get(c, c) for c in names]
    out = running_accumulate(rows, own(keys), own(order), _Named(reduced), chunk_rows=chunk_rows)
    kept = [F.col(renamed.get(c, c)).alias(c) for c in dict.fromkeys([*keys, *order]) if c not in renamed]
    return out.select(*kept, *[F.col(f"__reduced_{c}").alias(c) for c in reduced.columns])


class _Named(Accumulator):
    """An accumulator whose results have names of their own."""

    def __init__(self, inner: Reduced):
        types = T.StructType.fromDDL(inner.schema).fields
        self.schema = ", ".join(f"`__reduced_{f.name}` {f.dataType.simpleString()}" for f in types)
        self.create, self.add, self.merge, self.finish = inner.create, inner.add, inner.merge, inner.finish


def most_active(df: DataFrame, user: str, seq: str) -> DataFrame:
    """The user with most rows; on a tie, the one whose last row came last."""
    counts = df.groupBy(user).agg(F.count("*").alias("cnt"), F.max(seq).alias("last_seq"))
    best = F.max(F.struct("cnt", "last_seq", user)).alias("best")
    return counts.agg(best).select(f"best.{user}", "best.cnt")


def running_leader(
    df: DataFrame, user: str, seq: str, chunk_rows: int | None = None
) -> DataFrame:
    """After every row, the user with most rows so far and that count.

    A newer count wins a tie. ``seq`` is the unique arrival number.
    """
    chunks = plan_chunks(df, [seq], chunk_rows=chunk_rows)
    rows = chunks.assign(df.select(seq, user))
    per_chunk = rows.groupBy(CHUNK, user).agg(
        F.count("*").alias("__n"), F.max(seq).alias("__last")
    )
    # A user's count is highest at its last row in a chunk, so the summary alone
    # gives both the counts and the leader each chunk starts with.
    counted = per_chunk.withColumn("__upto", F.sum("__n").over(W.partitionBy(user).orderBy(CHUNK)))
    best = (
        counted.groupBy(CHUNK)
        .agg(F.max(F.struct(F.col("__upto").alias("cnt"), F.col("__last").alias("at"), F.col(user).alias("who"))).alias("__best"))
    )
    leader = F.max("__best").over(W.orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1))
    leaders = best.select(CHUNK, leader.alias("__lead")).where(F.col("__lead").isNotNull())
    starts = counted.select(
        CHUNK, user, (F.col("__upto") - F.col("__n")).alias("__one")
    ).where(F.col("__one") > 0)

    stacked = (
        rows.select(CHUNK, seq, user, F.lit(1).cast("bigint").alias("__one"))
        .unionByName(starts, allowMissingColumns=True)
        .unionByName(leaders, allowMissingColumns=True)
    )
    placed = chunks.place(stacked)
    per_user = W.partitionBy(CHUNK, user).orderBy(F.col(seq).asc_nulls_first())
    in_chunk = W.partitionBy(CHUNK).orderBy(F.col(seq).asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, 0
    )
    candidate = F.coalesce(
        "__lead",
        F.when(
            F.col(seq).isNotNull(),
            F.struct(F.col("__cnt").alias("cnt"), F.col(seq).alias("at"), F.col(user).alias("who")),
        ),
    )
    return (
        placed.withColumn("__cnt", F.sum("__one").over(per_user))
        .withColumn("__top", F.max(candidate).over(in_chunk))
        .where(F.col(seq).isNotNull())
        .select(seq, F.col("__top.who").alias(user), F.col("__top.cnt").alias("cnt"))
    )


def changelog_count(
    df: DataFrame,
    user: str,
    counted: str,
    order: Sequence[str],
    chunk_rows: int | None = None,
) -> DataFrame:
    """Changes of ``count(counted) group by user`` as rows come in.

    ``+I`` for a user's first row, then ``-U`` with the old and ``+U`` with the new
    count; a row that leaves the count as it is gives nothing.
    """
    hit = F.col(counted).isNotNull().cast("bigint")
    counts = prefix_scan(
        df,
        order,
        {"__n": ("sum", F.lit(1).cast("bigint")), "__cnt": ("sum", hit)},
        [user],
        chunk_rows=chunk_rows,
    )
    return changes_of(counts.withColumnsRenamed({"__n": "n", "__cnt": "cnt"}), [*order, user], hit)


def changes_of(counts: DataFrame, columns: Sequence[str], hit: Column) -> DataFrame:
    """Changes from running ``n`` and ``cnt``: ``columns, row_kind, cnt``."""
    change = lambda kind, cnt: F.struct(F.lit(kind).alias("row_kind"), cnt.alias("cnt"))
    new = F.col("cnt")
    changes = (
        F.when(F.col("n") == 1, F.array(change("+I", new)))
        .when(hit == 1, F.array(change("-U", new - 1), change("+U", new)))
    )
    return counts.select(*columns, F.explode(changes).alias("__c")).select(
        *columns, "__c.row_kind", "__c.cnt"
    )


def average_of_every(
    df: DataFrame,
    user: str,
    value: str,
    order: Sequence[str],
    size: int = 5,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Mean of ``value`` over each full group of ``size`` rows of a user, in order."""
    counted = running_count(df, [user], order, "__n", chunk_rows)
    group = F.floor((F.col("__n") - 1) / size).cast("bigint")
    return (
        counted.groupBy(user, group.alias("group_no"))
        .agg(F.avg(value).alias("avg_value"), F.count("*").alias("__size"))
        .where(F.col("__size") == size)
        .drop("__size")
    )
