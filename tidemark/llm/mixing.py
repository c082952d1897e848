"""Mix sources to target weights by capped water-filling.

Each source wants a share of all words in proportion to its weight, but gives at
most ``max_epochs`` times what it has. What a capped source cannot take goes to the
others by weight, until no target is above its cap. Targets are found exactly by one
sweep over the sources sorted by cap per weight: the capped ones are a prefix.

Every row is then taken ``floor(rate)`` times whole, and a seeded rounding decides
how many words of one more, partial repetition follow. Expected words are exact for
each document, so a source meets its target up to the rounding.

Defined cases: null or blank text has size 0 and is never taken; a null source is a
source of its own, last in order; repeated rows count each time; an empty table gives
an empty mix; other columns of the input are ignored (``take``) or carried (``mixed``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
MAX_EPOCHS = 3.0
WEIGHTS = (5, 2, 1)
#: Beyond this many sources the table of targets is joined by a shuffle.
BROADCAST_SOURCES = 20_000


def word_count(text: Column) -> Column:
    """Number of words; 0 for null. Runs of blanks become one, so words are gaps plus one."""
    packed = F.btrim(F.regexp_replace(text, BLANKS, " "), F.lit(" "))
    gaps = F.length(packed) - F.length(F.replace(packed, F.lit(" "), F.lit("")))
    return F.when(F.coalesce(packed, F.lit("")) == "", 0).otherwise(gaps + 1).cast("long")


def water_fill(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to one row per source with ``source_size`` and ``weight``.

    The sweep runs in one task over one row per source.
    """
    capped = sources.withColumn("__cap", F.col("source_size") * F.lit(float(max_epochs)))
    sweep = W.orderBy(F.col("__cap") / F.col("weight"), "source")
    before, rest = sweep.rowsBetween(W.unboundedPreceding, -1), sweep.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    level = left / F.sum("weight").over(rest)
    swept = capped.withColumn("__full", F.col("__cap") <= level * F.col("weight"))
    taken = F.sum(F.when(F.col("__full"), F.col("__cap")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(~F.col("__full"), F.col("weight"))).over(everything)
    share = (F.sum("source_size").over(everything) - taken) / open_weight * F.col("weight")
    return swept.select(
        "source", "source_size", "weight",
        F.when(F.col("__full"), F.col("__cap")).otherwise(share).alias("target"),
    )


def take(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    max_epochs: float = MAX_EPOCHS,
    seed: int = 17,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, whole, part``, one row per input row.

    ``weights`` go to the sources in code-point order, null last, repeating.
    """
    sized = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")
    )
    targets = cut_lineage(water_fill(sources.withColumn("weight", weight), max_epochs))
    if targets.count() <= BROADCAST_SOURCES:
        targets = F.broadcast(targets)
    targets = targets.withColumnRenamed("source", "__source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("__source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    uniform = F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    most = (F.col("size") * F.lit(float(max_epochs))).cast("long")
    drawn = F.least(F.floor(F.col("size") * rate + uniform).cast("long"), most)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", drawn.alias("taken")
    ).select(
        "*",
        whole.cast("long").alias("whole"),
        (F.col("taken") - whole * F.col("size")).cast("long").alias("part"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents with the columns of ``docs``: a row per whole repetition,
    and one with the words of the partial repetition, joined by single spaces.

    The partial repetition starts at a seeded word and goes on from the first word after
    the last. Repeated rows are each repeated alike.
    """
    columns = docs.columns
    plan = take(docs, **options).groupBy("doc_id", "source", "size").agg(
        F.first("whole").alias("__whole"), F.first("part").alias("__part")
    )
    plan = plan.toDF("__doc", "__src", "__size", "__whole", "__part")
    joined = docs.withColumn("__words", word_count(F.col("text"))).join(
        plan,
        F.col("doc_id").eqNullSafe(F.col("__doc"))
        & F.col("source").eqNullSafe(F.col("__src"))
        & (F.col("__words") == F.col("__size")),
    )
    words = F.split(F.btrim(F.regexp_replace("text", BLANKS, " "), F.lit(" ")), " ")
    start = F.pmod(F.xxhash64(F.lit(23), "doc_id"), F.greatest(F.col("__words"), F.lit(1)))
    first = F.least(F.col("__part"), F.col("__words") - start)
    piece = F.concat(
        F.slice(words, (start + 1).cast("int"), first.cast("int")),
        F.slice(words, 1, (F.col("__part") - first).cast("int")),
    )
    copies = F.transform(F.sequence(F.lit(1), F.col("__whole")), lambda _: F.col("text"))
    copies = F.when(F.col("__whole") > 0, copies).otherwise(F.array().cast("array<string>"))
    part = F.when(F.col("__part") > 0, F.array(F.array_join(piece, " "))).otherwise(
        F.array().cast("array<string>")
    )
    out = joined.withColumn("__text", F.explode(F.concat(copies, part)))
    changed = {"text": F.col("__text")}
    if "n_chars" in columns:
        changed["n_chars"] = F.length("__text").cast(docs.schema["n_chars"].dataType)
    return out.withColumns(changed).select(*columns)


@query()
def op8_mixing(spark, folder):
    return take(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "whole", "part", "source"
    )
