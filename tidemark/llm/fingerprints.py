"""Document fingerprints that subtract: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs at line and sentence ends. The digests of its distinct
paragraphs go into cells of three sub-tables; a cell holds a count, the exclusive or
of its digests, and the exclusive or of their check hashes. Two sketches subtract cell
by cell. Peeling then recovers the digests held by one version only: a cell with one
digest left gives it away, and its removal frees other cells. Where peeling gets stuck,
it is retried on larger sketches, and at last the digest sets are compared directly.

Likeness is shared over all distinct digests. Everything is DataFrame functions.

Defined cases: null text is empty text; an empty text has no paragraphs, and two such
are alike; repeated paragraphs count once; rows that repeat a doc_id each get a row, and
"the next document" is the smallest text of the next doc_id (the first after the last,
itself if it is alone); a null doc_id comes first; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table

#: Cells per sub-table of the fingerprint, then of the larger sketches when peeling fails.
SIZES = (8, 24)
TABLES = 3
ROUNDS = 8
PARAGRAPH_END = r"\n+|(?<=[.!?])[ \t]+"
#: Documents per range of ids in which the next document is looked up.
RANGE_ROWS = 2_000
MOST_RANGES = 4_096


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where lambdas below repeat it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digests(text: Column) -> Column:
    """Distinct paragraph digests, ascending; never 0."""
    pieces = F.filter(F.split(text, PARAGRAPH_END), lambda p: p != "")
    hashed = F.transform(pieces, lambda p: F.xxhash64(p))
    return F.array_sort(F.array_distinct(hashed))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(97)).bitwiseAND(F.lit(0xFFFFFFFF))


def _slot(digest: Column, sub: Column, width: int) -> Column:
    return F.pmod(F.xxhash64(digest, sub), F.lit(width)).cast("int")


def cells(keys: Column, width: int) -> Column:
    """The sketch of ``keys``: ``TABLES * width`` cells of (count, key, check)."""
    entries = F.transform(
        keys,
        lambda k: F.struct(
            k.alias("k"), _check(k).alias("h"), *[_slot(k, F.lit(j), width).alias(f"s{j}") for j in range(TABLES)]
        ),
    )
    none = F.struct(
        F.lit(0).alias("c"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("h")
    )

    def sub(bound: Column, j: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(width - 1)),
            lambda i: F.aggregate(
                F.filter(bound, lambda e: e[f"s{j}"] == i),
                none,
                lambda a, e: F.struct(
                    (a["c"] + 1).alias("c"), a["k"].bitwiseXOR(e["k"]).alias("k"), a["h"].bitwiseXOR(e["h"]).alias("h")
                ),
            ),
        )

    return _bound(entries, lambda bound: F.concat(*[sub(bound, j) for j in range(TABLES)]))


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(
        a, b,
        lambda x, y: F.struct(
            (x["c"] - y["c"]).alias("c"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["h"].bitwiseXOR(y["h"]).alias("h")
        ),
    )


def peel(difference: Column, width: int) -> Column:
    """``(cells, found)`` after peeling; decoded if all cells are empty.

    Each round takes out the digests of all cells that hold one alone.
    """
    start = F.struct(
        difference.alias("cells"), F.array().cast("array<bigint>").alias("found")
    )

    def pure(c: Column) -> Column:
        return (F.abs(c["c"]) == 1) & (c["h"] == _check(c["k"]))

    def step(state: Column, _: Column) -> Column:
        singles = F.array_distinct(
            F.transform(
                F.filter(state["cells"], pure),
                lambda c: F.struct(
                    c["k"].alias("k"),
                    c["c"].alias("c"),
                    c["h"].alias("h"),
                    *[_slot(c["k"], F.lit(j), width).alias(f"s{j}") for j in range(TABLES)],
                ),
            )
        )
        return _bound(singles, lambda bound: lift(state, bound))

    def lift(state: Column, singles: Column) -> Column:
        def lifted(c: Column, i: Column) -> Column:
            sub = F.floor(i / width).cast("int")
            mine = F.filter(
                singles,
                lambda s: F.when(sub == 0, s["s0"]).when(sub == 1, s["s1"]).otherwise(s["s2"]) == i % width,
            )
            return F.aggregate(
                mine,
                c,
                lambda a, s: F.struct(
                    (a["c"] - s["c"]).alias("c"),
                    a["k"].bitwiseXOR(s["k"]).alias("k"),
                    a["h"].bitwiseXOR(s["h"]).alias("h"),
                ),
            )

        return F.when(F.size(singles) == 0, state).otherwise(
            F.struct(
                F.transform(state["cells"], lifted).alias("cells"),
                F.concat(state["found"], F.transform(singles, lambda s: s["k"])).alias("found"),
            )
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def decoded(state: Column) -> Column:
    empty = F.forall(state["cells"], lambda c: (c["c"] == 0) & (c["k"] == 0) & (c["h"] == 0))
    return F.when(empty, F.size(state["found"]))


def written(sketch: Column) -> Column:
    """The sketch as text: count, key and check of each cell."""
    return F.array_join(
        F.transform(
            sketch,
            lambda c: F.when(c["c"] == 0, "").otherwise(
                F.concat_ws(":", c["c"].cast("string"), F.hex(c["k"]), F.hex(c["h"]))
            ),
        ),
        ";",
    )


def with_likeness(df: DataFrame, name: str, a: str, b: str) -> DataFrame:
    """Add the likeness of digest columns ``a`` and ``b``, with their sketches in
    ``a_cells`` and ``b_cells``."""
    small, large = SIZES
    state = peel(subtract(F.col(f"{a}_cells"), F.col(f"{b}_cells")), small)
    df = df.withColumn("__d0", decoded(state))
    # A sketch this full hardly ever peels: the larger one is tried at once beyond it.
    retried = decoded(peel(subtract(cells(F.col(a), large), cells(F.col(b), large)), large))
    df = df.withColumn("__d1", F.when(F.col("__d0").isNull() & _may_peel(a, b, large), retried))
    shared = F.size(F.array_intersect(a, b))
    direct = F.size(a) + F.size(b) - 2 * shared
    differing = F.coalesce("__d0", "__d1", direct)
    total = F.size(a) + F.size(b)
    union = (total + differing) / 2
    likeness = F.when(union == 0, 1.0).otherwise((total - differing) / 2 / union)
    return df.withColumn(name, likeness.cast("double")).drop("__d0", "__d1")


def _may_peel(a: str, b: str, width: int) -> Column:
    """Sizes so far apart that the cells cannot hold the difference need no retry."""
    return F.abs(F.size(a) - F.size(b)) <= TABLES * width


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text``: each row with the text of the next doc_id.

    Ids are cut into ranges at quantiles. Each range also gets the first row of the
    ranges after it, so the texts cross the network once.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.where(F.col("doc_id").isNotNull())
    n = known.count()
    parts = int(max(1, min(MOST_RANGES, n // RANGE_ROWS)))
    steps = [i / parts for i in range(1, parts)]
    cut: list[int] = []
    if steps:
        (found,) = known.agg(F.percentile_approx("doc_id", steps, 10 * parts)).first()
        cut = sorted(set(found or []))
    coarse = [cut[i] for i in range(0, len(cut), 64)]
    fine = [cut[i : i + 64] for i in range(0, len(cut), 64)]

    def below(borders: Column, value: Column) -> Column:
        return F.size(F.filter(borders, lambda b: b <= value))

    def longs(values: list[int]) -> Column:
        return F.expr(f"array({', '.join(f'{v}L' for v in values)})")

    if cut:
        group = below(longs(coarse), F.col("doc_id"))
        nested = F.array(*[longs(f) for f in fine])
        inner = below(F.element_at(nested, F.greatest(group, F.lit(1))), F.col("doc_id"))
        part = F.when(group == 0, 0).otherwise((group - 1) * 64 + inner)
        part = F.coalesce(part, F.lit(0)).cast("int")
    else:
        part = F.lit(0)
    rows = rows.withColumn("part", part)
    # The first row of each range, one per range, goes to the range before it.
    firsts = rows.groupBy("part").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    around = F.lag("part").over(W.orderBy("part"))
    last = F.max("part").over(W.partitionBy())
    carried = firsts.select(
        F.coalesce(around, last).alias("part"),
        F.col("first.doc_id").alias("doc_id"),
        F.col("first.text").alias("text"),
        F.lit(True).alias("carry"),
        around.isNull().alias("wraps"),
    )
    stacked = rows.withColumns({"carry": F.lit(False), "wraps": F.lit(False)}).unionByName(carried)
    # Ranges border on ids, so the rows of one id share a range: the next id begins at
    # the first row whose id differs, and its first text is its smallest.
    frame = W.partitionBy("part").orderBy("carry", "wraps", F.col("doc_id").asc_nulls_first(), "text")
    ahead = F.lead(F.struct("carry", "doc_id", "text")).over(frame)
    stepped = stacked.withColumn("ahead", ahead)
    changes = F.when(
        F.col("ahead.carry").isNotNull()
        & (F.col("ahead.carry") | ~F.col("ahead.doc_id").eqNullSafe(F.col("doc_id"))),
        F.col("ahead.text"),
    )
    # Rows that repeat an id take the answer of the last of them.
    same = W.partitionBy("part", "carry", "doc_id")
    settled = stepped.where(~F.col("carry")).withColumn("next_text", F.max(changes).over(same))
    return settled.select("doc_id", "text", "next_text")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    swapped = F.floor(F.col("n_chars") / 4).cast("int")
    kept = (F.col("n_chars") - swapped).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), kept), F.substring(F.col("next_text"), F.lit(1), swapped)
    )
    keyed = rows.withColumn("edited", edited).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("changed"),
        digests(F.col("next_text")).alias("after"),
    )
    for name in ("own", "changed", "after"):
        keyed = keyed.withColumn(f"{name}_cells", cells(F.col(name), SIZES[0]))
    keyed = with_likeness(keyed, "near_edited", "own", "changed")
    keyed = with_likeness(keyed, "near_next", "own", "after")
    return keyed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own_cells")).alias("fingerprint"),
        written(F.col("changed_cells")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


@query()
def op9_fingerprints(spark, folder):
    return fingerprinted(table(spark, folder, "documents"))
