"""Join documents whose word shingles have a high Jaccard similarity.

Sets that overlap enough share ``L`` tokens among the first ``p + L - 1`` of a common
order, where ``p`` is the usual prefix. Here ``L`` is 2, and the order puts rare tokens
first. Where such a shared token is rare, it is found by the index of single tokens;
where all shared ones are frequent, by the index of pairs of frequent tokens. So rare
tokens are indexed singly and frequent ones only in combination.

What is frequent is read from counts over all documents, in a table of fixed size: a
token whose slot is far above the mean. That steers cost, never results. With a longer
prefix a linked pair shares more of it, about half at twice the prefix. So each document
first asks which tokens of its longer prefix others hold in theirs, and only those with
enough of them go on. Index keys are parted by set size, which in linked pairs is within
the threshold's ratio. The groups that stay are verified exactly and joined in ``links``.
Copies with one set are one node.

Defined cases: null or blank text has an empty set and is linked with nothing; a text
with fewer words than a shingle has one shingle, all its words; repeated rows are linked
(equal sets); a null doc_id is linked but never names a component with other ids; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import links, shared
from tidemark.llm.registry import query, table
from tidemark.llm.shared import HELD, Rolling
from tidemark.session import cut_lineage

SHINGLE = 3
PERCENT = 90
COMBINED = 2
SLOTS = 1 << 20
PIECES = 64
#: A slot is frequent above this many times the mean and this many more.
FREQUENT_TIMES, FREQUENT_MORE = 4, 64
FOUND = "doc_id long, n_shingles long, node binary, keys array<long>, body binary"
FOUND_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.binary()),
     ("keys", pa.list_(pa.int64())), ("body", pa.binary())]
)


def tokens(text: bytes | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of the shingles of ``n`` words; A-Z in lower case."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    symbols = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(words) < n:
        end = np.array([len(words)])
        return Rolling(symbols).runs(0 * end, end)
    return shared.distinct(Rolling(symbols).every(n))


def _slot(t: np.ndarray) -> np.ndarray:
    return (t >> np.uint64(44)).astype(np.int64)


def frequent_slots(texts: DataFrame, n: int) -> np.ndarray:
    """One flag per slot: far more documents hold its tokens than the mean slot's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(counts, _slot(tokens(text, n)), 1)
        for i, piece in enumerate(np.split(counts, PIECES)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([piece.tobytes()], pa.binary())], names=["piece", "counts"]
            )

    def add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.int64) for b in rows.column("counts").to_pylist())
        return pa.table({"piece": [key[0].as_py()], "counts": [total.tobytes()]}).cast(
            pa.schema([("piece", pa.int32()), ("counts", pa.binary())])
        )

    counted = texts.mapInArrow(count, "piece int, counts binary").groupBy("piece").applyInArrow(
        add, "piece int, counts binary"
    )
    counts = np.zeros(SLOTS, np.int64)
    for row in counted.collect():  # PIECES rows of a fixed size
        counts[row.piece * (SLOTS // PIECES) :][: SLOTS // PIECES] = np.frombuffer(row.counts, np.int64)
    return counts > FREQUENT_TIMES * counts.mean() + FREQUENT_MORE


def _missing(m: int, percent: int) -> int:
    """Of a set of ``m`` tokens, how many a linked set can lack."""
    return m - -(-percent * m // 100)


def needed(m: int, percent: int) -> int:
    """How many tokens of its longer prefix a set shares with any linked one.

    With prefixes of ``missing + L`` tokens a pair shares ``L`` of them; ``L`` is
    ``missing + 2``, so the smaller set of the pair decides.
    """
    return _missing(-(-percent * m // 100), percent) + COMBINED


def longer_prefix(t: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first tokens of the set, rare ones before frequent ones."""
    if len(t) < COMBINED:
        return t[:0]
    often = frequent[_slot(t)]
    return np.concatenate([t[~often], t[often]])[: 2 * _missing(len(t), percent) + COMBINED]


def index_keys(
    prefix: np.ndarray, often: np.ndarray, held: np.ndarray, m: int, percent: int
) -> np.ndarray:
    """Single rare tokens that others hold, and pairs of frequent ones, of the prefix."""
    size = _missing(m, percent) + COMBINED
    prefix, often, held = prefix[:size], often[:size], held[:size]
    single, common = prefix[~often & held], prefix[often]
    i, j = np.triu_indices(len(common), 1)
    pairs = shared.mixed(common[i] * np.uint64(3) + shared.mixed(common[j]))
    return np.concatenate([single, pairs])


def joined(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest doc_id reachable by links."""
    texts, buckets = shared.dealt(docs, "doc_id")
    frequent = frequent_slots(docs.select(F.col("text").cast("binary")), n)

    def sets(rows: pa.Table) -> list[tuple[np.ndarray, bytes, bytes]]:
        found = []
        for text in rows.column("text").to_pylist():
            t = tokens(text, n)
            found.append((t, xxhash.xxh3_128_digest(t.tobytes()), text))
        return found

    def prefixes(found) -> tuple[dict[bytes, np.ndarray], np.ndarray, np.ndarray]:
        by_node: dict[bytes, np.ndarray] = {}
        for t, node, _ in found:
            if node not in by_node:
                by_node[node] = longer_prefix(t, frequent, percent)
        every = np.concatenate([*by_node.values(), np.zeros(0, np.uint64)])
        keys, counts = np.unique(every, return_counts=True)
        return by_node, keys, counts

    def about_keys(batch: int, rows: pa.Table) -> list[tuple]:
        _, keys, _ = prefixes(sets(rows))
        return shared.request_rows(batch, HELD, buckets, keys)

    def apply(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        found = sets(rows)
        by_node, keys, counts = prefixes(found)
        held = shared.read_bits(told.to_pylist(), HELD, buckets, keys)[0] | (counts > 1)
        out = []
        for doc, (t, node, text) in zip(rows.column("doc_id").to_pylist(), found):
            prefix, index, body = by_node.pop(node, None), None, None
            if prefix is not None and len(prefix):
                known = held[np.searchsorted(keys, prefix)]
                if known.sum() >= needed(len(t), percent):
                    often = frequent[_slot(prefix)]
                    index = index_keys(prefix, often, known, len(t), percent)
                    index = links.sized(index, len(t), percent).astype(np.int64)
                    body = b" ".join(text.lower().split())
            out.append((doc, len(t), node if len(t) else None, index, body))
        return shared.table_of(out, FOUND_ARROW)

    asked = shared.ask(texts, about_keys, buckets)
    found = cut_lineage(
        texts.groupBy("batch").cogroup(asked.groupBy("batch")).applyInArrow(apply, FOUND)
    )
    members = found.where(F.col("keys").isNotNull()).select(
        F.explode("keys").alias("key"), "node", F.octet_length("body").alias("size")
    )
    bodies = found.where(F.col("body").isNotNull()).groupBy("node").agg(F.first("body").alias("body"))
    roots = links.link(members, bodies, partial(tokens, n=n), percent)
    nodes = found.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    least = links.rooted(nodes, roots, "doc_id")
    rows = found.select("doc_id", "n_shingles", "node").join(least, "node", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def without_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of linked ones, with all columns: the smallest doc_id.

    Documents without doc_id stay; of repeated rows one stays.
    """
    kept = joined(docs, n, percent).where("component_id = doc_id").select("doc_id").distinct()
    spot = W.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    rows = docs.withColumn("__row", F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = rows.select("__row", "doc_id", "text").where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    first = rows.withColumn("__spot", F.row_number().over(spot)).where("__spot = 1").select("__row.*")
    return first.unionByName(docs.where("doc_id IS NULL"))


@query(r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
words AS (SELECT r, len(w) AS total, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
grams AS (
  SELECT r, p, total, count(*) OVER here AS n, string_agg(word, ' ') OVER here AS k FROM words
  WINDOW here AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)),
sets AS MATERIALIZED (SELECT DISTINCT r, k FROM grams WHERE n = 3 OR (p = 1 AND total < 3)),
sizes AS MATERIALIZED (SELECT r, count(*) AS m FROM sets GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS held FROM sets a JOIN sets b USING (k) GROUP BY a.r, b.r),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
  WHERE 100 * held >= 90 * (x.m + y.m - held)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS r, min(d.doc_id) AS least FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT doc_id, coalesce(m, 0) AS n_shingles, coalesce(least, doc_id) AS component_id
FROM d LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)""")
def op3_jaccard(spark, folder):
    return joined(table(spark, folder, "documents"))
