"""Exact top-k inner products by the threshold algorithm over sorted lists.

Vectors are quantised to integers. The rows are dealt in blocks; each block keeps one
list per dimension, sorted by value, and its rows in the order in which a walk down all
lists at once, from both ends, meets them. No row below the walk can score above the
weighted sum of the values at the frontier, taken at the top where a query's weight is
positive and at the bottom where it is negative; once that bound is under the k-th best
score so far, the query skips the rest of the block. The queries of a part walk together:
what a step meets is scored for all that go on.

Blocks are put together in regions of bounded size and query parts in lots. A task has one
region and one lot: it holds the blocks and reads the parts one by one, so queries travel
once per region. Nothing is joined: rows of either kind are sent to their tasks by number,
and none can become a broadcast. A final ranking merges the regions.

Defined cases: vectors that are null or hold null or non-finite components take no part;
shorter vectors are filled up with zeros; a query's own row is no candidate, other rows
with its vec_id are; repeated query rows are asked each; ties go to the smaller vec_id;
fewer candidates than k give fewer rows; repeated rows are candidates each; rows without
vec_id take no part; an empty table gives an empty result; other columns are ignored. A
component too large for exact 64-bit scores (131072 in 4096 dimensions) is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.llm.shared import ranges
from tidemark.session import cut_lineage

SCALE = 256.0
BLOCK_ROWS, LEAST_BLOCK = 4096, 256
QUERY_ROWS = 512
#: Components of a block, of a query part and of a region at most, for wide vectors.
BLOCK_VALUES, QUERY_VALUES, REGION_VALUES = 1 << 20, 1 << 17, 1 << 24
#: Query parts that meet a region in one task.
LOT_PARTS = 512
FIRST_DEPTH = 8
#: Rows that are scored at once: their scores for a part stay in the processor's cache.
SCORED_ROWS = 1024
#: So many times k candidates a query are first cut by the k-th best of them.
CROWD = 4
#: Below all scores: of a place that is not taken, and of a query's own row.
FREE, BANNED = -(1 << 62), -(1 << 63)
PACKED = "number int, kind string, ids binary, rows binary, values binary, ends binary, highs binary, lows binary"


def usable(vector: Column) -> Column:
    """True where the vector and all its components are non-null and finite."""
    good = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def quantised(vector: Column, most: int) -> Column:
    """Integer components; an error if one is not below ``most`` in size."""

    def component(x: Column) -> Column:
        scaled = F.lit(SCALE) * x.cast("double")
        too_large = F.raise_error(F.lit("a component is too large for exact scores"))
        return F.when(F.abs(scaled) < most, F.floor(scaled)).otherwise(too_large)

    return F.transform(vector, component)


def _arrays(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, row numbers, and the vectors filled up with zeros, in the smallest type that holds them."""
    lists = rows.column("q").combine_chunks()
    ends = lists.offsets.to_numpy()
    matrix = np.zeros((rows.num_rows, width), np.int64)
    held = ranges(np.arange(rows.num_rows) * width, np.diff(ends))
    matrix.ravel()[held] = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
    ids, numbers = (rows.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "row"))
    largest = int(np.abs(matrix).max(initial=0))
    return ids, numbers, matrix.astype(next(t for t in (np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max))


def _packed(number: int, values: np.ndarray, **more: np.ndarray) -> pa.Table:
    blobs = {n: pa.array([None if v is None else v.tobytes()], pa.binary()) for n, v in (more | {"values": values}).items()}
    head = {"number": pa.array([number], pa.int32()), "kind": pa.array([values.dtype.str])}
    return pa.table(head | {n: blobs[n] for n in ("ids", "rows", "values", "ends", "highs", "lows")})


def _pack_part(width: int):
    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids, numbers, values = _arrays(rows, width)
        return _packed(key[0].as_py(), values, ids=ids, rows=numbers, ends=None, highs=None, lows=None)

    return pack


def _pack_block(width: int):
    """Rows in the order in which the walk meets them: those of a step by id. ``ends`` has where
    each step ends, ``highs`` and ``lows`` the frontiers of all lists before it."""

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids, numbers, values = _arrays(rows, width)
        n = len(ids)
        order = np.argsort(values, axis=0, kind="stable")
        from_end = np.minimum(np.arange(n), np.arange(n)[::-1])
        met = np.full(n, n)
        for at in order.T:
            met[at] = np.minimum(met[at], from_end)
        depths = [0, FIRST_DEPTH]
        while depths[-1] < n:
            depths.append(depths[-1] * 4)
        step = np.searchsorted(depths[1:-1], met, side="right")
        walk = np.lexsort((ids, step))
        ends = np.cumsum(np.bincount(step))
        frontier = np.maximum(depths[: len(ends)], 1)
        highs = np.take_along_axis(values, order[n - frontier], axis=0)
        lows = np.take_along_axis(values, order[frontier - 1], axis=0)
        return _packed(key[0].as_py(), values[walk], ids=ids[walk], rows=numbers[walk], ends=ends, highs=highs, lows=lows)

    return pack


class _Rows:
    """A block or a query part, from its packed form."""

    def __init__(self, packed: dict, width: int):
        self.ids, self.rows = (np.frombuffer(packed[c], np.int64) for c in ("ids", "rows"))
        self.values = np.frombuffer(packed["values"], packed["kind"]).reshape(len(self.ids), width)
        self.largest = int(np.abs(self.values.astype(np.int64)).max(initial=0))
        if packed["ends"] is not None:
            self.ends = np.frombuffer(packed["ends"], np.int64).tolist()
            self.highs, self.lows = (
                np.frombuffer(packed[c], packed["kind"]).reshape(len(self.ends), width) for c in ("highs", "lows")
            )
            self.by_row = np.argsort(self.rows)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Where in the block the given rows are, -1 where they are not."""
        at = self.by_row[np.minimum(np.searchsorted(self.rows, rows, sorter=self.by_row), len(self.rows) - 1)]
        return np.where(self.rows[at] == rows, at, -1)


def _exact(width: int, a: int, b: int) -> type:
    """The fastest type that holds any sum of ``width`` products of components up to a and b."""
    largest = width * a * b
    return np.float32 if largest < 1 << 24 else np.float64 if largest < 1 << 53 else np.int64


def _keep(best: tuple[np.ndarray, np.ndarray], asked: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
    """Put the new rows of the queries ``asked`` (``scores`` has a line for each) among their best.
    ``ids`` rise; a score that ties with the last place wins by its smaller id."""
    k = best[0].shape[1]
    bar = best[0][asked, -1].astype(scores.dtype)
    some = np.flatnonzero(scores.max(axis=1) >= bar)
    if not len(some):
        return
    asked, bar, scores = asked[some], bar[some], scores[some]
    hit = scores >= bar[:, None]
    if np.count_nonzero(hit) > CROWD * k * len(asked):
        at = scores.shape[1] - k
        bar = np.maximum(bar, np.partition(scores, at, axis=1)[:, at])
        hit = scores >= bar[:, None]
        if np.count_nonzero(hit) > CROWD * k * len(asked):
            tied = scores == bar[:, None]
            hit &= ~tied | (np.cumsum(tied, axis=1) <= k)
    found = np.flatnonzero(hit)
    line, column = np.divmod(found, scores.shape[1])
    new, line = np.unique(line, return_inverse=True)
    at = asked[new]
    line = np.concatenate([line, np.repeat(np.arange(len(new)), k)])
    score = np.concatenate([scores.ravel()[found].astype(np.int64), best[0][at].ravel()])
    vec_id = np.concatenate([ids[column], best[1][at].ravel()])
    order = np.lexsort((vec_id, -score, line))
    first = order[np.searchsorted(line[order], np.arange(len(new)))[:, None] + np.arange(k)]
    best[0][at], best[1][at] = score[first], vec_id[first]


def _walk(block: _Rows, part: _Rows, best: tuple[np.ndarray, np.ndarray]) -> int:
    """Take the rows of a block that are among the best of a part's queries; how many scores that took.

    A query's bar is the k-th best score so far. A bound that ties with it goes on, as an
    unseen row may win by its smaller id.
    """
    kind = _exact(block.values.shape[1], block.largest, part.largest)
    rows, weights, highs, lows = (x.astype(kind) for x in (block.values, part.values, block.highs, block.lows))
    bounds = np.maximum(weights, 0) @ highs.T + np.minimum(weights, 0) @ lows.T
    own = block.places(part.rows)
    room = np.empty(len(weights) * min(len(rows), SCORED_ROWS), kind)
    asked, begin, scored = np.arange(len(weights)), 0, 0
    for step, end in enumerate(block.ends):
        asked = asked[bounds[asked, step] >= best[0][asked, -1].astype(kind)]
        if not len(asked):
            break
        mine = weights[asked]
        for a in range(begin, end, SCORED_ROWS):
            b = min(end, a + SCORED_ROWS)
            scores = np.matmul(mine, rows[a:b].T, out=room[: len(mine) * (b - a)].reshape(len(mine), b - a))
            here = np.flatnonzero((own[asked] >= a) & (own[asked] < b))
            scores[here, own[asked[here]] - a] = BANNED
            _keep(best, asked, scores, block.ids[a:b])
            scored += scores.size
        begin = end
    return scored


def _search(k: int, width: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if tile != row["tile"]:
                    tile, blocks = row["tile"], []
                rows = _Rows(row, width)
                if row["ends"] is not None:
                    blocks.append(rows)
                    continue
                best = tuple(np.full((len(rows.ids), k), x, np.int64) for x in (FREE, 0))
                for block in blocks:
                    _walk(block, rows, best)
                asked, place = np.nonzero(best[0] > FREE)
                found = {"query_row": rows.rows[asked], "query_id": rows.ids[asked]}
                found |= {"vec_id": best[1][asked, place], "score": best[0][asked, place]}
                yield pa.RecordBatch.from_pydict({n: pa.array(x) for n, x in found.items()})

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row with ``is_query``."""
    usable_rows = vectors.where(usable(F.col(vector)) & F.col("vec_id").isNotNull())
    width = usable_rows.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]
    most = isqrt((1 << 62) // max(1, width))
    # Numbers of rows hold once they are written.
    good = cut_lineage(
        usable_rows.select(
            F.monotonically_increasing_id().alias("row"), "vec_id",
            quantised(F.col(vector), most).alias("q"), is_query.alias("asks"),
        )
    )
    size = good.agg(F.count("*").alias("n"), F.count(F.when(F.col("asks"), 1)).alias("asks")).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    block_rows, part_rows = (
        max(1, min(rows, values // max(1, width))) for rows, values in ((BLOCK_ROWS, BLOCK_VALUES), (QUERY_ROWS, QUERY_VALUES))
    )
    blocks = max(1, -(-size.n // block_rows), min(cores, size.n // LEAST_BLOCK))
    parts = max(1, -(-size.asks // part_rows))
    region_blocks = max(1, REGION_VALUES // max(1, block_rows * width))
    regions = max(-(-blocks // region_blocks), min(blocks, 2 * cores))
    lots = max(-(-parts // LOT_PARTS), min(parts, 2 * cores // regions))

    def packed(rows: DataFrame, n: int, pack) -> DataFrame:
        dealt = rows.withColumn("number", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
        return dealt.groupBy("number").applyInArrow(pack(width), PACKED)

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    region, lot = F.col("number") % regions, F.col("number") % lots
    held = packed(good, blocks, _pack_block).select("*", region.alias("region"), numbers(lots).alias("lot"))
    asked = packed(good.where("asks"), parts, _pack_part).select("*", lot.alias("lot"), numbers(regions).alias("region"))
    tiles = held.unionByName(asked).withColumn("tile", F.col("region") * lots + F.col("lot"))
    in_turn = tiles.repartitionById(regions * lots, F.col("tile")).sortWithinPartitions("tile", F.col("ends").isNull())
    found = in_turn.mapInArrow(_search(k, width), "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


@query("""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id AS vec_id,
    CAST(list_dot_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5""")
def op10_topk(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))
