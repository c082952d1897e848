"""Compare candidates exactly and join what is linked, without all pairs of a large group.

Sets that share a key are candidates. The groups of all keys whose least member (by hash) is
the same make one *home* around that member, so the many keys of a cluster give one home and
a set moves once per home, not once per key. A task takes homes of some megabytes together
and compares the members of each; it gives back components, not pairs. A larger home is cut
into parts, and every two parts are compared in one task.

A home of more than ``FAR`` parts is compared with its least member, the hub, alone. If its
members are not of one component then, a pair may still be linked that the hub does not join.
Write D(x) for the tokens in which x differs from the hub. If x and y are linked and y is not
linked to the hub, then D(x) and D(y) share a token: |D(x)| + |D(y)| is above the difference
that a linked pair can have, by the triangle inequality. By the prefix argument it is enough
to look at the first ``limit + 1`` tokens of D(x) in a common order, where ``limit`` is the
largest difference that x can have to a linked set. So members are grouped anew by hub and
such tokens, for another turn. What is left after ``ROUNDS`` turns, large homes of sets that
are alike but not linked, is compared part by part, so a task stays bounded.

Components come from distributed union-find: edges are first joined within each task, then
by large-star and small-star steps over tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import mixed, table_of
from tidemark.session import cut_lineage

#: Homes of at most so many members are compared pair by pair, larger ones by a matrix.
SMALL = 4
#: Sets that a worker holds for the pairs to come.
KNOWN = 256
_CLASS = 0x9FB21C651E98DF25
#: Turns with hubs; what is left after them is compared part by part.
ROUNDS = 8
#: A part of a home has about so many members and bytes of bodies; a task compares two.
PART_MEMBERS, PART_BYTES = 512, 1 << 20
#: Homes of more parts are compared with their hub first.
FAR = 16
#: Bytes of bodies that a task takes at once.
TASK_BYTES = 4 << 20
#: Tokens whose counts a task adds up at once.
TOKENS_AT_ONCE = 4096
#: So many members are compared with one copy of their hub.
HUB_MEMBERS = 512


def sized(keys: np.ndarray, size: int, percent: int) -> np.ndarray:
    """``keys`` for sets of about ``size`` tokens. Linked sets differ in size by at most
    ``percent``, so they are of one size class or of neighbouring ones; each set has the
    keys of its class and of the next."""
    # A hair wider than the ratio, so that rounding parts no pair.
    step = np.log(100 / percent) * (1 + 1e-9) + 1e-12
    place = int(np.log(max(size, 1)) / step)
    return np.concatenate([mixed(keys + np.uint64(c * _CLASS % (1 << 64))) for c in (place, place + 1)])


class Forest:
    """Components of the edges seen so far."""

    def __init__(self) -> None:
        self.above: dict[bytes, bytes] = {}

    def top(self, x: bytes) -> bytes:
        above = self.above
        root = above.setdefault(x, x)
        while above[root] != root:
            root = above[root]
        while above[x] != root:
            above[x], x = root, above[x]
        return root

    def join(self, a: bytes, b: bytes) -> None:
        x, y = self.top(a), self.top(b)
        if x != y:
            self.above[max(x, y)] = min(x, y)

    def stars(self) -> list[tuple[bytes, bytes]]:
        """An edge from each node to the least of its component."""
        return [(x, r) for x in self.above if (r := self.top(x)) != x]


EDGES = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of one partition as stars around the least node of each of its components."""
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
    yield from table_of(forest.stars(), EDGES).to_batches()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of the nodes in ``edges`` (``a, b``); the root is the least node."""
    current = cut_lineage(edges.where("a <> b").select("a", "b").mapInArrow(_forest, "a binary, b binary"))
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = cut_lineage(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        before, state = state, _state(current)
        if state == before:
            # Now each node points at its root, and no root points anywhere.
            stars = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _verify(set_of: Callable[[bytes], np.ndarray], percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, again = [], []
            known: dict[bytes, np.ndarray] = {}
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if right not in known:
                    if len(known) == KNOWN:
                        known.clear()
                    known[right] = set_of(right)
                x, hub = set_of(left), known[right]
                common = np.intersect1d(x, hub, assume_unique=True)
                linked.append(100 * len(common) >= percent * (len(x) + len(hub) - len(common)))
                limit = (100 - percent) * len(x) // percent
                more = np.setdiff1d(x, common, assume_unique=True)
                less = np.setdiff1d(hub, common, assume_unique=True)
                keys = np.concatenate([np.sort(more), mixed(np.sort(less))])[: limit + 1]
                again.append(keys.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(again, pa.list_(pa.int64()))],
                names=["a", "b", "linked", "keys"],
            )

    return verify


def compared(pairs: DataFrame, bodies: DataFrame, set_of, percent: int) -> DataFrame:
    """``a, b, linked, keys`` of each pair of a member and its hub (``a, b``): the exact
    decision, and tokens to go on with.

    A hub has as many copies as its members need tasks.
    """
    copies = F.floor((F.count("*") - 1) / HUB_MEMBERS).cast("int")
    wanted = pairs.groupBy(F.col("b").alias("node")).agg(copies.alias("last"))
    right = bodies.join(wanted, "node").select(
        F.col("node").alias("b"), F.col("body").alias("right"), "last",
        F.explode(F.sequence(F.lit(0), F.col("last"))).alias("copy"),
    )
    left = bodies.select(F.col("node").alias("a"), F.col("body").alias("left"))
    dealt = pairs.join(wanted.withColumnRenamed("node", "b"), "b")
    dealt = dealt.withColumn("copy", F.pmod(F.xxhash64("a"), F.col("last") + 1).cast("int"))
    joined = dealt.select("a", "b", "copy").join(left, "a").join(right.drop("last"), ["b", "copy"])
    return joined.select("a", "b", "left", "right").mapInArrow(
        _verify(set_of, percent), "a binary, b binary, linked boolean, keys array<long>"
    )


def _homes(members: DataFrame) -> DataFrame:
    """``home, node, size`` from ``key, node, size, mark``: the groups of the keys whose least
    member (by hash) is the same, as one. Groups with one ``mark`` are left out."""
    place = F.xxhash64("node")
    group = members.groupBy("key").agg(
        F.min(place).alias("home"), F.min("mark").alias("lo"), F.max("mark").alias("hi")
    )
    group = group.where("lo <> hi").select("key", "home")
    return members.join(group, "key").groupBy("home", "node").agg(F.max("size").alias("size"))


def _parts(homes: DataFrame) -> DataFrame:
    """``home, parts`` of the homes that are too large for one comparison."""
    parts = F.greatest(F.ceil(F.count("*") / PART_MEMBERS), F.ceil(F.sum("size") / PART_BYTES))
    return homes.groupBy("home").agg(parts.cast("int").alias("parts")).where("parts > 2")


def _labels(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the number of the first one of its component."""
    label = np.arange(len(sets))
    if len(sets) <= SMALL:
        for j, y in enumerate(sets):
            for i, x in enumerate(sets[:j]):
                if label[i] != label[j] and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        label[label == max(label[i], label[j])] = min(label[i], label[j])
        return label
    size = np.array([len(x) for x in sets], np.int64)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    several = count[token] > 1
    number = np.cumsum(count > 1) - 1
    row, token = row[several], number[token[several]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    last = int(token[-1]) + 1 if len(token) else 0
    for low in range(0, last, TOKENS_AT_ONCE):
        width = min(TOKENS_AT_ONCE, last - low)
        i, j = np.searchsorted(token, [low, low + width])
        held = np.zeros((len(sets), width), np.float32)
        held[row[i:j], token[i:j] - low] = 1
        common += held @ held.T
    common = common.astype(np.int64)
    linked = (common > 0) & (100 * common >= percent * (size[:, None] + size[None, :] - common))
    np.fill_diagonal(linked, True)
    while True:
        least = np.where(linked, label, len(sets)).min(1)
        if (least == label).all():
            return label
        label = least[least]


def _block_forest(set_of: Callable[[bytes], np.ndarray], percent: int):
    def compare(table: pa.Table) -> pa.Table:
        """The components among the members of each of some blocks, as stars."""
        nodes = table.column("node").to_pylist()
        sets: dict[bytes, np.ndarray] = {}
        for node, body in zip(nodes, table.column("body")):
            if node not in sets:
                sets[node] = set_of(body.as_py())
        block = np.stack([table.column(c).to_numpy() for c in ("home", "i", "j")])
        order = np.lexsort(block)
        new = (np.diff(block[:, order], axis=1) != 0).any(axis=0)
        forest = Forest()
        for mine in np.split(order, np.flatnonzero(new) + 1):
            members = [nodes[i] for i in mine.tolist()]
            label = _labels([sets[x] for x in members], percent)
            for i in np.flatnonzero(label != np.arange(len(members))).tolist():
                forest.join(members[i], members[label[i]])
        return table_of(forest.stars(), EDGES)

    return compare


def within_blocks(homes: DataFrame, parts: DataFrame, bodies: DataFrame, set_of, percent: int) -> DataFrame:
    """Edges (``a, b``) that join what is linked in the given homes. Each large home is dealt
    into its parts, and two parts make a block."""
    spot = F.pmod(F.xxhash64("node", F.lit(3)), F.col("parts")).cast("int")
    rows = homes.join(parts, "home", "left").withColumn("mine", F.coalesce(spot, F.lit(0)))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: x != F.col("mine"))
    rows = rows.withColumn("other", F.explode(F.coalesce(others, F.array(F.lit(0)))))
    rows = rows.select(
        "home", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node"
    )
    moved = homes.join(parts, "home", "left").agg(F.sum(F.col("size") * F.coalesce(F.col("parts") - 1, F.lit(1))))
    tasks = max(1, -(-(moved.first()[0] or 0) // TASK_BYTES))
    task = F.pmod(F.xxhash64("home", "i", "j"), F.lit(tasks)).alias("task")
    return rows.select(task, "home", "i", "j", "node").join(bodies, "node").groupBy("task").applyInArrow(
        _block_forest(set_of, percent), "a binary, b binary"
    )


def link(
    members: DataFrame, bodies: DataFrame, set_of: Callable[[bytes], np.ndarray], percent: int
) -> DataFrame | None:
    """``node, root`` of all nodes linked to another one; None where there is none.

    ``members`` has ``key`` (long), ``node`` (binary) and ``size`` (of its body), ``bodies``
    the ``body`` of each node, from which ``set_of`` makes its sorted distinct tokens.
    """
    roots: DataFrame | None = None
    members = members.withColumn("mark", F.xxhash64("node"))
    for turn in range(ROUNDS + 1):
        homes = cut_lineage(_homes(members))
        parts = cut_lineage(_parts(homes))
        far = parts.where(F.lit(turn < ROUNDS) & (F.col("parts") > FAR)).select("home")
        more = not far.isEmpty()
        near = homes.join(far, "home", "left_anti") if more else homes
        edges = cut_lineage(within_blocks(near, parts, bodies, set_of, percent))
        if more:
            homes = homes.join(far, "home")
            hubs = homes.where(F.xxhash64("node") == F.col("home")).groupBy("home").agg(F.min("node").alias("b"))
            to_hub = homes.join(hubs, "home").where("node <> b").select("home", F.col("node").alias("a"), "b")
            told = cut_lineage(compared(to_hub.select("a", "b").distinct(), bodies, set_of, percent))
            edges = edges.unionByName(told.where("linked").select("a", "b"))
        if roots is not None:
            edges = edges.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        roots = cut_lineage(components(edges))
        if not more:
            break
        mark = F.xxhash64(F.coalesce("root", "node"))
        marked = homes.join(roots, "node", "left").select("home", "node", "size", mark.alias("mark"))
        marked = cut_lineage(marked)
        still = marked.groupBy("home").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).where("lo <> hi")
        beyond = hubs.join(still, "home").select("b").distinct()
        held = told.join(beyond, "b", "left_semi").join(
            marked.select(F.col("node").alias("a"), "size", "mark").distinct(), "a"
        )
        members = held.select("b", F.explode("keys").alias("token"), F.col("a").alias("node"), "size", "mark")
        members = members.withColumn("key", F.xxhash64("b", "token"))
    return None if roots.isEmpty() else roots


def rooted(nodes: DataFrame, roots: DataFrame | None, value: str) -> DataFrame:
    """``node, least``: the least ``value`` of each node's component."""
    if roots is None:
        return nodes.select("node", F.col(value).alias("least"))
    within = cut_lineage(nodes.join(roots, "node"))
    least = within.groupBy("root").agg(F.min(value).alias("least"))
    within = within.join(least, "root").select("node", "least")
    return nodes.join(within, "node", "left").select("node", F.coalesce("least", value).alias("least"))
