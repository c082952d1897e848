"""Remove byte strings seen in earlier documents, by sorting suffixes in two depths.

A 50-byte window that starts in two documents is found by sorting suffixes, up to the
window's depth. Only suffixes that can have a partner are sorted: each window has an
anchor, the least of its grams by hash, and equal windows agree on it, so windows whose
anchor occurs once are done. Neighbouring windows of one anchor travel as one context,
their bytes with 49 more, to the bucket of their anchor; equal contexts of a batch are
one, with the smallest doc_id. Anchors that very many batches hold have their windows
dealt singly, by content.

A bucket sorts the suffixes of its contexts, deep-shallow: multikey quicksort on eight
bytes at a time to a shallow depth, after which most groups are single; a blind trie
orders each group that still ties and is not all equal. Neighbours in this order whose
common prefix spans the window are one class; the smallest doc_id of a class keeps it.
The comparison is of bytes, so nothing rests on hashes.

Defined cases: null text is empty; a text shorter than the window keeps all; rows with
one doc_id do not remove from each other; a null doc_id comes before all; copies of a
whole earlier text are settled by the text's digest; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import shared
from tidemark.llm.registry import query, table
from tidemark.llm.shared import EARLIER, HELD, Rolling

WINDOW = 50
GRAM = 20
SHALLOW = 24
LONGEST_CONTEXT = 60
#: Bytes whose hashes are held at once.
PART_BYTES = 256 << 10
#: Suffixes that one bucket sorts at a time.
SORT_AT_ONCE = 4_000_000
NOTE = np.dtype([("start", "<u4"), ("context", "<u4"), ("count", "u1")])
CONTEXTS = (
    "batch int, bucket int, anchors binary, counts binary, owners binary, bytes binary, note binary"
)
CONTEXTS_ARROW = pa.schema(
    [("batch", pa.int32()), ("bucket", pa.int32())]
    + [(n, pa.binary()) for n in ("anchors", "counts", "owners", "bytes", "note")]
)
MASKS_ARROW = pa.schema(
    [("batch", pa.int32()), ("bucket", pa.int32())] + [(n, pa.binary()) for n in ("masks", "owners", "note")]
)


class BlindTrie:
    """A Patricia trie over equal-length strings: nodes know a depth and one byte each way.

    A search compares only branching bytes; the leaf it ends in then tells the true
    common prefix, and so where the new string belongs.
    """

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | None = None

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [len(s), [i]]
            return
        node = self.root
        while isinstance(node[1], dict):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[1][0]]
        apart = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        if not apart:
            node[1].append(i)
            return
        common = len(s) - (apart.bit_length() + 7) // 8
        node = self.root
        while node[0] < common:
            node = node[1][s[node[0]]]
        leaf = [len(s), [i]]
        if node[0] == common:
            node[1][s[common]] = leaf
        else:
            node[0], node[1] = common, {other[common]: [node[0], node[1]], s[common]: leaf}

    def leaves(self) -> list[list[int]]:
        """The strings' numbers in order, equal ones together."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node[1], dict):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node[1])
        return out


def _eight(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one number, first byte highest."""
    key = np.zeros(len(at), np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | data[at + i]
    return key


def sorted_classes(
    data: np.ndarray, at: np.ndarray, depth: int = WINDOW, shallow: int = SHALLOW
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes of ``data`` at ``at``, to ``depth`` bytes, and where in it
    a new class of equal ones begins. ``data`` needs ``depth + 8`` bytes past each start."""
    order = np.argsort(_eight(data, at), kind="stable")
    new = np.ones(len(at), bool)
    key = _eight(data, at[order])
    new[1:] = key[1:] != key[:-1]
    for d in range(8, shallow, 8):
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            return order, new
        group = np.cumsum(new)[tied]
        key = _eight(data, at[order[tied]] + d)
        inner = np.lexsort((key, group))
        order[tied] = order[tied[inner]]
        key = key[inner]
        new[tied[1:]] |= (key[1:] != key[:-1]) & (group[1:] == group[:-1])
    tied = np.flatnonzero(~new | np.append(~new[1:], False))
    if not len(tied):
        return order, new
    # Groups whose rest is all equal are one class; the others are ordered by a blind trie.
    differs = np.zeros(len(tied), bool)
    starts = at[order[tied]]
    for d in [*range(shallow, depth - 7, 8), depth - 8]:
        key = _eight(data, starts + d)
        differs[1:] |= key[1:] != key[:-1]
    differs &= ~new[tied]
    group = np.cumsum(new[tied]) - 1
    first = np.flatnonzero(new[tied])
    for g in np.unique(group[differs]).tolist():
        a = first[g]
        b = first[g + 1] if g + 1 < len(first) else len(tied)
        members = order[tied[a:b]]
        trie = BlindTrie([data[s + shallow : s + depth].tobytes() for s in at[members].tolist()])
        for i in range(len(members)):
            trie.add(i)
        spot = tied[a]
        for leaf in trie.leaves():
            order[spot : spot + len(leaf)] = members[leaf]
            new[spot + 1 : spot + len(leaf)] = False
            new[spot] = True
            spot += len(leaf)
    return order, new


def _earlier_windows(
    data: np.ndarray, begin: np.ndarray, counts: np.ndarray, anchors: np.ndarray, owners: np.ndarray
) -> np.ndarray:
    """For each of the distinct contexts, a bit for each window that one of an earlier
    owner holds too. A context that is alone with its anchor has no partner."""
    masks = np.zeros(len(counts), np.uint64)
    # Equal windows share their anchor, so groups of anchors can be sorted one by one.
    by_anchor = np.argsort(anchors, kind="stable")
    new = np.append(True, anchors[by_anchor][1:] != anchors[by_anchor][:-1])
    by_anchor = by_anchor[~new | ~np.append(new[1:], True)]
    if not len(by_anchor):
        return masks
    edges = np.flatnonzero(np.append(True, anchors[by_anchor][1:] != anchors[by_anchor][:-1]))
    edges = np.append(edges, len(by_anchor))
    ahead = np.append(0, np.cumsum(counts[by_anchor]))
    a = 0
    while a < len(by_anchor):
        # As many whole groups as fit, one at least.
        limit = np.searchsorted(ahead, ahead[a] + SORT_AT_ONCE, side="right") - 1
        b = int(edges[max(np.searchsorted(edges, limit, side="right") - 1, np.searchsorted(edges, a) + 1)])
        some = by_anchor[a:b]
        at = shared.ranges(begin[some], counts[some])
        context = np.repeat(some, counts[some])
        order, new = sorted_classes(data, at)
        first = np.flatnonzero(new)
        owner = owners[context[order]]
        least = np.repeat(np.minimum.reduceat(owner, first), np.diff(np.append(first, len(order))))
        earlier = order[least < owner]
        bit = (at[earlier] - begin[context[earlier]]).astype(np.uint64)
        np.bitwise_or.at(masks, context[earlier], np.uint64(1) << bit)
        a = b
    return masks


def sort_bucket(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each context asked about, which of its windows an earlier document holds."""
    rows = table.to_pylist()
    sizes = [len(r["counts"]) for r in rows]
    anchors = np.concatenate([np.frombuffer(r["anchors"], np.uint64) for r in rows])
    counts = np.concatenate([np.frombuffer(r["counts"], np.uint8) for r in rows]).astype(np.int64)
    owners = np.concatenate([np.frombuffer(r["owners"], np.int64) for r in rows])
    data = np.frombuffer(b"".join([*(r["bytes"] for r in rows), bytes(WINDOW + 8)]), np.uint8)
    length = counts + WINDOW - 1
    begin = np.cumsum(length) - length
    # Equal contexts of several batches are one; the smallest owner keeps its windows.
    digest = Rolling(_SYMBOLS[data]).runs(begin, begin + length)
    by_content, first = shared.grouped(digest, None)
    same = np.diff(np.append(first, len(by_content)))
    kept = by_content[first]
    least = np.minimum.reduceat(owners[by_content], first)
    found = _earlier_windows(data, begin[kept], counts[kept], anchors[kept], least)
    masks = np.empty(len(counts), np.uint64)
    masks[by_content] = np.where(
        owners[by_content] > np.repeat(least, same), ~np.uint64(0), np.repeat(found, same)
    )
    out, at_row = [], 0
    for r, n in zip(rows, sizes):
        out.append(
            (r["batch"], r["bucket"], masks[at_row : at_row + n].tobytes(), r["owners"], r["note"])
        )
        at_row += n
    return shared.table_of(out, MASKS_ARROW)


class Batch:
    """The windows of a batch: positions count bytes in its joined texts."""

    def __init__(self, rows: pa.Table, window: int, gram: int):
        self.texts = [t or b"" for t in rows.column("text").to_pylist()]
        self.ids = rows.column("owner").to_numpy()
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.window, self.gram = window, gram
        long = np.flatnonzero(self.sizes >= window)
        digests = [hashlib.sha256(self.texts[i]).digest() for i in long.tolist()]
        pairs = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 4)
        order, first = shared.grouped(pairs[:, 0].copy(), pairs[:, 1].copy())
        sizes = np.diff(np.append(first, len(order)))
        self.digest, self.check = pairs[order[first], 0], pairs[order[first], 1]
        owners = self.ids[long][order]
        self.least = np.minimum.reduceat(owners, first) if len(first) else owners
        self.place = np.full(len(self.texts), -1)
        self.place[long[order]] = np.repeat(np.arange(len(first)), sizes)

    def parts(self):
        """``offset, symbols, sizes`` of parts of the joined texts."""
        joined = np.frombuffer(b"".join(self.texts), np.uint8)
        for base, sizes in shared.part_ranges(self.sizes.tolist(), PART_BYTES, self.window):
            yield base, joined[base : base + sum(sizes)], np.array(sizes)

    def anchors(self, piece: np.ndarray, sizes: np.ndarray):
        rolling = Rolling(_SYMBOLS[piece])
        ok = shared.starts_within(sizes, self.window)
        return rolling, shared.minimizers(rolling, self.window, self.gram), ok


_SYMBOLS = shared.mixed(np.arange(1, 257, dtype=np.uint64))


def without_earlier(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``: bytes in windows that also
    start in a document with a smaller doc_id are removed."""
    owner = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    texts, buckets = shared.dealt(docs.withColumn("owner", owner), "doc_id", "owner")

    def about_anchors(batch: int, rows: pa.Table) -> list[tuple]:
        b = Batch(rows, window, gram)
        found = [np.zeros(0, np.uint64)]
        for _, piece, sizes in b.parts():
            _, anchors, ok = b.anchors(piece, sizes)
            found.append(_run_values(anchors, ok))
        keys = np.unique(np.concatenate(found))
        return shared.request_rows(batch, HELD, buckets, keys) + shared.request_rows(
            batch, EARLIER, buckets, b.digest, b.check, b.least
        )

    def contexts(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = shared.in_order(rows)
        batch, got = key[0].as_py(), told.to_pylist()
        b = Batch(rows, window, gram)
        copy = _copies(b, got, buckets)
        found, local = [np.zeros(0, np.uint64)], []
        for base, piece, sizes in b.parts():
            rolling, anchors, ok = b.anchors(piece, sizes)
            found.append(_run_values(anchors, ok))
            local.append((base, piece, sizes, anchors, ok))
            del rolling
        runs = np.concatenate(found)
        keys, seen = np.unique(runs, return_counts=True)
        held, hot = shared.read_bits(got, HELD, buckets, keys)
        held |= seen > 1
        text_of = np.repeat(np.arange(len(b.sizes)), b.sizes).astype(np.int32)
        columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        for base, piece, sizes, anchors, ok in local:
            if not len(anchors):
                continue
            spot = np.searchsorted(keys, anchors)
            spot[spot == len(keys)] = 0
            ok = ok & held[spot] & ~copy[text_of[base : base + len(anchors)]]
            alone = hot[spot]
            start, count = shared.cut_runs(anchors, ok, LONGEST_CONTEXT, alone)
            if not len(start):
                continue
            rolling = Rolling(_SYMBOLS[piece])
            digest = rolling.runs(start, start + count + window - 1)
            home = np.where(alone[start], digest, anchors[start])
            for c, v in zip(columns, (start + base, count, home, digest, b.ids[text_of[start + base]])):
                c.append(v)
        if not columns[0]:
            return shared.table_of([], CONTEXTS_ARROW)
        start, count, home, digest, owners = (np.concatenate(c) for c in columns)
        joined = np.frombuffer(b"".join(b.texts), np.uint8)
        bucket = (home % np.uint64(buckets)).astype(np.int64)
        out = []
        for n, mine in shared.parted(bucket):
            order, first = shared.grouped(digest[mine], None)
            sizes = np.diff(np.append(first, len(order)))
            picked = mine[order[first]]
            note = np.zeros(len(mine), NOTE)
            note["start"], note["count"] = start[mine], count[mine]
            context = np.empty(len(mine), np.int64)
            context[order] = np.repeat(np.arange(len(first)), sizes)
            note["context"] = context
            out.append(
                (
                    batch, n, home[picked].tobytes(), count[picked].astype(np.uint8).tobytes(),
                    np.minimum.reduceat(owners[mine][order], first).tobytes(),
                    joined[shared.ranges(start[picked], count[picked] + window - 1)].tobytes(), note.tobytes(),
                )
            )
        return shared.table_of(out, CONTEXTS_ARROW)

    def apply(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = shared.in_order(rows)
        b = Batch(rows, window, gram)
        got = told.to_pylist()
        copy = _copies(b, [r for r in got if r["masks"] is None], buckets)
        total = int(b.sizes.sum())
        text_of = np.repeat(np.arange(len(b.sizes)), b.sizes).astype(np.int32)
        hits = [np.zeros(0, np.int64)]
        for r in got:
            if r["masks"] is None:
                continue
            note = np.frombuffer(r["note"], NOTE)
            start, count = note["start"].astype(np.int64), note["count"].astype(np.int64)
            mask = np.frombuffer(r["masks"], np.uint64)[note["context"]]
            least = np.frombuffer(r["owners"], np.int64)[note["context"]]
            mask = np.where(b.ids[text_of[start]] > least, ~np.uint64(0), mask)
            some = mask != 0
            start, count, mask = start[some], count[some], mask[some]
            at = shared.ranges(start, count)
            bit = (at - np.repeat(start, count)).astype(np.uint64)
            hits.append(at[(np.repeat(mask, count) >> bit) & np.uint64(1) == 1])
        hit = np.concatenate(hits)
        drop = shared.covered(hit, np.ones(len(hit), np.int64), window, total)
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []}
        at = 0
        for i, text in enumerate(b.texts):
            gone = drop[at : at + len(text)]
            at += len(text)
            if copy[i]:
                gone = np.ones(len(text), bool)
            s, e = shared.kept_pieces(gone)
            kept = b"".join(text[x:y] for x, y in zip(s.tolist(), e.tolist()))
            out["n_bytes"].append(len(text))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return pa.table({"doc_id": rows.column("doc_id"), **out})

    first = shared.ask(texts, about_anchors, buckets)
    sent = texts.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(contexts, CONTEXTS)
    masks = sent.groupBy("bucket").applyInArrow(
        sort_bucket, "batch int, bucket int, masks binary, owners binary, note binary"
    )
    copies = first.where(F.col("kind") == EARLIER).select("batch", "bucket", "kind", "bits")
    told = masks.unionByName(copies, allowMissingColumns=True)
    return texts.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(
        apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _run_values(anchors: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """The anchors of runs of windows, one each."""
    start, _ = shared.cut_runs(anchors, ok, 1 << 40)
    return anchors[start]


def _copies(b: Batch, got: list[dict], buckets: int) -> np.ndarray:
    """Which texts are copies of a whole earlier text."""
    if not len(b.digest):
        return np.zeros(len(b.texts), bool)
    earlier, _ = shared.read_bits(got, EARLIER, buckets, b.digest)
    least = b.least[b.place]
    return (b.place >= 0) & (earlier[b.place] | (b.ids > least))


@query()
def op5_suffixes(spark, folder):
    return without_earlier(table(spark, folder, "documents"))
