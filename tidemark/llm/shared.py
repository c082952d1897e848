"""Ask of many keys at once which of them other parts of a table hold too.

Documents are dealt in *batches* of bounded bytes. A batch sends its distinct keys to
*buckets* (by the key itself) as one array per bucket; a bucket sorts what it gets and
answers each batch with one bit per key, in the order asked. A key travels once per
batch that has it, however often it occurs there, so no key is hot. Batches and buckets
grow in number with the data, not in size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
#: A key that more batches hold is spread by what stands around it.
HOT_BATCHES = 512
REQUEST = "batch int, bucket int, kind int, keys binary, checks binary, owners binary, note binary"
ANSWER = "batch int, bucket int, kind int, bits binary, note binary"
#: Kinds of question: is the key held elsewhere; with an equal check; by a smaller owner;
#: with differing checks (a check of 0 differs from all).
HELD, CHECKED, EARLIER, BRANCH = 0, 1, 2, 3
#: Powers up to so many symbols are kept by a worker.
FEW = (1 << 18) + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)
_STEP_2 = np.uint64(0xAF251AF3B0F025B5)


def dealt(docs: DataFrame, *columns: str) -> tuple[DataFrame, int]:
    """``batch``, the given columns and ``text`` as bytes, moved to its batch (by the
    first column); and the number of buckets for keys of these texts."""
    size = F.sum(F.octet_length("text") + 64)
    total = docs.agg(size.cast("long")).first()[0] or 0
    batches = max(1, -(-total // BATCH_BYTES))
    spot = F.pmod(F.xxhash64(columns[0], F.octet_length("text")), F.lit(batches)).cast("int")
    rows = docs.select(spot.alias("batch"), *columns, F.col("text").cast("binary").alias("text"))
    return rows.repartition("batch"), max(1, -(-total // BUCKET_BYTES))


def in_order(rows: pa.Table) -> pa.Table:
    """The rows of a batch by doc_id and text. A shuffle hands them over in any order, and
    positions that one pass counts are read in another; rows alike in both are exchangeable."""
    return rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _MIX
    x ^= x >> np.uint64(29)
    x *= _STEP_2
    x ^= x >> np.uint64(32)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct values in order."""
    x = np.sort(x)
    return x[np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])]


def _inverse(odd: np.uint64) -> np.uint64:
    x = int(odd)
    y = x
    for _ in range(6):
        y = y * (2 - x * y) % (1 << 64)
    return np.uint64(y)


_INVERSE, _INVERSE_2 = _inverse(_STEP), _inverse(_STEP_2)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


@cache
def _few_powers(base: np.uint64) -> np.ndarray:
    return _powers(base, FEW)


def _first_powers(base: np.uint64, n: int) -> np.ndarray:
    return _few_powers(base)[:n] if n <= FEW else _powers(base, n)


class Rolling:
    """Hashes of any runs of ``symbols`` (unsigned 64-bit) in constant time each."""

    def __init__(self, symbols: np.ndarray, second: bool = False):
        step = _STEP_2 if second else _STEP
        n = len(symbols) + 1
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(symbols * _first_powers(step, n)[:-1], out=self.sums[1:])
        self.back = _first_powers(_INVERSE_2 if second else _INVERSE, n)

    def every(self, length: int) -> np.ndarray:
        """The hash of each run of ``length`` symbols."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        out = self.sums[length:] - self.sums[:-length]
        out *= self.back[: len(out)]
        return mixed(out)

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mixed(raw + (end - start).astype(np.uint64) * _MIX)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    if len(values) < width:
        return np.zeros(0, values.dtype)
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if span < width:
        values = np.minimum(values[: len(values) - (width - span)], values[width - span :])
    return values


def minimizers(rolling: Rolling, window: int, gram: int) -> np.ndarray:
    """For each window, the least hash of the grams in it; equal windows agree."""
    return sliding_min(rolling.every(gram), window - gram + 1)


def starts_within(sizes: np.ndarray, window: int) -> np.ndarray:
    """Which starts in the joined texts have their whole window in one text."""
    total = int(sizes.sum())
    ok = np.ones(max(0, total - window + 1), bool)
    ends = np.cumsum(sizes)
    for end in ends[:-1] if len(ends) else []:
        ok[max(0, end - window + 1) : end] = False
    return ok


def part_ranges(sizes: list[int], most: int, window: int) -> list[tuple[int, list[int]]]:
    """Cut joined texts into parts of about ``most`` symbols: where each begins, and the
    sizes of the texts in it. A longer text is cut into parts of its own, that overlap by
    one symbol less than a window, so each window lies in one part."""
    parts: list[tuple[int, list[int]]] = []
    open_part: list[int] = []
    at = base = held = 0
    for n in sizes:
        if open_part and held + n > most:
            parts.append((base, open_part))
            open_part, held = [], 0
        if n > most:
            for i in range(0, n, most):
                m = min(n, i + most + window - 1) - i
                if m >= window:
                    parts.append((at + i, [m]))
        else:
            if not open_part:
                base = at
            open_part.append(n)
            held += n
        at += n
    if open_part:
        parts.append((base, open_part))
    return parts


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    shift = np.cumsum(size) - size
    return np.repeat(start - shift, size) + np.arange(int(size.sum()))


def cut_runs(values: np.ndarray, ok: np.ndarray, longest: int, alone: np.ndarray | None = None):
    """``start, count`` of runs of neighbouring windows of one value, where ``ok``; none
    has more than ``longest`` windows, and those marked ``alone`` have one."""
    at = np.flatnonzero(ok)
    if not len(at):
        return at, at
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (values[at[1:]] != values[at[:-1]])
    if alone is not None:
        new |= alone[at]
    first = np.flatnonzero(new)
    ordinal = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(ordinal % longest == 0)
    return at[first], np.diff(np.append(first, len(at)))


def parted(home: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number that occurs in ``home``, with its places in order: one sort, however
    many numbers there are."""
    order = np.argsort(home, kind="stable")
    starts = np.flatnonzero(np.diff(home[order], prepend=-1))
    for b, mine in zip(home[order[starts]].tolist(), np.split(order, starts[1:]) if len(starts) else ()):
        yield b, mine


def request_rows(batch: int, kind: int, buckets: int, keys, checks=None, owners=None) -> list[tuple]:
    """One row per bucket for sorted distinct ``keys``."""
    home = (keys % np.uint64(buckets)).astype(np.int64)
    rows = []
    for b, mine in parted(home):
        rows.append(
            (batch, b, kind, keys[mine].tobytes(), None if checks is None else checks[mine].tobytes(),
             None if owners is None else owners[mine].tobytes(), None)
        )
    return rows


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


REQUEST_ARROW = pa.schema(
    [("batch", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()),
     ("checks", pa.binary()), ("owners", pa.binary()), ("note", pa.binary())]
)
ANSWER_ARROW = pa.schema(
    [("batch", pa.int32()), ("bucket", pa.int32()), ("kind", pa.int32()), ("bits", pa.binary()),
     ("note", pa.binary())]
)


def _joined(blobs: list, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in blobs]) if blobs else np.zeros(0, kind)


def grouped(keys: np.ndarray, checks: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal (key, check) together, and where each group begins."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    if checks is not None:
        c = checks[order]
        if (~new[1:] & (c[1:] != c[:-1])).any():
            order = np.lexsort((checks, keys))
            k, c = keys[order], checks[order]
            new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    return order, np.flatnonzero(new)


def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Bits for the requests of one bucket: held in another batch (or by a smaller
    owner), then, in a second half, held by very many batches (or with differing checks)."""
    rows, out = table.to_pylist(), []
    for kind in sorted({r["kind"] for r in rows}):
        mine = [r for r in rows if r["kind"] == kind]
        sizes = [len(r["keys"]) // 8 for r in mine]
        keys = _joined([r["keys"] for r in mine], np.uint64)
        checks = None if kind == HELD else _joined([r["checks"] for r in mine], np.uint64)
        order, first = grouped(keys, None if kind == BRANCH else checks)
        held = np.diff(np.append(first, len(keys)))
        if kind == EARLIER:
            owners = _joined([r["owners"] for r in mine], np.int64)
            least = np.minimum.reduceat(owners[order], first) if len(first) else owners
            yes = np.zeros(len(keys), bool)
            yes[order] = np.repeat(least, held) < owners[order]
        else:
            yes = np.zeros(len(keys), bool)
            yes[order] = np.repeat(held > 1, held)
        hot = np.zeros(len(keys), bool)
        if kind == BRANCH and len(first):
            least = np.minimum.reduceat(checks[order], first)
            differs = (least == 0) | (least != np.maximum.reduceat(checks[order], first))
            hot[order] = np.repeat(differs, held)
        else:
            hot[order] = np.repeat(held > HOT_BATCHES, held)
        at = 0
        for r, n in zip(mine, sizes):
            bits = np.packbits(np.concatenate([yes[at : at + n], hot[at : at + n]])).tobytes()
            out.append((r["batch"], r["bucket"], kind, bits, r["note"]))
            at += n
    return table_of(out, ANSWER_ARROW)


def answers(requests: DataFrame) -> DataFrame:
    return requests.groupBy("bucket").applyInArrow(answer, ANSWER)


def read_bits(rows: list[dict], kind: int, buckets: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answers to ``keys`` (as in :func:`request_rows`): held, hot."""
    yes, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    places = dict(parted((keys % np.uint64(buckets)).astype(np.int64)))
    for r in rows:
        if r["kind"] == kind:
            mine = places[r["bucket"]]
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=2 * len(mine)).astype(bool)
            yes[mine], hot[mine] = bits[: len(mine)], bits[len(mine) :]
    return yes, hot


def ask(texts: DataFrame, questions: Callable, buckets: int) -> DataFrame:
    """Answers to what ``questions(batch table)`` asks, a list of request rows."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return table_of(questions(key[0].as_py(), table), REQUEST_ARROW)

    return answers(texts.groupBy("batch").applyInArrow(run, REQUEST))


def covered(starts: np.ndarray, counts: np.ndarray, window: int, total: int) -> np.ndarray:
    """Which of ``total`` symbols lie in a window of the given runs of windows."""
    edge = np.bincount(starts, minlength=total + 1)
    edge -= np.bincount(starts + counts + window - 1, minlength=total + 1)
    return np.cumsum(edge)[:total] > 0


def kept_pieces(drop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the runs that stay."""
    edge = np.diff(np.concatenate([[True], drop, [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
