"""Pack token sequences into windows with little padding, by non-negative least squares.

A document is tokenised once; windows it fills alone are cut off at once, so only the
remainders (shorter than a window) are packed. Shallow combinations of two to four
lengths that fill a window exactly are enumerated from the histogram of remainders,
and non-negative least squares finds how often each is used; the counts are rounded to
what the histogram holds. Remainders get a rank within their length and so a place in a
combination. What is left is packed greedily, best fit first, in blocks.

The histogram has one row per length below the window, whatever the data's size; it and
the plan are all the driver sees.

Defined cases: null or empty text is the end token alone; repeated rows are packed each;
an empty table gives no pieces; other columns are ignored; a very long text is cut into
as many windows as it fills.
"""

from __future__ import annotations

import os
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm import shared
from tidemark.llm.registry import query, table
from tidemark.session import cut_lineage

WINDOW = 2048
END = 1
#: Remainders in one greedy block, and items whose rank one task computes.
BLOCK_ITEMS = 20_000
#: Distinct words that a Python worker remembers the ids of, some 130 bytes each. An executor
#: may hold more workers than cores, and each keeps its own.
MEMO_WORDS = 640_000
RUN_WORDS = 512
TEXTS_AT_ONCE = 1024
#: Marks that end words; without the apostrophe and what special tokens end in.
TAIL = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'
#: Between words that are tokenised together; a word that holds it is tokenised alone.
SEPARATOR = "\x01"
PIECE = "key long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Numbers(dict):
    """Numbers keys in the order in which they are first looked up."""

    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


class WordIds:
    """Token ids of texts, word by word; the tokenizer never merges across blanks.

    A word is its core and a tail of marks: after an ASCII letter or digit, a tail of
    these marks is tokenised apart, and ASCII letters are lowered first in any case. So
    cores are few. Ids of cores and tails lie in one flat array, found by number. A core is
    looked up as a word, so no second table of them is held.

    Beyond ``MEMO_WORDS`` the words that came once are forgotten, and of the others the
    rarer half if they are too many.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        (self.mark,) = self._encode([SEPARATOR])[0]
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.seen = np.zeros(0, np.int64)
        self.parts = np.zeros((1 << 18, 2), np.int32)
        self.tail_number: dict[bytes, int] = {b"": 0}
        self.flat = np.zeros(0, np.uint16)
        self.ends = np.zeros(2, np.int64)

    def forget(self) -> None:
        """Keep the words that came again, at most half of ``MEMO_WORDS``."""
        often = np.flatnonzero(self.seen > 1)
        most = MEMO_WORDS // 2
        if len(often) > most:
            often = np.sort(often[np.argsort(-self.seen[often], kind="stable")[:most]])
        words, tails, flat, ends = list(self.number), self.tail_number, self.flat, self.ends
        # Part 0, the empty one, stays first.
        stay, part = np.unique(np.append(self.parts[often].ravel(), 0), return_inverse=True)
        # Words that do not come again go in the end.
        seen = self.seen[often] // 2
        self.clear()
        self.number.update((words[i], n) for n, i in enumerate(often.tolist()))
        self.seen = seen
        self._hold(len(often))
        self.parts[: len(often)] = part[:-1].reshape(-1, 2)
        new = dict(zip(stay.tolist(), range(len(stay))))
        self.tail_number = {t: new[i] for t, i in tails.items() if i in new}
        size = ends[stay + 1] - ends[stay]
        self.flat = flat[shared.ranges(ends[stay], size)]
        self.ends = np.concatenate([[0], np.cumsum(size)])

    def _hold(self, words: int) -> None:
        while words > len(self.parts):
            self.parts = np.concatenate([self.parts, np.zeros_like(self.parts)])

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, words: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words in another order, all their ids, and how many each has."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        joint = [t for t in texts if SEPARATOR not in t]
        alone = [t for t in texts if SEPARATOR in t]
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        runs = [joint[i : i + RUN_WORDS] for i in range(0, len(joint), RUN_WORDS)]
        for run, got in zip(runs, self._encode([f" {SEPARATOR} ".join(run) for run in runs])):
            row = np.array(got, np.uint32)
            cuts = np.flatnonzero(row == self.mark)
            if len(cuts) == len(run) - 1:
                ids.append(row[row != self.mark])
                sizes.append(np.diff(np.concatenate([[-1], cuts, [len(row)]])) - 1)
            else:
                each = self._encode(run)
                ids.append(np.array([i for x in each for i in x], np.uint32))
                sizes.append(np.array([len(x) for x in each]))
        for x in self._encode(alone):
            ids.append(np.array(x, np.uint32))
            sizes.append(np.array([len(x)]))
        order = [t.encode("utf-8", "surrogatepass") for t in [*joint, *alone]]
        return order, np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, words: list[bytes], at: int) -> None:
        """The ids of ``words``, whose numbers begin with ``at``."""
        cores = [word.rstrip(TAIL) for word in words]
        tails = [word[len(core) :] for word, core in zip(words, cores)]
        for i in [i for i, t in enumerate(tails) if t] + [i for i, c in enumerate(cores) if not c]:
            if b"'" in words[i] or not cores[i][-1:].isalnum():
                cores[i], tails[i] = words[i], b""
        cores = [core.lower() for core in cores]
        # A core is known by its tail's number or by that of the word that it alone is.
        known = {**self.tail_number}
        for core in {*cores} - known.keys():
            n = self.number.get(core, at)
            if n < at and not self.parts[n, 1]:
                known[core] = int(self.parts[n, 0])
        new, ids, sizes = self._ids(list({*cores, *tails} - known.keys()))
        parts = len(self.ends) - 1
        known.update(zip(new, range(parts, parts + len(new))))
        self.tail_number.update((t, known[t]) for t in {*tails} - self.tail_number.keys())
        self.flat = np.concatenate([self.flat, ids.astype(np.uint16)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        self._hold(at + len(words))
        look = known.__getitem__
        self.parts[at : at + len(words), 0] = np.fromiter(map(look, cores), np.int32, len(words))
        self.parts[at : at + len(words), 1] = np.fromiter(map(look, tails), np.int32, len(words))

    def texts(self, texts: list[bytes]) -> list[np.ndarray]:
        if len(self.number) > MEMO_WORDS:
            self.forget()
        before, look = len(self.number), self.number.__getitem__
        split = (t.split() for t in texts)
        numbers = [np.fromiter(map(look, words), np.int32, len(words)) for words in split]
        new = len(self.number) - before
        if new:
            self._learn([*islice(reversed(self.number), new)][::-1], before)
        self.seen = np.append(self.seen, np.zeros(new, np.int64))
        self.seen += np.bincount(np.concatenate([np.zeros(0, np.int32), *numbers]), minlength=len(self.seen))
        out = []
        for at in numbers:
            part = self.parts[at].ravel()
            begin, size = self.ends[part], self.ends[part + 1] - self.ends[part]
            out.append(np.append(self.flat[shared.ranges(begin, size)], END).astype("<u4"))
        return out


def worker_words(path: str) -> WordIds:
    """The word ids of this Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_tidemark_words", types.ModuleType("_tidemark_words"))
    if getattr(kept, "path", None) != path:
        kept.words, kept.path = WordIds(path), path
    return kept.words


def tokenised(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of at most ``window`` ids; ``key`` tells pieces apart once written."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(path)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
                rows, few = [], batch.slice(i, TEXTS_AT_ONCE)
                some = [t or b"" for t in few.column(1).to_pylist()]
                for doc, tokens in zip(few.column(0).to_pylist(), words.texts(some)):
                    raw, n = memoryview(tokens.tobytes()), len(tokens)
                    for start in range(0, n, window):
                        size = min(window, n - start)
                        crc = zlib.crc32(raw[4 * start : 4 * (start + size)])
                        rows.append((key, doc, start, size, crc, n))
                        key += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)],
                    names=["key", "doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    texts = docs.select("doc_id", F.col("text").cast("binary"))
    return texts.mapInArrow(cut, PIECE)


def combinations(held: np.ndarray, window: int = WINDOW, depth: int = 4) -> np.ndarray:
    """Rows of lengths, ascending, that fill the window; 0 fills up short rows.

    All pairs and triples of lengths that occur. Four lengths are two equal pairs'
    halves: a pair (a, b) with a + b = window / 2, twice.
    """
    lengths = np.flatnonzero(held)
    lengths = lengths[(lengths > 0) & (lengths < window)]
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    rows = [np.zeros((0, 4), np.int32)]
    a = lengths[2 * lengths <= window]
    pairs = a[have[window - a]]
    rows.append(np.stack([pairs, window - pairs, 0 * pairs, 0 * pairs], 1))
    for x in lengths[3 * lengths <= window] if depth > 2 else []:
        y = lengths[(lengths >= x) & (x + 2 * lengths <= window)]
        y = y[have[window - x - y]]
        rows.append(np.stack([0 * y + x, y, window - x - y, 0 * y], 1))
    if depth > 3 and window % 2 == 0:
        half = window // 2
        h = lengths[2 * lengths <= half]
        h = h[have[half - h]]
        rows.append(np.stack([h, h, half - h, half - h], 1))
    return np.concatenate(rows).astype(np.int32)


def least_squares(combos: np.ndarray, held: np.ndarray, steps: int = 150) -> np.ndarray:
    """Counts x >= 0 that bring ``A x`` near the histogram: multiplicative updates,
    which keep signs and never raise the squared error."""
    used = combos > 0

    def back(y: np.ndarray) -> np.ndarray:
        return (y[combos] * used).sum(1)

    goal = held.astype(float).copy()
    goal[0] = 0.0
    x = np.full(len(combos), goal.sum() / max(1, used.sum()))
    up = back(goal)
    for _ in range(steps):
        made = np.bincount(combos.ravel(), (used * x[:, None]).ravel(), minlength=len(held))
        made[0] = 0.0
        x *= up / np.maximum(back(made), 1e-12)
    return x


def rounded(combos: np.ndarray, x: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Whole counts that the histogram can meet: first the rounded solution, largest
    counts first, then whatever combination still fits."""
    left = held.astype(np.int64).copy()
    counts = np.zeros(len(combos), np.int64)
    order = np.argsort(-x, kind="stable")
    rows = [[int(a) for a in row if a] for row in combos]
    for only_rounded in (True, False):
        for c in order.tolist():
            row = rows[c]
            n = min(left[a] // row.count(a) for a in row)
            if only_rounded:
                n = min(n, int(x[c]))
            if n > 0:
                counts[c] += n
                for a in row:
                    left[a] -= n
    return counts


def plan(held: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Which ranks of which lengths go where: sorted ranges, as arrays."""
    combos = combinations(held, window)
    counts = rounded(combos, least_squares(combos, held), held) if len(combos) else np.zeros(0, int)
    kept = np.flatnonzero(counts)
    next_rank = np.zeros(window + 1, np.int64)
    ranges, sequence = [], 0
    for c in kept.tolist():
        n, offset = int(counts[c]), 0
        for a in combos[c].tolist():
            if a:
                ranges.append((a, int(next_rank[a]), n, sequence, offset))
                next_rank[a] += n
                offset += a
        sequence += n
    table = np.array(sorted(ranges), np.int64).reshape(-1, 5)
    return {"ranges": table, "allotted": next_rank, "sequences": np.array(sequence)}


def _best_fit(window: int):
    def fit(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """Longest first, each into the fullest sequence that it still fits."""
        size = rows.column("length").to_numpy()
        ids = rows.column("key").to_numpy()
        order = np.lexsort((ids, -size))
        by_space: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]
        spaces, sequences = 0, 0
        at, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for i in order.tolist():
            n = int(size[i])
            fits = spaces >> n
            if fits:
                space = n + (fits & -fits).bit_length() - 1
                number, used = by_space[space].pop()
                if not by_space[space]:
                    spaces &= ~(1 << space)
            else:
                number, used = sequences, 0
                sequences += 1
            at[i], offset[i] = number, used
            left = window - used - n
            if left:
                by_space[left].append((number, used + n))
                spaces |= 1 << left
        base = key[0].as_py() << 32
        return pa.table({"key": ids, "sequence_id": (base + at) * 3 + 2, "offset": offset})

    return fit


def packed(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, a row per piece.

    Ids of sequences that one document fills are 0 modulo 3, of planned ones 1, of
    greedily packed ones 2.
    """
    pieces = cut_lineage(tokenised(docs, path, window))
    rest = pieces.where(F.col("length") < window)
    held = np.zeros(window + 1, np.int64)
    for row in rest.groupBy("length").count().collect():
        held[row[0]] = row[1]
    layout = plan(held, window)
    ranges = layout["ranges"]
    firsts = (ranges[:, 0] << 40) + ranges[:, 1]

    blocks = max(1, -(-int(held.sum()) // BLOCK_ITEMS))
    placed = rest.select(
        "key", "length", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    )
    before = W.partitionBy("length").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    counts = placed.groupBy("length", "block").count().select(
        "length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    number = F.row_number().over(W.partitionBy("length", "block").orderBy("key")) - 1
    ranked = placed.withColumn("number", number).join(counts, ["length", "block"])
    ranked = ranked.select("key", "length", (F.col("before") + F.col("number")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            sequence, offset = np.full(len(rank), -1, np.int64), np.zeros(len(rank), np.int64)
            if len(firsts):
                at = np.searchsorted(firsts, (length << 40) + rank, side="right") - 1
                row = ranges[np.maximum(at, 0)]
                ok = (at >= 0) & (row[:, 0] == length) & (rank < row[:, 1] + row[:, 2])
                sequence[ok] = ((row[:, 3] + rank - row[:, 1]) * 3 + 1)[ok]
                offset[ok] = row[:, 4][ok]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sequence), pa.array(offset)],
                names=["key", "length", "sequence_id", "offset"],
            )

    put = cut_lineage(
        ranked.mapInArrow(place, "key long, length long, sequence_id long, offset long")
    )
    loose = int((held - layout["allotted"])[1:].sum())
    lots = max(1, -(-loose // BLOCK_ITEMS))
    residual = put.where(F.col("sequence_id") < 0).select(
        "key", "length", F.pmod(F.xxhash64("key", F.lit(5)), F.lit(lots)).alias("lot")
    )
    greedy = residual.groupBy("lot").applyInArrow(
        _best_fit(window), "key long, sequence_id long, offset long"
    )
    where = put.where(F.col("sequence_id") >= 0).drop("length").unionByName(greedy)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    alone = pieces.where(F.col("length") == window).withColumns(
        {"sequence_id": F.col("key") * 3, "offset": F.lit(0).cast("long")}
    )
    return alone.select(columns).unionByName(rest.join(where, "key").select(columns))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op7_packing(spark, folder):
    return packed(table(spark, folder, "documents"), tokenizer_path())
