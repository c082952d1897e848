"""Align the tokens of two tokenizers over the same bytes, in lockstep.

Documents are gathered in chunks of bounded bytes. Texts are cut where a single space
stands between two characters that are not blank; both tokenizers always end a token
there, so the parts can be encoded apart and are *lanes* of their own. One state vector
holds a pointer into A's and into B's tokens for every lane of the chunk. In each step all
lanes emit a link between the tokens they point to, emit a cut where both tokens end at
the same byte, and move the pointer whose token ends first (both at a cut); lanes that are
done leave the vector. A long lane without such spaces is cut at bytes where tokens of both
end, so that none takes many steps.

How often two ids are linked is counted over all documents: a chunk gives each of its
pairs of ids once, with a count, and keeps which pairs each document has. Totals are summed
by pair and come back to the chunks by a join, so a common pair is one row per chunk. The
best count of a B id is broadcast: one row per id of B's vocabulary.

A's vocabulary and merges are read from its file and run by a byte-level engine that takes
ranks; files that are not plain byte-level BPE are refused.

Defined cases: texts that are null, empty, not valid UTF-8, or that a tokenizer does not
give back byte for byte (as with U+2581 in B) have no tokens and count nowhere; null and
repeated doc_ids are kept, each row for itself; an empty table gives an empty result; other
columns are ignored. One text with its tokens must fit in a worker's memory, about 60 bytes
for each of its own.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.registry import query, table
from tidemark.session import cut_lineage

CHUNK_BYTES = 4 << 20
#: Characters from which on a text is cut at the next blank, and tokens of a lane without one.
LANE_CHARS, LANE_TOKENS = 512, 1024
#: Lanes encoded at once.
RUN = 1024
#: A pair of ids is one number, B's id in the low bits.
B_BITS = 20
BLANK = "▁"

# Fixed value: how byte-level BPE with "use_regex" splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it
    prints, the others in order from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        with open(a_path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"], spec["model"]
        vocabulary = dict(model["vocab"])
        for added in spec["added_tokens"]:
            vocabulary.pop(added["content"], None)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        merged = [vocabulary[a + b] for a, b in pairs]
        plain = before["type"] == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        if spec["normalizer"] or model["type"] != "BPE" or not plain or merged != sorted(merged):
            raise ValueError(f"{a_path} is not a plain byte-level BPE")
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in word): i for word, i in vocabulary.items()}
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.a_size = np.zeros(max(ranks.values()) + 1, np.int64)
        self.a_size[list(ranks.values())] = [len(word) for word in ranks]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        if len(pieces) > 1 << B_BITS:
            raise ValueError(f"{b_path} has more than {1 << B_BITS} pieces")
        # Merges cannot pass from a letter to a blank if no piece has them side by side.
        self.cuts = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.b_size = np.array([len(x) for x in self.b_bytes])
        most = max(len(self.a_size), len(self.b_bytes))
        self.texts = [f"{i}{mark}".encode() for i in range(most) for mark in ",|;"]

    def lanes(self, text: str) -> list[str]:
        out, at = [], 0
        while self.cuts and len(text) - at > LANE_CHARS:
            end = text.find(" ", at + LANE_CHARS)
            while end > 0 and (text[end - 1].isspace() or text[end + 1 : end + 2].isspace() or end + 1 == len(text)):
                end = text.find(" ", end + 1)
            if end < 0:
                break
            out.append(text[at:end])
            at = end + 1
        return [*out, text[at:]]


def worker_tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """The tokenizers of this Python worker, kept from task to task."""
    kept = sys.modules.setdefault("_tidemark_pairs", types.ModuleType("_tidemark_pairs"))
    if getattr(kept, "paths", None) != (a_path, b_path):
        kept.both, kept.paths = Tokenizers(a_path, b_path), (a_path, b_path)
    return kept.both


@dataclass
class Tokens:
    """Tokens of a chunk: ids, and how many each lane and each document has."""

    a: np.ndarray
    b: np.ndarray
    a_lane: np.ndarray
    b_lane: np.ndarray
    #: The document of each lane, in order.
    owner: np.ndarray


def encoded(both: Tokenizers, texts: list[bytes | None]) -> Tokens:
    lanes: list[str] = []
    owner: list[int] = []
    for at, raw in enumerate(texts):
        try:
            text = (raw or b"").decode()
        except UnicodeDecodeError:
            continue
        parts = both.lanes(text) if text else []
        lanes += parts
        owner += [at] * len(parts)
    whole = np.ones(len(texts), bool)
    ids: tuple[list, list] = ([], [])
    sizes: tuple[list, list] = ([], [])
    encode, decode, b_bytes = both.a.encode_ordinary, both.a.decode_bytes, both.b_bytes.__getitem__
    for at in range(0, len(lanes), RUN):
        some = lanes[at : at + RUN]
        found = ([encode(" " + lane) for lane in some], both.b.encode(some, num_threads=1))
        for doc, lane, a, b in zip(owner[at : at + RUN], some, *found):
            raw = (" " + lane).encode()
            if b"".join(map(b_bytes, b)) != raw or decode(a) != raw:
                whole[doc] = False
        for side in (0, 1):
            ids[side].append(np.fromiter(chain.from_iterable(found[side]), np.int32))
            sizes[side].append(np.fromiter(map(len, found[side]), np.int64, len(some)))
    owners = np.array(owner, np.int64)
    keep = whole[owners]
    out = []
    for side in (0, 1):
        n = np.concatenate([np.zeros(0, np.int64), *sizes[side]])
        out.append((np.concatenate([np.zeros(0, np.int32), *ids[side]])[np.repeat(keep, n)], n[keep]))
    (a, a_lane), (b, b_lane) = out
    return Tokens(a, b, a_lane, b_lane, owners[keep])


def lane_starts(a_end: np.ndarray, b_end: np.ndarray, a_lane: np.ndarray, b_lane: np.ndarray):
    """First token of each lane in A and in B; long lanes are cut where tokens of both end."""
    a_start, b_start = np.cumsum(a_lane) - a_lane, np.cumsum(b_lane) - b_lane
    more_a, more_b = [a_start], [b_start]
    for lane in np.flatnonzero(a_lane + b_lane > 4 * LANE_TOKENS).tolist():
        i, j = a_start[lane], b_start[lane]
        _, at_a, at_b = np.intersect1d(
            a_end[i : i + a_lane[lane]], b_end[j : j + b_lane[lane]], assume_unique=True, return_indices=True
        )
        pick = np.unique(np.searchsorted(at_a, np.arange(LANE_TOKENS, a_lane[lane], LANE_TOKENS)))
        pick = pick[pick < len(at_a) - 1]
        more_a.append(i + at_a[pick] + 1)
        more_b.append(j + at_b[pick] + 1)
    return np.sort(np.concatenate(more_a)), np.sort(np.concatenate(more_b))


def lockstep(a_end: np.ndarray, b_end: np.ndarray, a_start: np.ndarray, b_start: np.ndarray):
    """All links in order, as positions in A and in B, and which of them end a group.

    ``a_end`` and ``b_end`` are the bytes at which tokens end, over all lanes; a lane starts
    and ends at the same byte in both.
    """
    stop = np.append(a_start, len(a_end))[1:]
    room = stop - a_start + np.diff(np.append(b_start, len(b_end)))
    link_a = np.full(int(room.sum()), -1, np.int64)
    link_b = np.empty(len(link_a), np.int64)
    is_cut = np.zeros(len(link_a), bool)
    # Pointer into A, pointer into B, A's end, where the next link goes.
    state = np.stack([a_start, b_start, stop, np.cumsum(room) - room])
    while state.shape[1]:
        i, j, _, slot = state
        link_a[slot], link_b[slot] = i, j
        ends_a, ends_b = a_end[i], b_end[j]
        is_cut[slot] = ends_a == ends_b
        moves = ends_a <= ends_b, ends_b <= ends_a
        i += moves[0]
        j += moves[1]
        slot += 1
        live = i < state[2]
        if not live.all():
            state = state[:, live]
    held = link_a >= 0
    return link_a[held], link_b[held], is_cut[held]


@dataclass
class Aligned:
    """Tokens, links and cuts of a chunk, and where each document's end (exclusive)."""

    a: np.ndarray
    b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    #: Last tokens of each group.
    cut_a: np.ndarray
    cut_b: np.ndarray
    a_stop: np.ndarray
    b_stop: np.ndarray
    link_stop: np.ndarray
    cut_stop: np.ndarray


def align(both: Tokenizers, texts: list[bytes | None]) -> Aligned:
    tokens = encoded(both, texts)
    a_end, b_end = np.cumsum(both.a_size[tokens.a]), np.cumsum(both.b_size[tokens.b])
    starts = lane_starts(a_end, b_end, tokens.a_lane, tokens.b_lane)
    link_a, link_b, is_cut = lockstep(a_end, b_end, *starts)
    a_stop = np.cumsum(np.bincount(tokens.owner, tokens.a_lane, len(texts)).astype(np.int64))
    b_stop = np.cumsum(np.bincount(tokens.owner, tokens.b_lane, len(texts)).astype(np.int64))
    cut_a, cut_b = link_a[is_cut], link_b[is_cut]
    return Aligned(
        tokens.a, tokens.b, link_a, link_b, cut_a, cut_b, a_stop, b_stop,
        np.searchsorted(link_a, a_stop), np.searchsorted(cut_a, a_stop),
    )


def group_digests(both: Tokenizers, found: Aligned) -> list[str]:
    """SHA-256 of each document's groups as text; empty without tokens."""
    size_a = np.diff(found.cut_a, prepend=-1)
    size_b = np.diff(found.cut_b, prepend=-1)
    codes = np.empty(len(found.a) + len(found.b), np.int32)
    place_a = np.arange(len(found.a)) + np.repeat(found.cut_b - size_b + 1, size_a)
    place_b = np.arange(len(found.b)) + np.repeat(found.cut_a + 1, size_b)
    codes[place_a], codes[place_b] = 3 * found.a, 3 * found.b
    codes[place_a[found.cut_a]] += 1
    codes[place_b[found.cut_b]] += 2
    out, at = [], 0
    text = both.texts.__getitem__
    for stop in (found.a_stop + found.b_stop).tolist():
        joined = b"".join(map(text, codes[at:stop].tolist()))
        out.append(hashlib.sha256(joined[:-1]).hexdigest() if joined else "")
        at = stop
    return out


def packed(values: np.ndarray) -> bytes:
    """By planes of bytes, compressed."""
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours, undone by a running sum of the same type."""
    return np.diff(values, prepend=values.dtype.type(0))


def document_pairs(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The chunk's pairs and their counts; then, by document, which pairs it has (places
    among the chunk's) and how often, and how many there are per document."""
    sizes = np.diff(found.link_stop, prepend=0)
    pair = (found.a[found.link_a].astype(np.int64) << B_BITS) | found.b[found.link_b]
    bits = max(1, int(pair.max(initial=0)).bit_length())
    if bits + len(sizes).bit_length() > 63:
        raise ValueError("too many documents in a chunk")
    keyed = (np.repeat(np.arange(len(sizes)), sizes) << bits) | pair
    keyed.sort()
    first = np.flatnonzero(np.diff(keyed, prepend=-1))
    times = np.diff(np.append(first, len(keyed)))
    docs, own = keyed[first] >> bits, keyed[first] & ((1 << bits) - 1)
    pairs, place = np.unique(own, return_inverse=True)
    counts = np.bincount(place, times, len(pairs)).astype(np.int64)
    return pairs, counts, place.astype(np.uint32), times.astype(np.uint32), np.bincount(docs, minlength=len(sizes))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes | None]]]:
    """Chunks of rows, whatever the sizes of the batches."""
    ids: list = []
    texts: list[bytes | None] = []
    held = 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids.append(doc)
            texts.append(text)
            held += 64 + len(text or b"")
            if held >= CHUNK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def pieces(flat: np.ndarray, stops: np.ndarray) -> list[np.ndarray]:
    return np.split(flat, stops[:-1]) if len(stops) else []


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: doc_id, the ids of both sides, after how many tokens of each side a group
    ends, and the links as positions among the document's tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(a_path, b_path)
        for ids, texts in gathered(batches):
            x = align(both, texts)
            first_a, first_b = np.append(0, x.a_stop[:-1]), np.append(0, x.b_stop[:-1])
            links, cuts = np.diff(x.link_stop, prepend=0), np.diff(x.cut_stop, prepend=0)
            columns = {
                "a_ids": pieces(x.a, x.a_stop),
                "b_ids": pieces(x.b, x.b_stop),
                "a_cuts": pieces(x.cut_a + 1 - np.repeat(first_a, cuts), x.cut_stop),
                "b_cuts": pieces(x.cut_b + 1 - np.repeat(first_b, cuts), x.cut_stop),
                "a_links": pieces(x.link_a - np.repeat(first_a, links), x.link_stop),
                "b_links": pieces(x.link_b - np.repeat(first_b, links), x.link_stop),
            }
            arrays = {c: pa.array(v, pa.list_(pa.int32())) for c, v in columns.items()}
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, kind)} | arrays)

    kind = arrow_type(docs)
    lists = ", ".join(f"{c} array<int>" for c in ("a_ids", "b_ids", "a_cuts", "b_cuts", "a_links", "b_links"))
    name = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, f"doc_id {name}, {lists}")


def arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def chunked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per chunk: its documents with counts and digests, its pairs of ids with counts,
    and which pairs each document has."""
    kind = arrow_type(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = worker_tokenizers(a_path, b_path)
        chunk = TaskContext.get().partitionId() << 32
        for ids, texts in gathered(batches):
            x = align(both, texts)
            pairs, counts, place, times, runs = document_pairs(x)
            stops = (x.a_stop, x.b_stop, x.cut_stop, x.link_stop)
            lists = {c: np.diff(s, prepend=0) for c, s in zip(COUNTS, stops)} | {"runs": runs}
            arrays = {c: pa.array([v], pa.list_(pa.int64())) for c, v in lists.items()}
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([chunk], pa.int64()),
                    "doc_id": pa.array([ids], pa.list_(kind)),
                    "digest": pa.array([group_digests(both, x)], pa.list_(pa.string())),
                    **arrays,
                    "pairs": pa.array([packed(steps(pairs))], pa.binary()),
                    "counts": pa.array([packed(counts)], pa.binary()),
                    "place": pa.array([packed(steps(place))], pa.binary()),
                    "times": pa.array([packed(times)], pa.binary()),
                }
            )
            chunk += 1

    name = docs.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<bigint>" for c in (*COUNTS, "runs"))
    packs = "pairs binary, counts binary, place binary, times binary"
    schema = f"chunk bigint, doc_id array<{name}>, digest array<string>, {lists}, {packs}"
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(run, schema)


def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each pair of a chunk."""
    for batch in batches:
        for row in batch.to_pylist():
            pairs = np.cumsum(unpacked(row["pairs"], np.int64))
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(np.full(len(pairs), row["chunk"])),
                    "pair": pa.array(pairs),
                    "n": pa.array(unpacked(row["counts"], np.int64)),
                }
            )


def summed(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per row: counts, digest, and sums over its links of what the links count corpus-wide."""
    chunks = cut_lineage(chunked(docs, a_path, b_path))
    held = chunks.select("chunk", "pairs", "counts").mapInArrow(spread, "chunk long, pair long, n long")
    totals = cut_lineage(held.groupBy("pair").agg(F.sum("n").alias("count")))
    b_id = F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1))
    # A row per id of B's vocabulary.
    top = F.broadcast(totals.groupBy(b_id.alias("b")).agg(F.max("count").alias("top")))
    marked = totals.join(top, b_id == F.col("b")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = held.select("chunk", "pair").join(marked, "pair")
    kind = arrow_type(docs)

    def finish(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        order = np.argsort(right.column("pair").to_numpy())
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy()[order].astype(np.int64)
        place = np.cumsum(unpacked(row["place"], np.uint32), dtype=np.uint32)
        times = unpacked(row["times"], np.uint32).astype(np.int64)
        stops = np.append(0, np.cumsum(row["runs"]))

        def sums(of: np.ndarray) -> pa.Array:
            until = np.append(0, np.cumsum(of[place] * times))
            return pa.array(np.diff(until[stops]), pa.int64())

        return pa.table(
            {"doc_id": pa.array(row["doc_id"], kind)}
            | {c: pa.array(row[c], pa.int64()) for c in COUNTS}
            | {"n_best": sums(best), "count_sum": sums(count), "groups_sha256": pa.array(row["digest"], pa.string())}
        )

    name = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum"))
    own = chunks.drop("pairs", "counts").groupBy("chunk")
    return own.cogroup(answers.groupBy("chunk")).applyInArrow(finish, f"doc_id {name}, {counts}, groups_sha256 string")


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query()
def op12_alignment(spark, folder):
    return summed(table(spark, folder, "documents"), *tokenizer_paths())
