"""Remove fuzzy repeats of lines: MinHash, banding, exact check, union-find.

A line is compared in lower case with runs of blanks as one. Its set is its distinct
8-byte shingles; lines match from a Jaccard similarity of 0.8 on. Signatures of 32
minima in 8 bands of 4 bring candidates together: a pair at 0.8 shares a band with
chance 0.985, one at 0.9 with 0.9997. Candidates are compared exactly, and matching
lines joined to components (``links``). The first line of each component, by doc_id and
place, stays; the others go.

Equal lines are one node from the start. Band values that one batch of documents alone
holds are dropped before any row is made of them.

Defined cases: blank lines are never removed; a line under 8 bytes matches equal lines
only; null text stays null; rows that repeat a doc_id and text keep one of their lines;
a null doc_id comes first; an empty table gives an empty result; other columns are
carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import links, shared
from tidemark.llm.registry import query, table
from tidemark.llm.shared import HELD, Rolling
from tidemark.session import cut_lineage

GRAM = 8
BANDS, ROWS = 8, 4
PERCENT = 80
PART_BYTES = 64 << 10
#: Kind of the row in which a batch keeps the band values of its lines for the next pass.
KEPT = -1
_SYMBOLS = shared.mixed(np.arange(1, 257, dtype=np.uint64))
_DRAW = np.random.default_rng(41)
_FLIP = _DRAW.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_SCALE = _DRAW.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
FOUND = "batch int, node binary, owner long, place int, keys array<long>, body binary"
FOUND_ARROW = pa.schema(
    [("batch", pa.int32()), ("node", pa.binary()), ("owner", pa.int64()), ("place", pa.int32()),
     ("keys", pa.list_(pa.int64())), ("body", pa.binary())]
)


def plain(line: bytes) -> bytes:
    """The line as it is compared; empty for a blank one."""
    return b" ".join(line.lower().split())


def plain_lines(texts: list[bytes]) -> list[list[bytes]]:
    """The lines of each text as they are compared. Few texts have blanks that change, so
    all are searched for them at once."""
    low = [text.lower() for text in texts]
    raw = np.frombuffer(b"\n".join([b"", *low, b""]), np.uint8)
    space, end = raw == 32, raw == 10
    odd = (raw >= 9) & (raw <= 13) & ~end
    # Blanks beside a blank, or at an end of a line.
    odd[1:] |= (space[1:] & (space | end)[:-1]) | (end[1:] & space[:-1])
    change = np.zeros(len(low) + 1, bool)
    starts = np.cumsum([1, *[len(t) + 1 for t in low]])
    # The line end after a text shows a blank before it.
    change[np.searchsorted(starts, np.flatnonzero(odd), side="right") - 1] = True
    return [
        list(map(plain, text.split(b"\n"))) if changes else text.split(b"\n")
        for text, changes in zip(low, change.tolist())
    ]


def shingles(body: bytes) -> np.ndarray:
    return shared.distinct(Rolling(_SYMBOLS[np.frombuffer(body, np.uint8)]).every(GRAM))


def band_keys(bodies: list[bytes]) -> np.ndarray:
    """A row of band values for each body; 0 for those shorter than a shingle.

    Bodies of about one size are taken together, a column each, so minima run along rows.
    """
    sizes = np.array([len(b) for b in bodies], np.int64)
    out = np.zeros((len(bodies), BANDS), np.uint64)
    order = np.argsort(sizes, kind="stable")
    order = order[np.searchsorted(sizes[order], GRAM) :]
    size = sizes[order]
    ends = np.cumsum(size)
    i = 0
    while i < len(order):
        most = min(int(np.searchsorted(ends, ends[i] + PART_BYTES)), int(np.searchsorted(size, size[i] * 5 // 4 + GRAM)))
        j = max(i + 1, most)
        mine = order[i:j]
        joined = np.frombuffer(b"".join([bodies[k] for k in mine.tolist()]), np.uint8)
        grams = (Rolling(_SYMBOLS[joined]).every(GRAM) >> np.uint64(32)).astype(np.uint32)
        count = size[i:j] - GRAM + 1
        begin = np.cumsum(size[i:j]) - size[i:j]
        # Shorter bodies repeat their last shingle, which changes no minimum.
        low = grams[begin + np.minimum(np.arange(count[-1])[:, None], count - 1)]
        turned = np.empty_like(low)
        for band in range(BANDS):
            key = np.full(len(mine), band + 1, np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                np.bitwise_xor(low, _FLIP[k], out=turned)
                np.multiply(turned, _SCALE[k], out=turned)
                key = shared.mixed(key * np.uint64(1_000_003) + turned.min(axis=0))
            out[mine, band] = key
        i = j
    return out


class Lines:
    """The distinct lines of a batch, where each first stands, and how often."""

    def __init__(self, texts: list[bytes | None], owners: list[int]):
        self.places: list[list[tuple[int, int]]] = []
        self.first: list[tuple[int, int]] = []
        number: dict[bytes, int] = {}
        counts: list[int] = []
        for own, owner in zip(plain_lines([text or b"" for text in texts]), owners):
            row = []
            for place, body in enumerate(own):
                if not body:
                    continue
                at = number.setdefault(body, len(number))
                if at == len(counts):
                    counts.append(1)
                    self.first.append((owner, place))
                else:
                    counts[at] += 1
                    self.first[at] = min(self.first[at], (owner, place))
                row.append((place, at))
            self.places.append(row)
        self.bodies = list(number)
        self.counts = np.array(counts, np.int64)
        self.nodes = list(map(xxhash.xxh3_128_digest, self.bodies))
        self.halves = np.frombuffer(b"".join(self.nodes), np.uint64).reshape(-1, 2)
        self.names = self.halves[:, 0].copy()

    def by_node(self) -> np.ndarray:
        """The numbers of the lines by digest: one order in each pass, whatever the rows' order."""
        return np.lexsort(self.halves.T)


def _rows(docs: DataFrame):
    owner = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return shared.dealt(docs.select(owner.alias("owner"), row.alias("row"), "text"), "owner", "row")


def cleaned(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The columns of ``docs`` without the repeated lines in ``text``, and
    ``__lines, __removed``: how many lines there were, and how many went."""
    texts, buckets = _rows(docs)

    def about_lines(batch: int, rows: pa.Table) -> list[tuple]:
        lines = Lines(rows.column("text").to_pylist(), rows.column("owner").to_pylist())
        keys = band_keys(lines.bodies)
        distinct = shared.distinct(np.concatenate([keys[keys != 0], lines.names]))
        kept = keys[lines.by_node()].tobytes()
        return [*shared.request_rows(batch, HELD, buckets, distinct), (batch, -1, KEPT, kept, None, None, None)]

    def candidates(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        lines = Lines(rows.column("text").to_pylist(), rows.column("owner").to_pylist())
        told = told.to_pylist()
        keys = np.zeros((len(lines.bodies), BANDS), np.uint64)
        for kept in [r["bits"] for r in told if r["kind"] == KEPT]:
            keys[lines.by_node()] = np.frombuffer(kept, np.uint64).reshape(-1, BANDS)
        distinct, counts = np.unique(np.concatenate([keys[keys != 0], lines.names]), return_counts=True)
        held = shared.read_bits(told, HELD, buckets, distinct)[0] | (counts > 1)
        shared_band = (keys != 0) & held[np.minimum(np.searchsorted(distinct, keys), len(distinct) - 1)] if len(
            distinct
        ) else keys != 0
        again = held[np.searchsorted(distinct, lines.names)] | (lines.counts > 1)
        some = shared_band.any(axis=1)
        out = []
        for i in np.flatnonzero(again | some).tolist():
            mine = keys[i][shared_band[i]].astype(np.int64) if some[i] else None
            owner, place = lines.first[i]
            out.append((key[0].as_py(), lines.nodes[i], owner, place, mine, lines.bodies[i] if some[i] else None))
        return shared.table_of(out, FOUND_ARROW)

    def ask(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return shared.table_of(about_lines(key[0].as_py(), rows), shared.REQUEST_ARROW)

    requests = cut_lineage(texts.groupBy("batch").applyInArrow(ask, shared.REQUEST))
    kept = requests.where(F.col("kind") == KEPT).select("batch", "bucket", "kind", F.col("keys").alias("bits"), "note")
    asked = shared.answers(requests.where(F.col("kind") == HELD)).unionByName(kept)
    found = cut_lineage(
        texts.groupBy("batch").cogroup(asked.groupBy("batch")).applyInArrow(candidates, FOUND)
    )
    members = found.where(F.col("keys").isNotNull()).select(
        F.explode("keys").alias("key"), "node", F.octet_length("body").alias("size")
    )
    bodies = found.where(F.col("body").isNotNull()).groupBy("node").agg(F.first("body").alias("body"))
    roots = links.link(members, bodies, shingles, percent)
    # Read twice below.
    nodes = cut_lineage(found.groupBy("node").agg(F.min(F.struct("owner", "place")).alias("first")))
    keepers = links.rooted(nodes, roots, "first")
    back = found.select("batch", "node").join(keepers, "node").select(
        "batch", "node", F.col("least.owner").alias("owner"), F.col("least.place").alias("place")
    )

    def apply(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        owners = rows.column("owner").to_pylist()
        raw = rows.column("text").to_pylist()
        lines = Lines(raw, owners)
        stays = {r["node"]: (r["owner"], r["place"]) for r in told.to_pylist()}
        used: set[tuple[int, int]] = set()
        out: dict[str, list] = {"text": [], "lines": [], "removed": []}
        for text, owner, row in zip(raw, owners, lines.places):
            gone = set()
            for place, at in row:
                first = stays.get(lines.nodes[at])
                if first is None:
                    continue
                if first == (owner, place) and first not in used:
                    used.add(first)
                else:
                    gone.add(place)
            if text is not None and gone:
                text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)
            out["text"].append(text)
            out["lines"].append(len(row))
            out["removed"].append(len(gone))
        return pa.table(
            {
                "row": rows.column("row"),
                "text": pa.array(out["text"], pa.binary()),
                "__lines": pa.array(out["lines"], pa.int64()),
                "__removed": pa.array(out["removed"], pa.int64()),
            }
        )

    kind = texts.schema["row"].dataType.simpleString()
    done = texts.groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(
        apply, f"row {kind}, text binary, __lines long, __removed long"
    )
    columns = [F.col("text").cast("string").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns]
    return done.select(*columns, "__lines", "__removed")


def without_repeats(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The columns of ``docs``; texts that lost all their lines go, ``n_chars`` follows."""
    rows = cleaned(docs, percent).where("__removed = 0 OR __removed < __lines")
    if "n_chars" in docs.columns:
        size = F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        rows = rows.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


@query()
def op4_lines(spark, folder):
    rows = cleaned(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
