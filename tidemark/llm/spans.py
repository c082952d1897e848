"""Remove word spans that repeat: a De Bruijn graph of the corpus, compacted.

The edges are windows of consecutive words. Each window has an anchor, the least of its
short word k-mers by hash, on which equal windows agree. Neighbouring windows of one
anchor form a path piece. A piece that occurs twice repeats with all its edges. Where
all pieces of an anchor are the same, the path does not branch there, and its digest is
all that travels. Where they differ, it branches: there each edge is asked for by itself.
Anchors that occur once need nothing more.

Pieces and edges keep their source coordinates (document, first word, count). Digests of
pieces and edges have 128 bits, and the spans are cut out of the source text, where
neighbouring pieces join into maximal spans.

Defined cases: null or empty text has no words; a text shorter than the window keeps
all; repeated rows are occurrences of one another; a text that repeats itself is cut;
a null doc_id is kept as it is; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tidemark.llm import shared
from tidemark.llm.registry import query, table
from tidemark.llm.shared import BRANCH, CHECKED, Rolling

WINDOW = 35
GRAM = 12
LONGEST_PIECE = 64
#: Words whose hashes are held at once; a longer text is cut in overlapping parts.
PART_WORDS = 150_000
NOTE = np.dtype([("start", "<i8"), ("count", "<u4"), ("key", "<i8")])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Pieces:
    """The path pieces of a batch: coordinates count words in the batch's joined texts."""

    def __init__(self, texts: list[bytes | None], window: int, gram: int):
        split = [(t or b"").split() for t in texts]
        words = [w for ws in split for w in ws]
        found = [
            (base, word_hashes(words[base : base + sum(sizes)]), np.array(sizes))
            for base, sizes in shared.part_ranges([len(ws) for ws in split], PART_WORDS, window)
        ]
        self.window, self.parts = window, found
        names = ("start", "count", "anchor", "digest", "check", "inner")
        columns: list[list[np.ndarray]] = [[] for _ in names]
        for offset, symbols, lengths in found:
            rolling = Rolling(symbols)
            grams = rolling.every(gram)
            anchors = shared.sliding_min(grams, window - gram + 1)
            ok = shared.starts_within(lengths, window)
            start, count = shared.cut_runs(anchors, ok, LONGEST_PIECE)
            end = start + count + window - 1
            second = Rolling(symbols, second=True)
            # Windows of one piece can only be equal if its anchor occurs twice in it.
            spread = count + window - gram
            met = grams[shared.ranges(start, spread)] == np.repeat(anchors[start], spread)
            inner = np.add.reduceat(met.astype(np.int32), np.cumsum(spread) - spread) > 1 if len(start) else met
            for c, v in zip(
                columns,
                (start + offset, count, anchors[start], rolling.runs(start, end), second.runs(start, end), inner),
            ):
                c.append(v)
        kinds = (np.int64, np.int64, np.uint64, np.uint64, np.uint64, bool)
        values = [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(columns, kinds)]
        self.start, self.count, self.anchor, self.digest, self.check, self.inner = values

    def paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, the piece digest of each (0 where pieces differ, or where one
        may repeat itself), and each piece's place."""
        anchors, _, place, _ = _distinct(self.anchor, None)
        low = np.full(len(anchors), ~np.uint64(0))
        high = np.zeros(len(anchors), np.uint64)
        np.minimum.at(low, place, np.where(self.inner, np.uint64(0), self.digest))
        np.maximum.at(high, place, self.digest)
        return anchors, np.where(low == high, low, np.uint64(0)), place

    def edges(self, wanted: np.ndarray, settled: np.ndarray):
        """Start, digest and check of each window of the ``wanted`` pieces, and whether
        its piece is ``settled``."""
        starts, keys, checks, known = [], [], [], []
        for offset, symbols, _ in self.parts:
            inside = wanted & (self.start >= offset) & (self.start < offset + len(symbols) - self.window + 1)
            if not inside.any():
                continue
            s, n = self.start[inside] - offset, self.count[inside]
            at = np.repeat(s - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            starts.append(at + offset)
            known.append(np.repeat(settled[inside], n))
            keys.append(Rolling(symbols).every(self.window)[at])
            checks.append(Rolling(symbols, second=True).every(self.window)[at])
        if not starts:
            none = np.zeros(0, np.uint64)
            return np.zeros(0, np.int64), none, none, np.zeros(0, bool)
        return tuple(np.concatenate(c) for c in (starts, keys, checks, known))


def _distinct(keys: np.ndarray, checks: np.ndarray | None):
    """Distinct (key, check) in ascending order, the place of each in them, and their counts."""
    order, first = shared.grouped(keys, checks)
    counts = np.diff(np.append(first, len(keys)))
    place = np.empty(len(keys), np.int64)
    place[order] = np.repeat(np.arange(len(first)), counts)
    picked = order[first]
    return keys[picked], None if checks is None else checks[picked], place, counts


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, n_spans``: words in windows that occur
    more than once are removed."""
    texts, buckets = shared.dealt(docs, "doc_id")

    def about_pieces(batch: int, rows: pa.Table) -> list[tuple]:
        p = Pieces(rows.column("text").to_pylist(), window, gram)
        anchors, path, _ = p.paths()
        digests, checks, _, _ = _distinct(p.digest, p.check)
        return shared.request_rows(batch, BRANCH, buckets, anchors, path) + shared.request_rows(
            batch, CHECKED, buckets, digests, checks
        )

    def about_edges(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = shared.in_order(rows)
        batch, got = key[0].as_py(), told.to_pylist()
        p = Pieces(rows.column("text").to_pylist(), window, gram)
        anchors, path, a_place = p.paths()
        digests, checks, d_place, d_count = _distinct(p.digest, p.check)
        branch = (shared.read_bits(got, BRANCH, buckets, anchors)[1] | (path == 0))[a_place]
        whole = (shared.read_bits(got, CHECKED, buckets, digests)[0] | (d_count > 1))[d_place]
        start, key_, check, known = p.edges(branch, whole)
        keys, checks, place, count = _distinct(key_, check)
        settled = np.zeros(int(whole.sum()), NOTE)
        settled["start"], settled["count"], settled["key"] = p.start[whole], p.count[whole], -1
        twice = (count > 1)[place] & ~known
        local = np.zeros(int(twice.sum()), NOTE)
        local["start"], local["count"], local["key"] = start[twice], 1, -1
        out = [(batch, batch % buckets, CHECKED, b"", b"", None, np.concatenate([settled, local]).tobytes())]
        # Edges that are settled here are sent all the same: other batches ask for them.
        home = (keys % np.uint64(buckets)).astype(np.int64)
        spot = np.zeros(len(keys), np.int64)
        open_edges = np.flatnonzero(~twice & ~known)
        asking = dict(shared.parted(home[place[open_edges]]))
        for b, mine in shared.parted(home):
            spot[mine] = np.arange(len(mine))
            asked = open_edges[asking.get(b, np.zeros(0, np.int64))]
            note = np.zeros(len(asked), NOTE)
            note["start"], note["count"], note["key"] = start[asked], 1, spot[place[asked]]
            out.append((batch, b, CHECKED, keys[mine].tobytes(), checks[mine].tobytes(), None, note.tobytes()))
        return shared.table_of(out, shared.REQUEST_ARROW)

    def apply(key: tuple[pa.Scalar, ...], rows: pa.Table, told: pa.Table) -> pa.Table:
        rows = shared.in_order(rows)
        starts, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in told.to_pylist():
            note = np.frombuffer(r["note"], NOTE)
            asked = int(note["key"].max(initial=-1)) + 1
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8)).astype(bool)
            sure = note["key"] < 0
            if asked:
                sure = sure | bits[np.maximum(note["key"], 0)]
            starts.append(note["start"][sure].astype(np.int64))
            counts.append(note["count"][sure].astype(np.int64))
        all_words = [(t or b"").split() for t in rows.column("text").to_pylist()]
        total = sum(map(len, all_words))
        drop = shared.covered(np.concatenate(starts), np.concatenate(counts), window, total)
        out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "n_spans": []}
        at = 0
        for words in all_words:
            gone = drop[at : at + len(words)]
            at += len(words)
            a, b = shared.kept_pieces(gone)
            kept = b" ".join(w for i, j in zip(a.tolist(), b.tolist()) for w in words[i:j])
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["n_spans"].append(int((np.diff(np.concatenate([[False], gone]).astype(np.int8)) == 1).sum()))
        return pa.table({"doc_id": rows.column("doc_id"), **out})

    first = shared.ask(texts, about_pieces, buckets)
    asked = texts.groupBy("batch").cogroup(first.groupBy("batch")).applyInArrow(about_edges, shared.REQUEST)
    second = shared.answers(asked)
    return texts.groupBy("batch").cogroup(second.groupBy("batch")).applyInArrow(
        apply, "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long"
    )


@query(r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
words AS MATERIALIZED (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT r, p, count(*) OVER here AS n, string_agg(word, ' ') OVER here AS k FROM words
  WINDOW here AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)),
marked AS (SELECT r, p, n = 35 AND count(*) OVER (PARTITION BY n, k) > 1 AS starts FROM windows),
gone AS (
  SELECT r, p, word, coalesce(max(CASE WHEN starts THEN p END) OVER (PARTITION BY r ORDER BY p) > p - 35, false) AS gone
  FROM words JOIN marked USING (r, p)),
runs AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS opens FROM gone),
done AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, count(*) FILTER (opens) AS n_spans,
    string_agg(word, ' ' ORDER BY p) FILTER (NOT gone) AS kept
  FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN done USING (r)""")
def op2_spans(spark, folder):
    return without_repeats(table(spark, folder, "documents"))
