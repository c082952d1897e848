"""Lockstep alignment against a double loop over each document's tokens."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tests.llm.conftest import AWKWARD, DOCS, row
from tidemark.llm import alignment

A_PATH, B_PATH = alignment.tokenizer_paths()
TEXTS = [
    " leading and trailing  ", "a  b\tc\n\nd", "don't we'll ' s", "1234567890 12,345.67", "ﬁ ① é é ñ", "한국어 中文字符 日本語", "😀😀 🏳️‍🌈",
    "a▁b", "<|endoftext|> <s> </s> <unk>", "x\x00y \x1c z\x85w　q ​", "word " * 400, "ab" * 5000, "中文" * 3000, " ", "\n", "a b " * 300 + " " * 700 + "tail",
]


@pytest.fixture(scope="module")
def engines():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    b = SentencePieceProcessor(model_file=B_PATH)
    words = {i: bytes(letters[c] for c in w) for w, i in a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in w)}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    raw = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    return a, b, words, raw


def by_hand(engines, rows):
    """The contract's rows, from whole texts and plain overlaps of byte ranges."""
    a, b, words, raw = engines
    found, counts = [], Counter()
    for doc, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        ends = [np.cumsum([len(x[i]) for i in ids]).tolist() for x, ids in ((words, ids_a), (raw, ids_b))]
        whole = (" " + (text or "")).encode()
        if b"".join(words[i] for i in ids_a) != whole or b"".join(raw[i] for i in ids_b) != whole:
            found.append((doc, [], [], [], []))
            continue
        starts = [[0, *e[:-1]] for e in ends]
        links, groups, i0, j0 = [], [], 0, 0
        j = 0
        for i in range(len(ids_a)):
            while j and starts[1][j] > starts[0][i]:
                j -= 1
            while j < len(ids_b) and starts[1][j] < ends[0][i]:
                if ends[1][j] > starts[0][i]:
                    links.append((ids_a[i], ids_b[j]))
                j += 1
            j = max(0, j - 1)
        common = sorted(set(ends[0]) & set(ends[1]))
        for end in common:
            i1, j1 = ends[0].index(end, i0) + 1, ends[1].index(end, j0) + 1
            groups.append((ids_a[i0:i1], ids_b[j0:j1]))
            i0, j0 = i1, j1
        counts.update(links)
        found.append((doc, ids_a, ids_b, groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for doc, ids_a, ids_b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (doc, len(ids_a), len(ids_b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if text else "")
        )
    return out


def query(spark, docs, path):
    docs.write.parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, alignment.op12_alignment(spark, str(path)).collect()), key=repr)


def test_hand_made(spark, engines, tmp_path, monkeypatch):
    rows = [row(i, t) for i, t in enumerate(TEXTS)] + AWKWARD
    docs = spark.createDataFrame(rows, DOCS).withColumns({"chunk": F.lit("c"), "pair": F.lit(1)})
    want = sorted(by_hand(engines, [r[:2] for r in rows]), key=repr)
    assert query(spark, docs, tmp_path / "one") == want
    assert sum(w[1] == 0 for w in want) == 3
    # Small chunks and short lanes give the same.
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(alignment, "LANE_CHARS", 7)
    monkeypatch.setattr(alignment, "LANE_TOKENS", 5)
    assert query(spark, docs.repartition(3), tmp_path / "two") == want


def test_table(spark, engines, tmp_path):
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(by_hand(engines, [(r.doc_id, r.text) for r in some.collect()]), key=repr)
    assert query(spark, some, tmp_path) == want and sum(w[1] for w in want) > 10_000


def test_empty(spark, nothing, tmp_path):
    assert query(spark, nothing, tmp_path / "none") == []
    blank = spark.createDataFrame([row(1, None), row(1, ""), row(None, None)], DOCS)
    zero = (0, 0, 0, 0, 0, 0, "")
    assert query(spark, blank, tmp_path / "blank") == sorted([(1, *zero), (1, *zero), (None, *zero)], key=repr)


def test_aligned(spark, engines):
    """Groups and links as positions, and both texts back from the ids."""
    _, _, words, raw = engines
    rows = [row(i, t) for i, t in enumerate(TEXTS)]
    for r in alignment.aligned(spark.createDataFrame(rows, DOCS), A_PATH, B_PATH).collect():
        text = " " + TEXTS[r.doc_id]
        if not r.a_ids:
            assert "▁" in text and not (r.b_ids or r.a_cuts or r.b_cuts or r.a_links or r.b_links)
            continue
        assert b"".join(words[i] for i in r.a_ids) == text.encode() == b"".join(raw[i] for i in r.b_ids)
        assert r.a_cuts[-1] == len(r.a_ids) and r.b_cuts[-1] == len(r.b_ids)
        ends = [[0, *np.cumsum([len(x[i]) for i in ids]).tolist()] for x, ids in ((words, r.a_ids), (raw, r.b_ids))]
        assert all(ends[0][i] == ends[1][j] for i, j in zip(r.a_cuts, r.b_cuts))
        pairs = list(zip(r.a_links, r.b_links))
        assert len(set(pairs)) == len(pairs)
        assert all(max(ends[0][i], ends[1][j]) < min(ends[0][i + 1], ends[1][j + 1]) for i, j in pairs)


def test_engine(engines):
    """The engine with ranks gives what the vocabulary's own one gives, on all sorts of characters."""
    both = alignment.Tokenizers(A_PATH, B_PATH)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = [f" x{chr(c)}1 {chr(c)}y '{chr(c)}s  {chr(c)} {chr(c)}{chr(c)} z" for c in points]
    want = [x.ids for x in engines[0].encode_batch(texts, add_special_tokens=False)]
    assert [both.a.encode_ordinary(t) for t in texts] == want


def test_other_files(tmp_path):
    other = tmp_path / "other.json"
    other.write_text(open(A_PATH, encoding="utf-8").read().replace('"add_prefix_space":false', '"add_prefix_space":true').replace('"add_prefix_space": false', '"add_prefix_space": true'))
    with pytest.raises(ValueError):
        alignment.Tokenizers(str(other), B_PATH)
