"""Mixing, packing, fingerprints, top-k and the learned models."""

import hashlib
import math
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, DOCS, row
from tidemark.llm import fingerprints, language, mixing, packing, topk, toxicity


def filled(sizes, weights, cap):
    """Water-filling by repeated clamping."""
    total, full = sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        left = total - sum(cap * sizes[i] for i in full)
        target = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if target[i] > cap * sizes[i]}
        if not over:
            return [cap * sizes[i] if i in full else target[i] for i in range(len(sizes))]
        full |= over


def test_targets(spark):
    draw = random.Random(2)
    for n in (1, 2, 7, 30):
        sizes = [draw.choice([0, 1, 5, 100, 10_000]) for _ in range(n)]
        weights = [(5.0, 2.0, 1.0)[i % 3] for i in range(n)]
        rows = [(f"s{i:03d}", z, w) for i, (z, w) in enumerate(zip(sizes, weights))]
        df = spark.createDataFrame(rows, "source string, source_size long, weight double")
        got = {r.source: r.target for r in mixing.water_fill(df).collect()}
        assert [got[f"s{i:03d}"] for i in range(n)] == pytest.approx(filled(sizes, weights, 3.0))


def test_taken(spark, awkward):
    rows = [row(i, "w " * (i % 50), source=None if i % 7 == 0 else f"s{i % 5}") for i in range(2000)]
    got = mixing.take(spark.createDataFrame(rows, DOCS)).toPandas()
    assert (got["size"] == got["doc_id"] % 50).all() and (got["taken"] <= 3 * got["size"]).all()
    assert (got["whole"] * got["size"] + got["part"] == got["taken"]).all()
    for _, g in got.groupby("source", dropna=False):
        assert g["source_size"].iloc[0] == g["size"].sum()
        assert abs(g["taken"].sum() - g["target"].iloc[0]) < 0.01 * g["target"].iloc[0] + 30
    again = mixing.take(spark.createDataFrame(rows, DOCS).repartition(5)).toPandas()
    key = ["doc_id", "source", "taken"]
    assert again[key].sort_values("doc_id").astype(str).values.tolist() == got[key].sort_values("doc_id").astype(str).values.tolist()
    counts = {r.doc_id: r["size"] for r in mixing.take(awkward).collect() if r.doc_id in (4, 5, 6, 7, 8)}
    assert counts == {4: 0, 5: 0, 6: 0, 7: 1, 8: 120}


def test_mixed_rows(spark, awkward):
    mix = mixing.mixed(awkward)
    assert mix.columns == awkward.columns
    words = {}
    for r in mix.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
        assert r.n_chars == len(r.text)
    want = {}
    for r in mixing.take(awkward).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    assert words == {d: n for d, n in want.items() if n}


def test_packing(spark, awkward):
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    many = [row(100 + i, " ".join(f"w{j}" for j in range(i * 7 % 900))) for i in range(150)]
    rows = AWKWARD + many
    got = packing.packed(spark.createDataFrame(rows, DOCS), path).toPandas()
    want = {}
    for r in rows:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            key = (r[0], start, len(part), zlib.crc32(part.tobytes()), len(ids))
            want[key] = want.get(key, 0) + 1
    have = {}
    for r in got.itertuples():
        key = (None if math.isnan(r.doc_id) else int(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens)
        have[key] = have.get(key, 0) + 1
    assert have == want
    placed = got.sort_values(["sequence_id", "offset"])
    before = placed.groupby("sequence_id")["length"].cumsum() - placed["length"]
    assert (before == placed["offset"]).all()
    sizes = placed.groupby("sequence_id")["length"].sum()
    assert sizes.max() <= 2048
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.1 * sizes.sum()


def test_words_are_tokenised_as_in_texts():
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer, words = Tokenizer.from_file(path), packing.WordIds(path)
    draw = random.Random(5)
    marks = "abcZÉüßñ'’.,!?:;|<>()_-$# \n\t1239\x01éİΣσ中…　\xa0\u0085%&~`^]≠"
    more = ["<|endoftext|>", "<|startoftext|>", "it's", "'S", "é.", "x|>"]
    texts = ["".join(draw.choice(marks) if draw.random() < 0.9 else draw.choice(more) for _ in range(30)) for _ in range(500)]
    for text, ids in zip(texts, words.texts([t.encode() for t in texts])):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_words_are_numbered_as_they_come(monkeypatch):
    words = packing.WordIds(packing.tokenizer_path())
    first = words.texts([b"one two, one three", b"", b"two, four"])
    assert [*words.number.items()] == [(b"one", 0), (b"two,", 1), (b"three", 2), (b"four", 3)]
    assert words.texts([b"five one"])[0].tolist()[-2:] == first[0][[0, -1]].tolist()
    assert words.number[b"five"] == 4
    monkeypatch.setattr(packing, "MEMO_WORDS", 4)
    again = words.texts([b"one two, one three"])[0]
    assert again.tolist() == first[0].tolist() and len(words.number) == 3


def test_words_that_come_again_are_not_forgotten(monkeypatch):
    """A full memory drops rare words only, and ids are right before and after."""
    from tokenizers import Tokenizer

    path = packing.tokenizer_path()
    tokenizer, words = Tokenizer.from_file(path), packing.WordIds(path)
    monkeypatch.setattr(packing, "MEMO_WORDS", 200)
    often, learned, learn = [f"Often{i}," for i in range(40)], [], words._learn
    monkeypatch.setattr(words, "_learn", lambda new, at: learned.extend(new) or learn(new, at))
    for turn in range(30):
        text = " ".join([*often, *(f"rare{turn}x{i}!" for i in range(50)), "<>", *often])
        assert words.texts([text.encode()])[0].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert len(words.number) <= 200 + 50
    assert learned.count(b"Often3,") == 1 and learned.count(b"<>") == 1
    # What comes no more goes in the end, and the frequent ones are too many to stay.
    for turn in range(60):
        words.texts([" ".join(f"w{turn}x{i} w{turn}x{i}" for i in range(150)).encode()])
        assert len(words.number) <= 200 + 150
    assert b"Often3," not in words.number


def test_a_worker_remembers_some_megabytes():
    words = packing.WordIds(packing.tokenizer_path())
    for i in range(0, 640_000, 40_000):
        words.texts([b" ".join(b"%dword%d," % (j % 7, j) for j in range(i, i + 40_000))])
    tables = [x for x in vars(words).values() if isinstance(x, dict)]
    size = sum(sys.getsizeof(k) + sys.getsizeof(n) for t in tables for k, n in t.items())
    size += sum(map(sys.getsizeof, tables))
    size += sum(x.nbytes for x in vars(words).values() if isinstance(x, np.ndarray))
    assert size < 100e6


def test_plan_fills_windows_exactly():
    held = np.zeros(65, np.int64)
    held[[16, 48, 20, 24, 32]] = [10, 9, 6, 3, 4]
    layout = packing.plan(held, 64)
    filled_to = {}
    for length, _, n, first, offset in layout["ranges"].tolist():
        for i in range(n):
            filled_to.setdefault(first + i, []).append((offset, length))
    for parts in filled_to.values():
        assert sum(n for _, n in parts) == 64
        assert sorted(o for o, _ in parts) == sorted(np.cumsum([0, *[n for _, n in sorted(parts)]])[:-1].tolist())
    assert (layout["allotted"] <= held).all() and layout["sequences"] >= 12


def test_fingerprints(spark):
    texts = [(5, "One. Two! Three?\nFour.\nFive and more words."), (1, "a"), (9, None), (7, "x" * 103),
             (5, "Another with the same number. And so on."), (None, "no number. none."), (2**60, "Far. Away.")]
    got = fingerprints.fingerprinted(spark.createDataFrame([row(d, t) for d, t in texts], DOCS)).collect()
    order = [None, 1, 5, 7, 9, 2**60]
    least = {d: min(t or "" for e, t in texts if e == d) for d in order}
    want = []
    for d, t in texts:
        t = t or ""
        after = least[order[(order.index(d) + 1) % len(order)]]
        q = len(t) // 4
        want.append((d, len(t), hashlib.sha256((t[: len(t) - q] + after[:q]).encode()).hexdigest()))
    assert sorted(((r[0], r[1], r[2]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)


def test_next_document_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 3)
    ids = [(i * i) % 9973 - 50 for i in range(120)] + [-(2**62), 2**62]
    rows = [row(d, f"text {d}") for d in ids]
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    order = sorted(set(ids))
    assert got == {d: f"text {order[(i + 1) % len(order)]}" for i, d in enumerate(order)}


def test_peeling_recovers_the_difference(spark):
    draw = random.Random(3)
    rows = []
    for i in range(60):
        both = [draw.getrandbits(62) for _ in range(draw.randint(0, 200))]
        left = [draw.getrandbits(62) for _ in range(draw.randint(0, 7))]
        right = [draw.getrandbits(62) for _ in range(draw.randint(0, 4))]
        rows.append((i, both + left, both + right, sorted(left + right)))
    df = spark.createDataFrame(rows, "i long, a array<long>, b array<long>, want array<long>")
    state = fingerprints.peel(fingerprints.subtract(fingerprints.cells(F.col("a"), 24), fingerprints.cells(F.col("b"), 24)), 24)
    got = df.select("want", fingerprints.decoded(state).alias("n"), F.array_sort(state["found"]).alias("found")).collect()
    peeled = [r for r in got if r.n is not None]
    assert len(peeled) >= 58
    assert all(r.found == r.want and r.n == len(r.want) for r in peeled)


@pytest.mark.parametrize("rounds", [0, 8])
def test_likeness_is_exact_whatever_peels(spark, monkeypatch, rounds):
    monkeypatch.setattr(fingerprints, "ROUNDS", max(1, rounds))
    if not rounds:
        monkeypatch.setattr(fingerprints, "SIZES", (1, 2))
    rows = [([1, 2, 3], [3, 4]), ([], []), ([5], []), (list(range(10, 90)), list(range(50, 140))), ([7], [7])]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    for name in "ab":
        df = df.withColumn(f"{name}_cells", fingerprints.cells(F.col(name), fingerprints.SIZES[0]))
    got = [r.near for r in fingerprints.with_likeness(df, "near", "a", "b").collect()]
    assert got == pytest.approx([len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0 for a, b in rows])


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "LOT_PARTS", 2)
    draw = random.Random(8)
    rows = [(i, [draw.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(6)], "q") for i in range(0, 700, 2)]
    rows += [(1, None, "q"), (3, [float("nan")] * 6, "q"), (50, [None, 1.0, 0, 0, 0, 0], "q"), (5, [0.5], "q")]
    rows = [r for r in rows if r[0] != 50] + [(50, [None, 1.0, 0.0, 0.0, 0.0, 0.0], "q"), (7, rows[3][1], "q")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, q string")
    got = sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    good = []
    for i, v, _ in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * x) for x in v] + [0] * (6 - len(v))))
    want = []
    for at, (q, w) in enumerate(good):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for j, (i, v) in enumerate(good) if j != at)
            want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert got == sorted(want)


def test_top_k_repeated_and_large(spark):
    """Only a query's own row is no candidate; scores that would not fit are refused."""
    kind = "vec_id long, embedding array<double>"
    rows = spark.createDataFrame([(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0])], kind)
    one = 256 * 256
    assert sorted(tuple(r) for r in topk.top_k(rows, F.col("vec_id") == 50).collect()) == sorted(
        [(50, 1, 1, one), (50, 2, 50, 0), (50, 1, 1, one), (50, 2, 50, 0)]
    )
    copies = spark.createDataFrame([(50, [1.0])] * 9, kind)
    assert [r.rank for r in topk.top_k(copies, F.lit(True)).collect()].count(5) == 9
    with pytest.raises(Exception, match="too large"):
        topk.top_k(spark.createDataFrame([(50, [1e30, 1.0]), (1, [1e30, 2.0])], kind), F.lit(True)).collect()
    close = spark.createDataFrame([(0, [5e6, 1.0]), (1, [5e6, 2.0])], kind)
    q = 256 * 5_000_000
    assert sorted(r.score for r in topk.top_k(close, F.col("vec_id") == 0).collect()) == [q * q + 256 * 512]


def test_top_k_of_few_and_none(spark):
    kind = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (50, [0.5, 2.0])], kind)
    assert sorted(tuple(r) for r in topk.top_k(two, F.col("vec_id") % 50 == 0).collect()) == [
        (0, 1, 50, 32768), (50, 1, 0, 32768)
    ]
    assert topk.top_k(spark.createDataFrame([], kind), F.col("vec_id") % 50 == 0).collect() == []


@pytest.fixture(scope="module")
def speech(spark):
    draw = random.Random(6)
    words = {"xx": "ka ko ki taka tiko".split(), "yy": "zum zer zot frezz".split()}
    rows = []
    for i in range(300):
        lang = draw.choice(["xx", "yy"])
        rows.append(row(i, " ".join(draw.choice(words[lang]) for _ in range(30)), lang=lang))
    return rows


def test_language(spark, speech):
    rows = [*speech, row(900, None), row(901, "12 34 !!"), row(902, "ka", lang=None), row(None, "zum zer", lang=None)]
    df = spark.createDataFrame(rows, DOCS)
    got = language.languages(df, F.coalesce(F.col("doc_id") % 5 == 0, F.lit(False))).toPandas()
    assert len(got) == len(rows)
    by_id = got.set_index("doc_id")
    assert all(by_id.lang_pred[r[0]] == r[2] for r in speech)
    assert by_id.lang_pred[900] == by_id.lang_pred[901] == "und" and by_id.lang_pred[902] == "xx"
    assert got.score.between(0, 1).all()


def test_language_without_labels(spark, nothing):
    assert language.languages(nothing, F.lit(False)).collect() == []
    df = spark.createDataFrame([row(1, "ka", lang=None)], DOCS)
    assert [tuple(r) for r in language.languages(df, F.lit(False)).collect()] == [(1, False, "und", 0.0)]


def test_toxicity(spark):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        words = [f"w{draw.randint(0, 300)}" + draw.choice("abc") for _ in range(40)]
        words = [w.translate(str.maketrans("0123456789", "klmnopqrst")) for w in words]
        if i % 4 == 0:
            for _ in range(draw.randint(1, 4)):
                words.insert(draw.randrange(40), draw.choice(["Vilest!", "awful", "rotten" + draw.choice("abcd")]))
        rows.append(row(i, " ".join(words)))
        if i < 300:
            labels.append((i, 1, int(i % 4 == 0)))
    rows += [row(1000, None), row(1001, "")]
    df = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (2, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.severities(df, marks).toPandas().set_index("doc_id")
    unseen = [i for i in range(300, 400)]
    assert np.mean([got.toxic[i] == (i % 4 == 0) for i in unseen]) > 0.97
    assert not got.toxic[1000] and not got.toxic[1001]
    kept = toxicity.without_toxic(df, marks)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(got.index[~got.toxic])
    none = toxicity.severities(df, marks.limit(0)).toPandas()
    assert not none.toxic.any() and len(none) == len(rows)


def test_thresholds_increase():
    draw = np.random.default_rng(0)
    z = draw.normal(size=600)
    grades = np.digitize(z, [0.3, 1.0])
    x = toxicity.Sparse(
        np.repeat(np.arange(600), 2), np.tile([0, 1], 600), np.stack([z, draw.normal(size=600)], 1).ravel(), (600, 2)
    )
    w, t = toxicity.ordinal_fit(x, grades, 3)
    assert t[0] < t[1] and w[0] > 3 * abs(w[1])


def test_nothing(nothing):
    assert mixing.take(nothing).collect() == []
    assert mixing.mixed(nothing).collect() == []
    assert packing.packed(nothing, packing.tokenizer_path()).collect() == []
    assert fingerprints.fingerprinted(nothing).collect() == []
