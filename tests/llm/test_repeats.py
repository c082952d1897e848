"""Spans, suffixes, Jaccard join and lines against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from tests.llm.conftest import AWKWARD, DOCS, row
from tidemark.llm import jaccard, lines, links, shared, spans, suffixes


def spans_by_hand(rows, window):
    words = [(d, (t or "").encode().split()) for d, t in rows]
    counts = defaultdict(int)
    for _, w in words:
        for i in range(len(w) - window + 1):
            counts[tuple(w[i : i + window])] += 1
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def suffixes_by_hand(rows, window):
    order = [(-(1 << 63) if d is None else d, d, (t or "").encode()) for d, t in rows]
    first = {}
    for key, _, b in order:
        for i in range(len(b) - window + 1):
            s = b[i : i + window]
            first[s] = min(first.get(s, key), key)
    out = []
    for key, d, b in order:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < key:
                gone[i : i + window] = [True] * window
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def components_by_hand(rows, n, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(
        ((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def mixture(seed, n=60):
    """Texts that share passages, copies and near copies, and repeat themselves."""
    draw = random.Random(seed)
    passages = [[f"p{k}w{draw.randint(0, 9)}" for _ in range(draw.randint(5, 60))] for k in range(6)]
    texts = []
    for i in range(n):
        kind = draw.random()
        if texts and kind < 0.2:
            texts.append(draw.choice(texts))
        elif texts and kind < 0.45:
            w = draw.choice(texts).split()
            for _ in range(draw.randint(1, 3)):
                w[draw.randrange(len(w))] = f"n{i}"
            texts.append(" ".join(w))
        else:
            w = [f"u{i}v{j}" for j in range(draw.randint(1, 80))]
            for p in draw.sample(passages, draw.randint(0, 3)):
                at = draw.randint(0, len(w))
                w[at:at] = p
            if draw.random() < 0.2:
                w = w[:3] * draw.randint(2, 40)
            texts.append(" ".join(w))
    return [(i * 3 - 20, t) for i, t in enumerate(texts)]


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


CASES = ["awkward", 1, 2]


@pytest.fixture(params=CASES)
def case(request, spark):
    rows = AWKWARD if request.param == "awkward" else [row(d, t) for d, t in mixture(request.param)]
    return spark.createDataFrame(rows, DOCS).repartition(3), [(r[0], r[1]) for r in rows]


@pytest.fixture(params=[None, 40_000])
def batches(request, monkeypatch):
    """One batch, or many small ones and more buckets."""
    if request.param:
        monkeypatch.setattr(shared, "BATCH_BYTES", request.param)
        monkeypatch.setattr(shared, "BUCKET_BYTES", request.param)


def test_spans(case, batches):
    df, rows = case
    got = rows_of(spans.without_repeats(df, 35, 12), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == spans_by_hand(rows, 35)


def test_spans_in_parts(spark, monkeypatch):
    rows = mixture(5)
    found = []
    for most in (1 << 20, 70):
        monkeypatch.setattr(spans, "PART_WORDS", most)
        p = spans.Pieces([t.encode() for _, t in rows], 20, 6)
        windows = sorted((s + i) for s, n in zip(p.start.tolist(), p.count.tolist()) for i in range(n))
        found.append(windows)
    assert found[0] == found[1] and len(found[0]) == len(set(found[0]))


def test_suffixes(case, batches):
    df, rows = case
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffixes.without_earlier(df), *columns) == suffixes_by_hand(rows, 50)


@given(st.lists(st.binary(min_size=30, max_size=40).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=30))
@settings(max_examples=40, deadline=None)
def test_deep_shallow_sort(strings):
    strings = [s[:30] for s in strings for _ in (0, 1)]
    data = np.frombuffer(b"".join(strings) + bytes(60), np.uint8)
    at = np.arange(0, 30 * len(strings), 30)
    order, new = suffixes.sorted_classes(data, at, depth=30, shallow=8)
    in_order = [strings[i] for i in order]
    assert in_order == sorted(strings)
    assert new.tolist() == [i == 0 or in_order[i] != in_order[i - 1] for i in range(len(strings))]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
def test_jaccard(case, n, percent):
    df, rows = case
    got = rows_of(jaccard.joined(df, n, percent), "doc_id", "n_shingles", "component_id")
    assert got == components_by_hand(rows, n, percent)


def test_jaccard_when_tokens_are_frequent(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT_TIMES", 0)
    monkeypatch.setattr(jaccard, "FREQUENT_MORE", 2)
    monkeypatch.setattr(links, "SMALL", 2)
    draw = random.Random(9)
    base = [f"b{i}" for i in range(50)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(draw.randint(0, 2)):
            w[draw.randrange(50)] = f"x{draw.randint(0, 5)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame([row(d, t) for d, t in rows], DOCS)
    got = rows_of(jaccard.joined(df, 3, 90), "doc_id", "n_shingles", "component_id")
    assert got == components_by_hand(rows, 3, 90)


def test_one_of_each_group_stays(awkward):
    kept = rows_of(jaccard.without_copies(awkward), "doc_id")
    # 1, 2, the two rows of 3 and -5 are near copies; empty texts are no copies.
    assert kept == sorted([(-5,), (4,), (5,), (6,), (7,), (8,), (9,), (9,), (None,)], key=repr)
    assert jaccard.without_copies(awkward).columns == awkward.columns


def test_components(spark):
    edges = [(b"%03d" % a, b"%03d" % (a + 1)) for a in range(0, 40)] + [(b"900", b"800"), (b"800", b"700")]
    df = spark.createDataFrame(edges, "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in links.components(df).collect()}
    assert got == {**{b"%03d" % i: b"000" for i in range(41)}, b"700": b"700", b"800": b"700", b"900": b"700"}


def test_lines(spark):
    shared_line = "This line is in all of the documents and long enough to compare, number 12345"
    texts = [f"own line of {i} and nothing else {i * 7}\n{shared_line}{'' if i % 2 else '.'}" for i in range(8)]
    texts += [shared_line + "\n\n" + shared_line.upper(), None, "", "\n \n"]
    df = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in lines.cleaned(df).collect()}
    assert got[0].text == texts[0]
    assert all(got[i].text == texts[i].split("\n")[0] for i in range(1, 8))
    assert (got[8].text, got[8].__getitem__("__lines"), got[8].__getitem__("__removed")) == ("", 2, 2)
    assert [got[i].text for i in (9, 10, 11)] == [None, "", "\n \n"]
    kept = lines.without_repeats(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11]
    assert all(r.n_chars == len(r.text) for r in kept.collect() if r.text)


def test_lines_recall(spark):
    """Pairs at a similarity of 0.85 or more are all but always found."""
    draw = random.Random(4)
    rows, pairs = [], 0
    for i in range(150):
        line = "".join(draw.choice("abcdefghij klmno") for _ in range(300))
        at = draw.randrange(280)
        rows += [row(2 * i, line), row(2 * i + 1, line[:at] + "ZQ" + line[at + 2 :])]
        pairs += 1
    df = spark.createDataFrame(rows, DOCS)
    removed = [r.doc_id for r in lines.cleaned(df).where("__removed > 0").collect()]
    assert all(d % 2 for d in removed) and len(removed) >= 0.97 * pairs


def test_lines_awkward(awkward):
    got = sorted((tuple(r[:2]) for r in lines.cleaned(awkward).select("doc_id", "__lines", "text").collect()), key=repr)
    assert len(got) == len(AWKWARD)
    assert lines.cleaned(awkward).where("doc_id = 4").first().text is None


def test_nothing(nothing):
    assert spans.without_repeats(nothing).collect() == []
    assert suffixes.without_earlier(nothing).collect() == []
    assert jaccard.joined(nothing).collect() == []
    assert lines.cleaned(nothing).collect() == []


def test_hot_anchors_are_dealt_singly(spark, monkeypatch):
    monkeypatch.setattr(shared, "HOT_BATCHES", 2)
    monkeypatch.setattr(shared, "BATCH_BYTES", 600)
    monkeypatch.setattr(shared, "BUCKET_BYTES", 4000)
    rows = mixture(7, 40)
    df = spark.createDataFrame([row(d, t) for d, t in rows], DOCS)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffixes.without_earlier(df), *columns) == suffixes_by_hand(rows, 50)


def test_lines_of_the_table(spark):
    """All pairs of lines of 150 documents, compared one by one."""
    some = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 150")
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in some.collect())
    first = {}
    for doc, text in rows:
        for place, line in enumerate(text.split(b"\n")):
            if lines.plain(line):
                first.setdefault(lines.plain(line), (doc, place))
    bodies = list(first)
    sets = [set(lines.shingles(b).tolist()) for b in bodies]
    above = list(range(len(bodies)))

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                above[max(top(i), top(j))] = min(top(i), top(j))
    keeper = {}
    for i, body in enumerate(bodies):
        keeper[top(i)] = min(keeper.get(top(i), first[body]), first[body])
    want = {}
    for doc, text in rows:
        marks = [(place, lines.plain(x)) for place, x in enumerate(text.split(b"\n"))]
        gone = {p for p, b in marks if b and keeper[top(bodies.index(b))] != (doc, p)}
        want[doc] = (sum(bool(b) for _, b in marks), len(gone))
    got = {r.doc_id: (r["__lines"], r["__removed"]) for r in lines.cleaned(some).collect()}
    assert got == want and sum(n for _, n in want.values()) > 50


@pytest.mark.parametrize("rounds, members", [(8, 512), (0, 8), (1, 8)])
def test_large_groups_lose_no_link(spark, monkeypatch, rounds, members):
    """One group of sets that are alike, linked or just under the threshold: hubs, blocks
    and parts give the components of all pairs."""
    monkeypatch.setattr(links, "ROUNDS", rounds)
    monkeypatch.setattr(links, "PART_MEMBERS", members)
    monkeypatch.setattr(links, "SMALL", 3)
    draw = np.random.default_rng(5)
    base = draw.permutation(200)[:40]
    sets = {}
    for i in range(90):
        own = base.copy()
        spots = draw.choice(40, int(draw.integers(2, 7)), replace=False)
        own[spots] = 200 + draw.integers(0, 12, len(spots))
        sets[i.to_bytes(2, "big")] = np.unique(own).astype(np.uint64)
    bodies = spark.createDataFrame([(bytearray(n), bytearray(x.tobytes())) for n, x in sets.items()], "node binary, body binary")
    grouped = bodies.selectExpr("7L AS key", "node", "octet_length(body) AS size")
    again = bodies.selectExpr("8L AS key", "node", "octet_length(body) AS size")
    got = links.link(grouped.unionByName(again), bodies, lambda b: np.frombuffer(b, np.uint64), 80)
    got = {bytes(r.node): bytes(r.root) for r in got.collect()}
    top = {n: n for n in sets}
    for _ in sets:
        for a, x in sets.items():
            for b, y in sets.items():
                both = len(np.intersect1d(x, y))
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    top[a] = top[b] = min(top[a], top[b])
        if all(top[top[n]] == top[n] for n in sets):
            break
    assert len(set(top.values())) > 1
    assert {n: got.get(n, n) for n in sets} == top


@pytest.fixture
def any_order(monkeypatch):
    """The rows of a batch in another order in each pass, as a cluster's shuffle gives them."""
    by_batch = GroupedData.cogroup

    def shuffled(left, right):
        spot = F.xxhash64("doc_id", "text", F.lit(random.random()))
        return by_batch(left._df.sortWithinPartitions("batch", spot).groupBy("batch"), right)

    monkeypatch.setattr(GroupedData, "cogroup", shuffled)


@pytest.mark.parametrize(
    "removed, by_hand, columns",
    [
        (spans.without_repeats, spans_by_hand, ["n_words", "n_removed", "kept_sha256"]),
        (suffixes.without_earlier, suffixes_by_hand, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    ],
)
def test_rows_come_in_any_order(spark, any_order, removed, by_hand, columns):
    rows = [*mixture(3), (1, None), (1, ""), (None, "x " * 60), (40, "x " * 60), (40, "y " * 60)]
    docs = spark.createDataFrame([row(d, t) for d, t in rows], DOCS)
    window = {spans.without_repeats: spans.WINDOW, suffixes.without_earlier: suffixes.WINDOW}[removed]
    assert rows_of(removed(docs), "doc_id", *columns) == by_hand(rows, window)


def alike(seed, n):
    """Sets of 40 tokens, linked or just under a similarity of 0.8; some share keys."""
    draw = np.random.default_rng(seed)
    base = draw.permutation(200)[:40]
    sets, keys = {}, []
    for i in range(n):
        own = base.copy()
        spots = draw.choice(40, int(draw.integers(2, 7)), replace=False)
        own[spots] = 200 + draw.integers(0, 12, len(spots))
        node = i.to_bytes(2, "big")
        sets[node] = np.unique(own).astype(np.uint64)
        keys += [(k, node) for k in (7, 8 + i % 3, 100 + i // 2)]
    return sets, keys


def linked_by_hand(sets):
    nodes = list(sets)
    top = {x: x for x in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def linked(spark, sets, keys):
    bodies = spark.createDataFrame([(bytearray(n), bytearray(x.tobytes())) for n, x in sets.items()], "node binary, body binary")
    members = spark.createDataFrame([(k, bytearray(n)) for k, n in keys], "key long, node binary")
    members = members.join(bodies.selectExpr("node", "octet_length(body) AS size"), "node")
    got = links.link(members, bodies, lambda b: np.frombuffer(b, np.uint64), 80)
    got = {bytes(r.node): bytes(r.root) for r in got.collect()}
    return {n: got.get(n, n) for n in sets}


def test_a_cluster_with_many_keys_takes_few_tables(spark, monkeypatch):
    """Sets that share many keys and are alike, but not all linked, are settled in one turn."""
    written, cut = [], links.cut_lineage
    monkeypatch.setattr(links, "PART_MEMBERS", 16)
    monkeypatch.setattr(links, "cut_lineage", lambda df: written.append(1) or cut(df))
    sets, keys = alike(6, 60)
    assert linked(spark, sets, keys) == linked_by_hand(sets)
    assert len(written) <= 12


@pytest.mark.parametrize("rounds", [1, 8])
def test_homes_beyond_one_task_lose_no_link(spark, monkeypatch, rounds):
    monkeypatch.setattr(links, "ROUNDS", rounds)
    monkeypatch.setattr(links, "PART_MEMBERS", 8)
    monkeypatch.setattr(links, "FAR", 2)
    monkeypatch.setattr(links, "TASK_BYTES", 2000)
    sets, keys = alike(7, 70)
    got = linked(spark, sets, keys)
    assert got == linked_by_hand(sets) and len(set(got.values())) > 1


def test_one_home_for_the_keys_of_a_cluster(spark):
    """A member moves once for all keys that it shares with the same least member."""
    rows = [(k, bytearray(i.to_bytes(2, "big")), 1, i) for k in range(30) for i in range(50)]
    members = spark.createDataFrame(rows, "key long, node binary, size int, mark long")
    assert links._homes(members).count() == 50


def test_lines_are_compared_as_one_by_one():
    draw = random.Random(9)
    texts = [bytes(draw.choices(b"aB\xc3 \n\t\r\x0b\x0c\x1c\x85", [9, 9, 2, 3, 3, *[k] * 6], k=n)) for n in range(60) for k in (0, 0, 0.1)]
    texts += [b"", b" ", b"\n", b"a", b" a", b"a ", b"a\n", b"\na", b"a b", b"a  b", b"a \nb", b"a\n b", b"a\tb", b"", b"a"]
    for some in (texts, texts[::-1], [], [b""], [b" a"], [b"a "], *([t] for t in texts)):
        assert lines.plain_lines(some) == [[lines.plain(x) for x in t.split(b"\n")] for t in some]


def test_only_texts_with_odd_blanks_are_rewritten(monkeypatch):
    """Lines of other texts cost no work one by one."""
    rewritten, plain = [], lines.plain
    monkeypatch.setattr(lines, "plain", lambda line: rewritten.append(line) or plain(line))
    texts = [b"\n".join(b"Line %d of %d" % (i, j) for i in range(100)) for j in range(20)]
    texts[7] += b"\nand  one"
    got = lines.Lines([*texts, None], [*range(20), 20])
    assert len(rewritten) == 101 and len(got.bodies) == 2001
    assert got.bodies[0] == b"line 0 of 0" and b"and one" in got.bodies


@pytest.mark.parametrize("most", [64, 1 << 16])
def test_band_keys_are_minima(monkeypatch, most):
    monkeypatch.setattr(lines, "PART_BYTES", most)
    draw = random.Random(8)
    bodies = [bytes(draw.choices(b"abcd e", k=n)) for n in (0, 7, 8, 9, 300, 40, 41, 8, 2000, 12)]
    got = lines.band_keys(bodies)
    for body, row_ in zip(bodies, got):
        grams = (shared.Rolling(lines._SYMBOLS[np.frombuffer(body, np.uint8)]).every(8) >> np.uint64(32)).astype(np.uint32)
        for band in range(lines.BANDS):
            key = np.full(1, band + 1, np.uint64)
            for k in range(band * lines.ROWS, (band + 1) * lines.ROWS) if len(grams) else ():
                key = shared.mixed(key * np.uint64(1_000_003) + ((grams ^ lines._FLIP[k]) * lines._SCALE[k]).min())
            assert row_[band] == (key[0] if len(grams) else 0)
