"""The Feistel shuffle against a row-by-row network, and its law."""

import struct
import zlib
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD, DOCS, row
from tidemark.llm import sharding


def hashed(key, value):
    """Spark's xxhash64 of two longs."""
    seed = 42
    for x in (key, value):
        seed = xxhash.xxh64(struct.pack("<q", x), seed=seed).intdigest()
    return seed - (1 << 64) if seed >> 63 else seed


def placed(number, shuffle):
    while True:
        u, v = divmod(number, shuffle.right_size)
        for key, size in shuffle.rounds:
            u, v = v, (u + hashed(key, v) % size) % size
        number = u * shuffle.right_size + v
        if number < shuffle.rows:
            return number


def test_permutation(spark):
    for rows in (1, 2, 3, 5, 10, 23, 24, 97, 1000, 1023):
        shuffle = sharding.Permutation(spark, rows, seed=rows)
        got = spark.range(rows).select("id", shuffle.place(F.col("id")).alias("p"), shuffle.find(shuffle.place(F.col("id"))).alias("back")).collect()
        assert sorted(r.p for r in got) == list(range(rows))
        assert all(r.back == r.id for r in got)
        assert all(r.p == placed(r.id, shuffle) for r in got)
        assert rows <= shuffle.left_size * shuffle.right_size < rows + shuffle.left_size


def test_large_numbers(spark):
    shuffle = sharding.Permutation(spark, 10**12 + 39)
    some = [0, 1, 2, 10**9, 10**12, 10**12 + 38]
    got = spark.createDataFrame([(x,) for x in some], "id long").select(shuffle.place(F.col("id")).alias("p"), shuffle.find(shuffle.place(F.col("id"))).alias("back")).collect()
    assert [r.back for r in got] == some
    assert [r.p for r in got] == [placed(x, shuffle) for x in some]


def law(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_copies(spark, monkeypatch):
    """One row holds a third of the table; its copies go everywhere."""
    monkeypatch.setattr(sharding, "COPIES", 16)
    rows = [(7, "hot")] * 1000 + [(i, None if i % 5 == 0 else f"t{i}") for i in range(2000)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.sharded(df, 24).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    law(got, 24)
    hot = Counter(r.shard for r in got if r.text == "hot")
    assert len(hot) == 24 and max(hot.values()) < 80
    again = sharding.sharded(df.repartition(7), 24).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    other = sharding.sharded(df, 24, seed=18).collect()
    assert sorted(map(repr, other)) != sorted(map(repr, got))


def test_query(spark, awkward, nothing, tmp_path):
    run = sharding.op13_sharding
    for docs, rows in ((awkward, AWKWARD), (nothing, [])):
        folder = tmp_path / str(len(rows))
        docs.withColumns({"shard": F.lit("x"), "law": F.lit(1)}).write.parquet(f"{folder}/documents.parquet")
        got = run(spark, str(folder)).collect()
        texts = [(r[1] or "").encode() for r in rows]
        want = Counter((r[0], len(t) + 8, zlib.crc32(t)) for r, t in zip(rows, texts))
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
        assert {r.law for r in got} <= {"rows"} and {r.grown_shard for r in got} <= {None}
        law(got, 24)
    assert sharding.sharded(spark.createDataFrame([row(1, "a")], DOCS)).first().slot == 0
