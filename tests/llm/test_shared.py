"""The exchange of keys with buckets costs the same for any number of buckets."""

import time

import numpy as np

from tidemark.llm import shared


def test_parted():
    draw = np.random.default_rng(3)
    for size, most in ((0, 1), (1, 1), (1000, 7), (1000, 100_000)):
        home = draw.integers(0, most, size)
        got = list(shared.parted(home))
        assert [b for b, _ in got] == np.unique(home).tolist()
        assert all((mine == np.flatnonzero(home == b)).all() for b, mine in got)


def test_ask_and_read():
    """What is asked of many buckets comes back to its key."""
    keys = np.unique(np.random.default_rng(4).integers(0, 1 << 63, 200_000).astype(np.uint64))
    took = {}
    for buckets in (64, 15_000):
        began = time.perf_counter()
        rows = shared.request_rows(5, shared.HELD, buckets, keys)
        asked = [np.frombuffer(r[3], np.uint64) for r in rows]
        told = [
            {"bucket": r[1], "kind": r[2], "bits": np.packbits(np.concatenate([k % np.uint64(3) == 0, k % np.uint64(5) == 0])).tobytes()}
            for r, k in zip(rows, asked)
        ]
        yes, hot = shared.read_bits(told, shared.HELD, buckets, keys)
        took[buckets] = time.perf_counter() - began
        assert (yes == (keys % np.uint64(3) == 0)).all() and (hot == (keys % np.uint64(5) == 0)).all()
    # Rows cost something; keys are not looked at once per bucket (that took seconds).
    assert took[15_000] < 1
