import hashlib
import random

import numpy as np
import pytest

from lumbung.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, h long, block string"


def brute(rows, width):
    """Bytes covered by a string of ``width`` bytes that starts at two places or more."""
    places = {}
    for r, (_, text, *_) in enumerate(rows):
        data = (text or "").encode()
        for i in range(len(data) - width + 1):
            places.setdefault(data[i : i + width], []).append((r, i))
    gone = [set() for _ in rows]
    for at in places.values():
        if len(at) > 1:
            for r, i in at:
                gone[r].update(range(i, i + width))
    out = []
    for (doc, text, *_), cut in zip(rows, gone, strict=True):
        data = (text or "").encode()
        spans = sum(i - 1 not in cut for i in cut)
        kept = bytes(b for i, b in enumerate(data) if i not in cut)
        out.append((doc, len(data), len(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    stock = ["".join(rng.choices("abé \n", k=rng.randint(5, 60))) for _ in range(8)]
    rows = [(i, "".join(rng.choice(stock) if rng.random() < .5 else "".join(rng.choices("abcdeß ", k=9)) for _ in range(rng.randint(0, 8))), 1, "x")
            for i in range(n)]
    return rows + [(100, None, 1, "x"), (101, "", 1, "x"), (102, "ab" * 40, 1, "x"), (103, "z" * 70, 1, "x"),
                   (3, rows[3][1], 1, "x"), (3, rows[3][1], 1, "x"), (4, "other text with the same id", 1, "x"), (None, rows[5][1], 1, "x")]


@pytest.mark.parametrize("seed,width,anchor,block,limit", [(1, 20, 8, 1 << 20, 1000), (2, 20, 5, 200, 2), (3, 33, 16, 500, 3), (4, 9, 8, 300, 1)])
def test_dedup_equals_brute_force(spark, seed, width, anchor, block, limit):
    rows = texts(seed)
    got = sd.dedup(spark.createDataFrame(rows, SCHEMA), width, anchor, block, limit).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, width)


def test_empty_table(spark):
    assert sd.dedup(spark.createDataFrame([], SCHEMA), 20, 8).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = bytes(rng.choice([97, 98, 0, 255] if seed % 2 else [97, 98], 400).astype(np.uint8)) + b"abab" * 30
    wanted = rng.random(len(data)) < (.5 if seed < 3 else 1)
    order = sd.suffix_order(data, wanted, 64)
    want = sorted(np.flatnonzero(wanted).tolist(), key=lambda i: data[i:] + b"\x00\xff")
    assert [data[i : i + 64] for i in order] == [(data + b"\x00\xff")[i : i + 64][: len(data) - i] for i in want]
    lengths = sd.common_prefixes(data, order, 64)
    for i in range(1, len(order)):
        a, b = data[order[i - 1] : order[i - 1] + 64], data[order[i] : order[i] + 64]
        same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert min(lengths[i], min(len(a), len(b))) == same
