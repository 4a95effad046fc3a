import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lumbung.llm import simhash as sh

SCHEMA = "doc_id long, text string, fp string, mask string"


def mark(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    ws = re.findall("[^\x20\x09-\x0d]+", lowered)
    grams = [" ".join(ws[i : i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(points, radius):
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    points = sorted(root)
    for i, p in enumerate(points):
        for q in points[:i]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    return {p: find(p) for p in points}


def brute(rows, radius=4):
    marks = [mark(r[1]) for r in rows]
    of = roots(marks, radius)
    ids = {}
    for m, r in zip(marks, rows, strict=True):
        if r[0] is not None:
            ids[of[m]] = min(ids.get(of[m], 1 << 62), r[0])
    return sorted([(r[0], f"{m:016x}", ids.get(of[m])) for m, r in zip(marks, rows, strict=True)], key=str)


def texts(seed):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(300)] + ["The", "É", "é", "ẞ"]
    rows = []
    for _ in range(30):
        base = rng.choices(voc, k=rng.choice([1, 2, 3, 4, 5, 40, 200, 400]))
        for _ in range(rng.randint(1, 6)):
            ws = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                ws[rng.randrange(len(ws))] = rng.choice(voc)
            rows.append(rng.choice([" ", "\n", " \t "]).join(ws))
    rows = [(i, t, "x", None) for i, t in enumerate(rows)]
    return rows + [(900, None, "x", "y"), (901, " \t", "x", "y"), (902, "", "x", "y"), (3, rows[3][1], "x", None), (904, rows[8][1].upper(), "x", None),
                   (None, rows[5][1], "x", None), (None, "quite alone here", "x", None), (906, "la la la " * 40000, "x", None), (907, "a b c d e f", "x", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = texts(seed)
    got = sh.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_every_pair_within_the_radius_meets():
    rng = random.Random(3)
    for fixed in (0, int(sh.masks(0, 4)[7]), int(sh.masks(int(sh.masks(0, 4)[3]), 4)[5])):
        tables = [int(m) for m in sh.masks(fixed, 4)]
        open_ = [i for i in range(64) if not fixed >> i & 1]
        assert len(tables) <= 31
        for _ in range(3000):
            flips = sum(1 << i for i in rng.sample(open_, min(len(open_), rng.randint(1, 4))))
            assert any(not flips & m for m in tables)


def test_every_round_fixes_a_bit():
    fixed = [0]
    for _ in range(4):
        fixed = [int(m) for f in fixed[:40] for m in sh.masks(f, 4) if not (m & f) ^ f and m != f or (~f & (1 << 64) - 1).bit_count() <= 4]
    for f in fixed[::50]:
        assert (64 - f.bit_count() <= 4) or all(int(m) != f for m in sh.masks(f, 4))


def test_tables_keep_half_of_the_bits():
    assert {int(m).bit_count() for m in sh.masks(0, 4)} <= {32, 33, 34}


def hot_cloud(rng, n, bits):
    base = rng.getrandbits(64)
    spots = rng.sample(range(64), bits)
    return sorted({base ^ sum(1 << s for s in rng.sample(spots, rng.randint(0, bits))) for _ in range(n)})


def test_large_buckets_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(sh, "NODES", 24)
    rng = random.Random(4)
    points = hot_cloud(rng, 150, 10) + hot_cloud(rng, 60, 30) + [rng.getrandbits(64) for _ in range(60)]
    signed = np.array(points, np.uint64).view(np.int64).tolist()
    links = sh.links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    pairs = [(r.u % (1 << 64), r.v % (1 << 64)) for r in links.collect()]
    assert all(a in points and b in points for a, b in pairs)
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in pairs:
        root[find(a)] = find(b)
    want, least = roots(points, 4), {}
    for p in points:
        least.setdefault(find(p), set()).add(want[p])
    assert all(len(s) == 1 for s in least.values()) and len(least) == len(set(want.values()))


def test_rows_of_a_hot_group_grow_in_proportion():
    rng = random.Random(6)
    for n in (200, 400, 800):
        cloud = np.array(hot_cloud(rng, n, 12), np.uint64)
        first, other = sh.spanning_links(cloud, 4)
        assert len(first) == len(other) < len(cloud)


def test_empty_table(spark):
    assert sh.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_hexadecimal(spark):
    got = spark.createDataFrame([(0,), (255,), (-1,)], "fp long").select(sh.hexadecimal(F.col("fp"))).collect()
    assert [r[0] for r in got] == ["0" * 16, "0" * 14 + "ff", "f" * 16]
