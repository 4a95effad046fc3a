import random
import re

import numpy as np
import pytest

from lumbung.llm import minhash as mh

SCHEMA = "doc_id long, text string, node long, kept string"


def sets_of(text, k=5):
    ws = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(ws[i : i + k]) for i in range(max(1, len(ws) - k + 1))} if ws else set()


def brute(rows):
    sets = [sets_of(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), 1 << 60), r[0])
    out = []
    for i, (doc, *_) in enumerate(rows):
        c = ids.get(find(i))
        out.append((doc, len(sets[i]), c, doc == c))
    return sorted(out, key=str)


def texts(seed, families=25, copies=7):
    rng = random.Random(seed)
    voc = [f"w{i}" for i in range(400)] + ["The", "the", "É", "é"]
    rows = []
    for _ in range(families):
        base = rng.choices(voc, k=rng.choice([1, 3, 4, 5, 30, 80, 200]))
        for _ in range(rng.randint(1, copies)):
            ws = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5, 12])):
                ws[rng.randrange(len(ws))] = rng.choice(voc)
            rows.append(rng.choice([" ", "\n", "  "]).join(ws))
    rng.shuffle(rows)
    rows = [(i, t, 1, "x") for i, t in enumerate(rows)]
    return rows + [(900, None, 1, "x"), (901, " \t", 1, "x"), (902, "", 1, "x"), (3, rows[3][1], 1, "x"), (905, rows[4][1].upper(), 1, "x"),
                   (None, rows[5][1], 1, "x"), (None, "quite alone here", 1, "x"), (906, "long " * 3000 + " ".join(voc), 1, "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = texts(seed)
    got = mh.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("_id", "_th")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_blocks_and_groups_of_a_hot_bucket(spark, monkeypatch):
    monkeypatch.setattr(mh, "NODES", 7)
    monkeypatch.setattr(mh, "SIGNATURES", 9)
    monkeypatch.setattr(mh, "SHINGLES", 900)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        ws = list(base)
        for _ in range(rng.randint(0, 2)):
            ws[rng.randrange(60)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(ws), 1, "x"))
    got = mh.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("_id", "_th")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert mh.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_minhashes_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(1, 1 << 63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2700], rng.integers(1, 1 << 63, 300, dtype=np.uint64)])
    sig, _ = mh.signatures(np.concatenate([a, b]), np.array([0, 3000]))
    assert abs((sig[0] == sig[1]).mean() - 2700 / 3300) < 0.2


def test_filter_follows_the_threshold(spark):
    """At 80 percent the minhash filter loses no more links than at 85."""
    rng = np.random.default_rng(6)
    assert (mh.reach(80), mh.reach(85)) == (43, 48)
    for percent in (80, 85):
        equal = rng.binomial(mh.MINHASHES, percent / 100, 200_000)
        assert (equal < mh.reach(percent)).mean() < 2 * mh.MISSED
    base = [f"w{i}" for i in range(60)]
    near = [*base[:30], "x", *base[31:]]  # 51 of 61 shingles in common
    df = spark.createDataFrame([(1, " ".join(base), 1, "x"), (2, " ".join(near), 1, "x")], SCHEMA)
    assert {p: sorted(r.component_id for r in mh.near_duplicates(df, percent=p).collect()) for p in (80, 85)} == {80: [1, 1], 85: [1, 2]}


def test_rows_dealt_grow_in_proportion_to_a_group(spark, monkeypatch):
    """Twice as many near copies of one text: about twice as many rows, and no more; links whole."""
    monkeypatch.setattr(mh, "NODES", 25)
    monkeypatch.setattr(mh, "SIGNATURES", 25)
    dealt, real = [], mh._sharded

    def counted(rows):
        out = real(rows)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(mh, "_sharded", counted)
    totals, base = [], [f"w{i}" for i in range(90)]
    for n in (150, 300):
        rows = []
        for i in range(n):
            rows.append((i, " ".join([*base, f"x{i}"]), 1, "x"))
        dealt.clear()
        got = mh.near_duplicates(spark.createDataFrame(rows, SCHEMA)).drop("_id", "_th")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
        totals.append(sum(dealt))
    assert totals[1] < 2.6 * totals[0], totals
