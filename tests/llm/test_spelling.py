import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lumbung.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n string, block string"


def brute(rows, least_length=5, least_n=3):
    count = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= least_length and n >= least_n}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w in count:
        others = [o for o in count if near(w, o)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], n_near[w], count.get(form[w])))
    return sorted(out, key=str)


def texts(seed):
    rng = random.Random(seed)
    letters = "abcdeéÿ÷no"
    voc = ["".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(60)]
    for w in list(voc):
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randrange(len(w)), rng.randrange(3)
            voc.append(w[:at] + (rng.choice(letters) if kind else "") + w[at + (kind != 1) :])
    voc += ["Hello", "HELLO", "hellO", "É" * 7, "é" * 7, "ab" * 1500, "ab" * 1500 + "c"]
    rows = []
    for i in range(400):
        ws = [voc[min(len(voc) - 1, int(rng.expovariate(1 / 60)))] for _ in range(rng.randint(0, 40))] + rng.choices(voc, k=5)
        rows.append((i, rng.choice([" ", "-", "1", "\n", "，", "_"]).join(ws), "x", None, "x"))
    rows += [(1000 + i, w, "x", None, "x") for i, w in enumerate(["planet"] * 40 + ["planete"] * 15 + ["planetes"] * 6 + ["planetez"] * 3 + ["planett"] * 25)]
    return rows + [(3, rows[3][1], "x", None, "x"), (None, rows[4][1], None, "x", "x"), (901, None, "x", "x", "x"), (902, "", "x", "x", "x"), (903, "ŝŝŝŝŝŝ Ąbcdefg", "x", "x", "x")]


@pytest.mark.parametrize("seed, chunk", [(1, 2048), (2, 7)])
def test_equals_brute_force(spark, monkeypatch, seed, chunk):
    monkeypatch.setattr(sp, "CHUNK", chunk)
    monkeypatch.setattr(sp, "CALL", 500)
    rows = texts(seed)
    got = sp.variants(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert any(r[1] and r[2] != r[1] for r in want) and any(r[4] > 1 for r in want)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_words_without_a_near_one_and_empty_table(spark):
    rows = [(i, "lonely", "x", "x", "x") for i in range(5)]
    assert [tuple(r) for r in sp.variants(spark.createDataFrame(rows, SCHEMA)).collect()] == [("lonely", None, "lonely", 5, 0, None)]
    assert sp.variants(spark.createDataFrame([], SCHEMA)).collect() == []


def test_steps_reach_every_near_block():
    rng = random.Random(5)
    reached = {tuple(s) for s in sp.steps()} | {tuple(-x for x in s) for s in sp.steps()}
    block = lambda w: np.bincount([ord(c) % sp.CLASSES for c in w], minlength=sp.CLASSES)
    for _ in range(2000):
        w = "".join(rng.choices(sp.LETTERS, k=rng.randint(5, 9)))
        at, kind = rng.randrange(len(w)), rng.randrange(3)
        other = w[:at] + (rng.choice(sp.LETTERS) if kind else "") + w[at + (kind != 1) :]
        assert tuple(block(other) - block(w)) in reached


def test_squared_distances():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 5, (40, 90)).astype(np.float32), rng.integers(0, 5, (30, 90)).astype(np.float32)
    assert (sp.squared_distances(a, b) == ((a[:, None] - b[None]) ** 2).sum(axis=2)).all()
