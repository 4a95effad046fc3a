import hashlib
import random
import re

import pytest

from lumbung.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, h long, cell string"


def brute(rows, width):
    found = [re.findall("[^\x20\x09-\x0d]+", text or "") for _, text, *_ in rows]
    places = {}
    for r, ws in enumerate(found):
        for i in range(len(ws) - width + 1):
            places.setdefault(tuple(ws[i : i + width]), []).append((r, i))
    gone = [set() for _ in rows]
    for at in places.values():
        if len(at) > 1:
            for r, i in at:
                gone[r].update(range(i, i + width))
    return sorted(((row[0], len(ws), len(cut), hashlib.sha256(" ".join(w for i, w in enumerate(ws) if i not in cut).encode()).hexdigest())
                   for row, ws, cut in zip(rows, found, gone, strict=True)), key=str)


def texts(seed, n=60):
    rng = random.Random(seed)
    stock = [rng.choices(["the", "a", "é", " x", "zu", "q"], k=rng.randint(3, 40)) for _ in range(8)]
    rows = []
    for i in range(n):
        ws = [w for _ in range(rng.randint(0, 8)) for w in (rng.choice(stock) if rng.random() < .5 else rng.choices("abcdef", k=9))]
        rows.append((i, "".join(w + rng.choice([" ", "\n", " \t", "\x0b"]) for w in ws), 1, "x"))
    return rows + [(100, None, 1, "x"), (101, " \n", 1, "x"), (102, "ab cd " * 40, 1, "x"), (103, "z" * 70, 1, "x"),
                   (3, rows[3][1], 1, "x"), (3, rows[3][1], 1, "x"), (4, "other text with this id", 1, "x"), (None, rows[5][1], 1, "x")]


@pytest.mark.parametrize("seed,width,anchor", [(1, 12, 4), (2, 35, 8), (3, 9, 3), (4, 20, 20)])
def test_dedup_equals_brute_force(spark, seed, width, anchor):
    rows = texts(seed)
    got = sd.dedup(spark.createDataFrame(rows, SCHEMA), width, anchor).drop("kept")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, width)


def test_kept_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e", 1, ""), (2, "x  a b c d", 1, "")], SCHEMA)
    assert {r.doc_id: r.kept for r in sd.dedup(df, 3, 2).collect()} == {1: "e", 2: "x"}
    assert sd.dedup(spark.createDataFrame([], SCHEMA), 20, 8).collect() == []


def test_sketch_loses_no_repeated_item(spark):
    df = spark.range(3000).selectExpr("id % 2500 AS h", "id")
    kept = {r.h for r in sd.estimated_repeated(df, "h").collect()}
    assert set(range(500)) <= kept
