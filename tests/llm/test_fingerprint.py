import hashlib
import random

from pyspark.sql import functions as F

from lumbung.llm import fingerprint as fp

SCHEMA = "doc_id long, text string, sketch string, q long"


def rows_of(seed=1, n=40):
    rng = random.Random(seed)
    voc = [f"w{i}é" for i in range(300)]
    rows = [(i * 3, " ".join(rng.choices(voc, k=rng.randint(0, 120))), "x", 1) for i in range(n)]
    rows += [(200, None, "x", 1), (201, "", "x", 1), (202, "one two", "x", 1), (203, "z" * 5000, "x", 1), (204, rows[4][1], "x", 1), (205, "😀" * 9, "x", 1)]
    rng.shuffle(rows)
    return rows


def test_edited_texts_and_order(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    by_id = sorted(rows)
    for i, (doc, text, *_) in enumerate(by_id):
        text, after = text or "", by_id[(i + 1) % len(by_id)]
        q = len(text) // 4
        edited = text[: len(text) - q] + (after[1] or "")[:q]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[doc].next_doc_id == after[0]
    assert len(got) == len(rows)
    assert got[204].fingerprint == got[12].fingerprint
    long = [got[d] for d, t, *_ in rows if t and len(t.split()) > 40]
    assert all(r.near_edited > 0.3 and r.near_next < 0.2 for r in long)
    assert got[200].fingerprint == "" and got[200].near_edited == 1.0 and got[200].near_next == 1.0


def test_anchors_equal_brute_force(spark):
    rows = rows_of(4)
    df = spark.createDataFrame(rows, SCHEMA)
    words = df.select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "w")).filter("w != ''").select("doc_id", "pos", F.xxhash64("w").alias("h"))
    hashes = {}
    for r in words.orderBy("doc_id", "pos").collect():
        hashes.setdefault(r.doc_id, []).append(r.h)
    pairs = {r.a: r.p for r in spark.createDataFrame(
        sorted({(a, b) for h in hashes.values() for a, b in zip(h, h[1:])}), "x long, y long").select(F.struct("x", "y").alias("a"), F.xxhash64("x", "y").alias("p")).collect()}
    pairs = {(k.x, k.y): v for k, v in pairs.items()}
    got = {}
    for r in fp.anchors(df).collect():
        got.setdefault(r.doc_id, set()).add(r.pos)
    for doc, h in hashes.items():
        if doc == 203 or len(h) < 5:
            continue
        p = [pairs[x] for x in zip(h, h[1:])]
        want = {i for i in range(len(h) - 4) if min(p[i : i + 4]) in (p[i], p[i + 3])}
        assert got[doc] == (want or {0})


def test_an_edit_moves_no_anchor_elsewhere(spark):
    words = [f"w{i}" for i in range(100)]
    df = spark.createDataFrame([(1, " ".join(words), "", 1), (2, " ".join(["new"] + words[:50] + ["other"] + words[51:]), "", 1)], SCHEMA)
    found = {1: {}, 2: {}}
    for r in fp.anchors(df).collect():
        found[r.doc_id][r.hash] = r.pos
    shared = found[1].keys() & found[2].keys()
    assert len(shared) >= len(found[1]) - 5
    assert {found[2][h] - found[1][h] for h in shared} == {1}


def test_repeated_null_and_empty(spark):
    df = spark.createDataFrame([(7, "a b c d e f g h", "", 1), (7, "a b c d e f g h", "", 1), (None, "x y", "", 1)], SCHEMA)
    got = fp.fingerprints(df).collect()
    assert len(got) == 3 and {(r.doc_id, r.next_doc_id) for r in got} == {(7, None), (None, 7)}
    one = fp.fingerprints(spark.createDataFrame([(1, "abcd efgh", "", 1)], SCHEMA)).first()
    assert one.next_doc_id == 1 and one.near_next == 1.0
    assert fp.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_that_share_a_passage(spark):
    """The whole set counts: a passage of 400 words in two texts of 4,000 words, and likeness by brute force."""
    rng = random.Random(8)
    voc = [f"w{i}" for i in range(50000)]
    passage = rng.choices(voc, k=400)
    rows = [(d, " ".join(rng.choices(voc, k=1800) + passage + rng.choices(voc, k=1800)), "x", 1) for d in (1, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in fp.fingerprints(df).collect()}
    sets = {1: set(), 2: set()}
    for r in fp.anchors(df).collect():
        sets[r.doc_id].add(r.hash & 0xFFFFFFFF)
    for d in (1, 2):
        f = got[d].fingerprint
        assert {int(f[i : i + 8], 16) for i in range(0, len(f), 8)} == sets[d]
        assert abs(got[d].near_next - len(sets[1] & sets[2]) / len(sets[1] | sets[2])) < 1e-12 and got[d].near_next > 0.03
        assert 0.7 * got[d].n_anchors < got[d].n_in_place < 0.8 * got[d].n_anchors
