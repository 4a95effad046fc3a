import random

import numpy as np

from lumbung.llm import decontamination as dc

DOCS = "doc_id long, text string, item_id long, cosine string"
ITEMS = "item_id long, text string, doc_id long"


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(row[j] + 1 if x == y else max(now[-1], row[j + 1]))
        row = now
    return row[-1]


def test_subsequence_equals_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = (rng.integers(0, 6, rng.integers(1, 90)).astype(np.uint64) for _ in range(2))
        assert dc.subsequence(a, b) == longest(a.tolist(), b.tolist())


def tables(seed=1):
    rng = random.Random(seed)
    common, rare = ["the", "of", "and", "to"], [f"r{i}x" for i in range(4000)]

    def prose(n):
        return [rng.choice(common) if rng.random() < .4 else rng.choice(rare) for _ in range(n)]

    items = []
    for i in range(60):
        ws = prose(rng.randint(14, 60))
        cut = len(ws) - 5
        items.append((i, " ".join(ws[:cut]).capitalize() + ". " + " ".join(ws[cut:]) + ".", 1))
    docs, truth = [], set()
    for d in range(400):
        ws = prose(rng.choice([20, 150, 600]))
        if d % 10 == 0:
            item, part = rng.choice(items), rng.random()
            leak = item[1].split()
            if part < .3:  # a few words changed
                for _ in range(len(leak) // 12):
                    leak[rng.randrange(len(leak))] = rng.choice(rare)
            at = rng.randrange(len(ws))
            ws[at:at] = leak
            truth.add((d, item[0]))
        elif d % 10 == 1:  # only the first third of an item
            leak = rng.choice(items)[1].split()
            ws[5:5] = leak[: len(leak) // 3]
        docs.append((d, rng.choice([" ", "\n"]).join(ws), 1, "x"))
    return docs, items, truth


def test_planted_leaks_and_clean_documents(spark):
    docs, items, truth = tables()
    docs += [(900, None, 1, "x"), (901, "", 1, "x"), (0, docs[0][1], 1, "x"), (902, "the " * 30000 + items[3][1], 1, "x"), (None, items[4][1], 1, "x")]
    items += [(90, None, 1), (91, "", 1), (92, "... !", 1), (None, "no id", 1)]
    truth |= {(902, 3), (None, 4)}
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = dc.leaks(df, bench).collect()
    pairs = [(r.doc_id, r.item_id) for r in got]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == truth
    # brute force over the same checks: every document against every item
    words = {i: dc.hashes_of([t])[0] for i, t, _ in items[:60]}
    for r in got:
        assert r.same_words <= longest(words[r.item_id].tolist(), dc.hashes_of([dict((d, t) for d, t, *_ in docs)[r.doc_id]])[0].tolist()) / len(words[r.item_id])
    kept = {r.doc_id for r in dc.clean(df, bench).collect()}
    assert kept == {d for d, *_ in docs} - {d for d, _ in truth}
    blocks = dc.leaks(df, bench, block=25)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} == truth


def test_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b", 1, "")], DOCS), spark.createDataFrame([], ITEMS)
    assert dc.leaks(docs, bench).collect() == [] and dc.clean(docs, bench).count() == 1
    assert dc.leaks(docs.limit(0), spark.createDataFrame([(1, "a b", 1)], ITEMS)).collect() == []


def test_hot_items_are_found(spark):
    """An item in a third of the documents, and one in all of them, as copied passages among other words."""
    for every in (3, 1):
        rng = random.Random(every)
        _, items, _ = tables(7)
        rare = [f"o{i}x" for i in range(3000)]
        docs = []
        for d in range(300):
            ws = rng.choices(rare, k=rng.choice([20, 40]))
            if d % every == 0:
                ws[7:7] = items[5][1].split()
            docs.append((d, " ".join(ws), 1, "x"))
        got = dc.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(d, 5) for d in range(0, 300, every)}
        assert all(r.same_words == 1 for r in got)


def test_paraphrases_equal_brute_force(spark):
    """Items with their rarest words changed and the answer kept: all that the checks accept are found."""
    rng = random.Random(11)
    common, rare = [f"c{i}x" for i in range(40)], [f"r{i}x" for i in range(3000)]
    items, docs = [], []
    for i in range(40):
        ws = [rng.choice(rare) if rng.random() < .35 else rng.choice(common) for _ in range(rng.randint(14, 50))]
        items.append((i, " ".join(ws[:-5]).capitalize() + ". " + " ".join(ws[-5:]) + ".", 1))
    for d in range(300):
        ws = rng.choices(common + rare[:400], k=20)
        if d % 2:
            leak, changes = rng.choice(items)[1].split(), rng.choice([.2, .5, 1])
            leak = [f"n{rng.randrange(3000)}x" if j < len(leak) - 5 and w.lower().startswith("r") and rng.random() < changes else w for j, w in enumerate(leak)]
            ws[9:9] = leak
        docs.append((d, " ".join(ws), 1, "x"))
    truth = set()
    for i, text, _ in items:
        item, answer = dc.hashes_of([text])[0], dc.hashes_of([text.split(". ")[1]])[0]
        for d, doc, *_ in docs:
            found = dc.hashes_of([doc])[0]
            share = dc.subsequence(item, found) / len(item)
            if share >= dc.SAME or share >= dc.LIKE and dc.subsequence(answer, found) / len(answer) >= dc.SAME:
                truth.add((d, i))
    assert len(truth) > 60
    got = dc.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth


def test_clean_documents_stay_beside_a_leak_with_their_id(spark):
    _, items, _ = tables(3)
    clean = [(None, f"nothing of it {i}", 1, "x") for i in range(20)] + [(None, None, 1, "x"), (7, "another text", 1, "x"), (7, None, 1, "x")]
    leaking = [(None, "before it " + items[2][1], 1, "x"), (7, items[3][1] + " after it", 1, "x"), (7, items[3][1] + " after it", 1, "x")]
    docs, bench = spark.createDataFrame(clean + leaking, DOCS), spark.createDataFrame(items, ITEMS)
    assert sorted(map(tuple, dc.clean(docs, bench).collect()), key=str) == sorted(clean, key=str)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(docs, bench).collect()} == {(None, 2), (7, 3)}


def test_candidates_come_from_the_latent_space(spark, monkeypatch):
    """All leaks are found through the basis; with two noisy directions in its place some are lost, with a blind one all."""
    docs, items, truth = tables(5)
    df, bench = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    got = dc.leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == truth and all(0 < r.cosine <= 1 for r in got)

    def noise(rows, items, own, weight, outside):
        return np.random.default_rng(1).standard_normal((len(weight), 2)).astype(np.float32)

    monkeypatch.setattr(dc, "_basis", noise)
    assert {(r.doc_id, r.item_id) for r in dc.leaks(df, bench).collect()} < truth
    monkeypatch.setattr(dc, "_basis", lambda rows, items, own, weight, outside: np.zeros((len(weight), 2), np.float32))
    assert dc.leaks(df, bench).collect() == []


def test_recall_with_more_items_than_dimensions(spark):
    """Four items to a dimension of the latent space: at least nine tenths of the verbatim and changed leaks."""
    rng = random.Random(3)
    voc = [f"v{i}x" for i in range(6000)]
    items = [(i, " ".join(rng.choices(voc, k=rng.randint(14, 60))) + ".", 1) for i in range(256)]
    docs, truth = [], set()
    for d in range(256):
        leak = items[d][1].split()
        for _ in range(len(leak) // 8 if d % 2 else 0):
            leak[rng.randrange(len(leak) - 1)] = rng.choice(voc)
        docs.append((d, " ".join(rng.choices(voc, k=60) + leak + rng.choices(voc, k=60)), 1, "x"))
        truth.add((d, d))
    got = {(r.doc_id, r.item_id) for r in dc.leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert len(got & truth) >= 0.9 * len(truth)


def test_clashing_names(spark):
    docs, items, _ = tables(2)
    names = "doc_id long, text string, _id long, _th string, _bad_id long, _bad_th long, row string, item_id long"
    df = spark.createDataFrame([(d, t, 5, "a", 6, 7, "b", 8) for d, t, *_ in docs], names)
    got = dc.clean(df, spark.createDataFrame(items, ITEMS))
    assert got.columns == df.columns and {tuple(r)[2:] for r in got.collect()} == {(5, "a", 6, 7, "b", 8)}
