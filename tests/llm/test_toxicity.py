import binascii
import random

import pytest

from lumbung.llm import toxicity as tx

DOCS = "doc_id long, text string, toxic string, term long"
LABELS = "doc_id long, toxic int, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    words = ["idiot", "moron", "worthless", "stupid", "scum", "clowns"]
    lex = tx.Lexicon(dict.fromkeys(words, 1.0), {"vermi": 2.0})
    for _ in range(4000):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            op = rng.random()
            if op < .3:
                w.insert(i, rng.choice("abcdiot1"))
            elif w and i < len(w):
                w[i : i + 1] = [] if op < .6 else [rng.choice("abcdiot1")]
        w = "".join(w)
        near = min((x for x in words if len(x) >= 5 and distance(w, x) <= 1), default=None)
        hit = lex.match(w)
        if w in words:
            assert hit == (w, 1.0, False)
        else:
            assert (hit[0] if hit else None) == near and (not hit or hit[2])
    assert lex.match('"vermins!"') == ("vermi", 2.0, False)


def test_quotation():
    say = 'he said "you are an idiot" to me'.split()
    assert tx.quoted(say, 5) and not tx.quoted("you are an idiot and more".split(), 3)


def corpus(n=900):
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    bad = ["idiot", "moron", "worthless", "schurkenX", "schurkenY", "schurkenZ"]
    docs, labels = [], []
    for i in range(n):
        ws = rng.choices(plain, k=rng.randint(10, 60))
        toxic = int(rng.random() < .3)
        if toxic:
            for _ in range(3):
                w = rng.choice(bad)
                ws.insert(rng.randrange(len(ws)), w if rng.random() < .8 or len(w) < 6 or "X" in w else w[:2] + w[3:])
        docs.append((i, " ".join(ws), "x", 1))
        if i % 4:
            labels.append((i, toxic, "x"))
    return docs, labels, dict((a, b) for a, b, _ in labels)


def test_held_out_scores(spark):
    docs, labels, truth = corpus()
    docs += [(5000, None, "x", 1), (5001, "", "x", 1), (5002, "an idi0t, a MORON! idiot worthless", "x", 1), (None, "idiot moron", "x", 1), (7, docs[7][1], "x", 1)]
    labels += [(None, 1, "x"), (3, None, "x")]
    out = tx.scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(docs)
    got = {r.doc_id: r for r in out}
    held = [r for d, r in got.items() if d in truth and r.held_out]
    assert all(r.held_out == (r.doc_id is not None and binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert got[5000].score == got[5001].score < 0.5 and got[5002].predicted == 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)


def test_held_out_labels_do_not_count(spark):
    docs, labels, _ = corpus(300)
    other = [(d, 1 - t if binascii.crc32(str(d).encode()) % 3 == 1 else t, x) for d, t, x in labels]
    df = spark.createDataFrame(docs, DOCS)
    a, b = (sorted(map(str, tx.scores(df, spark.createDataFrame(x, LABELS)).collect())) for x in (labels, other))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 1, "x")], [(1, 0, "x"), (2, 0, "x")]])
def test_few_labels_and_empty_tables(spark, labels):
    df = spark.createDataFrame(labels, LABELS)
    assert tx.scores(spark.createDataFrame([], DOCS), df).collect() == []
    assert len(tx.scores(spark.createDataFrame([(1, "a", "", 1), (2, None, "", 1)], DOCS), df).collect()) == 2
