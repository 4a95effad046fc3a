import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lumbung.llm import alignment as al

SCHEMA = "doc_id long, text string, piece string, pairs string, shard string"


@pytest.fixture(scope="module")
def libraries():
    tokenizer = Tokenizer.from_file(al.VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=al.MODEL)


def brute(rows, libraries):
    tokenizer, model = libraries
    letters = al.byte_letters()
    docs = []
    for doc, text, *_ in rows:
        a, b = (tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)) if text else ([], [])
        a_bytes = [bytes(letters[c] for c in tokenizer.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            docs.append((doc, [], [], []))
            continue
        groups, i, j, x, y = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if x <= y and i < len(a):
                groups[-1][0].append(a[i])
                x += len(a_bytes[i])
                i += 1
            else:
                groups[-1][1].append(b[j])
                y += len(b_bytes[j])
                j += 1
            if x == y and groups[-1][0] and groups[-1][1]:
                groups.append(([], []))
        docs.append((doc, a, b, groups[:-1]))
    held = Counter()
    for _, _, _, groups in docs:
        held.update({(p, q) for g in groups for p in g[0] for q in g[1]})
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = []
    for doc, a, b, groups in docs:
        links = [(p, q) for g in groups for p in g[0] for q in g[1]]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def texts():
    rng = random.Random(1)
    voc = "the of tionanre hello Überraschung naïve 東京 日本語 🙂🙂 <|endoftext|> </s> don't 12345 x=y; \x00 \t ﬁ é́ ereaties onouly wh".split(" ")
    rows = [(i, rng.choice([" ", "  ", "\n", " \n\n "]).join(rng.choices(voc, k=rng.randint(1, 60))), "x", None, "x") for i in range(120)]
    rows += [(200, None, "x", "x", "x"), (201, "", "x", "x", "x"), (202, "a ▁ b", "x", "x", "x"), (203, " ", "x", "x", "x"), (204, "   lead", "x", "x", "x"), (3, rows[3][1], "x", "x", "x"),
             (None, rows[4][1], "x", "x", "x"), (205, "z" * 30000, "x", "x", "x"), (206, "a" + " " * 20000 + "b", "x", "x", "x"), (207, "日本語" * 4000, "x", "x", "x"), (208, "q😀é" * 900, "x", "x", "x")]
    return rows


@pytest.mark.parametrize("limits", [{}, {"PIECE": 3000, "LINKS": 50, "KEYS": 40, "DENSE": 1, "FAN": 2}])
def test_equals_brute_force(spark, monkeypatch, libraries, limits):
    for name, value in limits.items():
        monkeypatch.setattr(al, name, value)
    rows = texts()
    got = al.align(spark.createDataFrame(rows, SCHEMA))
    want = brute(rows, libraries)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert any(r[5] < r[4] for r in want) and any(r[3] < min(r[1], r[2]) for r in want)


def test_empty_table(spark):
    assert al.align(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, "x", "x", "x"), (2, "", "x", "x", "x")]
    assert sorted(tuple(r) for r in al.align(spark.createDataFrame(rows, SCHEMA)).collect()) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_perfect_hash_is_minimal_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 50_000))
    found = al.PerfectHash.build(keys)
    assert sorted(found.slots(keys).tolist()) == list(range(len(keys)))
    assert len(found.bits) < 6 * len(keys)
    ordered = np.empty(len(keys), np.int64)
    ordered[found.slots(keys)] = keys
    shard = al.Shard(found.sizes.tobytes(), np.packbits(found.bits).tobytes(), ordered.tobytes())
    with pytest.raises(ValueError, match="not in its shard"):
        shard.slots(np.setdiff1d(np.arange(100), keys))
    assert len(al.PerfectHash.build(keys[:0]).slots(keys[:0])) == 0


def test_both_byte_level_libraries_agree(libraries):
    """Character by character: the library in use and the one of the vocabulary's file."""
    with open(al.VOCABULARY, "rb") as a, open(al.MODEL, "rb") as b:
        both = al.Pair(a.read(), b.read())
    for c in [*range(1, 0xD800, 7), *range(0xE000, 0x110000, 97)]:
        text = f" x{chr(c)}{chr(c)} {chr(c)}1{chr(c)} !{chr(c)}!"
        assert both.fast.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids
