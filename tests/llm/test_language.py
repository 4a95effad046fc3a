import binascii

import numpy as np
import pytest

from lumbung.llm import language as lg

SCHEMA = "doc_id long, text string, lang string, score string, held_out long"
WORDS = {"en": "the cat and of with house that", "de": "der und die ßen über schön nicht", "fr": "le être garçon avec les dans où"}


def table(n=300):
    rng = np.random.default_rng(3)
    langs = list(WORDS)
    rows = [(i, " ".join(rng.choice(WORDS[langs[i % 3]].split(), 12)), langs[i % 3], "x", 1) for i in range(n)]
    return rows + [(1001, None, "en", "x", 1), (1002, "", "en", "x", 1), (1003, "123 !?", "de", "x", 1), (1004, "THE CAT", None, "x", 1),
                   (None, "der und die", "de", "x", 1), (5, rows[5][1], "fr", "x", 1), (1005, "ü" * 200_000, "de", "x", 1)]


def test_held_out_accuracy_and_edge_cases(spark):
    rows = table()
    got = {}
    for r in lg.identify(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r.doc_id, r)
    for i, _, lang, *_ in rows[:300]:
        assert got[i].held_out == (binascii.crc32(str(i).encode()) % 5 == 0)
        assert got[i].lang_pred == lang and 0 <= got[i].score <= 1
    assert [got[i].lang_pred for i in (1001, 1002, 1003, 1004, None)] == ["und", "und", "und", "en", "de"]
    assert got[None].held_out is False


def test_labels_of_held_out_rows_do_not_count(spark):
    rows = table()
    other = [(i, t, "zz" if i is not None and binascii.crc32(str(i).encode()) % 5 == 0 else lang, s, h) for i, t, lang, s, h in rows]
    a, b = (sorted(map(str, lg.identify(spark.createDataFrame(x, SCHEMA)).collect())) for x in (rows, other))
    assert a == b


def test_empty_and_unlabelled_tables(spark):
    assert lg.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    assert lg.identify(spark.createDataFrame([(1, "abc", None, "", 1)], SCHEMA).coalesce(1)).first().lang_pred == "und"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 12, 40])
def test_codewords_differ(n):
    code = lg.codewords(n)
    assert code.shape[0] == n and len({tuple(r) for r in code}) == n
    if n > 2:
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= (2 if n == 3 else 4 if n == 4 else 5)


def test_one_bit_wrong_is_corrected():
    code = lg.codewords(4).astype(float)
    for i in range(4):
        for bit in range(code.shape[1]):
            margin = code[i].copy()
            margin[bit] *= -1
            assert np.log1p(np.exp(-margin * code)).sum(axis=1).argmin() == i
