import os
import random

import numpy as np
import pytest

import corpus_pipeline as cp
from lumbung.llm import secrets as sx
from lumbung.llm import sentencepiece_codec as sc

pytestmark = pytest.mark.skipif(not os.path.exists(sc.MODEL), reason="the vocabulary file is not here")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"en": "th er ing on the and ly wh re".split(), "de": "sch ung keit ein der ß ü pf".split()}


def corpus():
    """Documents with what each stage should do to them: (text that stays, or None)."""
    rng = random.Random(8)

    def prose(lang, n):
        return ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(2, 6))) for _ in range(n)]

    items = [(i, " ".join(prose("en", 30)) + ". " + " ".join(prose("en", 6)) + ".") for i in range(6)]
    rows, want = [], {}
    for i in range(160):
        lang = rng.choice(["en", "de"])
        ws = prose(lang, rng.randint(60, 150))
        text = " ".join(ws)
        want[i] = text
        if i % 10 == 1:  # a near copy of the one before it
            ws = rows[-1][1].split()
            ws[len(ws) // 2] = "changed"
            text, want[i] = " ".join(ws), None if 100 * (len(ws) - 9) >= 85 * (len(ws) + 1) else " ".join(ws)
            lang = rows[-1][2]
        elif i % 10 == 2:
            text, want[i] = rng.choice(["123 456 !!", "", None, "..."]), None
        elif i % 10 == 3:
            text, want[i] = " ".join([*prose("en", 40), rng.choice(items)[1], *prose("en", 40)]), None
            lang = "en"
        elif i % 10 == 4:
            secret = "".join(rng.choices("0123456789abcdef", k=18))
            text = f"{text} password={secret} {text[:30]}"
            want[i] = text.replace(secret, sx.SECRET)
        elif i % 10 == 5:
            number = "".join(rng.choices("0123456789", k=16))
            text = want[i] = f"{text} {number}"
        rows.append((i, text, lang, "s", len(text or "")))
    rows.append(rows[0])  # repeated as a whole
    return rows, items, {i: t for i, t in want.items() if t is not None}


def test_stages_take_effect_and_clean_documents_stay(spark, tmp_path):
    rows, items, want = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = cp.run(spark, str(tmp_path)).collect()
    codec = sc.load()
    got = {r.doc_id: codec.decode(np.array(r.ids, np.int32)).decode() for r in out}
    assert len(got) == len(out)
    assert got == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)


def test_columns_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for _, function in cp.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert cp.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0
