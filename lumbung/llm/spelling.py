"""Spelling variants of a corpus's words by blocked Gram matrices of letter counts.

Plan. (1) Every task counts the runs of letters of its texts; equal words are summed before and
after one shuffle. (2) Words fall into blocks of one length and one split of their letters over
``CLASSES`` classes. One edit changes the length by one at most and moves one letter between classes,
so a near word lies in the same block or in one of a fixed number of adjacent ones. Large blocks are
cut into chunks of ``CHUNK`` words. (3) For each pair of adjacent chunks one NumPy product of their
letter counts gives all squared distances: a replaced letter makes them two, an inserted or deleted
one makes them one, and only pairs with just that distance are compared letter by letter. Pairs
never leave the task unless they are near words. (4) Near words are summed up for each word: their
number and the one of largest n. (5) Forms are followed by doubling: n at least doubles on every
step, so this takes six rounds at most.

Work is quadratic in the *vocabulary* within adjacent blocks, as the method has it, not in the
corpus: nothing is dropped, and the number of chunks and of their pairs grows instead of a task.

Edge cases: null and empty texts have no words; a null doc_id counts as an empty one in the hash;
texts and words of any length are taken whole; of near words with equal n the smallest in code-point
order is the form; repeated rows count again, as do equal texts; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.sources.staging import stage

RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # a-z and U+00C0 to U+00FF, in UTF-8
LETTERS = [chr(c) for c in (*range(0x61, 0x7B), *range(0xC0, 0x100))]
CLASSES = 4  # a letter's class is its code point modulo this
CHUNK, CHARS = 2048, 1 << 20  # words and letters of a chunk, about
CALL = 200_000  # words of a Python call, about
PAIRS = 1 << 18  # candidates compared at a time
MISPRINT = 97
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))


def misprinted(run: bytes, start: int) -> bytes:
    """The run without one letter if its hash (carried on from the document's) says so."""
    h = zlib.crc32(run, start)
    if h % MISPRINT:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counted(batches):
    for batch in batches:
        total: Counter[bytes] = Counter()
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if text:
                start = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                for run, n in Counter(m.group() for m in RUN.finditer(text.lower())).items():
                    total[misprinted(run, start)] += n
        names, counts = pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())
        yield pa.RecordBatch.from_arrays([names, counts], names=["word", "n"])


def words(docs: DataFrame, least_length: int = 5, least_n: int = 3) -> DataFrame:
    """(word, n) of the corpus."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = texts.mapInArrow(_counted, "word string, n long").filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n)


# -- blocks -----------------------------------------------------------------------
def block_of(word: Column) -> Column:
    """Number of the word's letters in each class; their sum is its length."""
    def of(k: int) -> Column:
        others = "".join(c for c in LETTERS if ord(c) % CLASSES != k)
        return F.length(F.regexp_replace(word, f"[{others}]", ""))

    return F.array(*[of(k) for k in range(CLASSES)])


def steps() -> list[list[int]]:
    """To each unordered pair of adjacent blocks once: stay, one letter moved, one letter more."""
    unit = np.eye(CLASSES, dtype=int)
    moves = [unit[j] - unit[i] for i, j in permutations(range(CLASSES), 2) if i < j]
    return [s.tolist() for s in (np.zeros(CLASSES, int), *moves, *unit)]


def _chunk_pairs(listed: DataFrame) -> DataFrame:
    """Words once for each pair of chunks that theirs is part of: (left, lp, right, rp, side, word, n)."""
    sizes = listed.groupBy("block").agg(F.count("*").alias("c"), F.sum(F.length("word")).alias("t"))
    sizes = stage(sizes.select("block", F.ceil(F.greatest(F.col("c") / CHUNK, F.col("t") / CHARS)).cast("int").alias("parts")), "blocks")
    step = F.explode(F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps()]))
    ways = sizes.select(F.col("block").alias("left"), F.col("parts").alias("lparts"), step.alias("step"))
    ways = ways.withColumn("right", F.zip_with("left", "step", lambda a, b: a + b))
    ways = ways.join(sizes.select(F.col("block").alias("right"), F.col("parts").alias("rparts")), "right")
    ways = stage(ways.select("left", "right", "lparts", "rparts"), "block-pairs")
    chunks = listed.join(sizes, "block").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    same = F.col("left") == F.col("right")
    first = chunks.select(F.col("block").alias("left"), F.col("part").alias("lp"), "word", "n").join(ways, "left")
    first = first.select("left", "lp", "right", F.explode(F.sequence(F.when(same, F.col("lp")).otherwise(0), F.col("rparts") - 1)).alias("rp"), F.lit(0).alias("side"), "word", "n")
    second = chunks.select(F.col("block").alias("right"), F.col("part").alias("rp"), "word", "n").join(ways, "right")
    second = second.select("left", F.explode(F.sequence(F.lit(0), F.when(same, F.col("rp")).otherwise(F.col("lparts") - 1))).alias("lp"), "right", "rp", F.lit(1).alias("side"), "word", "n")
    # A chunk with itself needs its words on one side only.
    second = second.filter((F.col("left") != F.col("right")) | (F.col("lp") != F.col("rp")))
    return first.unionByName(second)


# -- Gram matrices ------------------------------------------------------------------
def _letters(listed: list[str]) -> np.ndarray:
    return np.frombuffer("".join(listed).encode("latin-1"), np.uint8).reshape(len(listed), -1)


def _counts(letters: np.ndarray) -> np.ndarray:
    n = len(LETTERS)
    at = _COLUMN[letters] + n * np.arange(len(letters))[:, None]
    exact = np.float32 if letters.shape[1] < 2000 else np.float64  # squares stay whole numbers
    return np.bincount(at.ravel(), minlength=n * len(letters)).reshape(-1, n).astype(exact)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all rows of two matrices of letter counts, by one product."""
    used = a.any(axis=0) | b.any(axis=0)
    a, b = a[:, used], b[:, used]
    left = np.column_stack([a, (a * a).sum(axis=1), np.ones(len(a), a.dtype)])
    right = np.column_stack([-2 * b, np.ones(len(b), b.dtype), (b * b).sum(axis=1)])
    return left @ right.T


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by one replaced letter or, if b's are longer, by one inserted letter."""
    length = a.shape[1]
    if length == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    front = np.logical_and.accumulate(a == b[:, :length], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= length


def near_pairs(left: list[str], right: list[str] | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words in two lists of one length each, or in one list."""
    a = _letters(left)
    b = a if right is None else _letters(right)
    want = 2 if a.shape[1] == b.shape[1] else 1
    close = squared_distances(_counts(a), _counts(b)) == want
    if right is None:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    step = max(1, PAIRS * 8 // max(8, a.shape[1]))
    ok = [one_edit(a[i[at : at + step]], b[j[at : at + step]]) for at in range(0, len(i), step)]
    ok = np.concatenate(ok) if ok else np.zeros(0, bool)
    return i[ok], j[ok]


def _near(pdf: pd.DataFrame) -> pd.DataFrame:
    out = []
    word, n, side = (pdf[c].to_numpy() for c in ("word", "n", "side"))
    for rows in pdf.groupby("pair", sort=False).indices.values():
        one, two = rows[side[rows] == 0], rows[side[rows] == 1]
        alone = pdf["alone"].iat[rows[0]]
        if len(one) and (alone or len(two)):
            i, j = near_pairs(word[one].tolist(), None if alone else word[two].tolist())
            i, j = one[i], (one if alone else two)[j]
            out += [(word[i], word[j], n[j]), (word[j], word[i], n[i])]
    sides = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(("word", "other", "other_n"), sides, strict=True)))


def near_words(listed: DataFrame) -> DataFrame:
    """(word, other, other_n): near words of (word, n), each pair in both directions."""
    rows = _chunk_pairs(listed)
    pair = F.xxhash64("left", "lp", "right", "rp")
    alone = (F.col("left") == F.col("right")) & (F.col("lp") == F.col("rp"))
    rows = stage(rows.select(pair.alias("pair"), alone.alias("alone"), "side", "word", "n"), "chunk-pairs")
    calls = max(1, rows.count() // CALL)
    return rows.withColumn("call", F.pmod("pair", F.lit(calls))).groupBy("call").applyInPandas(_near, "word string, other string, other_n long")


# -- forms and roots ------------------------------------------------------------------
def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each word's chain of forms, by doubling."""
    ends = stage(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(ends.join(onward, "root").select("word", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "roots")
        if not further.filter("moved").limit(1).count():
            return further.select("word", "root")
        ends = further.select("word", "root")


def variants(docs: DataFrame, least_length: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    listed = stage(words(docs, least_length, least_n), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(listed.select("word", "n", block_of(F.col("word")).alias("block"))).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    frequent = F.col("form_n") >= times * F.col("n")
    forms = listed.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("form")).alias("form"), F.when(frequent, F.col("form_n")).alias("form_n"))
    forms = stage(forms, "forms")
    return forms.join(follow(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
