"""Language ID by error-correcting output codes.

Training sums up the shares of hashed byte n-grams in each document (one to three bytes, ASCII letters lower-cased, other ASCII
bytes as blanks) per language over all training rows: one row per task, language and n-gram is
summed by Spark, so what reaches the driver is languages x ``BUCKETS`` numbers. Each bit of the
code is a binary classifier: the log ratio of an n-gram's probability in the languages whose
codeword has the bit and in those without it. Up to ``EXHAUSTIVE`` languages take the exhaustive
code, more of them random codewords with rows and columns far apart. Decoding is loss-weighted:
the codeword with the smallest summed logistic loss wins; a small lead flags ambiguity.

Edge cases: null text and text without a letter (Unicode category L) is ``und`` with score 0; so is
everything when there is no training row; with one language all other texts get it. Null doc_ids
are neither held out nor learned from. Repeated rows are predicted alike; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.common import pieces

BUCKETS = 1 << 14
EXHAUSTIVE = 7
SHARPNESS = 6.0
AMBIGUOUS = 0.2  # lead of the best codeword's probability below which a text is flagged

_CLASS = np.arange(256, dtype=np.uint32)
_CLASS[65:91] += 32
_CLASS[[b for b in range(128) if not chr(b).isalpha()]] = 32


def ngrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bucket numbers of the n-grams that start at each byte (bytes x 3); those that leave the row have ``BUCKETS``."""
    out = np.full((len(data), 3), BUCKETS, np.int32)
    code = _CLASS[data]
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    value = code.copy()
    for n in range(3):
        if n:
            value = value[:-1] * np.uint32(0x01000193) + code[n:]
        mixed = (value + np.uint32(n * 0x9E37)) * np.uint32(0x9E3779B1)
        out[: len(value), n] = np.where(left[: len(value)] > n, mixed >> np.uint32(32 - 14), BUCKETS)
    return out


def codewords(n: int, seed: int = 6) -> np.ndarray:
    """A codeword of -1 and 1 for each of n classes."""
    if n <= 2:
        return np.array([[-1], [1]][:n], np.int8)
    if n <= EXHAUSTIVE:
        bits = np.arange(1, 2 ** (n - 1))
        table = (bits[None, :] >> np.arange(n - 1)[:, None]) & 1
        return np.vstack([np.zeros(len(bits), int), table]).astype(np.int8) * 2 - 1
    rng, best, gap = np.random.default_rng(seed), None, -1
    size = 15 * int(np.ceil(np.log2(n)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, size))
        agree = code.astype(int) @ code.T
        nearest = (size - (agree - np.eye(n, dtype=int) * 10 * size).max()) // 2
        if nearest > gap and (abs(code.sum(0)) < n).all():
            best, gap = code, nearest
    return best


def _count(batches):
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for row, data, offsets in pieces(batch.column("text")):
            grams = ngrams(data, offsets)
            for i in range(len(offsets) - 1):
                found = np.bincount(grams[offsets[i] : offsets[i + 1]].ravel(), minlength=BUCKETS + 1)
                # Every document weighs the same, so that no long one speaks for its language.
                found = np.rint(found * (10_000 / max(1, found[:BUCKETS].sum()))).astype(np.int64)
                lang = langs[row + i]
                total[lang] = total[lang] + found if lang in total else found
    for lang, counts in total.items():
        at = np.flatnonzero(counts[:BUCKETS])
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(counts[at])], names=["lang", "gram", "n"])


class Model:
    """Languages, their codewords and one weight per n-gram and bit."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs, self.code = langs, codewords(len(langs))
        share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
        weights = []
        for bit in self.code.T:
            one, zero = (share[bit == s].mean(axis=0) if (bit == s).any() else np.full(BUCKETS, 1 / BUCKETS) for s in (1, -1))
            weights.append(np.log(one / zero))
        self.weights = np.vstack([np.array(weights).T, np.zeros(len(weights))]).astype(np.float32)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, its probability, and its lead over the next one, for non-empty rows."""
        grams = ngrams(data, offsets)
        sums = np.zeros((len(data), self.weights.shape[1]), np.float32)
        for n in range(3):
            sums += self.weights[grams[:, n]]
        margin = np.add.reduceat(sums, offsets[:-1], axis=0, dtype=np.float64) / np.diff(offsets)[:, None]
        loss = np.log1p(np.exp(-SHARPNESS * margin[:, None, :] * self.code[None])).sum(axis=2)
        chance = np.exp(loss.min(axis=1, keepdims=True) - loss)
        chance /= chance.sum(axis=1, keepdims=True)
        ranked = np.sort(chance, axis=1)
        lead = ranked[:, -1] - (ranked[:, -2] if len(self.langs) > 1 else 0)
        return chance.argmax(axis=1), chance.max(axis=1), lead


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(rows: DataFrame) -> Model | None:
    """The model of labelled rows (text, lang), all of them; None without any."""
    rows = rows.select("text", "lang").filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = counts.toPandas()
    if not len(found):
        return None
    langs = sorted(found["lang"].unique())
    table = np.zeros((len(langs), BUCKETS))
    table[np.searchsorted(langs, found["lang"].to_numpy(str)), found["gram"].to_numpy()] = found["n"]
    return Model(langs, table)


def _predict(model: Model | None):
    def run(batches):
        for batch in batches:
            letters = batch.column("_letter").to_numpy(zero_copy_only=False)
            lang, score = np.full(len(batch), "und", object), np.zeros(len(batch))
            unsure = np.zeros(len(batch), bool)
            for row, data, offsets in pieces(batch.column("_text")):
                known = np.flatnonzero(letters[row : row + len(offsets) - 1])
                if model is None or not len(known):
                    continue
                filled = np.flatnonzero(np.diff(offsets) > 0)
                best, chance, lead = model.predict(data, np.append(offsets[:-1][filled], offsets[-1]))
                use = letters[row + filled]
                at = row + filled[use]
                lang[at] = np.array(model.langs, object)[best[use]]
                score[at], unsure[at] = chance[use], lead[use] < AMBIGUOUS
            out = batch.drop_columns(["_text", "_letter"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(unsure)],
                names=[*out.schema.names, "lang_pred", "score", "ambiguous"])

    return run


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """Each row as one column ``row``, with lang_pred, score (0 to 1) and ambiguous, predicted from ``text`` alone."""
    every = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    taken = docs.select(every, F.coalesce(docs["text"], F.lit("")).alias("_text"), has_letter(docs["text"]).alias("_letter"))
    result = T.StructType([taken.schema["row"]]).add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    return taken.mapInArrow(_predict(model), result)


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """The kept columns, as they are, with lang_pred, score and ambiguous; a kept column of one of these names gives way to the prediction."""
    new = ["lang_pred", "score", "ambiguous"]
    kept = [F.col(f"row.`{name}`").alias(name) for name in keep if name.lower() not in new]
    return with_language(docs, model).select(*kept, *new)


def fold(folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous; learned from the rows of the folds 1, 2, ..., not from fold 0."""
    model = train(docs.filter(fold(folds) != 0))
    rows = docs.select("doc_id", F.coalesce(fold(folds) == 0, F.lit(False)).alias("held_out"), "text")
    return predict(rows, model, "doc_id", "held_out")
