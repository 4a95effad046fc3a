"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and windows that tell quotation from abuse.

Learning uses ``SAMPLE`` training documents of each label (those with the smallest hashes of their
doc_id): from one half of them the lexicon, terms (words, and stems: first letters of words) that
are significantly more frequent in toxic documents; on the other half a logistic regression on a
document's hits: in direct speech, misspelled, quoted, the strongest one and their density. Its
intercept is moved to the label shares of all training rows.

A word that is no entry is matched with an automaton that accepts an entry's neighbours at distance
one, run along the lexicon's trie; only words that share an entry's first or last half get that far,
which every neighbour does. A hit is quoted when quotation marks stand on both sides of it within
``WINDOW`` words or a word of reporting stands right before it.

Edge cases: null and blank texts have no hits and the intercept's score; without training rows of
both labels every score is the share of toxic ones (0.0 without labels); null labels are not learned
from, null doc_ids are neither held out nor learned from; repeated rows score alike; an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.language import fold

SAMPLE = 3000
TERMS = 400
SIGNIFICANT = 6.0
STEMS = range(4, 9)
WINDOW = 6
KNOWN = 400_000
PUNCTUATION = "\"'“”«»‘’`.,;:!?()[]{}<>*#%&$|-_~/\\=+"
QUOTES = frozenset("\"“”«»„")
# Words that introduce a quotation (fixed values).
REPORTING = frozenset("said says quoted called wrote writes word term sagte dit dijo".split())


# -- matching ---------------------------------------------------------------------
class Lexicon:
    """Entries with weights; ``match`` finds the entry a word is, starts with, or misspells."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems
        self.sizes = sorted({len(s) for s in stems}, reverse=True)
        self.trie: dict = {}
        self.starts, self.ends = set(), set()
        for word in words:
            if len(word) >= 5:
                node = self.trie
                for c in word:
                    node = node.setdefault(c, {})
                node[""] = word
                half = len(word) // 2
                self.starts.add(word[:half])
                self.ends.add(word[half:])
        self.halves = sorted({len(x) for x in self.starts}), sorted({len(x) for x in self.ends})

    def near(self, word: str) -> str | None:
        """The smallest entry at distance one: the automaton's state is the row of edit distances to ``word``."""
        found = []

        def step(node: dict, row: list[int]) -> None:
            if "" in node and row[-1] <= 1:
                found.append(node[""])
            for c, below in node.items():
                if c:
                    now = [row[0] + 1]
                    for i, x in enumerate(word):
                        now.append(min(now[i] + 1, row[i + 1] + 1, row[i] + (x != c)))
                    if min(now) <= 1:
                        step(below, now)

        step(self.trie, list(range(len(word) + 1)))
        return min(found, default=None)

    def match(self, token: str) -> tuple[str, float, bool] | None:
        """(entry, weight, misspelled) of a lower-case token."""
        word = token.strip(PUNCTUATION)
        if word in self.words:
            return word, self.words[word], False
        for n in self.sizes:
            if word[:n] in self.stems and len(word) >= n:
                return word[:n], self.stems[word[:n]], False
        if any(word[:n] in self.starts for n in self.halves[0]) or any(word[len(word) - n :] in self.ends for n in self.halves[1] if n <= len(word)):
            entry = self.near(word)
            if entry:
                return entry, self.words[entry], True
        return None


def quoted(tokens: list[str], i: int) -> bool:
    before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
    own = tokens[i]
    opened = any(not QUOTES.isdisjoint(t) for t in before) or own[0] in QUOTES
    closed = any(not QUOTES.isdisjoint(t) for t in after) or not QUOTES.isdisjoint(own[1:])
    return opened and closed or any(t.strip(PUNCTUATION) in REPORTING for t in before[-2:])


FEATURES = 6


class Matcher:
    """Hits of texts, with the tokens seen so far remembered in a bounded dictionary."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon, self.plain, self.hot = lexicon, set(), {}

    def features(self, text: str) -> list[float]:
        tokens = text.lower().split()
        if len(self.plain) > KNOWN:
            self.plain.clear()
        new = set(tokens)
        new -= self.plain
        for token in new:
            if token not in self.hot:
                hit = self.lexicon.match(token)
                if hit is None:
                    self.plain.add(token)
                else:
                    self.hot[token] = hit
        if len(self.hot) > KNOWN:
            self.hot = {t: h for t, h in self.hot.items() if t in new}
        if self.hot.keys().isdisjoint(new):
            return [0.0] * FEATURES
        direct, wrong, cited, entries = 0, 0, 0, {}
        for i, token in enumerate(tokens):
            hit = self.hot.get(token)
            if hit:
                entry, weight, misspelled = hit
                if quoted(tokens, i):
                    cited += 1
                    weight *= 0.25
                elif misspelled:
                    wrong += 1
                    weight *= 0.8
                else:
                    direct += 1
                entries[entry] = max(entries.get(entry, 0), weight)
        hits = direct + wrong
        return [np.log1p(direct), np.log1p(wrong), np.log1p(cited), max(entries.values()), min(20.0, sum(entries.values())),
                min(1.0, 20 * hits / len(tokens))]


# -- learning ---------------------------------------------------------------------
def _terms(batches):
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = {t.strip(PUNCTUATION) for t in set(text.lower().split())}
            terms = {w for w in words if 3 < len(w) <= 40}
            terms |= {w[:n] + "*" for w in words for n in STEMS if n < len(w)}
            out[0].extend(terms)
            out[1].extend([toxic] * len(terms))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32())], names=["term", "toxic"])


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Terms of (text, toxic) whose share in toxic documents is significantly higher."""
    sizes = sample.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    if not sizes.t or not sizes.c:
        return Lexicon({}, {})
    found = sample.mapInArrow(_terms, "term string, toxic int").groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    both = (F.col("t") + F.col("c")) / F.lit(sizes.t + sizes.c)
    z = (F.col("t") / sizes.t - F.col("c") / sizes.c) / F.sqrt(both * (1 - both + 1e-9) * (1 / sizes.t + 1 / sizes.c))
    best = found.filter("t >= 5").withColumn("z", z).filter(F.col("z") >= SIGNIFICANT)
    best = best.orderBy(F.desc("z"), F.desc(F.length("term")), "term").limit(20 * TERMS).collect()
    words, stems = {}, {}
    for r in best:
        weight = float(np.log((r.t + 0.5) / (sizes.t + 1)) - np.log((r.c + 0.5) / (sizes.c + 1)))
        stem = r.term.rstrip("*")
        if stem == r.term:
            if len(words) < TERMS:
                words[stem] = weight
        # Of stems that start alike the most significant one stands for all.
        elif len(stems) < TERMS and not any(stem.startswith(s) or s.startswith(stem) for s in stems):
            stems[stem] = weight
    return Lexicon(words, stems)


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray) -> None:
        self.lexicon, self.weights = lexicon, weights

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + features @ self.weights[1:], -30, 30)))


def fit(features: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights of a ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    keep = np.diag([1e-6, *[ridge] * features.shape[1]])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (labels - p) - keep @ w)
        w += step
        if abs(step).max() < 1e-6:
            break
    return w


def _features(lexicon: Lexicon, keep: int):
    def run(batches):
        matcher = Matcher(lexicon)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                rows = [matcher.features(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:keep], pa.array(rows, pa.list_(pa.float64()))], names=[*part.schema.names[:keep], "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the training rows: ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).first()
    ranked = known.withColumn("place", F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")))
    ranked = ranked.filter(F.col("place") <= sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * sample rows are broadcast.
    rows = texts.join(F.broadcast(ranked), "doc_id").withColumn("part", F.col("place") % 2)
    lexicon = learn_lexicon(rows.filter("part = 0"))
    prior = np.log((share.t + 0.5) / (share.c + 0.5)) if share.t + share.c else -30.0
    table = rows.filter("part = 1").select("toxic", "text").mapInArrow(_features(lexicon, 1), "toxic int, x array<double>").toPandas()
    y = table["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(lexicon, np.append(prior, np.zeros(FEATURES)))
    weights = fit(np.array(table["x"].tolist()), y)
    weights[0] += prior - np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    return Model(lexicon, weights)


def _score(model: Model):
    def run(batches):
        for batch in _features(model.lexicon, 2)(batches):
            x = batch.column("x").values.to_numpy().reshape(-1, FEATURES)
            score = model.score(x)
            hits = np.rint(np.expm1(x[:, :3])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(score), pa.array((score >= 0.7).astype(np.int32)), *(pa.array(h) for h in hits.T)],
                names=["doc_id", "held_out", "score", "predicted", "n_direct", "n_misspelled", "n_quoted"])

    return run


def scores(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7), n_direct, n_misspelled, n_quoted."""
    outside = fold(folds) != held
    model = train(docs.filter(outside), labels.filter(outside), sample)
    rows = docs.select("doc_id", F.coalesce(~outside, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int, n_direct long, n_misspelled long, n_quoted long")
