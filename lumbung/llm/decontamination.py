"""Benchmark decontamination by latent semantic retrieval, then subsequence and answer checks.

Words are runs of letters and digits, lower-cased in ASCII; rows of the TF-IDF matrix are half-passages
of ``HALF`` words. Items are taken in blocks of ``ITEMS``, each a query set that is held against all
passages. For a block: (1) one pass counts in how many half-passages of the whole corpus each of the
block's words occurs. A word's weight is the root of its inverse frequency, which is at least ``FLOOR``
of the median one: an item that stands in much of the corpus keeps a length of its own. (2) A
randomised SVD of the TF-IDF matrix: every task multiplies its rows with a random matrix of
``RANK + 8`` columns and back (A'A R); Spark sums the results by word; the items are rows too, with
four times the corpus's energy, so that the leading vectors span them. The left singular vectors of
the sum, words x ``RANK``, are what is broadcast: bounded by the block's vocabulary. (3) Passages, as many
neighbouring half-passages as hold the item wherever it starts, are projected. Candidates are the pairs
whose latent cosine, times the ratio of the passage's length to the item's, is ``COVER`` or more: the share of the item
that the passage covers, which other words of the passage do not lower. (4) Candidates near which too few of the
item's words stand for any subsequence go (``Bound``); the others are compared word
by word: an item leaks if its longest common subsequence with the passage and its surroundings has
``SAME`` of its words, or, as a paraphrase, ``LIKE`` of them and ``SAME`` of its answer (its last
sentence); ``LIKE`` of the words that are not everywhere (in less than half of the half-passages) must be among them
either way, and of an answer only those count. The cosine reported is that of the latent vectors.

A very long text is projected as a whole: 16 bytes of vectors a word and rank over ``HALF`` words, some 10 bytes a byte.

Edge cases: null and empty texts have no passages and null or empty items match nothing; repeated
rows give one row per doc_id and item; rows with null doc_ids are reported under null; an empty
table or benchmark gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import KEY, column_bytes, keyed, packed, pieces, unpacked, word_hashes, words

HALF = 32
ITEMS = 256
RANK = 64
SAME, LIKE = 0.8, 0.6
FLOOR, COVER = 0.25, 0.25
CHUNK, MANY = 1024, 8

_APART = np.zeros(256, bool)
_APART[[b for b in range(128) if not chr(b).isalnum()]] = True


def hashes_of(texts: list[str]) -> list[np.ndarray]:
    data, offsets = column_bytes(pa.array(texts, pa.string()))
    begin, end, counts = words(data, offsets, _APART)
    found = word_hashes(data, begin, end, lower=True)
    return [found[counts[i] : counts[i + 1]] for i in range(len(texts))]


class Items:
    """A block of items: their words, answers and the vocabulary."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        self.ids, self.words = ids, hashes_of(texts)
        self.answers = hashes_of([[s for s in re.split(r"(?<=[.!?])\s+|\n", t) if re.search(r"\w", s)][-1] for t in texts])
        self.vocabulary = np.unique(np.concatenate(self.words))
        self.number = np.min_scalar_type(len(self.vocabulary))  # numbers of two bytes are sorted by counting
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.vocabulary >> np.uint64(44)] = True

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of words that are in the vocabulary, and their numbers in it."""
        at = np.flatnonzero(self.seen[found >> np.uint64(44)])
        number = np.searchsorted(self.vocabulary, found[at])
        same = self.vocabulary[np.minimum(number, len(self.vocabulary) - 1)] == found[at]
        return at[same], number[same]


class Piece:
    """Words of a run of rows, those in the vocabulary, and the half-passage each is in."""

    def __init__(self, items: Items, data: np.ndarray, offsets: np.ndarray) -> None:
        begin, end, self.counts = words(data, offsets, _APART)
        self.hashes = word_hashes(data, begin, end, lower=True)
        sizes = np.diff(self.counts)
        self.halves = -(-sizes // HALF)
        self.first = np.cumsum(self.halves) - self.halves
        self.row_of = np.repeat(np.arange(len(sizes)), self.halves)
        self.at, self.term = items.look_up(self.hashes)
        self.number = items.number
        row = np.searchsorted(self.counts, self.at, "right") - 1
        self.half = self.first[row] + (self.at - self.counts[row]) // HALF
        starts = self.counts[self.row_of] + (np.arange(len(self.row_of)) - self.first[self.row_of]) * HALF
        length = np.minimum(HALF, self.counts[self.row_of + 1] - starts)
        self.unknown = (length - np.bincount(self.half, minlength=len(length))).astype(np.float32)

    def by_term(self) -> tuple[np.ndarray, np.ndarray]:
        """Terms in ascending order and their half-passages, ascending for each term."""
        order = np.argsort(self.term.astype(self.number), kind="stable")
        return self.term[order], self.half[order]

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """``by_term`` with each half-passage once for a term."""
        term, half = self.by_term()
        new = np.append(True, (term[1:] != term[:-1]) | (half[1:] != half[:-1]))[: len(term)]
        return term[new], half[new]

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums per half-passage of a row of values for each vocabulary word."""
        out = np.zeros((len(self.row_of), *values.shape[1:]), values.dtype)
        if len(self.half):
            at = np.flatnonzero(np.append(True, self.half[1:] != self.half[:-1]))
            out[self.half[at]] = np.add.reduceat(values, at, axis=0)
        return out

    def weights(self, weight: np.ndarray, outside: float) -> np.ndarray:
        """Squared length of each half-passage, words outside the vocabulary included."""
        return self.sums(weight[self.term] ** 2) + self.unknown * np.float32(outside**2)


def _frequencies(items: Items):
    def run(batches):
        total, halves = np.zeros(len(items.vocabulary), np.int64), 0
        for batch in batches:
            for _, data, offsets in pieces(batch.column("text")):
                piece = Piece(items, data, offsets)
                halves += len(piece.row_of)
                total += np.bincount(piece.occurrences()[0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], halves))], names=["term", "n"])

    return run


def _sketch(items: Items, weight: np.ndarray, outside: float, start: np.ndarray):
    def run(batches):
        total = np.zeros((len(weight), start.shape[1]), np.float32)
        weighed = start * weight[:, None]
        energy = 0.0
        for batch in batches:
            for _, data, offsets in pieces(batch.column("text")):
                piece = Piece(items, data, offsets)
                length = np.maximum(piece.weights(weight, outside), 1e-9)
                across = piece.sums(weighed[piece.term]) / length[:, None]
                energy += float((weight[piece.term] ** 2 / length[piece.half]).sum())
                term, half = piece.by_term()
                if len(term):
                    at = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
                    total[term[at]] += np.add.reduceat(across[half], at, axis=0)
        total *= weight[:, None]
        rows = np.flatnonzero(total.any(axis=1))
        first = np.full(start.shape[1], energy, np.float64)
        table = np.vstack([first, total[rows]])
        yield pa.RecordBatch.from_arrays([pa.array(np.append(-1, rows)), *(pa.array(c.astype(np.float64)) for c in table.T)], names=["term", *(f"y{i}" for i in range(start.shape[1]))])

    return run


def subsequence(item: np.ndarray, passage: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit of a number for each word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    state = full
    for w in passage.tolist():
        mask = masks.get(w)
        if mask:
            hit = state & mask
            state = (state + hit | state - hit) & full
    return len(item) - state.bit_count()


def _by_reach(found: list[np.ndarray]) -> list[tuple[int, np.ndarray]]:
    """Items by the number of half-passages that their length reaches beyond a passage."""
    reach = np.array([-(-len(w) // HALF) for w in found])
    return [(int(r), np.flatnonzero(reach == r)) for r in np.unique(reach)]


class Bound:
    """Items of one reach, and a cheap test of candidates: can the passage and its surroundings hold the item at all?

    Counted are an item's words, as often as it has them, that stand anywhere in the half-passages around a
    passage. No subsequence is longer, so no candidate that passes the checks is left out.
    """

    def __init__(self, reach: int, those: np.ndarray, found: list[np.ndarray], vocabulary: np.ndarray) -> None:
        self.reach, self.those = reach, those
        pairs = [np.unique(np.searchsorted(vocabulary, w), return_counts=True) for w in found]
        term, times = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
        item = np.repeat(np.arange(len(found)), [len(p[0]) for p in pairs])
        self.least = np.array([LIKE * len(w) - 1e-6 for w in found], np.float32)
        degree = np.bincount(term, minlength=len(vocabulary))
        # Words of many items are multiplied as a matrix, the others are added one by one.
        many = np.flatnonzero(degree >= MANY)
        self.column = np.full(len(vocabulary), -1)
        self.column[many] = np.arange(len(many))
        self.matrix = np.zeros((len(many), len(found)), np.float32)
        wide = self.column[term] >= 0
        self.matrix[self.column[term[wide]], item[wide]] = times[wide]
        by = np.argsort(term[~wide], kind="stable")
        self.item, self.times = item[~wide][by], times[~wide][by].astype(np.float32)
        self.degree = np.where(degree < MANY, degree, 0)
        self.ptr = np.cumsum(self.degree) - self.degree
        self.used = degree > 0

    def spans(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words and the passages (first, end) that have them near; spans of one word do not overlap."""
        term, half = piece.occurrences()
        some = self.used[term]
        term, half = term[some], half[some]
        row = piece.row_of[half]
        first = np.maximum(half - 1 - self.reach, piece.first[row])
        end = np.minimum(half + self.reach + 1, piece.first[row] + piece.halves[row])
        again = np.append(False, term[1:] == term[:-1])[: len(term)]
        again[1:] &= row[1:] == row[:-1]
        first[1:] = np.where(again[1:], np.maximum(first[1:], end[:-1]), first[1:])
        full = np.flatnonzero(first < end)
        by = full[np.argsort(first[full], kind="stable")]
        return term[by], first[by], end[by]

    def possible(self, spans: tuple[np.ndarray, ...], low: int, high: int) -> np.ndarray:
        """Passages low to high x items: whether enough of the item's words are near."""
        term, first, end = spans
        longest = int((end - first).max()) if len(term) else 0
        some = slice(*np.searchsorted(first, (low - longest, high)))
        t, a, b = term[some], np.maximum(first[some], low), np.minimum(end[some], high)
        t, a, b = t[a < b], a[a < b] - low, b[a < b] - low
        size, items = high - low + 1, len(self.those)
        col = self.column[t]
        wide = col >= 0
        width = len(self.matrix)
        steps = np.bincount(a[wide] * width + col[wide], minlength=size * width) - np.bincount(b[wide] * width + col[wide], minlength=size * width)
        near = steps.reshape(size, width).astype(np.float32) @ self.matrix
        t, a, b = t[~wide], a[~wide], b[~wide]
        degree = self.degree[t]
        at = np.repeat(self.ptr[t] - np.cumsum(degree) + degree, degree) + np.arange(degree.sum())
        item, times = self.item[at], self.times[at]
        cells = np.bincount(np.repeat(a * items, degree) + item, times, minlength=size * items)
        cells -= np.bincount(np.repeat(b * items, degree) + item, times, minlength=size * items)
        near += cells.reshape(size, items)
        return np.cumsum(near, axis=0)[:-1] >= self.least


class Latent:
    """The block's items in the latent space: ``vectors`` scaled so that the product with a passage's vector is the share covered."""

    def __init__(self, items: Items, weight: np.ndarray, basis: np.ndarray) -> None:
        self.basis = basis * weight[:, None]
        numbers = [np.searchsorted(items.vocabulary, w) for w in items.words]
        self.vectors = np.array([self.basis[n].sum(axis=0) for n in numbers])
        self.lengths = np.sqrt(np.maximum((self.vectors**2).sum(axis=1), 1e-12))
        self.vectors /= self.lengths[:, None] ** 2
        self.groups = _by_reach(items.words)

    def candidates(self, piece: Piece, bounds: list[Bound]):
        """(first half-passage, item, cosine) of the pairs that reach ``COVER`` and that the word bound lets through."""
        sums = np.zeros((len(piece.row_of) + 1, self.basis.shape[1]))
        np.cumsum(piece.sums(self.basis[piece.term]), axis=0, dtype=np.float64, out=sums[1:])
        ends = (piece.first + piece.halves)[piece.row_of]
        for (reach, those), bound in zip(self.groups, bounds, strict=True):
            last = np.minimum(np.arange(len(ends)) + reach + 1, ends)
            spans = bound.spans(piece)
            for low in range(0, len(ends), CHUNK):
                some = slice(low, low + CHUNK)
                vectors = (sums[last[some]] - sums[:-1][some]).astype(np.float32)
                shares = vectors @ self.vectors[those].T
                found = shares >= COVER
                if found.any():
                    found &= bound.possible(spans, low, low + len(vectors))
                p, i = np.nonzero(found)
                lengths = np.sqrt(np.maximum((vectors[p] ** 2).sum(axis=1), 1e-12))
                cosines = np.clip(shares[p, i] * self.lengths[those[i]] / lengths, -1, 1)
                yield from zip((p + low).tolist(), those[i].tolist(), cosines.tolist(), strict=True)


def _search(items: Items, rare: np.ndarray, latent: Latent):
    """``rare``: which words of the vocabulary are not everywhere."""
    known = set(items.vocabulary[rare].tolist())

    def telling(found: np.ndarray) -> np.ndarray:
        """The words that are not everywhere; all of them if all are."""
        some = np.array([w for w in found.tolist() if w in known], np.uint64)
        return some if len(some) else found

    tellings, answers = [telling(w) for w in items.words], [telling(w) for w in items.answers]
    bounds = [Bound(r, those, [tellings[i] for i in those], items.vocabulary) for r, those in latent.groups]

    def run(batches):
        for batch in batches:
            ids = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", *KEY)), strict=True))
            out = []
            for row, data, offsets in pieces(batch.column("text")):
                piece = Piece(items, data, offsets)
                for p, i, cosine in latent.candidates(piece, bounds):
                    r = piece.row_of[p]
                    start = piece.counts[r] + (p - piece.first[r]) * HALF
                    near = len(items.words[i])
                    low, high = max(piece.counts[r], start - near), min(piece.counts[r + 1], start + 2 * HALF + near)
                    # words outside the vocabulary are in no item
                    region = items.vocabulary[piece.term[slice(*np.searchsorted(piece.at, (low, high)))]]
                    if subsequence(tellings[i], region) < LIKE * len(tellings[i]):
                        continue
                    share = subsequence(items.words[i], region) / near
                    if share >= LIKE:
                        answer = subsequence(answers[i], region) / len(answers[i])
                        if share >= SAME or answer >= SAME:
                            out.append((*ids[row + r], items.ids[i], share, answer, cosine, int(low - piece.counts[r]), int(high - piece.counts[r])))
            cols = list(zip(*out, strict=True)) or [[]] * len(NAMES)
            kinds = [*[pa.int64()] * 4, pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=NAMES)

    return run


NAMES = ["doc_id", *KEY, "item_id", "same_words", "same_answer", "cosine", "first_word", "last_word"]
LEAK = "item_id long, same_words double, same_answer double, cosine double, first_word long, last_word long"
FOUND = "doc_id long, _id long, _th long, " + LEAK


def _leaks_of(rows: DataFrame, items: Items) -> DataFrame:
    counts = rows.mapInArrow(_frequencies(items), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(counts["term"], counts["n"], strict=True))
    total = counts.get(-1, 0)
    df = np.array([counts.get(i, 0) for i in range(len(items.vocabulary))], float)
    idf = np.log((total + 1) / (df + 0.5))
    outside = float(np.median(idf))
    weight = np.sqrt(np.maximum(idf, FLOOR * outside)).astype(np.float32)
    own = np.zeros((len(items.ids), len(weight)), np.float32)
    for row, found in zip(own, items.words, strict=True):
        number = np.searchsorted(items.vocabulary, found)
        np.add.at(row, number, weight[number])
    own /= np.maximum(np.sqrt((own**2).sum(axis=1, keepdims=True)), 1e-9)
    basis = _basis(rows, items, own, weight, float(np.sqrt(outside)))
    return rows.mapInArrow(_search(items, 2 * df < total, Latent(items, weight, basis)), FOUND)


def _basis(rows: DataFrame, items: Items, own: np.ndarray, weight: np.ndarray, outside: float) -> np.ndarray:
    """Leading left singular vectors of the corpus and the items (``own``, a row each), words x ``RANK``."""
    start = np.random.default_rng(4).standard_normal((len(weight), RANK + 8)).astype(np.float32)
    sums = [F.sum(f"y{i}").alias(f"y{i}") for i in range(start.shape[1])]
    table = rows.mapInArrow(_sketch(items, weight, outside, start), "term long, " + ", ".join(f"y{i} double" for i in range(start.shape[1])))
    table = table.groupBy("term").agg(*sums).toPandas().to_numpy()
    product = np.zeros(start.shape)
    terms = table[:, 0].astype(int)
    product[terms[terms >= 0]] = table[terms >= 0, 1:]
    energy = float(table[terms < 0, 1].sum())
    product += 4 * max(1.0, energy) / len(own) * (own.T @ (own @ start))
    return np.linalg.svd(product, full_matrices=False)[0][:, :RANK].astype(np.float32)


def _found(docs: DataFrame, benchmark: DataFrame, block: int) -> DataFrame | None:
    """Leaks of every passage with doc_id and the row's key; None without items."""
    rows = keyed(docs)
    queries = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter(F.col("text").rlike(r"[\p{L}\p{N}]")).orderBy("item_id", "text")
    found, ids, texts = None, [], []

    def close() -> None:
        nonlocal found, ids, texts
        if ids:
            some = _leaks_of(rows, Items(ids, texts))
            found, ids, texts = some if found is None else found.unionByName(some), [], []

    for r in queries.toLocalIterator():  # a block of items at a time
        if r.item_id is not None and len(hashes_of([r.text])[0]):
            ids.append(r.item_id)
            texts.append(r.text)
        if len(ids) == block:
            close()
    close()
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = ITEMS) -> DataFrame:
    """doc_id, item_id, same_words, same_answer, cosine, first_word, last_word: the best passage of each document and item."""
    found = _found(docs, benchmark, block)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, " + LEAK)
    best = F.max(F.struct("same_words", "same_answer", "cosine", "first_word", "last_word")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leak, all columns; documents that share a doc_id, or have none, are judged by their own texts."""
    found = _found(docs, benchmark, ITEMS)
    if found is None:
        return docs
    return unpacked(packed(docs).join(found.select(*KEY).distinct(), KEY, "left_anti"), docs)
