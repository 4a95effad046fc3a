"""Cross-tokenizer alignment: which tokens of a byte-level and of a piece vocabulary cover the same bytes.

Plan. (1) One pass encodes every text with both tokenizers in pieces of ``PIECE`` characters. Byte
offsets where tokens of both end cut a piece into groups, which never cross documents. A piece is one
row: its token ids (compressed), its distinct id pairs that share a group, and the number of its
documents that hold each. (2) The distinct pairs of all pieces fall into shards of ``KEYS`` pairs; a
task builds the minimal perfect hash of a shard: levels of bits, in which each pair owns one bit that
no other pair hits, and the bit's rank is the pair's slot. The pairs themselves are kept in slot
order, so that every look-up is verified. (3) Counts: rows of a shard are dealt to as many tasks as
make a task's rows some ``DENSE`` times its slots; each adds its rows up in a dense vector indexed by
the hash, and the vectors are summed in a tree of fan-in ``FAN``. (4) The sums go back the same way:
tasks of a shard look up the pairs of their pieces. (5) Every piece meets its pairs' counts, its
documents are aligned again from the kept ids, and links are summed up. A group's links are formed
from its distinct ids with their multiplicities, ``LINKS`` at a time, never all at once.

Memory is bounded by a piece (or the longest document), a shard, or the vocabulary: the largest count
of each A id, one number for each of at most 65,536 ids, is all that reaches the driver.

Edge cases: null and empty texts, and texts that either tokenizer does not give back byte by byte
(a text that holds U+2581), have no tokens: zeros and ''. Special tokens' strings are plain text.
Texts of any length are encoded whole, long runs of blanks by a slower library with equal results.
Repeated rows and equal texts count as documents of their own; ties for the highest count all count;
null doc_ids stay null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import mix
from lumbung.sources.staging import stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PIECE = 1 << 21  # characters
LINKS = 1 << 22  # distinct links formed at a time
KEYS = 1 << 19  # pairs of a shard, about
DENSE = 4
FAN = 16
SPARE = 2  # bits a pair and level of the hash
LONG_BLANKS = re.compile(r"\s{5000}")
MARK = "▁"
IDS = 1 << 16
# The pattern that cuts texts before the merges of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter of each byte in a byte-level vocabulary: itself, or the next one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers: ids of texts, bytes and lengths of ids."""

    def __init__(self, vocabulary: bytes, model: bytes) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        letters = byte_letters()
        listed = json.loads(vocabulary)
        special = {t["content"] for t in listed.get("added_tokens", ())}
        # Ids follow the order of the merges, so they serve as ranks.
        ranks = {bytes(letters[c] for c in t): i for t, i in listed["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = Tokenizer.from_str(vocabulary.decode())
        self.slow.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        size = self.pieces.get_piece_size()
        names = [self.pieces.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(t[3:-1], 16)]) if self.pieces.is_byte(i) else t.replace(MARK, " ").encode() for i, t in enumerate(names)]
        if max(len(self.a_bytes), size) > IDS:
            raise ValueError("ids take more than 16 bits")
        self.a_lengths, self.b_lengths = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text; none if either does not give back the text."""
        found = []
        for text, b in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            marked = " " + text
            if len(text) > 5000 and LONG_BLANKS.search(text):
                a = self.slow.encode(marked, add_special_tokens=False).ids
            else:
                a = self.fast.encode_ordinary(marked)
            whole = marked.encode()
            right = b"".join([self.b_bytes[i] for i in b]) == whole and b"".join([self.a_bytes[i] for i in a]) == whole
            found.append((a, b) if right and text else ([], []))
        return found


@lru_cache(maxsize=1)
def loaded(vocabulary: bytes, model: bytes) -> Pair:
    return Pair(vocabulary, model)


# -- groups and links of a piece ------------------------------------------------------
class Aligned:
    """Groups of a piece: its documents' tokens one after the other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, a_lengths: np.ndarray, b_lengths: np.ndarray) -> None:
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        a_ends, b_ends = np.cumsum(a_lengths[a]), np.cumsum(b_lengths[b])
        a_cut, b_cut = np.isin(a_ends, b_ends, assume_unique=True), np.isin(b_ends, a_ends, assume_unique=True)
        self.a_group, self.b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        total = int(a_cut.sum())
        self.sizes_a, self.sizes_b = np.bincount(self.a_group, minlength=total), np.bincount(self.b_group, minlength=total)
        cuts = np.append(0, np.cumsum(a_cut))
        self.n_groups = np.diff(cuts[np.append(0, np.cumsum(n_a))])
        self.doc = np.repeat(np.arange(len(n_a)), self.n_groups)  # of each group

    def links(self):
        """(document, pair, times) of each group's distinct id pairs, some at a time."""
        x, times_x = np.unique(self.a_group << 16 | self.a, return_counts=True)
        y, times_y = np.unique(self.b_group << 16 | self.b, return_counts=True)
        starts = np.searchsorted(y >> 16, np.arange(len(self.sizes_a) + 1))
        group = x >> 16
        partners = (starts[1:] - starts[:-1])[group]
        reach = np.cumsum(partners)
        at = 0
        while at < len(x):
            end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + LINKS, "right")))
            n = partners[at:end]
            left = np.repeat(np.arange(at, end), n)
            right = starts[group[left]] + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            yield self.doc[group[left]], (x[left] & 0xFFFF) << 16 | y[right] & 0xFFFF, times_x[left] * times_y[right]
            at = end

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs and the number of documents that hold each."""
        held = [np.unique(doc << 32 | pair) for doc, pair, _ in self.links()]
        held = np.unique(np.concatenate(held)) if held else np.zeros(0, np.int64)
        return np.unique(held & 0xFFFFFFFF, return_counts=True)

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups, written out."""
        # Every A token stands behind the B tokens of earlier groups, every B token behind the A tokens of its own.
        before_b, upto_a = np.cumsum(self.sizes_b) - self.sizes_b, np.cumsum(self.sizes_a)
        first_a, first_b = (np.append(True, g[1:] != g[:-1])[: len(g)] for g in (self.a_group, self.b_group))
        words = np.empty(len(self.a) + len(self.b), np.int64)
        words[np.arange(len(self.a)) + before_b[self.a_group]] = self.a + IDS * first_a
        words[np.arange(len(self.b)) + upto_a[self.b_group]] = self.b + IDS * (2 + first_b)
        out, at, table = [], 0, _written()
        for n in (self.n_a + self.n_b).tolist():
            out.append(hashlib.sha256("".join([table[w] for w in words[at : at + n].tolist()])[1:].encode()).hexdigest() if n else "")
            at += n
        return out


@lru_cache(maxsize=1)
def _written() -> list[str]:
    return [f"{mark}{i}" for mark in ",;,|" for i in range(IDS)]


def _batches_of_texts(batch: pa.RecordBatch):
    docs, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
    at, held = 0, 0
    for end, text in enumerate(texts, 1):
        held += len(text or "")
        if held >= PIECE or end == len(texts):
            yield docs[at:end], texts[at:end]
            at, held = end, 0


def _encoded(vocabulary: bytes, model: bytes):
    def run(batches):
        import zstandard

        both, packer = loaded(vocabulary, model), zstandard.ZstdCompressor(level=3)
        # A partition is a task; rows it is given are the same when it is run again, and so are its pieces.
        piece = TaskContext.get().partitionId() << 32
        for batch in batches:
            for docs, texts in _batches_of_texts(batch):
                ids = both.encode([t or "" for t in texts])
                n_a, n_b = (np.array([len(x[side]) for x in ids]) for side in (0, 1))
                a, b = (np.array([i for x in ids for i in x[side]], np.int64) for side in (0, 1))
                pairs, held = Aligned(a, b, n_a, n_b, both.a_lengths, both.b_lengths).pairs()
                packed = [packer.compress(x.astype(kind).tobytes()) for x, kind in ((a, np.uint16), (b, np.uint16), (n_a, np.int64), (n_b, np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(
                    (piece, docs, *packed, pairs.tobytes(), held.tobytes(), len(pairs)),
                    (pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 6, pa.int64()), strict=True)],
                    names=["piece", "docs", "a", "b", "n_a", "n_b", "pairs", "held", "n"])
                piece += 1

    return run


ENCODED = "piece long, docs array<long>, a binary, b binary, n_a binary, n_b binary, pairs binary, held binary, n long"


# -- minimal perfect hash ---------------------------------------------------------------
def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seeded = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level + 1)
    return (mix(seeded) % np.uint64(size)).astype(np.int64)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return _places(keys, -1, shards)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.ranks = np.cumsum(bits) - bits
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            size = SPARE * len(keys) + 64
            at = _places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; of one that the hash was not built for any slot or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = self.starts[level] + _places(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.ranks[at[hit]]
            left = left[~hit]
        return out


class Shard:
    """A shard's hash with its keys in slot order."""

    def __init__(self, sizes: bytes, bits: bytes, keys: bytes) -> None:
        sizes = np.frombuffer(sizes, np.int64)
        self.hash = PerfectHash(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool))
        self.keys = np.frombuffer(keys, np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        slots = self.hash.slots(keys)
        if not (len(keys) == 0 or ((slots >= 0).all() and (self.keys[slots] == keys).all())):
            raise ValueError("a pair is not in its shard")
        return slots


def _hashed(pdf: pd.DataFrame) -> pd.DataFrame:
    keys = pdf["pair"].to_numpy()
    found = PerfectHash.build(keys)
    ordered = np.empty(len(keys), np.int64)
    ordered[found.slots(keys)] = keys
    return pd.DataFrame({"shard": [int(pdf["shard"].iat[0])], "sizes": [found.sizes.tobytes()], "bits": [np.packbits(found.bits).tobytes()], "keys": [ordered.tobytes()]})


HASHED = "shard long, sizes binary, bits binary, keys binary"


# -- counts -------------------------------------------------------------------------------
def _listed(batches):
    for batch in batches:
        for x in batch.column("pairs").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, np.int64))], names=["pair"])


def _dealt(shards: int, salts: int):
    """A piece's pairs and numbers of documents, in one row for each shard."""

    def run(batches):
        for batch in batches:
            for piece, pairs, held in zip(*(batch.column(c).to_pylist() for c in ("piece", "pairs", "held")), strict=True):
                pairs, held = np.frombuffer(pairs, np.int64), np.frombuffer(held, np.int64)
                shard = shard_of(pairs, shards)
                by = np.argsort(shard, kind="stable")
                ends = np.searchsorted(shard[by], np.arange(shards + 1))
                full = np.flatnonzero(np.diff(ends))
                parts = [by[ends[s] : ends[s + 1]] for s in full.tolist()]
                salt = int(mix(np.array([piece], np.uint64))[0] % np.uint64(salts))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full.astype(np.int64)), pa.array(np.full(len(full), salt)), pa.array(np.full(len(full), piece)),
                    pa.array([pairs[p].tobytes() for p in parts], pa.binary()), pa.array([held[p].tobytes() for p in parts], pa.binary())],
                    names=["shard", "salt", "piece", "pairs", "held"])

    return run


def _dense(rows: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
    if rows.empty or hashes.empty:
        return pd.DataFrame({"shard": [], "salt": [], "counts": []})
    shard = Shard(*hashes[["sizes", "bits", "keys"]].iloc[0])
    counts = np.zeros(len(shard.keys), np.int64)
    for pairs, held in zip(rows["pairs"], rows["held"], strict=True):
        counts[shard.slots(np.frombuffer(pairs, np.int64))] += np.frombuffer(held, np.int64)  # a row's pairs are distinct
    return pd.DataFrame({"shard": rows["shard"].iloc[:1], "salt": rows["salt"].iloc[:1], "counts": [counts.tobytes()]})


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(pdf["counts"].iat[0]) // 8, np.int64)
    for counts in pdf["counts"]:
        total += np.frombuffer(counts, np.int64)
    return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "salt": pdf["to"].iloc[:1], "counts": [total.tobytes()]})


def _highest(batches):
    """Largest count of each A id within a shard."""
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            best = np.zeros(IDS, np.int64)
            np.maximum.at(best, np.frombuffer(keys, np.int64) >> 16, np.frombuffer(counts, np.int64))
            ids = np.flatnonzero(best)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best[ids])], names=["id", "best"])


def _found(rows: pd.DataFrame, hashes: pd.DataFrame) -> pd.DataFrame:
    """Counts of the pairs of each piece's row, in the row's order."""
    if rows.empty or hashes.empty:
        return pd.DataFrame({"piece": [], "pairs": [], "counts": []})
    shard = Shard(*hashes[["sizes", "bits", "keys"]].iloc[0])
    sums = np.frombuffer(hashes["counts"].iat[0], np.int64)
    counts = [sums[shard.slots(np.frombuffer(p, np.int64))].tobytes() for p in rows["pairs"]]
    return pd.DataFrame({"piece": rows["piece"], "pairs": rows["pairs"], "counts": counts})


def _measured(a_lengths: np.ndarray, b_lengths: np.ndarray, best: np.ndarray):
    def run(pieces: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        import zstandard

        out, unpacker = [], zstandard.ZstdDecompressor()
        for docs, *packed in pieces[["docs", "a", "b", "n_a", "n_b"]].itertuples(index=False):
            a, b, n_a, n_b = (np.frombuffer(unpacker.decompress(x), kind).astype(np.int64) for x, kind in zip(packed, (np.uint16, np.uint16, np.int64, np.int64), strict=True))
            pairs, counts = (np.frombuffer(b"".join(found[c]), np.int64) for c in ("pairs", "counts"))
            by = np.argsort(pairs)
            pairs, counts = pairs[by], counts[by]
            aligned = Aligned(a, b, n_a, n_b, a_lengths, b_lengths)
            sums = {c: np.zeros(len(n_a), np.int64) for c in ("n_links", "n_best", "count_sum")}
            for doc, pair, times in aligned.links():
                count = counts[np.searchsorted(pairs, pair)]
                highest = count == best[pair >> 16]
                np.add.at(sums["n_links"], doc, times)
                np.add.at(sums["n_best"], doc[highest], times[highest])
                np.add.at(sums["count_sum"], doc, times * count)
            out.append(pd.DataFrame({"doc_id": pd.array(list(docs), "Int64"), "n_a": n_a, "n_b": n_b, "n_groups": aligned.n_groups, **sums, "groups_sha256": aligned.digests()}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


MEASURED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def pair_counts(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shard, sizes, bits, keys, counts) of all shards, and the pieces' pairs dealt to (shard, salt)."""
    rows, shards, salts = pieces.agg(F.sum("n")).first()[0] or 0, 1, 1
    keys = stage(pieces.select("pairs").mapInArrow(_listed, "pair long").distinct(), "id-pairs")
    if rows:
        distinct = keys.count()
        shards, salts = -(-distinct // KEYS), max(1, -(-rows // (DENSE * distinct)))

    def sharded(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(batch.column(0).to_numpy(), shards)), batch.column(0)], names=["shard", "pair"])

    hashes = stage(keys.mapInArrow(sharded, "shard long, pair long").groupBy("shard").applyInPandas(_hashed, HASHED), "hashes")
    dealt = stage(pieces.select("piece", "pairs", "held").mapInArrow(_dealt(shards, salts), "shard long, salt long, piece long, pairs binary, held binary"), "dealt-pairs")
    sums = stage(dealt.groupBy("shard", "salt").cogroup(_for_salts(hashes, salts)).applyInPandas(_dense, "shard long, salt long, counts binary"), "counts")
    while salts > 1:
        salts = -(-salts // FAN)
        up = sums.withColumn("to", F.floor(F.col("salt") / FAN)).groupBy("shard", "to").applyInPandas(_summed, "shard long, salt long, counts binary")
        sums = stage(up, "counts")
    return stage(hashes.join(sums.select("shard", "counts").hint("merge"), "shard"), "counted"), dealt


def _for_salts(hashes: DataFrame, salts: int):
    return hashes.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).groupBy("shard", "salt")


def align(docs: DataFrame, vocabulary: str = VOCABULARY, model: str = MODEL) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    # Files of the installation, read on the driver and sent with the tasks.
    vocabulary, model = (Path(path).read_bytes() for path in (vocabulary, model))
    both = loaded(vocabulary, model)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stage(texts.mapInArrow(_encoded(vocabulary, model), ENCODED), "pieces")
    counted, dealt = pair_counts(pieces)
    best = np.zeros(IDS, np.int64)
    for row in counted.select("keys", "counts").mapInArrow(_highest, "id long, best long").groupBy("id").agg(F.max("best")).collect():
        best[row[0]] = row[1]
    salts = 1 + (dealt.agg(F.max("salt")).first()[0] or 0)
    found = dealt.select("shard", "salt", "piece", "pairs").groupBy("shard", "salt").cogroup(_for_salts(counted, salts)).applyInPandas(_found, "piece long, pairs binary, counts binary")
    own = pieces.select("piece", "docs", "a", "b", "n_a", "n_b")
    return own.groupBy("piece").cogroup(found.groupBy("piece")).applyInPandas(_measured(both.a_lengths, both.b_lengths, best), MEASURED)
