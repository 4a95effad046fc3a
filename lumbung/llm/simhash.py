"""SimHash near-dedup by covering locality-sensitive hashing.

Plan. (1) One pass over the texts makes each document's 64-bit fingerprint: a bit is 1 if it is set
in over half the XXH64 (seed 42) of the 4-word shingles. Equal fingerprints are one node from here
on. (2) Covering: every bit position gets a non-zero vector of ``radius + 1`` bits, and table v keeps
the positions whose vector has an odd product with v. At most ``radius`` vectors leave a non-zero v
that is orthogonal to all of them, so two fingerprints that differ in ``radius`` bits at most agree
on all positions of some table: no pair is missed. The vectors are dealt evenly, so each of the 31
tables for radius 4 keeps 32 or 33 of the 64 bits. (3) Buckets of ``NODES`` fingerprints at most are
searched in a task each, which puts out one link from the smallest member to each other member that
is connected with it inside the bucket: linear rows, whatever the pairs. (4) A larger bucket is dealt
again by the positions its members need not agree on yet, with masks that cover those: a pair within
the radius meets again in a smaller bucket. About half of the open positions are fixed each time and
one at least, so no bucket stays large and none is cut or skipped. (5) The links are closed to
components.

Edge cases: null, empty and blank texts have fingerprint zero and are linked like any other; fewer
than four words are one shingle; a text of any length is hashed whole; a tie of a bit (set in just
half) gives 0; repeated rows share their component; null doc_ids do not name components (a component
with null ids only is named null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.llm.graph import components
from lumbung.sources.staging import stage

SEED = 42
NODES = 4096  # fingerprints of a bucket that one task compares; 16 at least
SHARD = 200_000  # rows of a Python call, about
SLICE = 1 << 16  # hashes whose bits are counted at a time


def hashes_of(text: bytes, k: int) -> np.ndarray:
    """XXH64 of the text's shingles of k words, in order, repeats included."""
    words = text.lower().split()  # bytes: only A-Z change, only the six ASCII blanks cut
    if not words:
        return np.zeros(0, np.uint64)
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - k + 1)
    spans = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The 64 majorities of the hashes' bits; none: zero."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        some = hashes[at : at + SLICE].astype(">u8", copy=False)
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def _fingerprints(k: int):
    def run(batches):
        for batch in batches:
            marks = [fingerprint(hashes_of(t, k)) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(marks, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return run


@lru_cache(maxsize=4096)
def masks(fixed: int, radius: int) -> np.ndarray:
    """Masks that cover the positions outside ``fixed``, ``fixed`` included in each of them."""
    basis = 1 << np.arange(radius + 1)  # first, so that every mask fixes a bit as long as more than ``radius`` are open
    vectors = np.append(basis, np.random.default_rng(13).permutation(np.setdiff1d(np.arange(1, 1 << radius + 1), basis)))
    open_ = [i for i in range(64) if not fixed >> i & 1]
    own = vectors[np.arange(len(open_)) % len(vectors)]
    out = []
    for v in range(1, 1 << radius + 1):
        odd = np.bitwise_count(own & v) & 1
        out.append(fixed | sum(1 << i for i, keep in zip(open_, odd, strict=True) if keep))
    return np.unique(np.array(out, np.uint64))


def _deal(radius: int):
    """(mask, fp) rows to one row for each finer mask: (mask, key, fp)."""

    def run(batches):
        for batch in batches:
            fixed, fps = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("mask", "fp"))
            for mask in np.unique(fixed):
                rows, finer = fps[fixed == mask], masks(int(mask), radius)
                columns = [np.repeat(finer, len(rows)), (finer[:, None] & rows).ravel(), np.tile(rows, len(finer))]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["mask", "key", "fp"])

    return run


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, other): each fingerprint but the first of a connected part, with that first one."""
    left = np.sort(fps)
    firsts, others = [], []
    while len(left):
        root, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            near = np.bitwise_count(left ^ front[0]) <= radius
            found, left = left[near], left[~near]
            firsts.append(np.full(len(found), root))
            others.append(found)
            front = np.concatenate([front[1:], found])
    return np.concatenate(firsts or [fps[:0]]), np.concatenate(others or [fps[:0]])


def _linked(radius: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy().view(np.uint64)
        pairs = [spanning_links(fps[rows], radius) for rows in pdf.groupby(["mask", "key"], sort=False).indices.values()]
        u, v = (np.concatenate(side).view(np.int64) for side in zip(*pairs, strict=True))
        return pd.DataFrame({"u": u, "v": v})

    return run


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """(u, v) of fingerprints (column ``fp``, distinct): links that connect all that are connected by pairs within the radius."""
    found = None
    open_ = nodes.select(F.lit(0).cast("long").alias("mask"), "fp")
    while True:
        buckets = open_.mapInArrow(_deal(radius), "mask long, key long, fp long")
        sizes = buckets.groupBy("mask", "key").agg(F.count("*").alias("c")).filter("c > 1")
        sizes = stage(sizes, "bucket-sizes")
        total = sizes.filter(F.col("c") <= NODES).agg(F.sum("c")).first()[0] or 0
        members = buckets.join(sizes.filter(F.col("c") <= NODES), ["mask", "key"])
        shard = F.pmod(F.xxhash64("mask", "key"), F.lit(max(1, total // SHARD)))
        some = stage(members.select("mask", "key", "fp", shard.alias("shard")).groupBy("shard").applyInPandas(_linked(radius), "u long, v long").distinct(), "bucket-links")
        found = some if found is None else found.unionByName(some)
        large = sizes.filter(F.col("c") > NODES)
        if not large.limit(1).count():
            return found
        # n open positions leave 2^n fingerprints at most, and every round has fewer of them open.
        open_ = stage(buckets.join(large, ["mask", "key"], "left_semi").select("mask", "fp"), "large-buckets")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, k: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint, component_id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marked = stage(texts.mapInArrow(_fingerprints(k), "doc_id long, fp long"), "fingerprints")
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    labels = components(stage(links(nodes, radius).distinct(), "links"))
    named = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "least")
    named = stage(named, "named")
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_node = stage(named.join(names, "label").select("fp", "component_id"), "components")
    return marked.join(by_node, "fp").select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
