"""Suffix-array dedup: remove bytes covered by a ``width``-byte string that starts twice or more.

Plan. (1) Every window of ``width`` bytes belongs to the run of its anchor (common.window_runs);
equal windows share the anchor. (2) Only runs whose anchor occurs twice can hold a repeat; the
others leave by a semi join. (3) Runs with the same bytes are combined to one weighted segment
before any text is shuffled. (4) Segments are dealt into blocks of about ``BLOCK`` bytes by
anchor; in a block the suffixes that start a window are sorted in two stages and neighbours are
compared. Runs of neighbours that agree on ``width`` bytes and weigh two or more are repeats.
(5) An anchor with more than ``CLASS`` distinct segments is dealt over several blocks; its blocks
also emit the hashes of their distinct windows, ``CHUNK`` neighbours to a row. Equal windows are
in rows with equal cores (the bytes that all windows of such a row share), so rows whose core
occurs once leave, and the windows of the others are summed across blocks.
So no block grows with the data, and nothing is dropped.

Edge cases: null and empty texts have 0 bytes and keep the hash of nothing; texts shorter than
``width`` keep all; rows repeated as a whole are repeats of each other; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import (
    KEY, byte_values, column_bytes, keyed, merge_spans, pieces, prefix_sums, signed, window_runs,
)
from lumbung.sources.staging import stage

BLOCK = 1 << 19
CLASS = 500
CHUNK = 16


# -- local suffix sorting ---------------------------------------------------------
def suffix_order(data: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes, right on the first ``depth`` bytes.

    Stage one sorts the suffixes that are smaller than their successors. Stage two scans the
    buckets of first bytes in order; every suffix found there puts the one before it, when that
    is the greater of the two, at the end of what its own bucket has received so far.
    """
    data += b"\x00\xff"  # a last smaller suffix, so that every descending run ends
    text = np.frombuffer(data, np.uint8)
    n = len(text) - 1
    step = text[1:].astype(np.int16) - text[:-1]
    ahead = np.where(step != 0, np.arange(n), n)
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]
    small = step[ahead] > 0
    until = np.where(small, np.arange(n), n)
    until = np.minimum.accumulate(until[::-1])[::-1]
    # A greater suffix follows from the one after it, and so on to the next smaller one.
    at = np.flatnonzero(wanted)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, until[at] + 1, -1)
    needed = np.cumsum(edges)[:n] > 0

    seeds = np.flatnonzero(needed & small)
    keys = [data[i : i + depth] for i in seeds.tolist()]
    seeds = seeds[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    firsts = text[seeds]
    bounds = np.searchsorted(firsts, np.arange(257))
    induced = needed & ~small
    received: list[list[np.ndarray]] = [[] for _ in range(256)]
    order = []

    def place(found: np.ndarray, c: int) -> np.ndarray:
        """Append to the order, induce into greater buckets; what is induced into this one is returned."""
        order.append(found)
        before = found[found > 0] - 1
        before = before[induced[before]]
        bytes_ = text[before]
        same = before[bytes_ == c]
        above = bytes_ > c
        before, bytes_ = before[above], bytes_[above]
        if len(before):
            by = np.argsort(bytes_, kind="stable")
            before, bytes_ = before[by], bytes_[by]
            cuts = np.flatnonzero(bytes_[1:] != bytes_[:-1]) + 1
            for group, b in zip(np.split(before, cuts), bytes_[np.append(0, cuts)].tolist(), strict=True):
                received[b].append(group)
        return same

    for c in np.unique(text[:n][needed]).tolist():
        found = np.concatenate(received[c]) if received[c] else seeds[:0]
        received[c] = []
        while len(found):
            found = place(found, c)
        place(seeds[bounds[c] : bounds[c + 1]], c)
    found = np.concatenate(order) if order else seeds
    return found[wanted[np.minimum(found, len(wanted) - 1)] & (found < len(wanted))]


def common_prefixes(data: bytes, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one before it, ``depth`` at most."""
    lengths = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return lengths
    padded = data + bytes(depth + 8)
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    alive = np.arange(1, len(order))
    for done in range(0, depth, 8):
        differ = eights[order[alive] + done] ^ eights[order[alive - 1] + done]
        lowest = differ & (~differ + np.uint64(1))
        same = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // 8)
        lengths[alive] += same
        alive = alive[differ == 0]
        if not len(alive):
            break
    return np.minimum(lengths, depth)


def repeated_windows(segments: list[bytes], counts: np.ndarray, weights: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Window positions in suffix order with their segment, offset, group of equal windows and the group's weight."""
    lengths = np.array([len(s) for s in segments])
    starts = np.cumsum(lengths) - lengths
    data = b"".join(segments)
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + counts, -1)
    order = suffix_order(data, np.cumsum(edges)[:-1] > 0, width)
    group = np.cumsum(common_prefixes(data, order, width) < width) - 1
    segment = np.searchsorted(starts, order, "right") - 1
    total = np.bincount(group, weights[segment]).astype(np.int64)
    return order, segment, order - starts[segment], group, total[group]


# -- the distributed operator ----------------------------------------------------
def _anchors(width: int, k: int):
    def run(batches):
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy() for c in KEY)
            for row, data, offsets in pieces(batch.column("text")):
                rows, starts, sizes, places, anchors = window_runs(prefix_sums(byte_values(data)), offsets, width, k)
                view = memoryview(data)
                ends = (starts + sizes - 1 + width).tolist()
                contents = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[row + rows]), pa.array(hashes[row + rows]),
                    pa.array((starts - offsets[rows]).astype(np.int64)), pa.array(sizes.astype(np.int32)),
                    pa.array((places - starts).astype(np.int32)), pa.array(signed(anchors)), pa.array(signed(np.array(contents, np.uint64))),
                ], names=[*KEY, "a", "m", "p", "h", "seg"])

    return run


def _cut(width: int):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            parts = batch.column("parts")
            for i in range(len(batch)):
                text, rows = texts[i].as_py(), parts[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in rows], kind) for c, kind in (
                        ("block", pa.int64()), ("h", pa.int64()), ("seg", pa.int64()), ("m", pa.int32()), ("p", pa.int32()),
                        ("n", pa.int64()), ("split", pa.bool_()))]
                    + [pa.array([text[r["a"] : r["a"] + r["m"] - 1 + width] for r in rows], pa.binary())],
                    names=["block", "h", "seg", "m", "p", "n", "split", "bytes"])

    return run


MARKS = "h long, seg long, m int, lo int, hi int, core binary, los array<int>, windows array<long>, weights array<long>"


def _sort_block(width: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        segments, counts = pdf["bytes"].tolist(), pdf["m"].to_numpy()
        _, segment, offset, group, total = repeated_windows(segments, counts, pdf["n"].to_numpy(), width)
        keys = ["h", "seg", "m"]
        # ranges of repeated windows in each segment
        hit = total >= 2
        s, o = segment[hit], offset[hit]
        by = np.lexsort((o, s))
        s, o = s[by], o[by]
        at, last = _runs((s[1:] != s[:-1]) | (o[1:] != o[:-1] + 1), len(s))
        found = pdf.iloc[s[at]][keys].assign(lo=o[at], hi=o[last] + 1, core=None, los=None, windows=None, weights=None)
        # one window of each group of a class that is spread over blocks, in rows of neighbours
        one = pdf["split"].to_numpy()[segment] & np.append(True, group[1:] != group[:-1])
        s, o, w = segment[one], offset[one], total[one]
        chunk = (pdf["p"].to_numpy()[s] - o) // CHUNK
        by = np.lexsort((o, chunk, s))
        s, o, w, chunk = s[by], o[by], w[by], chunk[by]
        at, last = _runs((s[1:] != s[:-1]) | (chunk[1:] != chunk[:-1]), len(s))
        hashes = [xxhash.xxh3_64_intdigest(segments[a][b : b + width]) for a, b in zip(s.tolist(), o.tolist(), strict=True)]
        hashes = signed(np.array(hashes, np.uint64))
        cores = []
        for i in at.tolist():
            latest = int(pdf["p"].iat[s[i]] - chunk[i] * CHUNK)  # the last place where a window of this row can start
            cores.append(xxhash.xxh3_128_digest(segments[s[i]][latest : max(latest, latest - CHUNK + 1 + width)]))
        cut = lambda x: [x[i : j + 1] for i, j in zip(at.tolist(), last.tolist(), strict=True)]
        across = pdf.iloc[s[at]][keys].assign(lo=-1, hi=-1, core=cores, los=cut(o), windows=cut(hashes), weights=cut(w))
        return pd.concat([x for x in (found, across) if len(x)] or [found])

    return run


def _runs(new: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run, where ``new`` tells if an element but the first begins one."""
    at = np.append(0, np.flatnonzero(new) + 1) if n else np.zeros(0, np.int64)
    return at, np.append(at[1:], n)[: len(at)] - 1


def repeated_spans(docs: DataFrame, width: int = 400, anchor: int = 128, block: int = BLOCK, class_limit: int = CLASS) -> DataFrame:
    """_id, _th, s, e: byte spans of ``keyed`` rows, each the union of repeated windows of one run."""
    anchors = stage(docs.mapInArrow(_anchors(width, anchor), "_id long, _th long, a long, m int, p int, h long, seg long"), "anchors")
    # Staged, so that the join below is of two plain exchanges and Spark can split a hot anchor.
    repeated = stage(anchors.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"), "repeated")
    cand = stage(anchors.join(repeated, "h", "left_semi"), "repeated-anchors")
    segs = cand.groupBy("h", "seg", "m", "p").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "a")).alias("place"))
    segs = stage(segs, "segments")
    total = segs.agg(F.sum(F.col("m") + width - 1)).first()[0] or 0
    blocks = max(1, -(-total // block))
    classes = stage(segs.groupBy("h").agg(F.count("*").alias("c")).filter(F.col("c") > class_limit), "hot-anchors")
    salts = F.ceil(F.col("c") / class_limit)
    salt = F.when(F.col("c").isNotNull(), F.pmod(F.xxhash64("seg"), salts)).otherwise(0)
    dealt = segs.join(classes, "h", "left").select(
        "place.*", F.pmod(F.xxhash64("h", salt), F.lit(blocks)).alias("block"),
        "h", "seg", "m", "p", "n", F.col("c").isNotNull().alias("split"),
    )
    parts = dealt.groupBy(*KEY).agg(F.collect_list(F.struct("block", "h", "seg", "m", "p", "n", "split", "a")).alias("parts"))
    # Of rows repeated as a whole one is enough: they share the key.
    texts = docs.select(*KEY, "text").join(parts, KEY).select("text", "parts")
    cut = texts.mapInArrow(_cut(width), "block long, h long, seg long, m int, p int, n long, split boolean, bytes binary")
    marks = stage(cut.groupBy("block").applyInPandas(_sort_block(width), MARKS), "repeats")
    across = marks.filter("core IS NOT NULL").select("h", "seg", "m", "core", "los", "windows", "weights")
    shared = across.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1").select("core")
    windows = across.join(shared, "core", "left_semi").select("h", "seg", "m", "core", F.inline(F.arrays_zip("los", "windows", "weights")))
    again = windows.groupBy("core", "windows").agg(F.sum("weights").alias("t")).filter("t > 1").select("core", "windows")
    late = windows.filter("weights = 1").join(again, ["core", "windows"], "left_semi")
    late = late.select("h", "seg", "m", F.col("los").alias("lo"), (F.col("los") + 1).alias("hi"))
    marks = marks.filter("core IS NULL").select("h", "seg", "m", "lo", "hi").unionByName(late)
    return cand.join(marks, ["h", "seg", "m"]).select(
        *KEY, (F.col("a") + F.col("lo")).alias("s"), (F.col("a") + F.col("hi") - 1 + width).alias("e"))


def _remove(batches):
    for batch in batches:
        data, offsets = column_bytes(batch.column("text"))
        spans = batch.column("spans")
        out = []
        for i in range(len(batch)):
            text = memoryview(data[offsets[i] : offsets[i + 1]])
            given = spans[i].values
            pairs = np.column_stack([given.field("s").to_numpy(), given.field("e").to_numpy()]) if given is not None else np.zeros((0, 2), np.int64)
            starts, ends = merge_spans(pairs)
            digest, done, kept = hashlib.sha256(), 0, []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                kept.append(text[done:s])
                done = e
            kept.append(text[done:])
            for part in kept:
                digest.update(part)
            out.append((len(text), int((ends - starts).sum()), len(starts), digest.hexdigest(), b"".join(kept)))
        n, removed, count, sha, kept = zip(*out, strict=True) if out else ([], [], [], [], [])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
            pa.array(sha, pa.string()), pa.array(kept, pa.binary()),
        ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup(docs: DataFrame, width: int = 400, anchor: int = 128, block: int = BLOCK, class_limit: int = CLASS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes, which may cut characters)."""
    rows = keyed(docs)
    spans = repeated_spans(rows, width, anchor, block, class_limit)
    by_row = spans.groupBy(*KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = rows.join(by_row, KEY, "left").select("doc_id", "text", F.coalesce("spans", F.array().cast("array<struct<s:long,e:long>>")).alias("spans"))
    return joined.mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
