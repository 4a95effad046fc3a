"""Substring dedup: remove words covered by a window of ``width`` words that starts twice or more.

Plan. (1) Windows are gathered in runs by their anchor (common.window_runs), so that the sketch
counts one item for a run instead of one for every window; equal windows have equal anchors, so
the count of an anchor is never below that of a window. (2) Count-min prefilter: each row of the
sketch is a table of cells; partial sums per partition are the partition's sketch, and the
shuffle merges them. A run stays if the estimate (the smallest of its cells) is two or more. The
second row is filled from what the first row kept, which can only make it sharper: what leaves
has been counted once. The sketch lives in a table and is joined, so it may grow with the data.
(3) The second pass groups what is left exactly: whole runs by their content first; then, for
anchors with several contents, single windows by a 128-bit hash of their words. Windows travel
``CHUNK`` neighbours to a row, and a row whose core (the words all its windows share) occurs once
leaves before it is taken apart.

Edge cases: null and empty texts have no words and the hash of nothing; texts shorter than
``width`` keep all; rows repeated as a whole are repeats of each other; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import KEY, keyed, merge_spans, pieces, prefix_sums, signed, window_runs, word_hashes, words
from lumbung.sources.staging import stage

CHUNK = 7
ROWS = 2


def _runs(width: int, k: int):
    def run(batches):
        for batch in batches:
            ids, hashes = (batch.column(c).to_numpy() for c in KEY)
            for row, data, offsets in pieces(batch.column("text")):
                begin, end, counts = words(data, offsets)
                values = word_hashes(data, begin, end)
                rows, starts, sizes, places, anchors = window_runs(prefix_sums(values), counts, width, k)
                view = memoryview(values).cast("B")
                stops = (starts + sizes - 1 + width).tolist()
                contents = [xxhash.xxh3_64_intdigest(view[8 * a : 8 * b]) for a, b in zip(starts.tolist(), stops, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[row + rows]), pa.array(hashes[row + rows]),
                    pa.array((starts - counts[rows]).astype(np.int64)), pa.array(sizes.astype(np.int32)),
                    pa.array((places - starts).astype(np.int32)),
                    pa.array(signed(anchors)), pa.array(signed(np.array(contents, np.uint64))),
                ], names=[*KEY, "a", "m", "p", "h", "seg"])

    return run


def estimated_repeated(runs: DataFrame, item: str, rows: int = ROWS) -> DataFrame:
    """Rows of a staged table whose ``item`` a count-min sketch estimates to occur twice or more."""
    cells = max(1 << 16, 4 * runs.count())
    for nth in range(rows):
        cell = F.pmod(F.xxhash64(F.lit(nth), item), F.lit(cells))
        sketch = runs.groupBy(cell.alias("cell")).agg(F.count("*").alias("c"))
        full = stage(sketch.filter("c > 1").select("cell"), "sketch")
        runs = runs.withColumn("cell", cell).join(full, "cell", "left_semi").drop("cell")
        if nth + 1 < rows:
            runs = stage(runs, "estimated")
    return runs


def _windows(width: int):
    def run(batches):
        for batch in batches:
            parts = batch.column("parts").to_pylist()
            for row, data, offsets in pieces(batch.column("text")):
                begin, end, counts = words(data, offsets)
                view = memoryview(word_hashes(data, begin, end)).cast("B")
                out = []
                for i in range(len(offsets) - 1):
                    for r in parts[row + i]:
                        first, place = int(counts[i]) + r["a"], r["p"]
                        for chunk in range((place - r["m"] + 1) // CHUNK, place // CHUNK + 1):
                            los = range(max(0, place - CHUNK * chunk - CHUNK + 1), min(r["m"], place - CHUNK * chunk + 1))
                            core = first + place - CHUNK * chunk
                            key = xxhash.xxh3_128_digest(view[8 * core : 8 * max(core, core - CHUNK + 1 + width)])
                            windows = [xxhash.xxh3_128_digest(view[8 * (first + o) : 8 * (first + o + width)]) for o in los]
                            out.append((r["h"], r["seg"], r["m"], r["n"], key, list(los), windows))
                cols = zip(*out, strict=True) if out else [[]] * 7
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                    names=["h", "seg", "m", "n", "core", "los", "windows"])

    return run


def repeated_spans(docs: DataFrame, width: int = 35, anchor: int = 8) -> DataFrame:
    """_id, _th, s, e: spans of word numbers of ``keyed`` rows, each the union of repeated windows of one run."""
    runs = stage(docs.mapInArrow(_runs(width, anchor), "_id long, _th long, a long, m int, p int, h long, seg long"), "runs")
    cand = stage(estimated_repeated(runs, "h"), "candidates")
    segs = stage(cand.groupBy("h", "seg", "m", "p").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "a")).alias("place")), "segments")
    several = stage(segs.groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h"), "several")
    parts = segs.join(several, "h", "left_semi").groupBy("place._id", "place._th").agg(
        F.collect_list(F.struct("h", "seg", "m", "p", "n", "place.a")).alias("parts"))
    texts = docs.select(*KEY, "text").join(parts, KEY).select("text", "parts")
    schema = "h long, seg long, m int, n long, core binary, los array<int>, windows array<binary>"
    across = stage(texts.mapInArrow(_windows(width), schema), "windows")
    shared = stage(across.groupBy("core").agg(F.count("*").alias("c")).filter("c > 1").select("core"), "cores")
    windows = across.join(shared, "core", "left_semi").select("h", "seg", "m", "n", F.inline(F.arrays_zip("los", "windows")))
    again = windows.groupBy("windows").agg(F.sum("n").alias("t")).filter("t > 1").select("windows")
    late = windows.filter("n = 1").join(again, "windows", "left_semi")
    late = late.select("h", "seg", "m", F.col("los").alias("lo"), (F.col("los") + 1).alias("hi"))
    whole = segs.filter("n > 1").select("h", "seg", "m", F.lit(0).alias("lo"), F.col("m").alias("hi"))
    marks = stage(whole.unionByName(late), "repeats")
    return cand.join(marks, ["h", "seg", "m"]).select(
        *KEY, (F.col("a") + F.col("lo")).alias("s"), (F.col("a") + F.col("hi") - 1 + width).alias("e"))


def _remove(batches):
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        spans = batch.column("spans")
        out = []
        for i in range(len(batch)):
            found = texts[i].as_py().split()  # on the six ASCII blanks
            given = spans[i].values
            pairs = np.column_stack([given.field("s").to_numpy(), given.field("e").to_numpy()]) if given is not None else np.zeros((0, 2), np.int64)
            starts, ends = merge_spans(pairs)
            n = len(found)
            for s, e in zip(starts[::-1].tolist(), ends[::-1].tolist(), strict=True):
                del found[s:e]
            kept = b" ".join(found)
            out.append((n, n - len(found), hashlib.sha256(kept).hexdigest(), kept))
        n, removed, sha, kept = zip(*out, strict=True) if out else ([], [], [], [])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
            pa.array(sha, pa.string()), pa.array(kept, pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def dedup(docs: DataFrame, width: int = 35, anchor: int = 8) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the remaining words joined by one space)."""
    rows = keyed(docs)
    by_row = repeated_spans(rows, width, anchor).groupBy(*KEY).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    none = F.array().cast("array<struct<s:long,e:long>>")
    joined = rows.join(by_row, KEY, "left").select("doc_id", "text", F.coalesce("spans", none).alias("spans"))
    return joined.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
