"""What the operators share: row keys, column bytes as arrays, words, hashes, repeated runs.

Rows. ``keyed`` gives every row a key of two longs: its ``doc_id`` (null: the smallest
long) and a hash of its text. Rows repeated as a whole share a key and count as documents
with equal texts; rows with one ``doc_id`` but other texts have other keys. Other columns
of the input are not looked at, whatever their names.

Memory. Python tasks work on pieces of an Arrow batch of about ``PIECE`` bytes of text;
a longer document is a piece by itself and needs some 60 bytes of arrays a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 19
NO_ID = -(1 << 63)
KEY = ["_id", "_th"]

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES_LOW = _BYTES.copy()
_BYTES_LOW[65:91] = _BYTES[97:123]  # A-Z hash as a-z

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, the row's key and its text (null: empty), and nothing else of the input."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64(text).alias("_th"),
        text.alias("text"),
    )


def packed(docs: DataFrame) -> DataFrame:
    """The row's key, and the input's row as one column ``row``: no name of the input meets another one."""
    every = F.struct(*[docs[f"`{name}`"] for name in docs.columns])
    row_id, text = docs["doc_id"].cast("long"), docs["text"]
    return docs.select(F.coalesce(row_id, F.lit(NO_ID)).alias("_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("_th"), every.alias("row"))


def unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return rows.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])


def beside(docs: DataFrame, column: str) -> Column:
    """All columns but ``column`` (or null without others) as one column ``row``, out of the way of names an operator needs."""
    others = [docs[f"`{name}`"] for name in docs.columns if name.lower() != column]
    return (F.struct(*others) if others else F.lit(None)).alias("row")


def put_back(docs: DataFrame, column: str) -> list[Column]:
    """The columns of ``docs`` in their order, from ``row`` and the changed ``column``."""
    return [F.col(column).alias(name) if name.lower() == column else F.col(f"row.`{name}`").alias(name) for name in docs.columns]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column without nulls, and the offsets of its rows."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), offsets


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of rows with ``limit`` bytes at most, or of one row."""
    data, offsets = column_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


# -- hashes of spans ------------------------------------------------------------
class _Powers:
    """Powers of the base and of its inverse, as many as were asked for."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, min(2 * len(self.up), 1 << 24))
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value, in place."""
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial in the values, from which the hash of any span follows."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(len(values))[0], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal contents hash alike wherever they stand."""
    down = _powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * down[starts])


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTES[data]


def words(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not blank), and the number of words before each row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~blank[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    filled = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[filled] = solid[filled]
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[ends] = solid[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, stops, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    return span_hashes(prefix_sums((_BYTES_LOW if lower else _BYTES)[data]), starts, ends)


# -- runs of windows by their anchor ----------------------------------------------
def window_runs(sums: np.ndarray, offsets: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """Windows of ``width`` units, gathered in runs of consecutive windows with one anchor.

    The anchor of a window is the one of its k-unit spans with the smallest hash (the
    first of them): it depends on nothing but the window's content, so equal windows have
    equal anchors at the same place. Every window is in exactly one run. Returns row,
    first window, number of windows, place of the anchor and its hash, for each run.
    """
    n = len(sums) - 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none, np.zeros(0, np.uint64)
    at = np.arange(n - k + 1)
    hashes = span_hashes(sums, at, at + k)
    bits = np.uint64(int(n).bit_length())
    keys = (hashes >> bits << bits) | at.astype(np.uint64)
    span = width - k + 1
    padded = np.full(-(-len(keys) // span) * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, span)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    place = (np.minimum(after[:count], before[span - 1 : span - 1 + count]) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, offsets[:-1], np.maximum(offsets[1:] - width + 1, offsets[:-1])])
    starts = np.unique(cuts[cuts < count])
    sizes = np.diff(np.append(starts, count))
    rows = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + width <= offsets[np.minimum(rows + 1, len(offsets) - 1)]
    starts, sizes, rows = starts[inside], sizes[inside], rows[inside]
    return rows, starts, sizes, place[starts], hashes[place[starts]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def merge_spans(spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of half-open spans (an n x 2 array); touching spans are one."""
    if not len(spans):
        none = np.zeros(0, np.int64)
        return none, none
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    at = np.flatnonzero(new)
    return spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]
