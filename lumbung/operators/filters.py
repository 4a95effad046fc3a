"""The global filter of the queries: dice, date range and the Unknown rule, as one Column."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung.fixed_values import GENDER_UNKNOWN, UNKNOWN

# Filter name -> (hierarchy, level).
DICE = {
    "tahun": ("Waktu", "tahun"),
    "quarter": ("Waktu", "quarter"),
    "bulan": ("Waktu", "bulan"),
    "channel": ("Channel", "nama_channel"),
    "segmen": ("Nasabah", "segmen_nasabah"),
    "kategori": ("Merchant", "kategori"),
    "provinsi": ("Wilayah", "provinsi"),
    "kota": ("Wilayah", "kota"),
}

# Hierarchy -> (level, value that counts as unknown) hidden by default.
HIDDEN = {
    "Waktu": [("quarter", UNKNOWN), ("bulan", UNKNOWN), ("tahun", 0)],
    "Hari Transaksi": [("hari", UNKNOWN)],
    "Nasabah": [
        ("segmen_nasabah", UNKNOWN), ("jenis_kelamin", UNKNOWN),
        ("nama_lengkap", UNKNOWN), ("jenis_kelamin", GENDER_UNKNOWN),
    ],
    "Channel": [("jenis_channel", UNKNOWN), ("nama_channel", UNKNOWN)],
    "Wilayah": [("region", UNKNOWN), ("provinsi", UNKNOWN), ("kota", UNKNOWN)],
    "Merchant": [("kategori", UNKNOWN), ("nama_merchant", UNKNOWN)],
}


def every(conditions: list[Column]) -> Column:
    """The conjunction; true when there is nothing to hold."""
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def slice_on(level: str, value) -> Column:
    return F.col(level) == F.lit(value)


def dice(params: Mapping) -> Column:
    """AND over the levels named, OR over each level's values; an empty list filters nothing."""
    return every([F.col(level).isin(list(params[name])) for name, (_, level) in DICE.items() if params.get(name)])


def date_range(params: Mapping) -> Column:
    """``start_date <= tanggal <= end_date``; either side may be missing."""
    sides = []
    if params.get("start_date"):
        sides.append(F.col("tanggal") >= F.lit(str(params["start_date"])).cast("date"))
    if params.get("end_date"):
        sides.append(F.col("tanggal") <= F.lit(str(params["end_date"])).cast("date"))
    return every(sides)


def unknown_bits() -> Column:
    """One bit per hierarchy (in the order of HIDDEN) in which a row has a hidden member."""
    bits = [
        F.when(reduce(lambda a, b: a | b, [F.col(level) == F.lit(value) for level, value in hidden]), 1 << at).otherwise(0)
        for at, hidden in enumerate(HIDDEN.values())
    ]
    return reduce(lambda a, b: a + b, bits)


def hide_unknown(params: Mapping, columns: list[str] | tuple = ()) -> Column:
    """Hide Unknown members, hierarchy by hierarchy.

    A hierarchy with a dice filter keeps its Unknown members: none of its
    exclusions apply. A date range does not count as a filter of Waktu. Rows
    that carry ``unknown_in`` (unknown_bits) are judged by that column alone.
    """
    if params.get("include_unknown"):
        return F.lit(True)
    diced = {hierarchy for name, (hierarchy, _) in DICE.items() if params.get(name)}
    if "unknown_in" in columns:
        mask = sum(1 << at for at, hierarchy in enumerate(HIDDEN) if hierarchy not in diced)
        return F.col("unknown_in").bitwiseAND(F.lit(mask)) == 0
    return every([
        F.col(level) != F.lit(value)
        for hierarchy, hidden in HIDDEN.items() if hierarchy not in diced
        for level, value in hidden
    ])


def build_filter(params: Mapping, columns: list[str] | tuple = ()) -> Column:
    return dice(params) & date_range(params) & hide_unknown(params, columns)
