"""Facts joined to their dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.fixed_values import UNKNOWN

VIEW_COLUMNS = [
    "fact_id", "tanggal", "bulan", "tahun", "nama_lengkap", "segmen_nasabah", "jenis_kelamin",
    "nama_channel", "kota", "provinsi", "nama_merchant", "kategori_merchant",
    "nominal_transaksi", "biaya_admin",
]

# Level columns must not be null: what a missing attribute becomes.
LEVEL_DEFAULTS = {
    "tahun": 0, "quarter": UNKNOWN, "bulan": UNKNOWN, "hari": UNKNOWN, "tanggal": "1900-01-01",
    "segmen_nasabah": UNKNOWN, "jenis_kelamin": UNKNOWN, "nama_lengkap": UNKNOWN,
    "jenis_channel": UNKNOWN, "nama_channel": UNKNOWN,
    "region": UNKNOWN, "provinsi": UNKNOWN, "kota": UNKNOWN,
    "kategori": UNKNOWN, "nama_merchant": UNKNOWN,
}


# Dimension -> its id and its levels, in the order they are joined.
LEVELS_OF = {
    "dim_waktu": ("waktu_id", ["tanggal", "hari", "bulan", "tahun", "quarter"]),
    "dim_channel": ("channel_id", ["nama_channel", "jenis_channel"]),
    "dim_wilayah": ("wilayah_id", ["kota", "provinsi", "region"]),
    "dim_merchant": ("merchant_id", ["nama_merchant", "kategori"]),
    "dim_nasabah": ("nasabah_id", ["nama_lengkap", "jenis_kelamin", "segmen_nasabah"]),
}
# Dimensions that may be too large to broadcast: the facts of their Unknown member are spread.
SPREAD = ("dim_merchant", "dim_nasabah")
SALTS = 4096


def _joined(fact: DataFrame, dims: dict[str, DataFrame], levels: list[str]) -> DataFrame:
    """One left equi join per dimension that has one of the levels; Spark picks broadcast by size."""
    rows = fact
    for name, (key, own) in LEVELS_OF.items():
        wanted = [level for level in own if level in levels]
        if not wanted:
            continue
        if name not in SPREAD:
            rows = rows.join(dims[name].select(key, *wanted), key, "left")
            continue
        # Unknown facts all carry id 0. They join on many keys that match nothing, and take
        # the Unknown member's attributes from a subquery of one row.
        salt = F.pmod(F.xxhash64(*fact.columns), F.lit(SALTS))
        members = dims[name].filter(F.col(key) != 0).select(F.col(key).alias("_member"), *wanted)
        unknown = dims[name].filter(F.col(key) == 0).agg(F.max(F.struct(*wanted))).scalar()
        spread = F.when(F.col(key) == 0, -1 - salt).otherwise(F.col(key))
        rows = rows.withColumn("_member", spread).join(members, "_member", "left").drop("_member").withColumn("_unknown", unknown)
        rows = rows.withColumns({
            level: F.when(F.col(key) == 0, F.col("_unknown")[level]).otherwise(F.col(level)) for level in wanted
        }).drop("_unknown")
    return rows


def wide_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The 14-column reporting view, one row per fact."""
    rows = _joined(fact, dims, ["kategori", *VIEW_COLUMNS])
    return rows.withColumnRenamed("kategori", "kategori_merchant").select(*VIEW_COLUMNS)


def _level(name: str) -> Column:
    default = F.lit(LEVEL_DEFAULTS[name])
    return F.coalesce(F.col(name), default.cast("date") if name == "tanggal" else default).alias(name)


def cube_rows(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """All level columns (never null) and the additive measures, one row per fact."""
    return _joined(fact, dims, list(LEVEL_DEFAULTS)).select(
        *[_level(name) for name in LEVEL_DEFAULTS], "nominal_transaksi", "biaya_admin"
    )


def level_rows(fact: DataFrame, dims: dict[str, DataFrame], levels: list[str]) -> DataFrame:
    """The named level columns (never null), the measures and ``n_trx``, for queries that name no other level.

    Facts are summed by the ids of the dimensions that have these levels before they are joined to
    them, so no other dimension is read and each member is joined once, not once per fact.
    """
    ids = [key for key, own in LEVELS_OF.values() if set(own) & set(levels)]
    summed = fact.groupBy(*ids).agg(
        F.sum("nominal_transaksi").alias("nominal_transaksi"),
        F.sum("biaya_admin").alias("biaya_admin"),
        F.count("*").alias("n_trx"),
    )
    return _joined(summed, dims, levels).select(*[_level(name) for name in levels], "nominal_transaksi", "biaya_admin", "n_trx")
