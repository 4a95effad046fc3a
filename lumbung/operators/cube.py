"""Hierarchies, measures, roll-ups, pivots and the pre-aggregated cuboid.

All measures are additive, so the queries accept either one row per fact or the
cells of a cuboid: cells carry ``n_trx``, the number of facts behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.fixed_values import UNKNOWN, WEEKDAYS
from lumbung.operators.filters import unknown_bits

HIERARCHIES = {
    "Waktu": ["tahun", "quarter", "bulan", "tanggal"],
    "Hari Transaksi": ["hari"],
    "Nasabah": ["segmen_nasabah", "jenis_kelamin", "nama_lengkap"],
    "Channel": ["jenis_channel", "nama_channel"],
    "Nama Channel": ["nama_channel"],
    "Wilayah": ["region", "provinsi", "kota"],
    "Merchant": ["kategori", "nama_merchant"],
}
LEVELS = list(dict.fromkeys(level for levels in HIERARCHIES.values() for level in levels))

VOLUME, FEE, COUNT, AVERAGE = (
    "total_volume_transaksi", "total_biaya_admin", "jumlah_transaksi", "rata_rata_nominal",
)
# Members of a fine level that a cuboid leaves out are kept apart only as
# Unknown or not, which is all the default filter asks of them.
OTHERS = "*"


def n_facts(df: DataFrame, when: Column | None = None) -> Column:
    """Number of facts, over rows or cells; with ``when``, of those where it holds."""
    if "n_trx" in df.columns:
        counted = F.col("n_trx") if when is None else F.when(when, F.col("n_trx"))
        return F.coalesce(F.sum(counted), F.lit(0)).cast("bigint")
    return F.count("*") if when is None else F.count_if(when)


def total(column: str, when: Column | None = None) -> Column:
    return F.sum(F.col(column) if when is None else F.when(when, F.col(column)))


_MEASURES = {
    VOLUME: "CAST(SUM(nominal_transaksi) AS DOUBLE)",
    FEE: "CAST(SUM(biaya_admin) AS DOUBLE)",
    COUNT: "{n}",
    AVERAGE: "TRY_DIVIDE(CAST(SUM(nominal_transaksi) AS DOUBLE), {n})",
}


def measures_of(df: DataFrame, names: list[str]) -> list[Column]:
    """The named measures as aggregates over rows or cells."""
    n = "COALESCE(SUM(n_trx), 0)" if "n_trx" in df.columns else "COUNT(*)"
    return [F.expr(f"{_MEASURES[name].format(n=n)} AS {name}") for name in names]


def by_level(df: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    """Roll-up to any levels. Members are grouped by leaf, so the same leaf under two parents is one row."""
    return df.groupBy(*levels).agg(*measures_of(df, measures))


def drill_down(df: DataFrame, level: str, measures: list[str]) -> DataFrame:
    """The same roll-up one level finer than ``level`` in its hierarchy."""
    for levels in HIERARCHIES.values():
        if level in levels[:-1]:
            finer = levels[: levels.index(level) + 2]
            return by_level(df, finer, measures)
    raise ValueError(f"{level} has no finer level")


def summed(df: DataFrame, levels: list[str]) -> DataFrame:
    """Cells of the levels: what is multiplied by grouping sets afterwards is one row per cell, not per fact."""
    return df.groupBy(*levels).agg(
        total("nominal_transaksi").alias("nominal_transaksi"), total("biaya_admin").alias("biaya_admin"), n_facts(df).alias("n_trx")
    )


def stored_cells(df: DataFrame, levels: list[str]) -> DataFrame:
    """``summed``, in the types cells are stored in, however often they were added up."""
    amounts = {c: F.col(c).cast("decimal(28,2)") for c in ("nominal_transaksi", "biaya_admin")}
    return summed(df, levels).withColumns({**amounts, "n_trx": F.col("n_trx").cast("bigint")})


def hierarchy_totals(df: DataFrame, hierarchy: str, measures: list[str]) -> DataFrame:
    """Every level's subtotals of a hierarchy; ``depth`` counts the levels that are set (0 = grand total)."""
    levels = HIERARCHIES[hierarchy]
    df = summed(df, levels)
    rolled = df.rollup(*levels).agg(F.grouping_id().alias("_gid"), *measures_of(df, measures))
    depth = F.lit(len(levels)) - F.bit_count(F.col("_gid"))
    return rolled.select(*levels, depth.cast("int").alias("depth"), *measures)


def cross_totals(df: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    """Totals for all combinations of the levels (CUBE); ``gid`` tells which are rolled up."""
    df = summed(df, levels)
    return df.cube(*levels).agg(
        F.grouping_id().cast("bigint").alias("gid"), *measures_of(df, measures)
    )


def pivot_count(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of ``row`` x ``column``, one column per value, 0 where there is none."""
    cells = by_level(df, [row, column], [COUNT])
    return cells.groupBy(row).pivot(column, values).agg(F.sum(COUNT)).na.fill(0)


def weekday_grid(df: DataFrame) -> DataFrame:
    """Counts of month x weekday, dense: every month present with all seven days."""
    n = "n_trx" if "n_trx" in df.columns else "1"
    per_day = [F.expr(f"CAST(SUM(IF(hari = '{day}', {n}, 0)) AS BIGINT) AS {day}") for day in WEEKDAYS]
    cells = ", ".join(f"'{day}', {day}" for day in WEEKDAYS)
    return df.groupBy("bulan").agg(*per_day).selectExpr("bulan", f"stack(7, {cells}) AS (hari, {COUNT})")


def collapse(df: DataFrame, level: str) -> DataFrame:
    """Tell a fine level's Unknown members from the others, and nothing else."""
    return df.withColumn(level, F.when(F.col(level) == UNKNOWN, UNKNOWN).otherwise(OTHERS))


def cuboid(df: DataFrame, finest: tuple[str, ...] = ()) -> DataFrame:
    """Facts summed up to day x segment x gender x channel x city x category.

    ``finest`` adds the levels ``nama_lengkap`` or ``nama_merchant``; left out,
    they are collapsed. Answers every query that names no level left out, from
    far fewer rows. ``unknown_in`` saves the default filter from reading the
    levels a query does not ask for.
    """
    for level in ("nama_lengkap", "nama_merchant"):
        if level not in finest:
            df = collapse(df, level)
    return summed(df.withColumn("unknown_in", unknown_bits()), [*LEVELS, "unknown_in"])
