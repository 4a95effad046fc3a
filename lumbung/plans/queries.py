"""The named OLAP queries.

Each takes cube rows (or cuboid cells) and filter parameters, and returns a
DataFrame. Parameters: ``tahun``, ``quarter``, ``bulan``, ``channel``,
``segmen``, ``kategori``, ``provinsi``, ``kota`` (lists), ``start_date``,
``end_date`` (ISO dates) and ``include_unknown``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.fixed_values import MONTHS
from lumbung.functions import calendar as cal
from lumbung.functions import mapping as m
from lumbung.operators import presentation as pr
from lumbung.operators.cube import COUNT, VOLUME, by_level, n_facts, pivot_count, total, weekday_grid
from lumbung.operators.filters import build_filter

EVERYTHING: Mapping = {"include_unknown": True}
KPIS = [
    "total_volume_transaksi", "total_frekuensi_transaksi", "total_revenue_transaksi", "avg_nominal_transaksi",
]


def _filtered(rows: DataFrame, params: Mapping | None) -> DataFrame:
    return rows.filter(build_filter(params or {}, rows.columns))


def _in_time_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sorted after the aggregate's own tasks; Spark merges the small partitions of the result."""
    return df.orderBy(*order)


def _single_month(params: Mapping) -> tuple[int, str] | None:
    """The month chosen, when exactly one year and one month are."""
    years, months = params.get("tahun") or [], params.get("bulan") or []
    return (int(years[0]), months[0]) if len(years) == 1 and len(months) == 1 else None


# -- filter options -----------------------------------------------------------
OPTION_LEVELS = {
    "tahun": "tahun", "quarter": "quarter", "bulan": "bulan", "channel": "nama_channel",
    "segmen": "segmen_nasabah", "kategori": "kategori", "provinsi": "provinsi", "kota": "kota",
}


def filter_options(rows: DataFrame) -> DataFrame:
    """Members present per filter, in list order, and the date bounds: (filter, urutan, nilai).

    One scan: the combinations that occur are found first, and grouping sets
    aggregate the eight levels of those side by side.
    """
    levels = list(OPTION_LEVELS.values())
    sets = [[F.col(level)] for level in levels]
    present = rows.groupBy(*levels).agg(F.min("tanggal").alias("_first"), F.max("tanggal").alias("_last"))
    found = present.groupingSets([*sets, []], *levels).agg(
        F.grouping_id().alias("_gid"), F.min("_first").alias("_first"), F.max("_last").alias("_last")
    )
    # grouping_id has a 0 bit for the one level that is set, counted from the left.
    width, everything = len(levels), (1 << len(levels)) - 1
    entries = F.when(F.col("_gid") == everything, F.array(
        _option("min_date", cal.day_label(F.col("_first"))), _option("max_date", cal.day_label(F.col("_last")))
    ))
    for at, (name, level) in enumerate(OPTION_LEVELS.items()):
        only = F.col("_gid") == F.lit(everything - (1 << (width - 1 - at)))
        order = F.lpad(cal.month_index(F.col(level)).cast("string"), 2, "0") if level == "bulan" else None
        entries = entries.when(only, F.array(_option(name, F.col(level).cast("string"), order)))
    options = found.select(F.inline(entries)).filter((F.col("filter") != "bulan") | F.col("nilai").isin(MONTHS))
    place = F.row_number().over(Window.partitionBy("filter").orderBy("_order")).cast("bigint")
    return options.select("filter", place.alias("urutan"), "nilai")


def _option(name: str, value: Column, order: Column | None = None) -> Column:
    return F.struct(F.lit(name).alias("filter"), value.alias("nilai"), (value if order is None else order).alias("_order"))


# -- headline figures ---------------------------------------------------------
def _kpis(rows: DataFrame, when: Column | None, prefix: str = "") -> list[Column]:
    volume = F.coalesce(total("nominal_transaksi", when).cast("double"), F.lit(0.0))
    fee = F.coalesce(total("biaya_admin", when).cast("double"), F.lit(0.0))
    count = n_facts(rows, when)
    average = F.coalesce(F.try_divide(volume, count), F.lit(0.0))
    return [c.alias(prefix + name) for name, c in zip(KPIS, [volume, count, fee, average])]


def kpi(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    """One row: volume, count, fee, average, zeros for an empty selection.

    With exactly one year and one month chosen, ``trend_*`` gives the change
    against the month before in percent; both months are read in one pass.
    """
    params = params or {}
    chosen = _single_month(params)
    if chosen is None:
        now = rows.filter(build_filter(params, rows.columns)).agg(*_kpis(rows, None))
        return now.select("*", *[F.lit(None).cast("double").alias(f"trend_{name}") for name in KPIS])
    year, month = cal.previous_month(*chosen)
    this, last = (build_filter(p, rows.columns) for p in (params, {**params, "tahun": [year], "bulan": [month]}))
    both = rows.filter(this | last).agg(*_kpis(rows, this), *_kpis(rows, last, "_prev_"))
    return both.select(*KPIS, *[
        pr.percent_change(F.col(name).cast("double"), F.col(f"_prev_{name}").cast("double")).alias(f"trend_{name}")
        for name in KPIS
    ])


def monthly_trend(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Volume and count per month in time order, or per day when one year and one month are chosen."""
    params = params or {}
    chosen = _filtered(rows, params)
    if _single_month(params):
        days = _in_time_order(by_level(chosen, ["tanggal"], [VOLUME, COUNT]), "tanggal")
        return days.select(F.lit("day").alias("granularity"), cal.day_label(F.col("tanggal")).alias("label"), VOLUME, COUNT)
    months = by_level(chosen, ["tahun", "bulan"], [VOLUME, COUNT])
    return _in_time_order(months, "tahun", cal.month_index(F.col("bulan"))).select(
        F.lit("month").alias("granularity"), cal.month_label(F.col("bulan"), F.col("tahun")).alias("label"), VOLUME, COUNT
    )


# -- rankings by one level ----------------------------------------------------
def _ranking(rows: DataFrame, params: Mapping | None, level: str, name: str) -> DataFrame:
    ranked = by_level(_filtered(rows, params), [level], [VOLUME, COUNT])
    return ranked.withColumnRenamed(level, name).orderBy(F.col(VOLUME).desc(), F.col(name))


def channel_distribution(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    return _ranking(rows, params, "nama_channel", "channel")


def customer_segment(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    return _ranking(rows, params, "segmen_nasabah", "segmen")


def merchant_category(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    return _ranking(rows, params, "kategori", "kategori")


def city_ranking(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    return _ranking(rows, params, "kota", "kota")


def top_merchants(rows: DataFrame, params: Mapping | None = None, limit: int | None = 10) -> DataFrame:
    """The ``limit`` merchants with most volume, or all; ties go by name."""
    merchants = by_level(_filtered(rows, params), ["kategori", "nama_merchant"], [VOLUME, COUNT])
    order = [F.col(VOLUME).desc(), F.col("nama_merchant"), F.col("kategori")]
    ranked = merchants.orderBy(*order).select("nama_merchant", "kategori", VOLUME, COUNT)
    return ranked if limit is None else ranked.limit(limit)


# -- places, people, days -----------------------------------------------------
def geographic(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Volume and count per city with its map position."""
    cities = by_level(_filtered(rows, params), ["provinsi", "kota"], [VOLUME, COUNT])
    return cities.select(
        "provinsi", "kota", m.latitude(F.col("kota")).alias("lat"), m.longitude(F.col("kota")).alias("lon"), VOLUME, COUNT
    )


def gender_distribution(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    return by_level(_filtered(rows, params), ["jenis_kelamin"], [VOLUME, COUNT]).orderBy("jenis_kelamin")


def channel_by_region(rows: DataFrame, params: Mapping | None = None, channels: list[str] | None = None) -> DataFrame:
    """Counts per city, one column per channel, 0 where there is none.

    ``channels`` names the columns; left out, the channels present are looked up first.
    """
    chosen = _filtered(rows, params)
    if channels is None:
        channels = [r[0] for r in chosen.select("nama_channel").distinct().orderBy("nama_channel").collect()]
    return pivot_count(chosen, "kota", "nama_channel", channels).orderBy("kota")


def daily_transaction(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    days = by_level(_filtered(rows, params), ["hari"], [VOLUME, COUNT])
    return _in_time_order(days, cal.weekday_index(F.col("hari")))


def heatmap(rows: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Counts per month and weekday, every present month with all seven days."""
    grid = weekday_grid(_filtered(rows, params)).filter(F.col("bulan").isin(MONTHS))
    return _in_time_order(grid, cal.month_index(F.col("bulan")), cal.weekday_index(F.col("hari")))


# -- sample and benchmark queries, unfiltered ---------------------------------
def segment_by_gender(rows: DataFrame) -> DataFrame:
    return by_level(rows, ["segmen_nasabah", "jenis_kelamin"], [VOLUME])


def city_by_channel(rows: DataFrame) -> DataFrame:
    return by_level(rows, ["kota", "nama_channel"], [COUNT])


# The levels each of the sample and benchmark queries reads.
SAMPLE_LEVELS = {
    "kpi": [], "channel": ["nama_channel"], "segment_gender": ["segmen_nasabah", "jenis_kelamin"], "category": ["kategori"],
    "city": ["kota"], "month": ["tahun", "bulan"], "weekday": ["hari"], "city_channel": ["kota", "nama_channel"],
}
BENCHMARK_LEVELS = {
    "Q1_KPI": [], "Q2_MonthlyTrend": ["tahun", "bulan"], "Q3_Channel": ["nama_channel"], "Q4_Segment": ["segmen_nasabah"],
    "Q5_City": ["kota"], "Q6_ChannelCity": ["kota", "nama_channel"], "Q7_Heatmap": ["bulan", "hari"],
}


def sample_queries() -> dict:
    """The cube's eight sample queries: name -> function of the rows."""
    return {
        "kpi": lambda rows: kpi(rows, EVERYTHING).select(*KPIS),
        "channel": lambda rows: by_level(rows, ["nama_channel"], [VOLUME, COUNT]),
        "segment_gender": segment_by_gender,
        "category": lambda rows: by_level(rows, ["kategori"], [VOLUME]),
        "city": lambda rows: by_level(rows, ["kota"], [VOLUME]),
        "month": lambda rows: by_level(rows, ["tahun", "bulan"], [VOLUME]),
        "weekday": lambda rows: by_level(rows, ["hari"], [COUNT]),
        "city_channel": city_by_channel,
    }


def benchmark_queries() -> dict:
    """The seven benchmark queries: name -> (class, function of the rows)."""
    return {
        "Q1_KPI": ("simple", lambda rows: kpi(rows, EVERYTHING).select(*KPIS)),
        "Q2_MonthlyTrend": ("simple", lambda rows: by_level(rows, ["tahun", "bulan"], [VOLUME, COUNT])),
        "Q3_Channel": ("rollup", lambda rows: by_level(rows, ["nama_channel"], [VOLUME, COUNT])),
        "Q4_Segment": ("rollup", lambda rows: by_level(rows, ["segmen_nasabah"], [VOLUME, COUNT])),
        "Q5_City": ("rollup", lambda rows: by_level(rows, ["kota"], [VOLUME, COUNT])),
        "Q6_ChannelCity": ("pivot", city_by_channel),
        "Q7_Heatmap": ("pivot", lambda rows: by_level(rows, ["bulan", "hari"], [COUNT])),
    }
