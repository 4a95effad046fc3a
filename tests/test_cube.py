"""Filters, roll-ups and the named queries on hand-made cube rows."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumbung.functions.calendar import calendar_rows, weekday_index
from lumbung.operators import cube as c
from lumbung.operators import filters as flt
from lumbung.operators import presentation as pr
from lumbung.operators.star import LEVEL_DEFAULTS, cube_rows
from lumbung.plans import queries as q

BASE = {
    "day": "2026-04-13", "segmen_nasabah": "Reguler", "jenis_kelamin": "L", "nama_lengkap": "Andi",
    "jenis_channel": "Digital", "nama_channel": "ATM", "region": "Jawa", "provinsi": "Jawa Barat", "kota": "Bandung",
    "kategori": "Retail", "nama_merchant": "Toko 1", "nominal_transaksi": 100, "biaya_admin": 10,
}


def rows(spark, *changes):
    data = [{**BASE, **x} for x in changes]
    df = spark.createDataFrame([tuple(r.values()) for r in data], ", ".join(f"{k} {'int' if isinstance(x, int) else 'string'}" for k, x in BASE.items()))
    days = calendar_rows(df.select(F.col("day").cast("date").alias("d")).distinct(), F.col("d")).drop("waktu_id")
    money = {x: F.col(x).cast("decimal(18,2)") for x in ("nominal_transaksi", "biaya_admin")}
    return df.withColumn("tanggal", F.col("day").cast("date")).join(days, "tanggal").withColumns(money).drop("day")


def counts(df, level):
    return {r[0]: r[1] for r in c.by_level(df, [level], [c.COUNT]).collect()}


# -- the Unknown rule ---------------------------------------------------------
HIDDEN = [
    ("Nasabah", {"segmen_nasabah": "Unknown"}, {"segmen": ["Unknown", "Reguler"]}),
    ("Nasabah", {"jenis_kelamin": "U"}, {"segmen": ["Reguler"]}),
    ("Nasabah", {"nama_lengkap": "Unknown"}, {"segmen": ["Reguler"]}),
    ("Channel", {"jenis_channel": "Unknown", "nama_channel": "UNKNOWN"}, {"channel": ["UNKNOWN", "ATM"]}),
    ("Wilayah", {"provinsi": "Unknown", "region": "Unknown", "kota": "Cirebon"}, {"kota": ["Cirebon", "Bandung"]}),
    ("Wilayah", {"region": "Unknown"}, {"provinsi": ["Jawa Barat"]}),
    ("Merchant", {"kategori": "Unknown"}, {"kategori": ["Unknown", "Retail"]}),
    ("Merchant", {"nama_merchant": "Unknown"}, {"kategori": ["Retail"]}),
]


@pytest.mark.parametrize("hierarchy, change, inclusion", HIDDEN)
def test_unknown_is_hidden_unless_its_hierarchy_is_diced(spark, hierarchy, change, inclusion):
    df = rows(spark, {}, change)
    assert df.filter(flt.build_filter({})).count() == 1
    assert df.filter(flt.build_filter(inclusion)).count() == 2
    assert df.filter(flt.build_filter({"include_unknown": True})).count() == 2
    other = {"tahun": [2026]} if hierarchy != "Waktu" else {"segmen": ["Reguler"]}
    assert df.filter(flt.build_filter(other)).count() == 1


def test_unknown_time_and_date_range(spark):
    df = rows(spark, {}, {"day": "1900-01-01"})
    lost = F.col("tanggal") == F.lit("1900-01-01").cast("date")
    df = df.withColumns({"tahun": F.when(lost, 0).otherwise(F.col("tahun")), "bulan": F.when(lost, "Unknown").otherwise(F.col("bulan"))})
    assert df.filter(flt.build_filter({})).count() == 1
    assert df.filter(flt.build_filter({"tahun": [0, 2026]})).count() == 2
    # A date range is no filter of the time hierarchy: Unknown stays hidden.
    assert df.filter(flt.build_filter({"start_date": "1900-01-01"})).count() == 1


def test_dice_is_and_of_ors_and_ignores_empty_lists(spark):
    df = rows(spark, {}, {"nama_channel": "QRIS"}, {"nama_channel": "LIVIN"}, {"nama_channel": "QRIS", "kota": "Medan"})
    params = {"channel": ["ATM", "QRIS"], "kota": ["Bandung"], "segmen": []}
    assert counts(df.filter(flt.build_filter(params)), "nama_channel") == {"ATM": 1, "QRIS": 1}


def test_date_range_is_inclusive(spark):
    df = rows(spark, *[{"day": f"2026-04-{x}"} for x in (12, 13, 14, 15)])
    assert df.filter(flt.date_range({"start_date": "2026-04-13", "end_date": "2026-04-14"})).count() == 2
    assert df.filter(flt.date_range({"end_date": "2026-04-14"})).count() == 3


def test_filters_reach_the_scan(spark, tmp_path):
    rows(spark, {}).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).filter(flt.build_filter({"channel": ["ATM"]}))
    plan = c.by_level(df, ["kota"], [c.VOLUME])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(nama_channel,ATM)" in plan and "Not(EqualTo(kategori,Unknown))" in plan
    assert "biaya_admin" not in plan[plan.index("ReadSchema"):]


# -- measures, roll-ups -------------------------------------------------------
MIXED = [
    {}, {"nama_channel": "QRIS", "nominal_transaksi": 50}, {"kota": "Medan", "region": "Sumatera", "nominal_transaksi": 25},
    {"day": "2026-05-02", "nominal_transaksi": 7}, {"day": "2027-05-03", "segmen_nasabah": "Private", "nominal_transaksi": 3},
]


def test_every_level_adds_up_to_the_grand_total(spark):
    df = rows(spark, *MIXED)
    for level in c.LEVELS:
        got = c.by_level(df, [level], [c.VOLUME, c.COUNT]).agg(F.sum(c.VOLUME), F.sum(c.COUNT)).first()
        assert tuple(got) == (185.0, 5), level


def test_cuboid_answers_like_the_rows(spark):
    df = rows(spark, *MIXED, *MIXED, {"nama_lengkap": "Unknown"}, {"nama_merchant": "Unknown"})
    cells = c.cuboid(df)
    for query in (q.kpi, q.monthly_trend, q.channel_distribution, q.customer_segment, q.city_ranking, q.heatmap, q.daily_transaction, q.filter_options):
        args = ({},) if query is not q.filter_options else ()
        assert sorted(map(str, query(df, *args).collect())) == sorted(map(str, query(cells, *args).collect()))
    fine = c.cuboid(df, ("nama_merchant",))
    assert q.top_merchants(fine).collect() == q.top_merchants(df).collect()


def test_hierarchy_totals(spark):
    got = c.hierarchy_totals(rows(spark, *MIXED), "Wilayah", [c.COUNT])
    assert {(r.region, r.provinsi, r.kota, r.depth): r[c.COUNT] for r in got.filter("depth < 2").collect()} == {
        (None, None, None, 0): 5, ("Jawa", None, None, 1): 4, ("Sumatera", None, None, 1): 1
    }


def test_drill_down_goes_one_level_finer(spark):
    got = c.drill_down(rows(spark, *MIXED), "region", [c.COUNT])
    assert got.columns == ["region", "provinsi", c.COUNT] and got.count() == 2
    with pytest.raises(ValueError):
        c.drill_down(got, "kota", [c.COUNT])


def test_average_is_a_ratio_of_totals(spark):
    got = c.by_level(rows(spark, *MIXED), ["region"], [c.AVERAGE])
    assert {r[0]: r[1] for r in got.collect()} == {"Jawa": 40.0, "Sumatera": 25.0}


# -- named queries ------------------------------------------------------------
def test_kpi_of_nothing_is_zero(spark):
    got = q.kpi(rows(spark, {}), {"tahun": [1900]}).first()
    assert tuple(got[:4]) == (0.0, 0, 0.0, 0.0) and set(got[4:]) == {None}


@pytest.mark.parametrize("query", [
    q.monthly_trend, q.channel_distribution, q.customer_segment, q.merchant_category, q.top_merchants,
    q.geographic, q.city_ranking, q.gender_distribution, q.daily_transaction, q.heatmap,
])
def test_empty_selection_keeps_the_columns(spark, query):
    df = rows(spark, {})
    assert query(df, {"tahun": [1900]}).columns == query(df).columns
    assert query(df, {"tahun": [1900]}).count() == 0


def test_month_over_month(spark):
    df = rows(spark, {"day": "2026-12-30", "nominal_transaksi": 80}, {"day": "2027-01-02", "nominal_transaksi": 100}, {"day": "2027-01-05", "nominal_transaksi": 20})
    got = q.kpi(df, {"tahun": [2027], "bulan": ["January"]}).first()
    assert got.total_volume_transaksi == 120.0
    assert (got.trend_total_volume_transaksi, got.trend_total_frekuensi_transaksi) == (50.0, 100.0)
    assert got.trend_avg_nominal_transaksi == -25.0
    assert q.kpi(df, {"tahun": [2027]}).first().trend_total_volume_transaksi is None


def test_month_over_month_keeps_the_quarter_filter(spark):
    df = rows(spark, {"day": "2026-03-30"}, {"day": "2026-04-02"})
    assert q.kpi(df, {"tahun": [2026], "bulan": ["April"]}).first().trend_total_volume_transaksi == 0.0
    assert q.kpi(df, {"tahun": [2026], "bulan": ["April"], "quarter": ["Q2"]}).first().trend_total_volume_transaksi is None


def test_trend_rolls_up_or_drills_down(spark):
    df = rows(spark, *MIXED)
    assert [r.label for r in q.monthly_trend(df).collect()] == ["Apr 2026", "May 2026", "May 2027"]
    days = q.monthly_trend(df, {"tahun": [2026], "bulan": ["May"]}).collect()
    assert [(r.granularity, r.label, r[c.VOLUME]) for r in days] == [("day", "2026-05-02", 7.0)]


def test_heatmap_is_dense_and_merges_years(spark):
    df = rows(spark, {"day": "2026-04-13"}, {"day": "2026-04-14"}, {"day": "2027-04-12"})
    got = q.heatmap(df).collect()
    assert [(r.bulan, r.hari) for r in got] == [("April", x) for x in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")]
    assert [r[c.COUNT] for r in got] == [2, 1, 0, 0, 0, 0, 0]


def test_channel_by_region_fills_zero(spark):
    df = rows(spark, {}, {"nama_channel": "QRIS"}, {"kota": "Medan", "nama_channel": "QRIS"})
    got = q.channel_by_region(df)
    assert got.columns == ["kota", "ATM", "QRIS"]
    assert [tuple(r) for r in got.collect()] == [("Bandung", 1, 1), ("Medan", 0, 1)]


def test_rankings_break_ties_by_name(spark):
    df = rows(spark, {"nama_merchant": "B"}, {"nama_merchant": "A"}, {"nama_merchant": "C", "nominal_transaksi": 500})
    assert [r.nama_merchant for r in q.top_merchants(df, limit=2).collect()] == ["C", "A"]


def test_filter_options(spark):
    got = [(r.filter, r.urutan, r.nilai) for r in q.filter_options(rows(spark, *MIXED)).collect()]
    assert [x for x in sorted(got) if x[0] == "bulan"] == [("bulan", 1, "April"), ("bulan", 2, "May")]
    assert ("min_date", 1, "2026-04-13") in got and ("max_date", 1, "2027-05-03") in got
    assert {x[0] for x in got} == {*q.OPTION_LEVELS, "min_date", "max_date"}


def test_sample_and_benchmark_queries_run(spark):
    df = rows(spark, *MIXED)
    assert len(q.sample_queries()) == 8 and len(q.benchmark_queries()) == 7
    for query in [*q.sample_queries().values(), *[fn for _, fn in q.benchmark_queries().values()]]:
        assert query(df).count() >= 1


# -- presentation -------------------------------------------------------------
def values(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v double")


def test_shares(spark):
    got = {r.k: (r.share, r.label_visible) for r in pr.share_of_total(values(spark, ("a", 96.0), ("b", 4.0)), "v").collect()}
    assert got == {"a": (0.96, True), "b": (0.04, False)}
    assert {r.share_pct for r in pr.share_within(values(spark, ("a", 0.0)), "k", "v").collect()} == {0.0}


def test_ratio_to_max_and_radius(spark):
    got = {r.k: (r.ratio, r.radius) for r in pr.map_radius(pr.ratio_to_max(values(spark, ("a", 50.0), ("b", 25.0)), "v"), "v").collect()}
    assert got == {"a": (1.0, 30.0), "b": (0.5, 18.0)}
    assert pr.map_radius(values(spark, ("a", 0.0)), "v").first().radius == 6.0


def test_first_peak_wins(spark):
    days = spark.createDataFrame([("Tuesday", 5), ("Monday", 5), ("Friday", 1)], "hari string, n int")
    got = pr.peak_flag(days, "n", weekday_index(F.col("hari")))
    assert {r.hari for r in got.filter("is_peak").collect()} == {"Monday"}


def test_month_series_does_not_jump_gaps(spark):
    months = spark.createDataFrame([(2026, "December", 10.0), (2027, "January", 15.0), (2027, "March", 30.0)], "tahun int, bulan string, v double")
    got = {r.bulan: r.v_mom_pct for r in pr.month_over_month(months, ["v"]).collect()}
    assert got == {"December": None, "January": 50.0, "March": None}


def test_missing_members_get_level_defaults(spark):
    fact = spark.createDataFrame([(1, 9, 9, 9, 9, Decimal("5.00"), Decimal("0.00"))],
                                 "waktu_id bigint, nasabah_id bigint, channel_id bigint, wilayah_id bigint, merchant_id bigint, "
                                 "nominal_transaksi decimal(18,2), biaya_admin decimal(18,2)")
    from lumbung.operators.dimensions import DIMENSIONS
    got = cube_rows(fact, {x.table: spark.createDataFrame([], x.schema) for x in DIMENSIONS}).first()
    for level, default in LEVEL_DEFAULTS.items():
        assert got[level] == (datetime.date(1900, 1, 1) if level == "tanggal" else default)
