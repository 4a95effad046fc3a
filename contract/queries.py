"""Registered queries: one function (spark, sf_dir) -> DataFrame per operator or named query."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import bindings as b
from lumbung import fixed_values as v
from lumbung.functions import calendar as cal
from lumbung.functions import mapping as m
from lumbung.functions import parsing as p
from lumbung.functions.rounding import round_binary
from lumbung.operators import cube as c
from lumbung.operators import dimensions as d
from lumbung.operators import facts as f
from lumbung.operators import filters as flt
from lumbung.operators import presentation as pr
from lumbung.operators import quality, statistics as st
from lumbung.operators.dedupe import keep_first
from lumbung.operators.keys import max_or_zero, number_rows, number_source_rows
from lumbung.operators.star import VIEW_COLUMNS, cube_rows, level_rows
from lumbung.plans import cuboids, load, queries as q, scalability
from lumbung.sources import csv_source, export, metrics, synthetic
from lumbung.sources.staging import new_folder, stage_parts
from lumbung.sources.warehouse import FACT, MEMBER_REJECTS, Warehouse
from lumbung.streaming.batches import load_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- shared inputs ------------------------------------------------------------
def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, b.loaded_warehouse(spark, sf_dir))


def bank(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Cube rows of the loaded warehouse, Unknown members included; with ``levels``, rows of those alone.

    Rows of levels are cells, summed slice by slice where there are many facts.
    """
    wh = warehouse(spark, sf_dir)
    if not levels:
        return cube_rows(wh.facts(), wh.dimensions())
    parts = [level_rows(facts, wh.dimensions(), list(levels)) for facts in wh.fact_slices()]
    return parts[0] if len(parts) == 1 else stage_parts([c.stored_cells(rows, list(levels)) for rows in parts], "levels")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube's stored cells for the loaded warehouse."""
    return load.refresh_cube(warehouse(spark, sf_dir))


def routed(spark: SparkSession, sf_dir: str, *levels: str, params: dict | None = None) -> DataFrame:
    """Cells of the smallest stored roll-up that has the levels of a query and of its filters."""
    return cuboids.route(Warehouse(spark, b.with_cuboids(spark, sf_dir)), levels, params)


def clean(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Rows of the clean star with the levels."""
    return level_rows(b.clean_fact(spark, sf_dir, *levels), b.clean_dimensions(spark, sf_dir), list(levels))


def money(*names: str) -> list:
    return [F.col(n).cast("double").alias(n) for n in names]


def day(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


# -- scalar functions ---------------------------------------------------------
@register
def f1_parse_nominal(spark, sf_dir):
    raw = b.raw_transactions(spark, sf_dir)
    return raw.select("trx_id", p.parse_amount(F.col("nominal")).cast("double").alias("nominal"))


@register
def f2_parse_fee(spark, sf_dir):
    raw = b.raw_transactions(spark, sf_dir)
    return raw.select("trx_id", p.parse_fee(F.col("biaya_admin")).cast("double").alias("biaya_admin"))


@register
def f3_parse_dates(spark, sf_dir):
    raw = b.raw_transactions(spark, sf_dir)
    parsed = p.parse_transaction_date(F.col("tgl_transaksi"))
    return raw.select("trx_id", p.date_key(parsed).alias("waktu_id"), cal.day_label(parsed).alias("tanggal"))


@register
def f3_parse_birth_dates(spark, sf_dir):
    raw = b.raw_customers(spark, sf_dir)
    return raw.select("nasabah_code", cal.day_label(p.parse_birth_date(F.col("tanggal_lahir"))).alias("tanggal_lahir"))


@register
def f6_labels(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    placed = F.col("o_orderdate")
    return orders.select(
        "o_orderkey",
        cal.month_label(F.date_format(placed, "MMMM"), F.year(placed)).alias("bulan_label"),
        cal.day_label(placed).alias("tanggal_label"),
    )


@register
def f9_split_date_range(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    ranges = orders.groupBy("o_orderpriority").agg(
        F.min("o_orderdate").cast("date").alias("first"),
        F.max("o_orderdate").cast("date").alias("last"),
        (F.count("*") % 7 + 5).cast("int").alias("n"),
    )
    chunks = cal.split_date_range(ranges, "first", "last", "n")
    return chunks.select("o_orderpriority", F.col("chunk").cast("bigint").alias("chunk"), day("chunk_first"), day("chunk_last"))


@register
def f10_local_number(spark, sf_dir):
    part = b.table(spark, sf_dir, "part")
    whole = F.floor(F.col("p_retailprice") * 1000).cast("bigint")
    cents = F.when(F.col("p_partkey") % 5 == 0, F.col("p_partkey") % 100)
    return part.select("p_partkey", synthetic.local_number(whole, cents).alias("nominal"))


@register
def f11_labels(spark, sf_dir):
    rows = c.by_level(bank(spark, sf_dir, "jenis_kelamin", "bulan", "hari"), ["jenis_kelamin", "bulan", "hari"], [c.VOLUME])
    return rows.select(
        m.gender_label(F.col("jenis_kelamin")).alias("gender"),
        m.month_short(F.col("bulan")).alias("bulan"),
        m.weekday_short(F.col("hari")).alias("hari"),
        cal.in_billions(F.col(c.VOLUME)).alias("miliar"),
        cal.in_millions(F.col(c.VOLUME)).alias("juta"),
    )


@register
def f13_money_format(spark, sf_dir):
    totals = clean(spark, sf_dir, "kategori").groupBy("kategori").agg(c.total("nominal_transaksi").alias("x"))
    return totals.select("kategori", cal.money_label(F.col("x")).alias("volume"))


# -- standardisation ----------------------------------------------------------
@register
def p1_gender_map(spark, sf_dir):
    raw = p.blanks_to_null(b.raw_customers(spark, sf_dir), "src_seq", "is_new")
    return raw.select("nasabah_code", m.gender(F.col("jenis_kelamin")).alias("jenis_kelamin"))


@register
def p2_segment_map(spark, sf_dir):
    raw = p.blanks_to_null(b.raw_customers(spark, sf_dir), "src_seq", "is_new")
    return raw.select("nasabah_code", m.segment(F.col("segmen_nasabah")).alias("segmen_nasabah"))


@register
def p3_category_default(spark, sf_dir):
    raw = b.raw_merchants(spark, sf_dir)
    return raw.select("merchant_code", m.category(F.col("kategori")).alias("kategori"))


@register
def p4_channel_map(spark, sf_dir):
    """Raw spelling, what facts make of it, what the dimension makes of it, and how often."""
    raw = b.raw_transactions(spark, sf_dir)
    return raw.groupBy(
        F.col("channel").alias("raw"),
        m.channel_of_fact(F.col("channel")).alias("of_fact"),
        m.channel_member(F.col("channel")).alias("member"),
    ).agg(F.count("*").alias("n"))


@register
def p6_city_alias(spark, sf_dir):
    raw = b.raw_transactions(spark, sf_dir)
    return raw.groupBy(
        F.col("kota").alias("raw"),
        m.city_of_fact(F.col("kota")).alias("of_fact"),
        m.city_member(F.col("kota")).alias("member"),
    ).agg(F.count("*").alias("n"))


# -- cleansing and keys -------------------------------------------------------
@register
def a17_dedupe_first(spark, sf_dir):
    first = keep_first(b.raw_transactions(spark, sf_dir), ["trx_id"], ["src_seq"])
    return first.select("trx_id", "tgl_transaksi", "merchant_code", "nominal", "biaya_admin")


@register
def p8_p9_fact_cleanse(spark, sf_dir):
    return _cleansed(spark, sf_dir).select(
        "trx_id", "waktu_id", "nasabah_code", "merchant_code", "nama_channel", "kota", *money("nominal_transaksi", "biaya_admin")
    )


@register
def p8_p9_rejected_counts(spark, sf_dir):
    first = keep_first(
        f.typed_transactions(b.raw_transactions(spark, sf_dir), "src_seq"), ["trx_id"], ["src_seq"]
    )
    return first.groupBy(F.coalesce(f.fault(), F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@register
def w1_surrogate_keys(spark, sf_dir):
    """Orders numbered by date and key: dense ids over a table that grows with the data."""
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], "order_id").select("order_id", "o_orderkey")


def _split_customers(spark, sf_dir):
    members = d.customer_members(p.blanks_to_null(b.raw_customers(spark, sf_dir), "src_seq", "is_new"))
    old = number_rows(members.filter("NOT is_new"), ["src_seq"], "nasabah_id")
    return members, d.with_unknown(d.CUSTOMER, old)


@register
def w2_continue_keys(spark, sf_dir):
    members, existing = _split_customers(spark, sf_dir)
    fresh = d.new_members(members, existing, "nasabah_code")
    top = max_or_zero(existing, "nasabah_id").scalar()
    return number_rows(fresh, ["src_seq"], "nasabah_id", top).select("nasabah_id", "nasabah_code")


@register
def j3_new_members_anti(spark, sf_dir):
    members, existing = _split_customers(spark, sf_dir)
    return d.new_members(members, existing, "nasabah_code").select("nasabah_code", "nama_lengkap")


@register
def u1_unknown_member(spark, sf_dir):
    members = d.merchant_members(b.raw_merchants(spark, sf_dir))
    return d.with_unknown(d.MERCHANT, number_rows(members, ["src_seq"], "merchant_id"))


def _seen(spark, sf_dir):
    raw = csv_source.read_mandatory(spark, b.source_folder(spark, sf_dir), v.TRANSACTION_FILE)
    return d.members_in_transactions(f.typed_transactions(raw, "src_seq"))


@register
def a24_ordered_distinct(spark, sf_dir):
    members = number_source_rows(d.channel_members(_seen(spark, sf_dir)), "channel_id")
    return d.with_unknown(d.CHANNEL, members)


@register
def u2_city_union(spark, sf_dir):
    return d.with_unknown(d.AREA, number_source_rows(d.area_members(_seen(spark, sf_dir)), "wilayah_id"))


@register
def j6_city_enrich(spark, sf_dir):
    cities = b.raw_transactions(spark, sf_dir).select(m.city_member(F.col("kota")).alias("kota"))
    return d.enrich_city(cities.groupBy("kota").agg(F.count("*").alias("n")))


# -- facts --------------------------------------------------------------------
def _cleansed(spark, sf_dir):
    return f.cleanse(p.blanks_to_null(b.raw_transactions(spark, sf_dir), "src_seq", "ship_day"), ["src_seq"], "src_seq")


@register
def j1_fk_lookup(spark, sf_dir):
    dims = warehouse(spark, sf_dir).dimensions()
    keyed = f.look_up_keys(
        _cleansed(spark, sf_dir), dims["dim_nasabah"], dims["dim_merchant"], dims["dim_channel"], dims["dim_wilayah"]
    )
    return keyed.select("trx_id", "nasabah_id", "merchant_id", "channel_id", "wilayah_id")


@register
def j2_calendar_semi(spark, sf_dir):
    return f.in_calendar(_cleansed(spark, sf_dir), b.calendar_days(spark)).select("trx_id", "waktu_id")


@register
def j2_calendar_rejects(spark, sf_dir):
    return f.not_in_calendar(_cleansed(spark, sf_dir), b.calendar_days(spark)).select("trx_id", "tgl_transaksi", "waktu_id")


def _loaded_and_batch(spark, sf_dir):
    raw = p.blanks_to_null(b.raw_transactions(spark, sf_dir), "src_seq", "ship_day")
    loaded = f.cleanse(raw.filter(F.col("ship_day") <= F.lit(b.LOADED_UNTIL).cast("date")), ["src_seq"], "src_seq")
    batch = f.cleanse(raw, ["src_seq"], "src_seq")
    return loaded, batch


@register
def t1_high_water_load(spark, sf_dir):
    loaded, batch = _loaded_and_batch(spark, sf_dir)
    newer = f.newer_than(batch, f.high_water_mark(loaded))
    top = loaded.agg(F.count("*")).scalar()
    numbered = number_rows(newer, ["src_seq"], "fact_id", top)
    return numbered.select("fact_id", "trx_id", "waktu_id", *money("nominal_transaksi"))


@register
def t3_late_rejects(spark, sf_dir):
    loaded, batch = _loaded_and_batch(spark, sf_dir)
    late = f.not_newer_than(batch, f.high_water_mark(loaded))
    return late.select("trx_id", "tgl_transaksi", "waktu_id", F.lit("late").alias("reason"))


@register
def a15_high_water_mark(spark, sf_dir):
    facts = warehouse(spark, sf_dir).facts()
    return facts.agg(
        F.coalesce(F.max("waktu_id"), F.lit(0)).cast("bigint").alias("max_waktu"),
        F.coalesce(F.max("fact_id"), F.lit(0)).cast("bigint").alias("max_fact"),
        F.count("*").alias("rows"),
    )


@register
def t2_dim_incremental(spark, sf_dir):
    wh = Warehouse(spark, b.incremental_warehouse(spark, sf_dir))
    return wh.dimension(d.MERCHANT)


@register
def t2_customers_incremental(spark, sf_dir):
    dim = Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).dimension(d.CUSTOMER)
    return dim.withColumn("tanggal_lahir", cal.day_label(F.col("tanggal_lahir")))


@register
def t2_channels_incremental(spark, sf_dir):
    return Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).dimension(d.CHANNEL)


@register
def t2_areas_incremental(spark, sf_dir):
    return Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).dimension(d.AREA)


@register
def t2_calendar_incremental(spark, sf_dir):
    dim = Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).dimension(d.CALENDAR)
    return dim.withColumn("tanggal", cal.day_label(F.col("tanggal"))).withColumn("tahun", F.col("tahun").cast("bigint"))


# -- loads --------------------------------------------------------------------
def _facts(wh: Warehouse) -> DataFrame:
    ids = [x for x in f.FACT_COLUMNS if x not in ("nominal_transaksi", "biaya_admin")]
    return wh.facts().select(*ids, *money("nominal_transaksi", "biaya_admin"))


@register
def e1_full_load(spark, sf_dir):
    return _facts(warehouse(spark, sf_dir))


@register
def e1_dim_nasabah(spark, sf_dir):
    dim = warehouse(spark, sf_dir).dimension(d.CUSTOMER)
    return dim.withColumn("tanggal_lahir", cal.day_label(F.col("tanggal_lahir")))


@register
def e1_dim_waktu(spark, sf_dir):
    dim = warehouse(spark, sf_dir).dimension(d.CALENDAR)
    return dim.withColumn("tanggal", cal.day_label(F.col("tanggal"))).withColumn("tahun", F.col("tahun").cast("bigint"))


@register
def e1_rejects(spark, sf_dir):
    return warehouse(spark, sf_dir).not_loaded().select("trx_id", "tgl_transaksi", "waktu_id", "reason")


@register
def e1_member_rejects(spark, sf_dir):
    """Customers and merchants whose code stood earlier in the same source."""
    wh = Warehouse(spark, b.repeated_members_warehouse(spark, sf_dir))
    return wh.read(MEMBER_REJECTS).select("dimension", "code", "reason")


@register
def e1_first_members(spark, sf_dir):
    """Merchants of the same load: the first row of a code is the member."""
    return Warehouse(spark, b.repeated_members_warehouse(spark, sf_dir)).dimension(d.MERCHANT)


@register
def e2_incremental_load(spark, sf_dir):
    return _facts(Warehouse(spark, b.incremental_warehouse(spark, sf_dir)))


@register
def e2_reload_batch(spark, sf_dir):
    """Facts after an earlier batch was loaded once more behind a later one: nothing may change."""
    return _facts(Warehouse(spark, b.reloaded_warehouse(spark, sf_dir)))


@register
def e2_changed_batch(spark, sf_dir):
    """Facts after an earlier batch came again with more rows: only those are added, with ids after all others."""
    return _facts(Warehouse(spark, b.changed_warehouse(spark, sf_dir)))


@register
def e2_changed_rejects(spark, sf_dir):
    """What the batch that came again did not bring in: faulty, repeated and changed rows."""
    rejects = Warehouse(spark, b.changed_warehouse(spark, sf_dir)).not_loaded()
    return rejects.groupBy("batch_id", "reason").agg(F.count("*").alias("n"))


@register
def s10_packed_batches(spark, sf_dir):
    """What each batch brought, read after the batches were packed and the old version was removed."""
    return _per_batch(Warehouse(spark, b.packed_warehouse(spark, sf_dir)))


@register
def s10_packed_cells(spark, sf_dir):
    """Packed cells: each day's cell of a channel and category is one row again but for the batch that was not packed."""
    wh = Warehouse(spark, b.packed_warehouse(spark, sf_dir))
    return c.by_level(wh.cells(), ["tahun", "nama_channel", "kategori"], [c.VOLUME, c.COUNT]).withColumn("tahun", F.col("tahun").cast("bigint"))


@register
def e2_rejects(spark, sf_dir):
    wh = Warehouse(spark, b.incremental_warehouse(spark, sf_dir))
    return wh.not_loaded().groupBy("batch_id", "reason").agg(F.count("*").alias("n"))


@register
def t5_available_now_stream(spark, sf_dir):
    """Yearly batch folders loaded by the file stream: what each batch brought."""
    root = new_folder(spark, "stream")
    load_available(spark, b.yearly_landing(spark, sf_dir), f"{root}/wh", f"{root}/checkpoint").awaitTermination()
    return _per_batch(Warehouse(spark, f"{root}/wh"))


def _per_batch(wh: Warehouse) -> DataFrame:
    return wh.read(FACT).groupBy("batch_id").agg(
        F.count("*").alias("rows"),
        F.min("fact_id").alias("first_id"),
        F.max("fact_id").alias("last_id"),
        F.sum("nominal_transaksi").cast("double").alias("volume"),
    )


@register
def e3_quality_report(spark, sf_dir):
    raw = csv_source.read_mandatory(spark, b.source_folder(spark, sf_dir), v.TRANSACTION_FILE)
    return quality.quality_report(raw, ["src_seq"], warehouse(spark, sf_dir).facts())


@register
def p18_unknown_keys(spark, sf_dir):
    return quality.fact_quality(warehouse(spark, sf_dir).facts())


# -- sources and sinks --------------------------------------------------------
@register
def s1_read_source_csv(spark, sf_dir):
    raw = csv_source.read_mandatory(spark, b.source_folder(spark, sf_dir), v.TRANSACTION_FILE)
    return raw.drop("src_seq")


@register
def s1_mixed_headers(spark, sf_dir):
    """Part files with two headers and separators read as one source; what a part lacks is null."""
    return csv_source.read_mandatory(spark, b.mixed_folder(spark, sf_dir), v.TRANSACTION_FILE).drop("src_seq")


@register
def s1_source_order(spark, sf_dir):
    """Source rows numbered by the order the reader recovers from the files."""
    raw = csv_source.read_mandatory(spark, b.source_folder(spark, sf_dir), v.TRANSACTION_FILE)
    return number_source_rows(raw.select("trx_id", "nominal", "src_seq"), "line").drop("src_seq")


@register
def s12_ordered_export(spark, sf_dir):
    folder = new_folder(spark, "export")
    export.export_table(warehouse(spark, sf_dir).dimension(d.MERCHANT), f"{folder}/dim_merchant.csv")
    back = csv_source.read_mandatory(spark, folder, "dim_merchant.csv")
    return number_source_rows(back, "line").select(
        "line", F.col("merchant_id").cast("bigint").alias("merchant_id"), "merchant_code", "nama_merchant", "kategori"
    )


@register
def s16_dirty_batch(spark, sf_dir):
    """One generated transaction per order, references drawn from as many codes as there are customers and parts."""
    ids = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    customers = synthetic.Pool("N-", 0, b.table(spark, sf_dir, "customer").count())
    merchants = synthetic.Pool("MCH-", 0, b.table(spark, sf_dir, "part").count())
    return synthetic.transactions(ids, customers, merchants, synthetic.FIRST_DAY, synthetic.LAST_DAY, seed=42)


# -- star joins ---------------------------------------------------------------
@register
def j4_star_view(spark, sf_dir):
    return _view_out(warehouse(spark, sf_dir).view())


def _view_out(view: DataFrame) -> DataFrame:
    return view.select(*[
        cal.day_label(F.col(x)).alias(x) if x == "tanggal"
        else F.col(x).cast("bigint").alias(x) if x == "tahun"
        else F.col(x).cast("double").alias(x) if x in ("nominal_transaksi", "biaya_admin")
        else F.col(x)
        for x in VIEW_COLUMNS
    ])


@register
def s11_view_rebuild(spark, sf_dir):
    """The view rebuilt from the tables after an incremental load, totalled per segment and province."""
    return _view_totals(load.rebuild_view(Warehouse(spark, b.incremental_warehouse(spark, sf_dir))))


def _view_totals(view: DataFrame) -> DataFrame:
    return view.groupBy("segmen_nasabah", "provinsi").agg(
        F.sum("nominal_transaksi").cast("double").alias("volume"), F.count("*").alias("n")
    )


@register
def s11_stored_view(spark, sf_dir):
    """The stored view after an incremental load: every row."""
    return _view_out(Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).view())


@register
def t6_view_after_batch(spark, sf_dir):
    """The stored view after an incremental load, totalled per segment and province."""
    return _view_totals(Warehouse(spark, b.incremental_warehouse(spark, sf_dir)).view())


@register
def j5_cube_rows(spark, sf_dir):
    rows = bank(spark, sf_dir)
    return rows.select(
        F.col("tahun").cast("bigint").alias("tahun"), "quarter", "bulan", "hari", day("tanggal"),
        "segmen_nasabah", "jenis_kelamin", "nama_lengkap", "jenis_channel", "nama_channel",
        "region", "provinsi", "kota", "kategori", "nama_merchant", *money("nominal_transaksi", "biaya_admin"),
    )


@register
def p17_level_defaults(spark, sf_dir):
    """Clean facts against a calendar that ends early: missing levels get their defaults."""
    dims = b.clean_dimensions(spark, sf_dir)
    dims["dim_waktu"] = dims["dim_waktu"].filter("tahun < 2001")
    rows = level_rows(b.clean_fact(spark, sf_dir, "tahun", "quarter"), dims, ["tahun", "quarter"])
    out = c.by_level(rows, ["tahun", "quarter"], [c.VOLUME, c.COUNT])
    return out.withColumn("tahun", F.col("tahun").cast("bigint"))


# -- filters ------------------------------------------------------------------
DICED = {
    "tahun": [1997, 1998], "quarter": ["Q1", "Q3"], "channel": ["ATM", "QRIS"],
    "segmen": ["Reguler", "Prioritas"], "kota": ["Bandung", "Medan", "Cirebon", "Surabaya"],
}


@register
def p12_slice(spark, sf_dir):
    rows = bank(spark, sf_dir, "nama_channel", "segmen_nasabah").filter(flt.slice_on("nama_channel", "QRIS"))
    return c.by_level(rows, ["segmen_nasabah"], [c.VOLUME, c.COUNT])


@register
def p13_dice(spark, sf_dir):
    return q.customer_segment(routed(spark, sf_dir, "segmen_nasabah", params=DICED), DICED)


@register
def p14_date_range(spark, sf_dir):
    days = {"start_date": "1997-03-15", "end_date": "1998-02-10"}
    return q.channel_distribution(routed(spark, sf_dir, "nama_channel", params=days), days)


COUNTED = ["segmen_nasabah", "jenis_kelamin", "kategori"]


def _all_counts(rows: DataFrame, params: dict) -> DataFrame:
    return c.by_level(rows.filter(flt.build_filter(params, rows.columns)), COUNTED, [c.VOLUME, c.COUNT])


@register
def p15_unknown_default(spark, sf_dir):
    return _all_counts(routed(spark, sf_dir, *COUNTED), {})


@register
def p15_unknown_with_inclusion(spark, sf_dir):
    chosen = {"segmen": ["Reguler", "Prioritas", "Private", "Unknown"]}
    return _all_counts(routed(spark, sf_dir, *COUNTED, params=chosen), chosen)


@register
def p15_include_unknown(spark, sf_dir):
    return _all_counts(bank(spark, sf_dir, "segmen_nasabah", "jenis_kelamin", "kategori"), {"include_unknown": True})


# -- named queries ------------------------------------------------------------
@register
def q0_filter_options(spark, sf_dir):
    return q.filter_options(cells(spark, sf_dir))


@register
def q1_kpi(spark, sf_dir):
    return q.kpi(cells(spark, sf_dir))


@register
def q1_kpi_mom(spark, sf_dir):
    return q.kpi(cells(spark, sf_dir), {"tahun": [1998], "bulan": ["January"]})


@register
def q1_kpi_mom_quarter(spark, sf_dir):
    return q.kpi(cells(spark, sf_dir), {"tahun": [1998], "bulan": ["April"], "quarter": ["Q2"]})


@register
def q1_kpi_empty(spark, sf_dir):
    return q.kpi(cells(spark, sf_dir), {"tahun": [1900]})


@register
def q2_monthly_trend(spark, sf_dir):
    return q.monthly_trend(cells(spark, sf_dir))


@register
def q2_daily_drilldown(spark, sf_dir):
    return q.monthly_trend(cells(spark, sf_dir), {"tahun": [1998], "bulan": ["April"]})


@register
def q3_channel(spark, sf_dir):
    return q.channel_distribution(cells(spark, sf_dir))


@register
def q4_segment(spark, sf_dir):
    return q.customer_segment(cells(spark, sf_dir))


@register
def q5_category(spark, sf_dir):
    return q.merchant_category(cells(spark, sf_dir))


@register
def q6_top_merchants(spark, sf_dir):
    return q.top_merchants(routed(spark, sf_dir, "kategori", "nama_merchant"), limit=10)


@register
def q7_geographic(spark, sf_dir):
    return q.geographic(cells(spark, sf_dir))


@register
def q8_city_ranking(spark, sf_dir):
    return q.city_ranking(cells(spark, sf_dir))


@register
def q9_gender(spark, sf_dir):
    return q.gender_distribution(cells(spark, sf_dir))


@register
def q10_channel_by_region(spark, sf_dir):
    return q.channel_by_region(cells(spark, sf_dir))


@register
def q11_daily(spark, sf_dir):
    return q.daily_transaction(cells(spark, sf_dir))


@register
def q12_heatmap(spark, sf_dir):
    return q.heatmap(cells(spark, sf_dir))


@register
def q13_segment_gender(spark, sf_dir):
    return q.segment_by_gender(clean(spark, sf_dir, "segmen_nasabah", "jenis_kelamin"))


@register
def q14_city_channel(spark, sf_dir):
    return q.city_by_channel(clean(spark, sf_dir, "kota", "nama_channel"))


def _sample(name: str) -> Query:
    def run(spark, sf_dir):
        out = q.sample_queries()[name](clean(spark, sf_dir, *q.SAMPLE_LEVELS[name]))
        return out.withColumn("tahun", F.col("tahun").cast("bigint")) if "tahun" in out.columns else out

    return run


for _name in ("kpi", "channel", "category", "city", "month", "weekday"):
    QUERIES[f"q15_{_name}"] = _sample(_name)


def _benchmark(name: str) -> Query:
    def run(spark, sf_dir):
        out = q.benchmark_queries()[name][1](clean(spark, sf_dir, *q.BENCHMARK_LEVELS[name]))
        return out.withColumn("tahun", F.col("tahun").cast("bigint")) if "tahun" in out.columns else out

    return run


BENCHMARKS = {
    "q16_kpi": "Q1_KPI", "q16_monthly_trend": "Q2_MonthlyTrend", "q16_channel": "Q3_Channel",
    "q16_segment": "Q4_Segment", "q16_city": "Q5_City", "q16_channel_city": "Q6_ChannelCity", "q16_heatmap": "Q7_Heatmap",
}
for _key, _name in BENCHMARKS.items():
    QUERIES[_key] = _benchmark(_name)


# -- subtotals, pre-aggregation -----------------------------------------------
@register
def a8_drill_down(spark, sf_dir):
    return c.drill_down(clean(spark, sf_dir, *c.HIERARCHIES["Wilayah"]), "provinsi", [c.VOLUME, c.FEE, c.COUNT])


@register
def a9_rollup_time(spark, sf_dir):
    out = c.hierarchy_totals(clean(spark, sf_dir, *c.HIERARCHIES["Waktu"]), "Waktu", [c.VOLUME, c.COUNT])
    return out.select(F.col("tahun").cast("bigint").alias("tahun"), "quarter", "bulan", day("tanggal"),
                      F.col("depth").cast("bigint").alias("depth"), c.VOLUME, c.COUNT)


@register
def a9_cube_geo_channel(spark, sf_dir):
    levels = ["region", "nama_channel", "segmen_nasabah"]
    return c.cross_totals(clean(spark, sf_dir, *levels), levels, [c.VOLUME, c.COUNT])


@register
def a4_average(spark, sf_dir):
    return c.by_level(clean(spark, sf_dir, "kategori", "nama_channel"), ["kategori", "nama_channel"], [c.FEE, c.AVERAGE])


@register
def a9_cuboid_segment(spark, sf_dir):
    """The segment ranking answered from the pre-aggregated cuboid."""
    wh = warehouse(spark, sf_dir)
    parts = [c.cuboid(cube_rows(facts, wh.dimensions())) for facts in wh.day_slices()]
    return q.customer_segment(parts[0] if len(parts) == 1 else stage_parts(parts, "cells"))


@register
def a14_date_bounds(spark, sf_dir):
    return bank(spark, sf_dir, "tanggal").agg(
        cal.day_label(F.min("tanggal")).alias("min_date"), cal.day_label(F.max("tanggal")).alias("max_date")
    )


@register
def s17_cube_refresh(spark, sf_dir):
    """Cells refreshed after a batch was added to a warehouse whose cells were up to date: totals per region and category."""
    wh = Warehouse(spark, b.refreshed_warehouse(spark, sf_dir))
    return c.by_level(wh.cells(), ["region", "kategori"], [c.VOLUME, c.COUNT])


@register
def s17_merchant_months(spark, sf_dir):
    """Every merchant's months in cells that were made before a batch was added, and brought up to date by the router."""
    wh = Warehouse(spark, b.late_warehouse(spark, sf_dir))
    levels = ["kategori", "nama_merchant", "tahun", "bulan"]
    rows = cuboids.route(wh, levels)
    out = c.by_level(rows.filter(flt.build_filter({}, rows.columns)), levels, [c.VOLUME, c.COUNT])
    return out.withColumn("tahun", F.col("tahun").cast("bigint"))


@register
def s17_customers(spark, sf_dir):
    """Volume, fee and count of every customer with its share of the segment, from the customers' roll-up."""
    rows = routed(spark, sf_dir, "segmen_nasabah", "nama_lengkap")
    known = c.by_level(rows.filter(flt.build_filter({}, rows.columns)), ["segmen_nasabah", "nama_lengkap"], [c.VOLUME, c.FEE, c.COUNT])
    return pr.share_within(known, "segmen_nasabah", c.VOLUME)


@register
def s17_chosen_rollups(spark, sf_dir):
    """Cells of every stored roll-up: all must add up to the facts."""
    wh = Warehouse(spark, b.with_cuboids(spark, sf_dir))
    totals = [
        wh.read(stored["table"]).agg(F.sum("nominal_transaksi").cast("double").alias("volume"), F.sum("n_trx").alias("n"), F.lit(stored["table"]).alias("rollup"))
        for stored in wh.cuboids()
    ]
    return reduce(DataFrame.union, totals).groupBy("volume", "n").agg((F.count("*") > 2).alias("several"))


# -- presentation -------------------------------------------------------------
@register
def w3_merchant_rank(spark, sf_dir):
    top = q.top_merchants(routed(spark, sf_dir, "kategori", "nama_merchant"), limit=10)
    return pr.rank_rows(top, [F.col(c.VOLUME).desc(), F.col("nama_merchant")])


@register
def w4_share(spark, sf_dir):
    return pr.share_of_total(q.merchant_category(cells(spark, sf_dir)), c.VOLUME)


@register
def w5_city_channel_share(spark, sf_dir):
    return pr.share_within(q.city_by_channel(cells(spark, sf_dir)), "kota", c.COUNT)


@register
def w6_ratio_to_max(spark, sf_dir):
    return pr.ratio_to_max(q.heatmap(cells(spark, sf_dir)), c.COUNT)


@register
def w6_map_radius(spark, sf_dir):
    return pr.map_radius(q.geographic(cells(spark, sf_dir)), c.VOLUME)


@register
def w8_peak_day(spark, sf_dir):
    days = q.daily_transaction(cells(spark, sf_dir))
    return pr.peak_flag(days, c.COUNT, cal.weekday_index(F.col("hari")))


@register
def w9_mom_series(spark, sf_dir):
    rows = cells(spark, sf_dir)
    months = c.by_level(rows.filter(flt.build_filter({}, rows.columns)), ["tahun", "bulan"], [c.VOLUME, c.FEE, c.COUNT, c.AVERAGE])
    out = pr.month_over_month(months, [c.VOLUME, c.FEE, c.COUNT, c.AVERAGE])
    return out.select(F.col("tahun").cast("bigint").alias("tahun"), "bulan", *[x for x in out.columns if x.endswith("_pct")])


@register
def o7_sorted_table(spark, sf_dir):
    """All merchants by name, last first, with their place."""
    merchants = q.top_merchants(routed(spark, sf_dir, "kategori", "nama_merchant"), limit=None)
    numbered = number_rows(merchants, [F.col("nama_merchant").desc(), F.col("kategori").desc()], "place")
    return pr.sorted_by(numbered, "nama_merchant", descending=True)


# -- statistics ---------------------------------------------------------------
def _by_year(spark, sf_dir):
    return b.table(spark, sf_dir, "lineitem").withColumn("tahun", F.year("l_shipdate").cast("bigint"))


@register
def a18_growth_rate(spark, sf_dir):
    return st.growth_rate(b.table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_quantity", "l_extendedprice")


@register
def a20_run_stats(spark, sf_dir):
    return st.run_statistics(_by_year(spark, sf_dir), ["tahun"], "l_extendedprice")


@register
def a20_run_stats_overall(spark, sf_dir):
    """All rows as one group: the ranks are still found in parallel."""
    return st.run_statistics(b.table(spark, sf_dir, "lineitem"), [], "l_extendedprice")


@register
def a21_nearest_rank_quartiles(spark, sf_dir):
    return st.nearest_rank_quartiles(_by_year(spark, sf_dir), ["tahun"], "l_extendedprice")


@register
def a22_throughput(spark, sf_dir):
    loads = _by_year(spark, sf_dir).groupBy("tahun").agg(
        F.count("*").alias("rows_loaded"), F.sum("l_quantity").alias("etl_time_sec")
    )
    return loads.withColumn("throughput_rps", st.throughput(F.col("rows_loaded"), F.col("etl_time_sec")))


def _scale_of(line):
    return F.element_at(F.array(*[F.lit(s) for s in v.SCALES]), (line % 4 + 1).cast("int"))


def _metric_frames(spark, sf_dir):
    """Metric tables with the line items as measurements: scale by line number, queries by flag and status."""
    rows = b.table(spark, sf_dir, "lineitem").select(
        _scale_of(F.col("l_linenumber")).alias("scale"),
        F.col("l_linestatus").alias("query"),
        F.when(F.col("l_returnflag") == "A", "simple").when(F.col("l_returnflag") == "N", "rollup").otherwise("pivot").alias("complexity"),
        F.year("l_shipdate").alias("y"), "l_quantity", "l_extendedprice",
    )
    sizes = rows.groupBy("scale").agg(F.count("*").alias("n_rows"))
    etl = rows.groupBy("scale", "y").agg(
        F.count("*").alias("rows_total_in_db"), (F.sum("l_quantity") / 1000).alias("etl_time_sec")
    ).withColumn("throughput_rps", st.throughput(F.col("rows_total_in_db"), F.col("etl_time_sec")))
    runs = st.run_statistics(rows, ["scale"], "l_extendedprice").join(sizes, "scale")
    cube = runs.select(
        "scale", "n_rows", (F.col("median_ms") / 1000).alias("median_build_sec"),
        (F.col("min_ms") / 1000).alias("min_build_sec"), (F.col("max_ms") / 1000).alias("max_build_sec"),
        (F.col("n_rows") / 10).alias("median_memory_mb"),
    )
    query = st.run_statistics(rows, ["scale", "query", "complexity"], "l_extendedprice").join(sizes, "scale")
    return etl, cube, query


@register
def a19_class_average(spark, sf_dir):
    _, _, query = _metric_frames(spark, sf_dir)
    out = st.class_average(query, "complexity", "scale", "median_ms", "n_rows")
    return out.withColumn("avg_median_ms", F.bround("avg_median_ms", 3))


@register
def w7_bottleneck_rank(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("layer"))
    rows = b.table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return st.rank_by_growth(st.growth_rate(rows, ["layer"], "l_quantity", "l_extendedprice"))


@register
def e4_scalability_report(spark, sf_dir):
    return scalability.bottlenecks(*_metric_frames(spark, sf_dir))


@register
def e4_kept_up_report(spark, sf_dir):
    """The report after metrics came in two appends, from what is kept of each metric file."""
    folder = new_folder(spark, "metrics")
    etl, cube, query = _metric_frames(spark, sf_dir)
    etl = etl.withColumn("mode", F.lit("incremental")).withColumn("rows_loaded", F.col("rows_total_in_db"))
    query = query.withColumns({"p25_ms": F.col("min_ms"), "p75_ms": F.col("max_ms")})
    early = {"etl_benchmark": (etl, F.col("y") < 1998), "cube_benchmark": (cube, F.col("scale") == v.SCALES[0]), "query_benchmark": (query, F.col("query") == "F")}
    for part in (lambda c: c, lambda c: ~c):
        for kind, (rows, first) in early.items():
            metrics.append_metrics(rows.filter(part(first)), folder, kind)
        scalability.keep_up(spark, folder)
    return scalability.kept_bottlenecks(spark, folder)


@register
def f7_round_half_even(spark, sf_dir):
    """Prices per thousand and eighths of quantities at two places: by the value of the bits, exact ties to even."""
    rows = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), (F.col("l_extendedprice").cast("double") / 1000).alias("price"), (F.col("l_quantity").cast("double") / 8).alias("eighths"))
    return rows.select("l_orderkey", "l_linenumber", round_binary(F.col("price"), 2).alias("price"), round_binary(F.col("eighths"), 2).alias("eighths"))


@register
def e4_query_summary(spark, sf_dir):
    _, _, query = _metric_frames(spark, sf_dir)
    return scalability.query_summary(query)


@register
def s14_metrics_append(spark, sf_dir):
    """Metric rows appended in two steps, read back, and summarised."""
    folder = new_folder(spark, "metrics")
    etl, _, _ = _metric_frames(spark, sf_dir)
    rows = etl.withColumn("mode", F.lit("incremental")).withColumn("rows_loaded", F.col("rows_total_in_db"))
    metrics.append_metrics(rows.filter("y < 1998"), folder, "etl_benchmark")
    metrics.append_metrics(rows.filter("y >= 1998"), folder, "etl_benchmark")
    return scalability.etl_summary(metrics.read_metrics(spark, folder, "etl_benchmark"))
