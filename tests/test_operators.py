"""Keys, de-duplication, members, facts: small frames and hot keys."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumbung.operators import dimensions as d
from lumbung.operators import facts as f
from lumbung.operators import keys, star
from lumbung.operators.dedupe import keep_first
from lumbung.operators.keys import max_or_zero, number_rows, number_source_rows

RAW = ("trx_id string, tgl_transaksi string, nasabah_code string, channel string, merchant_code string, "
       "kota string, nominal string, biaya_admin string, src_seq bigint")


def raw(spark, *rows):
    base = ("T0", "13-04-2026", "N-1", "ATM", "MCH-1", "Bandung", "100", "0")
    names = [c.split()[0] for c in RAW.split(", ")][:-1]
    full = [tuple({**dict(zip(names, base)), **row}.values()) + (i,) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, RAW)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_copy_decides(spark):
    rows = raw(spark, {"trx_id": "T1", "nominal": "-5"}, {"trx_id": "T1", "nominal": "7"}, {"trx_id": "T2"})
    assert [r.trx_id for r in f.cleanse(rows, ["src_seq"], "src_seq").collect()] == ["T2"]


def test_null_ids_are_one_transaction(spark):
    rows = raw(spark, {"trx_id": None, "nominal": "1"}, {"trx_id": None, "nominal": "2"})
    kept = f.cleanse(rows, ["src_seq"], "src_seq").collect()
    assert [int(r.nominal_transaksi) for r in kept] == [1]


def test_unreadable_amount_counts_as_zero_and_stays(spark):
    kept = f.cleanse(raw(spark, {"nominal": "abc"}), ["src_seq"], "src_seq").collect()
    assert int(kept[0].nominal_transaksi) == 0


def test_one_fault_per_row(spark):
    rows = f.typed_transactions(raw(spark, {"nominal": "-1", "tgl_transaksi": None}, {"tgl_transaksi": "x"}, {}), "src_seq")
    assert [r[0] for r in rows.orderBy("src_seq").select(f.fault()).collect()] == ["negative_amount", "invalid_date", None]


def test_amounts_out_of_range_are_faults(spark):
    rows = f.typed_transactions(raw(spark, {"nominal": "12.345.678.901.234.567,00"}, {"biaya_admin": "1e30"}, {"nominal": "-0,004"}), "src_seq")
    got = [r[0] for r in rows.orderBy("src_seq").select(f.fault()).collect()]
    assert got == ["amount_out_of_range", "amount_out_of_range", "negative_amount"]


def test_keep_first_cuts_hot_keys_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    first = keep_first(hot, ["k"], ["id"])
    text = plan(first)
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle
    assert first.count() == 20_001 and first.filter("k = 'hot'").first().id == 0


@pytest.mark.parametrize("hot", [False, True])
def test_number_rows_is_dense_and_in_order(spark, hot):
    values = [(7 if hot and i % 3 == 0 else random.Random(i).randint(0, 500), i) for i in range(5_000)]
    numbered = number_rows(spark.createDataFrame(values, "a int, b int").repartition(7), ["a", "b"], "id", 100)
    got = sorted(tuple(r) for r in numbered.select("id", "a", "b").collect())
    assert got == [(101 + i, a, b) for i, (a, b) in enumerate(sorted(values))]


def test_numbers_run_on_over_groups_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(keys, "GROUP_BITS", 1)
    rows = spark.range(50).select((F.shiftleft(F.col("id") % 9, keys.ROW_BITS) + F.col("id")).alias("src_seq"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = number_source_rows(rows, "id")
        assert "BroadcastHashJoin" not in plan(numbered)
        assert [r.id for r in numbered.orderBy("src_seq").collect()] == list(range(1, 51))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_unknown_facts_are_spread_and_keep_their_member(spark):
    fact = spark.range(4000).select(
        F.lit(20260101).cast("bigint").alias("waktu_id"), (F.col("id") % 2).alias("nasabah_id"), F.lit(0).cast("bigint").alias("merchant_id"),
        F.lit(Decimal("1.00")).alias("nominal_transaksi"), F.lit(Decimal("0.00")).alias("biaya_admin"), F.col("id").alias("fact_id"),
    )
    dims = {
        "dim_nasabah": spark.createDataFrame([(0, "Unknown", "U", "Unknown"), (1, "Ani", "P", "Private")],
                                             "nasabah_id bigint, nama_lengkap string, jenis_kelamin string, segmen_nasabah string"),
        "dim_merchant": spark.createDataFrame([(0, "Unknown Merchant", "Unknown")], "merchant_id bigint, nama_merchant string, kategori string"),
    }
    joined = star._joined(fact, dims, ["nama_lengkap", "jenis_kelamin", "nama_merchant"])
    got = {tuple(r) for r in joined.groupBy("nama_lengkap", "jenis_kelamin", "nama_merchant").count().collect()}
    assert got == {("Unknown", "U", "Unknown Merchant", 2000), ("Ani", "P", "Unknown Merchant", 2000)}
    cells = star.level_rows(fact, dims, ["jenis_kelamin"])
    assert {(r.jenis_kelamin, r.n_trx) for r in cells.collect()} == {("U", 2000), ("P", 2000)}


def test_number_source_rows_follows_blocks(spark):
    seqs = [(block << 33) | row for block in range(-1, 5) for row in range(0, 200, 1 + abs(block))]
    flags = [(s, i % 4 != 0) for i, s in enumerate(seqs)]
    random.Random(1).shuffle(flags)
    df = spark.createDataFrame(flags, "src_seq bigint, ok boolean").repartition(5)
    got = {r.src_seq: r.id for r in number_source_rows(df, "id", 10, only="ok").collect()}
    kept = sorted(s for s, ok in flags if ok)
    assert {s: i for s, i in got.items() if i is not None} == {s: 11 + n for n, s in enumerate(kept)}
    assert sum(i is None for i in got.values()) == len(flags) - len(kept)


def test_max_or_zero(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert max_or_zero(empty, "id").first().id == 0
    assert max_or_zero(spark.range(4), "id").first().id == 3


def test_unlisted_channel_is_a_member_but_not_a_key(spark):
    rows = f.typed_transactions(raw(spark, {"trx_id": "A", "channel": "EDC"}, {"trx_id": "B", "channel": " atm"}), "src_seq")
    seen = d.members_in_transactions(rows)
    channels = d.with_unknown(d.CHANNEL, number_source_rows(d.channel_members(seen), "channel_id"))
    assert {tuple(r) for r in channels.collect()} == {(1, "EDC", "Digital"), (2, "ATM", "Digital"), (0, "UNKNOWN", "Unknown")}
    nobody = spark.createDataFrame([], d.CUSTOMER.schema), spark.createDataFrame([], d.MERCHANT.schema)
    areas = d.with_unknown(d.AREA, number_source_rows(d.area_members(seen), "wilayah_id"))
    keyed = f.look_up_keys(rows, *nobody, channels, areas)
    assert {r.trx_id: (r.channel_id, r.nasabah_id) for r in keyed.collect()} == {"A": (0, 0), "B": (2, 0)}


def test_unlisted_city_is_a_key(spark):
    rows = f.typed_transactions(
        raw(spark, {"trx_id": "A", "kota": "Cirebon"}, {"trx_id": "B", "kota": None}, {"trx_id": "C", "kota": "BDG"}), "src_seq"
    )
    areas = d.with_unknown(d.AREA, number_source_rows(d.area_members(d.members_in_transactions(rows)), "wilayah_id"))
    named = {r.kota: r for r in areas.collect()}
    assert named["Jakarta Selatan"].wilayah_id == 1 and named["Jayapura"].wilayah_id == 16
    assert tuple(named["Cirebon"]) == (17, "Cirebon", "Unknown", "Unknown") and named["Unknown"].wilayah_id == 0
    none = spark.createDataFrame([], d.CUSTOMER.schema), spark.createDataFrame([], d.MERCHANT.schema)
    keyed = f.look_up_keys(rows, *none, spark.createDataFrame([], d.CHANNEL.schema), areas)
    assert {r.trx_id: r.wilayah_id for r in keyed.collect()} == {"A": 17, "B": 0, "C": 2}


def test_first_of_a_repeated_code_is_the_member(spark):
    rows = spark.createDataFrame(
        [("N-1", "Andi", "M", "01/02/1990", "prio", 0), ("N-1", "Other", "P", None, None, 1), ("N-2", "Budi", "Pria", "31/02/1999", None, 2)],
        "nasabah_code string, nama_lengkap string, jenis_kelamin string, tanggal_lahir string, segmen_nasabah string, src_seq bigint",
    )
    got = {r.nasabah_code: (r.nama_lengkap, r.jenis_kelamin, str(r.tanggal_lahir), r.segmen_nasabah) for r in d.customer_members(rows).collect()}
    assert got == {"N-1": ("Andi", "L", "1990-02-01", "Prioritas"), "N-2": ("Budi", "U", "None", "Reguler")}


def test_skewed_lookup_gives_whole_results_without_broadcast(spark):
    """A third of the rows on one merchant and a third on none, joined by sort-merge."""
    n = 6_000
    rows = spark.range(n).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("trx_id"),
        F.when(F.col("id") % 3 == 0, "MCH-UNKNOWN").when(F.col("id") % 3 == 1, "MCH-5")
        .otherwise(F.concat(F.lit("MCH-"), (F.col("id") % 50).cast("string"))).alias("merchant_code"),
        *[F.concat(F.lit("x"), F.col("id").cast("string")).alias(x) for x in ("nasabah_code", "nama_channel", "kota")],
    )
    merchants = spark.range(40).select(F.col("id").alias("merchant_id"), F.concat(F.lit("MCH-"), F.col("id").cast("string")).alias("merchant_code"))
    empty = {x.table: spark.createDataFrame([], x.schema) for x in (d.CUSTOMER, d.CHANNEL, d.AREA)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keyed = f.look_up_keys(rows, empty["dim_nasabah"], merchants, empty["dim_channel"], empty["dim_wilayah"])
        assert "SortMergeJoin" in plan(keyed) and "Cartesian" not in plan(keyed) and "NestedLoop" not in plan(keyed)
        got = {r.merchant_id: r["count"] for r in keyed.groupBy("merchant_id").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want: dict[int, int] = {}
    for i in range(n):
        key = 0 if i % 3 == 0 else 5 if i % 3 == 1 else (i % 50 if i % 50 < 40 else 0)
        want[key] = want.get(key, 0) + 1
    assert got == want


def test_high_water_mark_is_strict(spark):
    loaded = spark.createDataFrame([(20260410,), (20260412,)], "waktu_id bigint")
    batch = spark.createDataFrame([(20260412,), (20260413,)], "waktu_id bigint")
    assert [r[0] for r in f.newer_than(batch, f.high_water_mark(loaded)).collect()] == [20260413]
    assert [r[0] for r in f.not_newer_than(batch, f.high_water_mark(loaded)).collect()] == [20260412]
    assert f.newer_than(batch, f.high_water_mark(loaded.limit(0))).count() == 2
