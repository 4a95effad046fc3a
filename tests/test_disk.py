"""What loads leave on disk while they run: passes in slices, shuffle files that go with their write, compressed sources."""

import contextlib
import gzip
import re
import threading
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from contract import bindings
from contract.oracle import ORACLE
from contract.queries import QUERIES
from lumbung.fixed_values import MERCHANT_FILE, TRANSACTION_FILE
from lumbung.plans import load
from lumbung.sources import csv_source, staging
from lumbung.sources.warehouse import COPIES, REJECTS, ROWS, VIEW, Warehouse
from tests.test_load import FIRST_DAY, SECOND_DAY, everything, sources
from tests.test_registered import in_order


@contextlib.contextmanager
def slices_of(spark, rows):
    spark.conf.set("spark.lumbung.slice.rows", str(rows))
    try:
        yield
    finally:
        spark.conf.unset("spark.lumbung.slice.rows")


def shuffles(spark):
    """Ids of the shuffles whose files are on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return set(re.findall(r"shuffle_(\d+)_", files.mkString(" ")))


@contextlib.contextmanager
def most_shuffles(spark):
    """[the largest number of new shuffles whose files were on disk at once]"""
    before, most, over = shuffles(spark), [0], threading.Event()

    def watch():
        while not over.wait(0.05):
            most[0] = max(most[0], len(shuffles(spark) - before))

    thread = threading.Thread(target=watch)
    thread.start()
    try:
        yield most
    finally:
        over.set()
        thread.join()


def left_behind(spark, before):
    for _ in range(50):  # they are removed in the background
        if not shuffles(spark) - before:
            return set()
        time.sleep(0.1)
    return shuffles(spark) - before


def star(spark, folder, n=60):
    """The driver's tables that sources are made of; transaction ids repeat."""
    at = F.col("id")
    spark.range(8).select(at.alias("c_custkey"), F.concat(F.lit("C"), at.cast("string")).alias("c_name"), (at % 5).cast("int").alias("c_nationkey"),
                          F.when(at % 4 == 0, "MACHINERY").otherwise("BUILDING").alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
    spark.range(9).select(at.alias("p_partkey"), F.concat(F.lit("P"), at.cast("string")).alias("p_name"),
                          F.when(at % 3 == 0, "PROMO").otherwise("STANDARD").alias("p_type")).write.parquet(f"{folder}/part.parquet")
    spark.range(30).select(at.alias("o_orderkey"), (at % 8).alias("o_custkey"), F.when(at % 2 == 0, "1-URGENT").otherwise("2-HIGH").alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
    spark.range(n).select(
        (at * 7 % 25).alias("l_orderkey"), (at % 2 + 1).cast("int").alias("l_linenumber"), (at % 9).alias("l_partkey"), at.alias("l_suppkey"),
        F.lit(1.0).alias("l_quantity"), (at * 10.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"), F.lit(0.1).alias("l_tax"),
        F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.date_add(F.lit("1998-01-01").cast("date"), (at * 37 % 1500).cast("int")).cast("timestamp").alias("l_shipdate"),
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def told(spark, root):
    wh = Warehouse(spark, root)
    rest = {name: sorted(map(str, wh.read(name).collect())) for name in (COPIES, ROWS)}
    return everything(spark, root) | rest


@pytest.fixture
def days(tmp_path):
    return sources(tmp_path / "day1", [*FIRST_DAY, *[f"T{30 + n};15-04-2026;N-1;ATM;MCH-2;Bandung;{n};0" for n in range(9)]]), sources(tmp_path / "day2", SECOND_DAY, days=False)


# -- full load ------------------------------------------------------------------
def test_a_write_takes_its_shuffle_files_along(spark):
    before = shuffles(spark)
    rows = staging.stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counted")
    assert not left_behind(spark, before)
    assert rows.count() == 7


def test_a_full_load_leaves_no_shuffle_files(spark, tmp_path, days):
    before = shuffles(spark)
    load.load_full(spark, days[0], str(tmp_path / "wh"))
    # Those of counts the driver asks for hold a row per task.
    assert len(left_behind(spark, before)) <= 12


def test_a_full_load_in_slices_is_the_same(spark, tmp_path, days):
    load.load_full(spark, days[0], str(tmp_path / "whole"))
    with slices_of(spark, 3):
        load.load_full(spark, days[0], str(tmp_path / "sliced"))
        assert len(Warehouse(spark, str(tmp_path / "sliced")).fact_slices()) == 5
    assert told(spark, str(tmp_path / "sliced")) == told(spark, str(tmp_path / "whole"))


def test_compressed_parts_are_read_by_their_header(spark, tmp_path):
    folder = tmp_path / MERCHANT_FILE
    folder.mkdir()
    for name, text in {"part-0.csv.gz": "", "part-1.csv.gz": "merchant_code;nama_merchant\nM1;A\nM2;B\n", "part-2.csv.gz": "nama_merchant,merchant_code\nC,M3\n"}.items():
        (folder / name).write_bytes(gzip.compress(text.encode()))
    rows = csv_source.read_source(spark, str(tmp_path), MERCHANT_FILE).orderBy("src_seq").collect()
    assert [(r.merchant_code, r.nama_merchant) for r in rows] == [("M1", "A"), ("M2", "B"), ("M3", "C")]


def test_sources_in_slices_keep_their_order(spark, tmp_path):
    sf_dir = star(spark, tmp_path / "sf")
    want = [r.trx_id for r in bindings.raw_transactions(spark, sf_dir).orderBy("src_seq").collect()]
    with slices_of(spark, 9):
        bindings.write_folder(spark, sf_dir, str(tmp_path / "src"), bindings.customers_lines(spark, sf_dir), None, None, None)
    rows = csv_source.read_mandatory(spark, str(tmp_path / "src"), TRANSACTION_FILE).orderBy("src_seq").collect()
    assert len({r.src_seq >> 33 for r in rows}) > 5 and [r.trx_id for r in rows] == want


# -- cells, roll-ups and queries ---------------------------------------------------
def cell_rows(spark, root):
    wh = Warehouse(spark, root)
    tables = {"cells": wh.cells(), **{s["table"]: wh.read(s["table"]).drop("batch_id") for s in wh.cuboids()}}
    return {name: sorted(map(str, rows.collect())) for name, rows in tables.items()}


def test_cells_in_slices_are_the_same(spark, tmp_path, days):
    roots = [str(tmp_path / name) for name in ("whole", "sliced")]
    for root, rows in zip(roots, (10**6, 2)):
        load.load_full(spark, days[0], root)
        with slices_of(spark, rows):
            before = shuffles(spark)
            load.refresh_cube(Warehouse(spark, root))
            kept = left_behind(spark, before)
            parts = Warehouse(spark, root).day_slices()
    assert len(parts) > 1 and sum(rows.count() for rows in parts) == Warehouse(spark, roots[1]).facts().count()
    assert len(kept) <= 4
    assert cell_rows(spark, roots[1]) == cell_rows(spark, roots[0])


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    return star(spark, tmp_path_factory.mktemp("driver"))


@pytest.mark.parametrize("name", [
    "e2_changed_rejects", "p14_date_range", "p13_dice", "t2_channels_incremental", "w5_city_channel_share", "a9_cuboid_segment",
    "e1_member_rejects", "q6_top_merchants", "p15_include_unknown", "s17_chosen_rollups", "o7_sorted_table", "s17_customers",
])
def test_queries_in_slices(spark, small, name, monkeypatch):
    """By the oracle's rows, with the shuffles of one write on disk at once however many passes there were."""
    monkeypatch.setattr(load, "together", lambda *steps: [step() for step in steps])
    with slices_of(spark, 25), most_shuffles(spark) as most:
        df = QUERIES[name](spark, small)
    con = duckdb.connect()
    for table in ("customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet/*.parquet'")
    result = con.execute(ORACLE[name])
    # Of a table this small fewer roll-ups are worth storing, with slices or without.
    order, columns = [c[0] for c in result.description], sorted(c for c in df.columns if c != "several")
    want = [tuple(row[order.index(c)] for c in columns) for row in result.fetchall()]
    assert in_order([tuple(row) for row in df.select(*columns).collect()]) == in_order(want)
    assert most[0] <= 8
