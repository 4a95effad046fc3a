"""Roll-ups by size and routing, packing of batches, parts with different headers."""

import pytest
from pyspark.sql import functions as F

from lumbung.fixed_values import TRANSACTION_FILE
from lumbung.operators.cube import VOLUME, by_level
from lumbung.operators.filters import build_filter
from lumbung.operators.lattice import candidates, cheapest, choose
from lumbung.operators.star import cube_rows
from lumbung.plans import cuboids, load, queries, upkeep
from lumbung.sources import csv_source, files
from lumbung.sources.warehouse import CELLS, FACT, PACKED, Warehouse
from tests.test_load import FIRST_DAY, SECOND_DAY, everything, put, sources


def test_greedy_choice():
    sizes = {frozenset(k): n for k, n in {"a": 10, "b": 50, "ab": 300, "abc": 900, "c": 2}.items()}
    workload = {frozenset("a"): 1.0, frozenset("b"): 1.0, frozenset("c"): 0.1}
    assert choose(sizes, workload, 1000, limit=1) == [frozenset("ab")]          # saves 700 twice
    assert choose(sizes, workload, 1000, limit=3) == [frozenset("ab"), frozenset("a"), frozenset("b")]
    assert choose(sizes, workload, 1000, stored=[frozenset("abc")], limit=9)[-1] == frozenset("c")
    assert frozenset("abc") not in choose(sizes, workload, 1000, limit=9)        # over half of the facts
    assert choose(sizes, {}, 1000) == [] and choose({}, workload, 1000) == []


def test_cheapest_and_candidates():
    sizes = {frozenset("a"): 10, frozenset("ab"): 30, frozenset("abc"): 30}
    assert cheapest(sizes, "a") == frozenset("a") and cheapest(sizes, "b") == frozenset("ab") and cheapest(sizes, "d") is None
    assert candidates(["a", "b"]) == {frozenset("a"), frozenset("b"), frozenset("ab")}


@pytest.fixture
def days(tmp_path):
    first = sources(tmp_path / "day1", FIRST_DAY)
    second = sources(tmp_path / "day2", SECOND_DAY, customers=False, merchants=False, days=False)
    third = sources(tmp_path / "day3", ["T20;17-04-2026;N-2;ATM;MCH-3;Medan;70;5"], customers=False, merchants=False, days=False)
    return first, second, third, str(tmp_path / "wh")


def rows_of(df):
    return sorted(map(str, df.collect()))


def choose_by_hand(wh):
    """The tables here are so small that no roll-up is under half of the facts."""
    finer = [["kategori", "nama_merchant", "tanggal"], ["segmen_nasabah", "nama_lengkap", "kota", "tahun"], ["kategori", "nama_merchant"]]
    wh.save_cuboids([{"table": CELLS, "levels": sorted(cuboids.CELL_LEVELS), "rows": 100}] + [
        {"table": f"cuboid_{n}", "levels": sorted(levels), "rows": 90 - n} for n, levels in enumerate(finer, 1)])


PARAMS = [{}, {"include_unknown": True}, {"kategori": ["Market", "Unknown"], "start_date": "2026-04-14"}, {"kota": ["Bandung"], "tahun": [2026]}]


@pytest.mark.parametrize("step", ["late", "packed"])
def test_routed_queries_equal_the_facts(spark, days, step):
    first, second, third, root = days
    load.load_full(spark, first, root)
    choose_by_hand(Warehouse(spark, root))
    cuboids.refresh(Warehouse(spark, root))
    load.load_batch(spark, second, root, "day2")
    load.load_batch(spark, third, root, "day3")
    if step == "packed":
        load.refresh_cube(Warehouse(spark, root))
        cuboids.refresh(Warehouse(spark, root))
        upkeep.compact(spark, root)
    wh = Warehouse(spark, root)
    facts = cube_rows(wh.facts(), wh.dimensions())
    for params in PARAMS:
        got = queries.top_merchants(cuboids.route(wh, ["kategori", "nama_merchant"], params), params, limit=None)
        assert rows_of(got) == rows_of(queries.top_merchants(facts, params, limit=None)), params
        levels = ["nama_lengkap", "segmen_nasabah"]
        routed = cuboids.route(wh, levels, params)
        got = by_level(routed.filter(build_filter(params, routed.columns)), levels, [VOLUME])
        assert rows_of(got) == rows_of(by_level(facts.filter(build_filter(params)), levels, [VOLUME])), params


def test_a_routed_query_reads_no_fact(spark, days):
    first, *_, root = days
    load.load_full(spark, first, root)
    wh = Warehouse(spark, root)
    assert [c["table"] for c in cuboids.plan(wh)] == [CELLS]
    choose_by_hand(wh)
    cuboids.refresh(wh)
    read = queries.top_merchants(cuboids.route(wh, ["kategori", "nama_merchant"])).inputFiles()
    assert read and not any(FACT in file or "dim_" in file for file in read)


def test_packing_keeps_every_row(spark, days):
    first, second, third, root = days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    for nth in range(3):
        load.load_batch(spark, third, root, f"more{nth}")
    choose_by_hand(Warehouse(spark, root))
    cuboids.refresh(Warehouse(spark, root))
    load.refresh_cube(Warehouse(spark, root))
    before, cells = everything(spark, root), rows_of(by_level(Warehouse(spark, root).cells(), ["kategori", "kota"], [VOLUME]))
    old = Warehouse(spark, root).version
    told = upkeep.compact(spark, root)
    wh = Warehouse(spark, root)
    assert wh.version == told["version"] != old and told["files_after"] < told["files_before"]
    assert everything(spark, root).keys() == before.keys()
    for table, rows in everything(spark, root).items():
        assert rows == before[table], table
    assert rows_of(by_level(wh.cells(), ["kategori", "kota"], [VOLUME])) == cells
    assert {r.batch_id for r in wh.read(FACT).select("batch_id").distinct().collect()} == {"full", "day2", "more0"}
    assert wh.facts(["day2"]).count() == 2 and wh.facts([PACKED]).count() == wh.facts().count()
    assert wh.packed() == ["full", "day2", "more0", "more1"] and files.exists(spark, f"{root}/{old}")
    upkeep.vacuum(spark, root)
    assert not files.exists(spark, f"{root}/{old}") and everything(spark, root).keys() == before.keys()
    again = upkeep.compact(spark, root)
    assert again["version"] == wh.version and again["files_after"] == again["files_before"]


def test_loads_go_on_after_packing(spark, days):
    first, second, third, root = days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    load.load_batch(spark, third, root, "day3")
    upkeep.compact(spark, root)
    with open(f"{second}/{TRANSACTION_FILE}", "a") as file:
        file.write("T11;15-04-2026;N-2;ATM;MCH-2;Medan;40;0\n")
    assert load.load_batch(spark, second, root, "day2")["rows_loaded"] == 1
    wh = Warehouse(spark, root)
    ids = sorted(r.fact_id for r in wh.facts().collect())
    assert ids == list(range(1, len(ids) + 1))
    assert load.refresh_cube(wh).agg(F.sum("n_trx")).first()[0] == len(ids)
    load.forget_cube(wh)
    assert load.refresh_cube(wh).agg(F.sum("n_trx")).first()[0] == len(ids)
    upkeep.compact(spark, root)
    assert sorted(r.fact_id for r in Warehouse(spark, root).facts().collect()) == ids
    assert Warehouse(spark, root).cells().agg(F.sum("n_trx")).first()[0] == len(ids)


def test_an_open_batch_is_not_packed(spark, days):
    first, second, _, root = days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    Warehouse(spark, root).set_open("day2")
    with pytest.raises(RuntimeError, match="day2"):
        upkeep.compact(spark, root)


def test_parts_with_other_headers(spark, tmp_path):
    folder = tmp_path / "s"
    put(folder / TRANSACTION_FILE, "part-0.csv", "trx_id;nominal;kota\nT1;1,5;Bandung\n")
    put(folder / TRANSACTION_FILE, "part-1.csv", 'kota,nominal,trx_id,extra\nMedan,"2,5",T2,x\n')
    put(folder / TRANSACTION_FILE, "part-2.csv", "trx_id;nominal;kota\nT3;;SBY\n")
    put(folder / TRANSACTION_FILE, "part-3.csv", "")
    put(folder / TRANSACTION_FILE, "part-4.csv", "kota;trx_id\nSolo;T4\n")
    df = csv_source.read_mandatory(spark, str(folder), TRANSACTION_FILE)
    assert df.columns == ["trx_id", "nominal", "kota", "extra", "src_seq"]
    got = [tuple(r)[:4] for r in df.orderBy("src_seq").collect()]
    assert got == [("T1", "1,5", "Bandung", None), ("T2", "2,5", "Medan", "x"), ("T3", None, "SBY", None), ("T4", None, "Solo", None)]
    put(folder / TRANSACTION_FILE, "part-5.csv", "kota;kota\nSolo;T4\n")
    with pytest.raises(ValueError, match="twice"):
        csv_source.read_mandatory(spark, str(folder), TRANSACTION_FILE)
