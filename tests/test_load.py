"""Sources, full and incremental loads, the file stream, the generator and the exports."""

import json
import os

import pytest
from pyspark.sql import functions as F

from lumbung.fixed_values import CALENDAR_FILE, CUSTOMER_FILE, MERCHANT_FILE, TRANSACTION_FILE
from lumbung.operators import dimensions as d
from lumbung.operators import quality
from lumbung.operators.star import cube_rows
from lumbung.plans import load, queries, upkeep
from lumbung.sources import csv_source, export, staging, synthetic
from lumbung.sources.warehouse import CELLS, COPIES, FACT, REJECTS, VIEW, Warehouse
from lumbung.streaming.batches import load_available

TRANSACTIONS = "trx_id;tgl_transaksi;nasabah_code;channel;merchant_code;kota;nominal;biaya_admin"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def sources(folder, transactions, customers=True, merchants=True, days=True):
    put(folder, TRANSACTION_FILE, "\n".join([TRANSACTIONS, *transactions]) + "\n")
    if customers:
        put(folder, CUSTOMER_FILE, " nasabah_code ;nama_lengkap; jenis_kelamin;tanggal_lahir;segmen_nasabah\n"
                                   "N-1;Andi;M;05/12/1980;prio\nN-2;Budi;Pria;31/02/1999;\nN-1;Twice;P;;RETAIL\n")
    if merchants:
        put(folder, MERCHANT_FILE, "merchant_code;nama_merchant;kategori\r\nMCH-1;Toko 1;Market\r\nMCH-2;Toko 2;\r\nMCH-3;Toko 3;F&B")
    if days:
        put(folder, CALENDAR_FILE, "waktu_id,tanggal,hari,bulan,tahun,quarter\n" + "".join(
            f"202604{x:02d},2026-04-{x:02d},{n},April,2026,Q2\n"
            for x, n in ((13, "Monday"), (14, "Tuesday"), (15, "Wednesday"), (16, "Thursday"), (17, "Friday"))
        ))
    return str(folder)


FIRST_DAY = [
    "T1;13-04-2026;N-1;atm;MCH-1;BDG;1.234.567,89;2500",
    "T2;14-04-2026;N-2; bifast ;MCH-2;SBY;100;",
    "T2;14-04-2026;N-1;ATM;MCH-1;Bandung;999;0",          # copy
    "T3;14-04-2026;N-9;EDC;MCH-9;Cirebon;5;0",            # nobody known
    "T4;13-04-2026;N-1;ATM;MCH-1;Bandung;-5.000;0",       # negative
    "T5;31-13-2026;N-1;ATM;MCH-1;Bandung;10;0",           # no such date
    "T6;01-01-2020;N-1;ATM;MCH-1;Bandung;10;0",           # not in the calendar
    "T7;14-04-2026;;;;;7;0",                              # no references
]
SECOND_DAY = [
    "T8;14-04-2026;N-1;ATM;MCH-1;Bandung;10;0",           # not after the mark
    "T9;15-04-2026;N-1;QRIS;MCH-1;Bogor;20;0",
    "T10;16-04-2026;N-3;LIVIN;MCH-4;Medan;30;0",
]


def facts_of(spark, root):
    return sorted(tuple(r)[:6] + (str(r.nominal_transaksi),) for r in Warehouse(spark, root).facts().collect())


def everything(spark, root):
    wh = Warehouse(spark, root)
    tables = {**wh.dimensions(), FACT: wh.facts(), VIEW: wh.view(), REJECTS: wh.read(REJECTS)}
    return {name: sorted(map(str, df.collect())) for name, df in tables.items()}


@pytest.fixture
def two_days(tmp_path):
    first = sources(tmp_path / "day1", FIRST_DAY)
    second = sources(tmp_path / "day2", SECOND_DAY, merchants=False, days=False)
    put(tmp_path / "day2", CUSTOMER_FILE, "nasabah_code,nama_lengkap,jenis_kelamin,tanggal_lahir,segmen_nasabah\nN-2,Changed,L,,\nN-3,Citra,Female,01/02/1990,Private\n")
    return first, second, str(tmp_path / "wh")


# -- sources ------------------------------------------------------------------
def test_separator_and_quirks(spark, tmp_path):
    folder = sources(tmp_path / "s", FIRST_DAY)
    assert csv_source.sniff(spark, f"{folder}/{CALENDAR_FILE}")[0] == ","
    assert csv_source.sniff(spark, f"{folder}/{MERCHANT_FILE}") == (";", ["merchant_code", "nama_merchant", "kategori"])
    merchants = csv_source.read_source(spark, folder, MERCHANT_FILE).orderBy("src_seq").collect()
    assert [(r.merchant_code, r.kategori) for r in merchants] == [("MCH-1", "Market"), ("MCH-2", None), ("MCH-3", "F&B")]
    customers = csv_source.read_source(spark, folder, CUSTOMER_FILE, trim_header=True)
    assert customers.columns[:5] == ["nasabah_code", "nama_lengkap", "jenis_kelamin", "tanggal_lahir", "segmen_nasabah"]


def test_ties_go_to_the_semicolon(spark, tmp_path):
    put(tmp_path, "one.csv", "only\nx\n")
    assert csv_source.sniff(spark, str(tmp_path / "one.csv"))[0] == ";"


def test_missing_sources(spark, tmp_path):
    assert csv_source.read_source(spark, str(tmp_path), CUSTOMER_FILE) is None
    with pytest.raises(FileNotFoundError):
        load.read_folder(spark, str(tmp_path))


@pytest.mark.parametrize("files", [1, 5])
def test_source_order_survives_splitting(spark, tmp_path, files):
    n = 3_000
    wanted = [f"row {i:05d}" for i in range(n)]
    for part in range(files):
        chunk = wanted[part * n // files:(part + 1) * n // files]
        put(tmp_path / "src.csv", f"part-{part:05d}.csv", "a;b\n" + "".join(f"{x};{'x' * 50}\n" for x in chunk))
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "10000"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, x in keys.items():
        spark.conf.set(k, x)
    try:
        df = csv_source.read_source(spark, str(tmp_path), "src.csv")
        assert df.rdd.getNumPartitions() > 1
        rows = df.collect()
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    assert len({r.src_seq for r in rows}) == n
    assert [r.a for r in sorted(rows, key=lambda r: r.src_seq)] == wanted


def test_staging_uses_the_shared_folder(spark):
    assert staging.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# -- full load ----------------------------------------------------------------
def test_full_load(spark, two_days):
    first, _, root = two_days
    load.load_full(spark, first, root)
    wh = Warehouse(spark, root)
    assert sorted(map(tuple, wh.dimension(d.CHANNEL).collect())) == [
        (0, "UNKNOWN", "Unknown"), (1, "ATM", "Digital"), (2, "BI_FAST", "Digital"), (3, "EDC", "Digital")
    ]
    customers = {r.nasabah_id: (r.nasabah_code, r.nama_lengkap, r.jenis_kelamin, str(r.tanggal_lahir), r.segmen_nasabah) for r in wh.dimension(d.CUSTOMER).collect()}
    assert customers == {
        0: ("UNKNOWN", "Unknown", "U", "None", "Unknown"),
        1: ("N-1", "Andi", "L", "1980-12-05", "Prioritas"), 2: ("N-2", "Budi", "U", "None", "Reguler"),
    }
    assert wh.dimension(d.AREA).count() == 18 and wh.dimension(d.MERCHANT).count() == 4
    assert facts_of(spark, root) == [
        (1, 20260413, 1, 1, 2, 1, "1234567.89"), (2, 20260414, 2, 2, 3, 2, "100.00"),
        (3, 20260414, 0, 0, 17, 0, "5.00"), (4, 20260414, 0, 0, 0, 0, "7.00"),
    ]
    reasons = {r.trx_id: (r.reason, r.tgl_transaksi) for r in wh.read(REJECTS).collect()}
    assert reasons == {
        "T4": ("negative_amount", "13-04-2026"), "T5": ("invalid_date", "31-13-2026"), "T6": ("not_in_calendar", "01-01-2020")
    }
    view = {r.fact_id: (r.nama_lengkap, r.kota, r.kategori_merchant, r.tahun) for r in wh.view().collect()}
    assert view[2] == ("Budi", "Surabaya", "Unknown", 2026) and view[3] == ("Unknown", "Cirebon", "Unknown", 2026)
    assert sorted(map(str, load.rebuild_view(wh).collect())) == sorted(map(str, wh.view().select(*load.rebuild_view(wh).columns).collect()))


def test_copies_are_listed_beside_the_rejects(spark, two_days):
    """Rows in = facts + rejects + copies, and copies are no rejects; also after the batches were packed."""
    first, second, root = two_days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    for packed in (False, True):
        if packed:
            upkeep.compact(spark, root)
        wh = Warehouse(spark, root)
        assert wh.read(REJECTS).filter("reason = 'duplicate'").count() == 0
        assert [tuple(r) for r in wh.read(COPIES).collect()] == [("T2", "14-04-2026", 20260414, "duplicate", "full")]
        told = sorted((r.batch_id, r.trx_id, r.reason) for r in wh.not_loaded().collect())
        assert told == [("day2", "T8", "late"), ("full", "T2", "duplicate"), ("full", "T4", "negative_amount"),
                        ("full", "T5", "invalid_date"), ("full", "T6", "not_in_calendar")]
        assert wh.facts().count() + len(told) == len(FIRST_DAY) + len(SECOND_DAY)


def test_full_load_replaces_and_renumbers(spark, two_days):
    first, _, root = two_days
    load.load_full(spark, first, root)
    before, version = everything(spark, root), Warehouse(spark, root).version
    load.load_full(spark, first, root)
    wh = Warehouse(spark, root)
    assert everything(spark, root) == before and wh.version != version
    wh.drop_old_versions()
    assert everything(spark, root) == before and len([x for x in os.listdir(root) if x.startswith("v-")]) == 1


def test_full_load_without_optional_sources(spark, tmp_path):
    folder = sources(tmp_path / "s", FIRST_DAY, customers=False, merchants=False)
    load.load_full(spark, folder, str(tmp_path / "wh"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.dimension(d.CUSTOMER).count() == 1 and wh.dimension(d.MERCHANT).count() == 1
    assert wh.facts().filter("nasabah_id = 0 AND merchant_id = 0").count() == 4


# -- incremental load ---------------------------------------------------------
def test_incremental_load(spark, two_days):
    first, second, root = two_days
    load.load_full(spark, first, root)
    record = load.load_batch(spark, second, root, "day2")
    assert record["rows_loaded"] == 2 and record["mark"] == 20260414 and record["mark_after"] == 20260416
    wh = Warehouse(spark, root)
    names = {r.nasabah_id: r.nama_lengkap for r in wh.dimension(d.CUSTOMER).collect()}
    assert names == {0: "Unknown", 1: "Andi", 2: "Budi", 3: "Citra"}            # known members never change
    assert {r.nama_channel: r.channel_id for r in wh.dimension(d.CHANNEL).collect()}.items() >= {"QRIS": 4, "LIVIN": 5}.items()
    assert facts_of(spark, root)[4:] == [(5, 20260415, 1, 4, 18, 1, "20.00"), (6, 20260416, 3, 5, 6, 0, "30.00")]
    assert [tuple(r) for r in wh.read(REJECTS, ["day2"]).select("trx_id", "reason").collect()] == [("T8", "late")]


def test_a_batch_can_be_loaded_again(spark, two_days):
    first, second, root = two_days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    before = everything(spark, root)
    load.load_batch(spark, second, root, "day2")
    assert everything(spark, root) == before
    record = load.load_batch(spark, second, root, "again")                       # same rows, another name
    assert record["rows_loaded"] == 0
    after = everything(spark, root)
    assert {k: x for k, x in after.items() if k != REJECTS} == {k: x for k, x in before.items() if k != REJECTS}


def test_a_changed_earlier_batch_adds_what_is_new(spark, two_days):
    first, second, root = two_days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    load.load_batch(spark, second, root, "day3")
    before = everything(spark, root)
    assert load.load_batch(spark, second, root, "day2")["rows_loaded"] == 2       # unchanged: left alone
    for folder, _, names in os.walk(second):
        for name in names:
            os.utime(os.path.join(folder, name), (1, 1))
    assert load.load_batch(spark, second, root, "day2")["rows_loaded"] == 0       # written anew, says the same
    assert everything(spark, root) == before
    with open(os.path.join(second, TRANSACTION_FILE), "a") as file:
        file.write("T9;15-04-2026;N-1;QRIS;MCH-1;Bogor;21;0\nT11;15-04-2026;N-3;ATM;MCH-2;Medan;40;0\nT11;15-04-2026;N-3;ATM;MCH-2;Medan;41;0\n")
        file.write("T12;14-04-2026;N-1;ATM;MCH-1;Bandung;5;0\n")
    added = load.load_batch(spark, second, root, "day2")
    assert (added["batch_id"], added["rows_loaded"]) == ("day2.add2", 1)
    wh = Warehouse(spark, root)
    assert {(r.trx_id, r.reason) for r in wh.read(REJECTS, ["day2.add2"]).collect()} == {("T9", "changed_copy"), ("T11", "duplicate"), ("T12", "late")}
    assert {k: x for k, x in everything(spark, root).items() if k not in (FACT, VIEW, REJECTS)} == {k: x for k, x in before.items() if k not in (FACT, VIEW, REJECTS)}
    ids = sorted(r.fact_id for r in wh.facts().select("fact_id").collect())
    assert ids == list(range(1, len(ids) + 1))
    assert wh.facts(["day2.add2"]).select("fact_id", "nasabah_id").first() == (max(ids), 3)
    grown = everything(spark, root)
    assert load.load_batch(spark, second, root, "day2")["rows_loaded"] == 2       # nothing new since
    assert everything(spark, root) == grown


def test_an_addition_that_did_not_finish_is_loaded_again(spark, two_days, monkeypatch):
    first, second, root = two_days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    load.load_batch(spark, second, root, "day3")
    with open(os.path.join(second, TRANSACTION_FILE), "a") as file:
        file.write("T11;15-04-2026;N-3;ATM;MCH-2;Medan;40;0\n")
    with monkeypatch.context() as m:
        def fails(self, record):
            if "rows_loaded" in record:
                raise OSError("the driver is gone")
            save(self, record)

        save = Warehouse.save_load
        m.setattr(Warehouse, "save_load", fails)
        with pytest.raises(OSError):
            load.load_batch(spark, second, root, "day2")
    assert load.load_batch(spark, second, root, "day2")["rows_loaded"] == 1
    ids = sorted(r.fact_id for r in Warehouse(spark, root).facts().collect())
    assert ids == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("name", ["unknown", "full", "", "a/b", "../x"])
def test_names_that_cannot_be_batches(spark, two_days, name):
    with pytest.raises(ValueError):
        load.load_batch(spark, two_days[1], two_days[2], name)


def test_an_unfinished_batch_is_finished_first(spark, two_days):
    first, second, root = two_days
    load.load_full(spark, first, root)
    load.load_batch(spark, second, root, "day2")
    wanted = everything(spark, root)
    wh = Warehouse(spark, root)
    # As after a crash between the dimensions and the facts.
    wh.set_open("day2")
    wh.drop(FACT, "day2")
    wh.drop(VIEW, "day2")
    with pytest.raises(RuntimeError):
        load.load_batch(spark, second, root, "day3")
    assert load.refresh_cube(wh).agg(F.sum("n_trx")).first()[0] == 4
    load.load_batch(spark, second, root, "day2")
    assert everything(spark, root) == wanted


def test_incremental_load_into_nothing(spark, two_days):
    first, _, root = two_days
    load.load_batch(spark, first, root, "day1")
    wh = Warehouse(spark, root)
    assert wh.dimension(d.CUSTOMER).filter("nasabah_id = 0").first().nasabah_code == "UNKNOWN"
    assert sorted(r.nasabah_id for r in wh.dimension(d.CUSTOMER).collect()) == [0, 1, 2]
    assert wh.facts().count() == 4


def test_cube_cells_follow_the_loads(spark, two_days):
    first, second, root = two_days
    load.load_full(spark, first, root)
    assert load.refresh_cube(Warehouse(spark, root)).agg(F.sum("n_trx")).first()[0] == 4
    load.load_batch(spark, second, root, "day2")
    wh = Warehouse(spark, root)
    cells, rows = load.refresh_cube(wh), cube_rows(wh.facts(), wh.dimensions())
    assert wh.read(CELLS, ["day2"]).agg(F.sum("n_trx")).first()[0] == 2
    for params in ({}, {"include_unknown": True}, {"kota": ["Cirebon", "Bandung"]}):
        assert queries.kpi(cells, params).collect() == queries.kpi(rows, params).collect()


def test_export_is_ordered(spark, two_days, tmp_path):
    first, _, root = two_days
    load.load_full(spark, first, root)
    export.export_all(Warehouse(spark, root), str(tmp_path / "out"))
    back = csv_source.read_source(spark, str(tmp_path / "out"), "dim_wilayah.csv").orderBy("src_seq").collect()
    assert [int(r.wilayah_id) for r in back] == list(range(18)) and back[17].kota == "Cirebon"


# -- generated batches --------------------------------------------------------
@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    paths = synthetic.write_batches(spark, str(folder), batches=3, n_customers=50, n_merchants=10, n_transactions=2000, seed=7)
    return str(folder), paths


def test_generated_dirt_rates(spark, generated):
    rows = csv_source.read_mandatory(spark, generated[1][0], TRANSACTION_FILE)
    n = rows.count()
    first = rows.dropDuplicates(["trx_id"])
    assert first.count() == 2000 and 2000 < n < 2100
    share = lambda cond: first.filter(cond).count() / 2000
    assert 0.01 < share("tgl_transaksi IS NULL") < 0.035 and 0.01 < share("tgl_transaksi = '31-13-2026'") < 0.035
    assert 0.015 < share("nominal LIKE '-%'") < 0.05 and 0.16 < share("nominal LIKE '%,%'") < 0.24
    blank = "int(nasabah_code IS NULL) + int(channel IS NULL) + int(merchant_code IS NULL) + int(kota IS NULL)"
    assert 0.01 < share(f"{blank} = 1") < 0.035 and share(f"{blank} > 1") == 0
    assert 0.03 < share("biaya_admin IS NULL") < 0.07


def test_generated_batches_reconcile(spark, generated, tmp_path):
    """Stream the batches; every batch: rows in = loaded + copies + rejects, members as issued."""
    landing, paths = generated
    root, checkpoint = str(tmp_path / "wh"), str(tmp_path / "checkpoint")
    load_available(spark, landing, root, checkpoint).awaitTermination()
    wh = Warehouse(spark, root)
    assert wh.batches() == ["batch_01", "batch_02", "batch_03"] and wh.done(CELLS) == set(wh.batches())
    for nth, path in enumerate(paths):
        batch = f"batch_{nth + 1:02d}"
        raw = csv_source.read_mandatory(spark, path, TRANSACTION_FILE)
        first = quality.input_quality(raw, ["src_seq"]).first()
        rejects = wh.read(REJECTS, [batch]).count()
        assert wh.read(FACT, [batch]).count() + rejects + first.duplicate_removed == first.total_input_rows
        assert wh.read(REJECTS, [batch]).filter("reason IN ('late', 'not_in_calendar')").count() == 0
        assert wh.read("dim_nasabah", [batch]).count() == 50 and wh.read("dim_merchant", [batch]).count() == 10
    ids = wh.facts().agg(F.min("fact_id"), F.max("fact_id"), F.count_distinct("fact_id"), F.count("*")).first()
    assert ids[0] == 1 and ids[1] == ids[2] == ids[3]
    assert wh.dimension(d.CHANNEL).count() == 6 and wh.dimension(d.AREA).count() == 17 and wh.dimension(d.CALENDAR).count() == 10957
    for dim in d.DIMENSIONS:                                                     # every key has its member
        assert wh.facts().join(wh.dimension(dim), dim.id_col, "left_anti").count() == 0
    before = everything(spark, root)
    load_available(spark, landing, root, checkpoint).awaitTermination()          # nothing new
    load_available(spark, landing, root, str(tmp_path / "lost")).awaitTermination()  # checkpoint lost: all again
    assert everything(spark, root) == before


def test_load_records_are_plain_json(spark, two_days):
    first, _, root = two_days
    record = load.load_full(spark, first, root)
    assert json.loads(json.dumps(record))["rows_loaded"] == 4


def test_a_job_drops_only_what_it_staged(spark):
    outside = staging.stage(spark.range(3), "outside")
    inside = []
    with staging.job(spark):
        staging.together(*[lambda: inside.append(staging.stage(spark.range(5), "inside"))] * 2)
        assert [df.count() for df in inside] == [5, 5]
        paths = [df.inputFiles()[0].rsplit("/", 1)[0] for df in inside]
    assert outside.count() == 3
    assert not any(os.path.exists(p.removeprefix("file:").replace("//", "/")) for p in paths)
