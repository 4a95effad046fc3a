"""Full and incremental loads: dimensions, then facts, then the reporting view."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions.parsing import key_year
from lumbung.operators import dimensions as d
from lumbung.operators import facts as f
from lumbung.operators.cube import collapse, cuboid
from lumbung.operators.dedupe import keep_first, later_copies
from lumbung.operators.keys import block_parts, number_source_rows
from lumbung.operators.star import cube_rows, wide_view
from lumbung.sources import csv_source, files
from lumbung.sources.staging import by_hash, discard, job, slices, stage, stage_parts, together
from lumbung.sources.warehouse import BASE_BATCH, CELL_COLUMNS, CELLS, COPIES, FACT, MEMBER_REJECTS, PACKED, REJECTS, ROWS, VIEW, Warehouse

FULL_BATCH = "full"
_BATCH_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.\-]*")
_SOURCE_FILES = (v.TRANSACTION_FILE, v.CUSTOMER_FILE, v.MERCHANT_FILE, v.CALENDAR_FILE)


@dataclass(frozen=True)
class Sources:
    """Raw source frames, all text, with ``src_seq``. Only the transactions must be there."""

    transactions: DataFrame
    customers: DataFrame | None = None
    merchants: DataFrame | None = None
    calendar: DataFrame | None = None


def read_folder(spark: SparkSession, folder: str) -> Sources:
    return Sources(
        transactions=csv_source.read_mandatory(spark, folder, v.TRANSACTION_FILE),
        customers=csv_source.read_source(spark, folder, v.CUSTOMER_FILE, trim_header=True),
        merchants=csv_source.read_source(spark, folder, v.MERCHANT_FILE),
        calendar=csv_source.read_source(spark, folder, v.CALENDAR_FILE),
    )


def load_full(spark: SparkSession, folder: str, root: str) -> dict:
    """Replace the warehouse by what the folder holds. Readers switch over when all of it is written."""
    sources = read_folder(spark, folder)
    wh = Warehouse.fresh(spark, root)
    record = _load(wh, sources, FULL_BATCH, incremental=False)
    wh.publish()
    return record


def load_batch(spark: SparkSession, folder: str, root: str, batch_id: str) -> dict:
    """Add a batch folder: new members, then transactions after the high-water mark, then their view rows.

    A batch that did not finish is loaded again with its first marks. A finished one whose files are
    the same is left alone. If its files changed, the last batch is replaced. Behind an earlier one
    later batches have taken the ids, so only what is new in it is added, as a batch of its own
    (``<batch>.add<n>``): transactions whose content the batch did not hold, with ids after all others
    and judged by the mark the batch had. What it held before stays as it was loaded, also where a
    file no longer has it; a changed copy of a transaction is rejected (``changed_copy``).
    """
    if not _BATCH_ID.fullmatch(batch_id) or batch_id in (BASE_BATCH, FULL_BATCH):
        raise ValueError(f"{batch_id!r} cannot name a batch")
    sources = read_folder(spark, folder)
    wh = Warehouse(spark, root)
    if wh.version is None:
        wh = Warehouse.fresh(spark, root)
        wh.publish()
    seen = {name: files.versions(spark, f"{folder}/{name}") for name in _SOURCE_FILES}
    known = wh.load_record(batch_id)
    if known and "rows_loaded" in known and wh.open_batch() != batch_id:
        if known.get("files") == seen:
            return known
        if wh.batches()[-1] != batch_id:
            added = _load(wh, sources, _addition(wh, batch_id), incremental=True, seen=seen, parent=known)
            wh.save_load(known | {"files": seen})
            return added
    return _load(wh, sources, batch_id, incremental=True, seen=seen)


def _addition(wh: Warehouse, batch: str) -> str:
    """Id of the next addition to a batch; of the last one if that did not finish."""
    started = [b for b in wh.batches() if re.fullmatch(re.escape(batch) + r"\.add\d+", b)]
    return started[-1] if started and started[-1] == wh.open_batch() else f"{batch}.add{len(started) + 1}"


def _load(
    wh: Warehouse, sources: Sources, batch: str, incremental: bool, seen: dict | None = None, parent: dict | None = None
) -> dict:
    record = _start(wh, batch) | {"files": seen}
    record["max_ids_after"] = dict(record["max_ids"])
    # What this batch may see: the Unknown members and the batches started before it.
    earlier = [BASE_BATCH, *wh.batches()[: record["sequence"] - 1]]
    for derived in {CELLS, *(c["table"] for c in wh.cuboids())}:
        wh.drop(derived, batch)
    with job(wh.spark):
        # The text is parsed once; members and facts are both made from the typed rows.
        raw, kept = sources.transactions, ["src_seq"]
        if incremental:
            raw, kept = raw.withColumn("content", f.content(raw.columns)), [*kept, "content"]
        typed = stage(f.typed_transactions(raw, *kept), "typed")
        changed, mark, owner = None, record["mark"] if incremental else None, batch
        if parent is not None:
            owner, mark = parent["batch_id"], parent["mark"]
            typed, changed = _news(typed, wh.read(ROWS, earlier).filter(F.col("parent") == owner))
        _load_dimensions(wh, sources, typed, record, earlier)
        if incremental:
            held = typed if changed is None else typed.unionByName(changed)
            wh.write(ROWS, batch, held.select("trx_id", "content", F.lit(owner).alias("parent")))
        _load_facts(wh, typed, record, wh.dimensions([*earlier, batch]), mark, changed)
    wh.save_load(record)
    wh.set_open(None)
    return record


def _news(typed: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Transactions a batch did not hold yet, and changed copies of ones it held; both in few rows, by their content's hash."""
    parts = slices(typed.sparkSession, max(typed.count(), stored.count()))
    unseen = stage_parts([
        typed.filter(part).join(stored.filter(part).select("content").distinct(), "content", "left_anti").select(*typed.columns)
        for part in by_hash("content", parts)
    ], "unseen")
    discard(typed)
    same = F.col("trx_id").eqNullSafe(F.col("_held"))

    def split(how: str, name: str) -> DataFrame:
        return stage_parts([
            unseen.filter(part).join(stored.filter(part).select(F.col("trx_id").alias("_held")).distinct(), same, how)
            for part in by_hash("trx_id", parts)
        ], name)

    news, changed = split("left_anti", "news"), split("left_semi", "changed")
    discard(unseen)
    return news, changed


def _start(wh: Warehouse, batch: str) -> dict:
    """The batch's load record. Its marks are fixed when it first starts, so a retry sees the same ones."""
    unfinished = wh.open_batch()
    if unfinished not in (None, batch):
        raise RuntimeError(f"batch {unfinished} did not finish; load it again before {batch}")
    wh.set_open(batch)
    started = wh.batches()
    if batch in started:
        return wh.load_record(batch)
    last = wh.load_record(started[-1]) if started else {"mark_after": 0, "max_ids_after": {}}
    record = {
        "batch_id": batch, "sequence": len(started) + 1, "mark": last["mark_after"], "max_ids": last["max_ids_after"]
    }
    wh.save_load(record)
    return record


def _load_dimensions(wh: Warehouse, sources: Sources, typed: DataFrame, record: dict, earlier: list[str]) -> None:
    batch = record["batch_id"]
    seen = stage(d.members_in_transactions(typed), "seen")
    members = [(d.CHANNEL, d.channel_members(seen)), (d.AREA, d.area_members(seen))]
    if sources.customers is not None:
        members.append((d.CUSTOMER, d.customer_members(sources.customers)))
    if sources.merchants is not None:
        members.append((d.MERCHANT, d.merchant_members(sources.merchants)))

    def load_members(dim: d.Dimension, rows: DataFrame) -> None:
        fresh = d.new_members(rows, wh.read(dim.table, earlier), dim.key)
        start = record["max_ids"].get(dim.table, 0)
        wh.write(dim.table, batch, number_source_rows(fresh, dim.id_col, start).select(*dim.columns))
        record["max_ids_after"][dim.table] = start + wh.read(dim.table, [batch]).count()

    def load_calendar() -> None:
        days = d.calendar_members(sources.calendar)
        fresh = d.new_members(days, wh.read(d.CALENDAR.table, earlier), d.CALENDAR.key)
        wh.write(d.CALENDAR.table, batch, fresh.select(*d.CALENDAR.columns))

    def list_copies() -> None:
        # Rows behind the first of their code in this batch; a code of an earlier batch is no fault.
        named = [(d.CUSTOMER, sources.customers), (d.MERCHANT, sources.merchants)]
        copies = [
            later_copies(rows.select(F.col(dim.key).alias("code"), "src_seq"), "code").select(
                F.lit(dim.table).alias("dimension"), "code", F.lit("duplicate").alias("reason"))
            for dim, rows in named if rows is not None
        ]
        if copies:
            wh.write(MEMBER_REJECTS, batch, reduce(DataFrame.unionByName, copies))

    steps = [*[partial(load_members, *m) for m in members], list_copies]
    together(*steps, *([load_calendar] if sources.calendar is not None else []))


def judged_transactions(typed: DataFrame, calendar: DataFrame, mark: int | None) -> DataFrame:
    """De-duplicated transactions with their natural keys and ``reason`` (null = loadable).

    The reason is the first of: negative amount, unreadable date, day not in the
    calendar, day not after the mark.
    """
    first = keep_first(typed.drop("channel_member", "city_member", "content"), ["trx_id"], ["src_seq"])
    days = calendar.select("waktu_id", F.lit(True).alias("_known_day"))
    reason = f.fault().when(F.col("_known_day").isNull(), "not_in_calendar")
    if mark is not None:
        reason = reason.when(F.col("waktu_id") <= mark, "late")
    # Only rejects need their raw text; facts travel on as keys and numbers.
    return first.join(days, "waktu_id", "left").withColumn("reason", reason).select(
        "src_seq",
        "reason",
        F.col("reason").isNull().alias("_accepted"),
        "waktu_id", "nasabah_code", "merchant_code", "nama_channel", "kota", "nominal_transaksi", "biaya_admin",
        F.when(F.col("reason").isNotNull(), F.col("trx_id")).alias("trx_id"),
        F.when(F.col("reason").isNotNull(), F.col("tgl_transaksi")).alias("tgl_transaksi"),
    )


def _load_facts(
    wh: Warehouse, typed: DataFrame, record: dict, dims: dict[str, DataFrame], mark: int | None, changed: DataFrame | None = None
) -> None:
    batch = record["batch_id"]
    start = record["max_ids"].get(FACT, 0)
    told = ["trx_id", "tgl_transaksi", "waktu_id", "reason"]
    # Slices of whole transactions, then of whole file blocks: a table is dropped once the next is made of it,
    # so the disk holds few of them beside the shuffles of one slice.
    n = slices(wh.spark, typed.count())
    dealt = [typed.filter(part) for part in by_hash("trx_id", n)]
    copies = [
        later_copies(rows.select("trx_id", "tgl_transaksi", "waktu_id", "src_seq"), "trx_id").withColumn("reason", F.lit("duplicate")).select(*told)
        for rows in dealt
    ]
    if changed is None:
        wh.write(COPIES, batch, *copies)
    else:
        # The quality report counts the copies in a batch's files. It knows none of an addition, so these are rejects.
        copies = [stage_parts(copies, "copies"), changed.withColumn("reason", F.lit("changed_copy")).select(*told)]
    judged = stage_parts([judged_transactions(rows, dims["dim_waktu"], mark) for rows in dealt], "judged")
    discard(typed)
    with job(wh.spark):
        keyed = f.look_up_keys(
            judged, dims["dim_nasabah"], dims["dim_merchant"], dims["dim_channel"], dims["dim_wilayah"], row="src_seq"
        ).drop("nasabah_code", "merchant_code", "nama_channel", "kota")
        blocks = block_parts(judged, n)
        numbered = number_source_rows(keyed, "fact_id", start, only="_accepted", parts=blocks)
        discard(judged)
        facts = numbered.filter("_accepted")
        wh.write(FACT, batch, *[
            facts.filter(part).select(*f.FACT_COLUMNS, key_year(F.col("waktu_id")).alias("tahun")) for part in blocks
        ])
        wh.write(REJECTS, batch, numbered.filter("NOT _accepted").select(*told), *(copies if changed is not None else []))
    rows, newest = wh.read(FACT, [batch]).agg(F.count("*"), F.max("waktu_id")).first()
    # Members never change and facts keep their ids, so the view rows of earlier
    # batches stay valid: only this batch's are added.
    wh.write(VIEW, batch, *[wide_view(facts, dims) for facts in wh.fact_slices(batch, (start, start + rows))])
    record["rows_loaded"] = rows
    record["mark_after"] = max(record["mark"], newest or 0)
    record["max_ids_after"][FACT] = start + rows


def rebuild_view(wh: Warehouse) -> DataFrame:
    """The whole view from the current tables."""
    return wide_view(wh.facts(), wh.dimensions())


# -- the cube -----------------------------------------------------------------
def refresh_cube(wh: Warehouse) -> DataFrame:
    """The cube's cells, brought up to date: only batches that have none yet are read."""
    skip = wh.done(CELLS) | {wh.open_batch()}
    together(*[partial(_write_cells, wh, batch) for batch in wh.batches() if batch not in skip])
    return wh.cells()


def forget_cube(wh: Warehouse) -> None:
    """Drop all cells; the next refresh makes them anew."""
    for batch in {*wh.done(CELLS), PACKED}:
        wh.drop(CELLS, batch)


def _write_cells(wh: Warehouse, batch: str) -> None:
    dims = wh.dimensions()
    # Names are collapsed before the joins: the two large dimensions travel as ids and short codes.
    dims["dim_nasabah"] = collapse(dims["dim_nasabah"], "nama_lengkap")
    dims["dim_merchant"] = collapse(dims["dim_merchant"], "nama_merchant")
    # A cell is of one day, so slices of whole days have whole cells.
    wh.write(CELLS, batch, *[cuboid(cube_rows(facts, dims)).select(*CELL_COLUMNS) for facts in wh.day_slices(batch)])
    wh.mark_done(CELLS, batch)
