"""Upkeep of a warehouse that grows by many small batches: packing and removal of old versions."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.cube import stored_cells
from lumbung.sources import files
from lumbung.sources.staging import together
from lumbung.sources.warehouse import CELLS, PACKED, SCHEMAS, Warehouse

SUMS = ("nominal_transaksi", "biaya_admin", "n_trx")


def compact(spark: SparkSession, root: str, keep: int = 1) -> dict:
    """Pack all batches but the last ``keep`` into few files, in a new version that CURRENT is renamed to.

    Tables kept by year are packed by year and sorted by day, into files of Spark's advisory partition
    size (spark.sql.adaptive.advisoryPartitionSizeInBytes). Rows remember their batch, so a batch can
    still be read, re-made or added to. Cells of packed batches are added up: a cell is one row again.
    Readers see the old version or the new one; the old one stays until ``vacuum``. Nothing is changed
    when there is nothing to pack, and a run that fails leaves a version nobody reads.
    """
    wh = Warehouse(spark, root)
    if wh.open_batch():
        raise RuntimeError(f"batch {wh.open_batch()} did not finish; load it again before packing")
    started = wh.batches()
    packed, last = started[: len(started) - keep], started[max(0, len(started) - keep):]
    before = files.size(spark, f"{wh.root}/{wh.version}")
    if not set(packed) - set(wh.packed()):
        return {"version": wh.version, "files_before": before[0], "files_after": before[0]}
    new = Warehouse(spark, root, f"v-{uuid.uuid4().hex[:12]}")
    new.save_cuboids(wh.cuboids())
    new.save_packed(packed)
    derived = [c["table"] for c in wh.cuboids() if c["table"] != CELLS] + [CELLS]
    plain = [t for t in SCHEMAS if t not in derived]
    together(
        *[partial(_pack_rows, wh, new, table, last) for table in plain],
        *[partial(_pack_cells, wh, new, table, packed, last) for table in derived],
    )
    for batch in started:
        new.save_load(wh.load_record(batch))
    # Loads are not locked out while this runs; what they added would be lost with the switch.
    if wh.batches() != started or wh.open_batch() or files.read_text(spark, f"{wh.root}/CURRENT") != wh.version:
        raise RuntimeError("the warehouse changed while it was packed; nothing was published")
    new.publish()
    return {"version": new.version, "files_before": before[0], "files_after": files.size(spark, f"{new.root}/{new.version}")[0]}


def _pack_rows(wh: Warehouse, new: Warehouse, table: str, last: list[str]) -> None:
    if not files.exists(wh.spark, wh.path(table)):
        return
    rows = wh.read(table)
    old = rows.filter(~F.col("batch_id").isin(last)).withColumnRenamed("batch_id", "source_batch")
    new.write(table, PACKED, old, pack=True)
    _copy(wh, new, table, rows, last)


def _pack_cells(wh: Warehouse, new: Warehouse, table: str, packed: list[str], last: list[str]) -> None:
    """Cells of the packed batches added up; a table that lacks one of them is left to the next refresh."""
    done = wh.done(table)
    if not set(packed) <= done:
        return
    rows = wh.read(table)
    levels = [c for c in rows.columns if c not in (*SUMS, "batch_id")]
    new.write(table, PACKED, stored_cells(rows.filter(~F.col("batch_id").isin(last)), levels).select(*levels, *SUMS), pack=True)
    _copy(wh, new, table, rows, [b for b in last if b in done])
    for batch in [b for b in (*packed, *last) if b in done]:
        new.mark_done(table, batch)


def _copy(wh: Warehouse, new: Warehouse, table: str, rows: DataFrame, batches: list[str]) -> None:
    for batch in batches:
        if files.exists(wh.spark, f"{wh.path(table)}/batch_id={batch}"):
            new.write(table, batch, rows.filter(F.col("batch_id") == batch).drop("batch_id"))


def vacuum(spark: SparkSession, root: str) -> None:
    """Remove all versions but the current one; run it when no reader is left on them."""
    Warehouse(spark, root).drop_old_versions()
