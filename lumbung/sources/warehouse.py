"""The warehouse: Parquet tables under one folder, one sub-folder per loaded batch.

    <root>/CURRENT                              name of the version in use
    <root>/<version>/<table>/batch_id=<b>/...   rows a batch brought
    <root>/<version>/_loads/<n>-<b>.json        marks before and after a batch, the n-th started
    <root>/<version>/_open                      the batch being loaded
    <root>/<version>/_done/<table>/<b>          derived tables: batches that are complete
    <root>/<version>/_cuboids.json              roll-ups that are stored beside the cells
    <root>/<version>/<table>/batch_id=_packed   rows of batches packed together, with their batch
    <root>/<version>/_packed.json               which batches those are

A full load writes a new version and then switches CURRENT, so readers never see
a half-built warehouse. A batch only ever overwrites its own folders, so running
it again after a failure, or on purpose, leaves the same rows.
"""

from __future__ import annotations

import json
import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.operators.dimensions import DIMENSIONS, Dimension, unknown_member
from lumbung.operators.facts import FACT_SCHEMA
from lumbung.operators.star import VIEW_COLUMNS
from lumbung.sources import files
from lumbung.sources.staging import by_range, shuffles_freed, slices, together

FACT, VIEW, REJECTS = "fact_transaksi", "mvw_dashboard_transaksi", "rejects"
# Rows behind the first of their transaction in a batch's files. An addition lists its own among its rejects.
COPIES = "transaction_copies"
# The facts summed up to the levels most queries use (operators.cube.cuboid).
CELLS = "cube_cells"
# The content of the transactions a batch brought, by which a later change of its files is judged.
ROWS = "source_rows"
MEMBER_REJECTS = "member_rejects"
# Where packed batches lie.
PACKED = "_packed"
# What was there before any batch: the Unknown members.
BASE_BATCH = "unknown"

VIEW_SCHEMA = (
    "fact_id bigint, tanggal date, bulan string, tahun int, nama_lengkap string, segmen_nasabah string, "
    "jenis_kelamin string, nama_channel string, kota string, provinsi string, nama_merchant string, "
    "kategori_merchant string, nominal_transaksi decimal(18,2), biaya_admin decimal(18,2)"
)
SCHEMAS = {
    **{d.table: d.schema for d in DIMENSIONS},
    FACT: FACT_SCHEMA,
    VIEW: VIEW_SCHEMA,
    CELLS: "tahun int, quarter string, bulan string, hari string, tanggal date, segmen_nasabah string, "
           "jenis_kelamin string, jenis_channel string, nama_channel string, region string, provinsi string, "
           "kota string, kategori string, nama_lengkap string, nama_merchant string, unknown_in int, "
           "nominal_transaksi decimal(28,2), biaya_admin decimal(28,2), n_trx bigint",
    REJECTS: "trx_id string, tgl_transaksi string, waktu_id bigint, reason string",
    COPIES: "trx_id string, tgl_transaksi string, waktu_id bigint, reason string",
    ROWS: "trx_id string, content string, parent string",
    MEMBER_REJECTS: "dimension string, code string, reason string",
}
CELL_COLUMNS = [part.split()[0] for part in SCHEMAS[CELLS].split(", ")]
_CELL_TYPES = dict(part.split(" ", 1) for part in SCHEMAS[CELLS].split(", "))
BY_YEAR = {FACT, VIEW, CELLS}


class Warehouse:
    """Paths, reads and batch writes of one warehouse version."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = version or files.read_text(spark, f"{self.root}/CURRENT")

    # -- versions ---------------------------------------------------------------
    @classmethod
    def fresh(cls, spark: SparkSession, root: str) -> "Warehouse":
        """A new, empty version that nobody reads until ``publish``."""
        wh = cls(spark, root, f"v-{uuid.uuid4().hex[:12]}")
        together(*[
            partial(wh.write, dim.table, BASE_BATCH, unknown_member(spark, dim))
            for dim in DIMENSIONS if dim.unknown
        ])
        return wh

    def publish(self) -> None:
        files.replace_text(self.spark, f"{self.root}/CURRENT", self.version)

    def drop_old_versions(self) -> None:
        """Remove versions CURRENT does not name; call when no reader uses them."""
        current = files.read_text(self.spark, f"{self.root}/CURRENT")
        for name in files.child_names(self.spark, self.root):
            if name.startswith("v-") and name != current:
                files.delete(self.spark, f"{self.root}/{name}")

    # -- tables -----------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root}/{self.version}/{table}"

    def read(self, table: str, batches: list[str] | None = None) -> DataFrame:
        """A table, of all batches or of those named. The schema is given, so no footer is read to plan."""
        schema = self.schema(table) + ", batch_id string" + (", tahun int" if table == FACT else "")
        if not files.exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        packed = self.packed()
        if not packed:
            df = self.spark.read.schema(schema).parquet(self.path(table))
            return df if batches is None else df.filter(F.col("batch_id").isin(batches))
        df = self.spark.read.schema(schema + ", source_batch string").parquet(self.path(table))
        if batches is not None:
            own = F.col("batch_id").isin(batches)
            if set(batches) & {BASE_BATCH, *packed}:
                own |= (F.col("batch_id") == PACKED) & F.col("source_batch").isin(batches)
            df = df.filter(own)
        # Packed cells are sums over batches and name none.
        return df.withColumn("batch_id", F.coalesce("source_batch", "batch_id")).drop("source_batch")

    def schema(self, table: str) -> str:
        """Columns of a table; those of a roll-up follow from its levels."""
        if table in SCHEMAS:
            return SCHEMAS[table]
        levels = next(c["levels"] for c in self.cuboids() if c["table"] == table)
        return ", ".join(f"{c} {_CELL_TYPES[c]}" for c in (*levels, "unknown_in", "nominal_transaksi", "biaya_admin", "n_trx"))

    def dimension(self, dim: Dimension, batches: list[str] | None = None) -> DataFrame:
        return self.read(dim.table, batches).select(*dim.columns)

    def dimensions(self, batches: list[str] | None = None) -> dict[str, DataFrame]:
        return {d.table: self.dimension(d, batches) for d in DIMENSIONS}

    def facts(self, batches: list[str] | None = None) -> DataFrame:
        return self.read(FACT, batches).drop("batch_id", "tahun")

    def fact_slices(self, batch: str | None = None, ids: tuple[int, int] | None = None) -> list[DataFrame]:
        """The facts of a batch, or all, in slices by ``fact_id`` that go through a wide shuffle one at a time.

        ``ids`` are the largest ids before and after the batch while it is loaded; later its record tells them.
        """
        if ids is None:
            started = self.batches()
            first, last = (self.load_record(b) or {} for b in ((batch, batch) if batch else (started[0], started[-1]))) if started else ({}, {})
            ids = first.get("max_ids", {}).get(FACT, 0), last.get("max_ids_after", {}).get(FACT, 0)
        n = slices(self.spark, ids[1] - ids[0])
        cuts = [ids[0] + (ids[1] - ids[0]) * nth // n for nth in range(1, n)]
        return [self.facts([batch] if batch else None).filter(part) for part in by_range("fact_id", cuts)]

    def day_slices(self, batch: str | None = None) -> list[DataFrame]:
        """``fact_slices`` of whole days."""
        facts, n = self.facts([batch] if batch else None), len(self.fact_slices(batch))
        at = facts.agg(F.percentile_approx("waktu_id", [nth / n for nth in range(1, n)], 10 * n)).first()[0] if n > 1 else None
        return [facts.filter(part) for part in by_range("waktu_id", sorted(set(at or [])))]

    def view(self) -> DataFrame:
        return self.read(VIEW).select(*VIEW_COLUMNS)

    def not_loaded(self, batches: list[str] | None = None) -> DataFrame:
        """Every transaction row that made no fact, with its reason: the rejects and the copies."""
        return self.read(REJECTS, batches).unionByName(self.read(COPIES, batches))

    def cells(self) -> DataFrame:
        """The pre-aggregated cells; batches may hold parts of the same cell, which queries add up."""
        return self.read(CELLS).drop("batch_id")

    def write(self, table: str, batch: str, *parts: DataFrame, pack: bool = False) -> None:
        """Replace what ``batch`` holds in ``table``; with ``pack``, in as few files as Spark's advisory size allows.

        Several parts are written one after the other. Large tables are kept by year and sorted by day: a filter on years skips
        folders, one on days skips row groups. Rebalancing beforehand makes
        small years share a task and splits a year too big for one.
        """
        path = f"{self.path(table)}/batch_id={batch}"
        with shuffles_freed(self.spark):
            for nth, df in enumerate(parts):
                mode = "append" if nth else "overwrite"
                if table in BY_YEAR:
                    day = "waktu_id" if table == FACT else "tanggal"
                    spread = df.hint("rebalance", "tahun").sortWithinPartitions("tahun", day)
                    spread.write.partitionBy("tahun").mode(mode).option("compression", "zstd").parquet(path)
                else:
                    (df.hint("rebalance") if pack else df).write.mode(mode).option("compression", "zstd").parquet(path)

    def drop_table(self, table: str) -> None:
        files.delete(self.spark, self._mark(table))
        files.delete(self.spark, self.path(table))

    def drop(self, table: str, batch: str) -> None:
        files.delete(self.spark, self._mark(table, batch))
        files.delete(self.spark, f"{self.path(table)}/batch_id={batch}")

    # -- batches a derived table holds ------------------------------------------
    def _mark(self, table: str, batch: str = "") -> str:
        return f"{self.path('_done')}/{table}/{batch}"

    def mark_done(self, table: str, batch: str) -> None:
        files.write_text(self.spark, self._mark(table, batch), "")

    def done(self, table: str) -> set[str]:
        return set(files.child_names(self.spark, self._mark(table)))

    # -- roll-ups and packed batches ----------------------------------------------
    def _noted(self, name: str) -> list:
        return json.loads(files.read_text(self.spark, self.path(name)) or "[]")

    def cuboids(self) -> list[dict]:
        """Stored roll-ups: table, levels and about how many rows."""
        return self._noted("_cuboids.json")

    def save_cuboids(self, chosen: list[dict]) -> None:
        files.write_text(self.spark, self.path("_cuboids.json"), json.dumps(chosen))

    def packed(self) -> list[str]:
        return self._noted("_packed.json")

    def save_packed(self, batches: list[str]) -> None:
        files.write_text(self.spark, self.path("_packed.json"), json.dumps(batches))

    # -- loads ------------------------------------------------------------------
    def batches(self) -> list[str]:
        """Batch ids in the order they were first started; only the folder is listed."""
        names = [n for n in files.child_names(self.spark, self.path("_loads")) if n.endswith(".json")]
        return [n[:-5].split("-", 1)[1] for n in names]

    def load_record(self, batch: str) -> dict | None:
        started = self.batches()
        if batch not in started:
            return None
        return json.loads(files.read_text(self.spark, self._load_path(started.index(batch) + 1, batch)))

    def open_batch(self) -> str | None:
        """The batch whose load has started and not finished."""
        return files.read_text(self.spark, self.path("_open"))

    def set_open(self, batch: str | None) -> None:
        if batch:
            files.write_text(self.spark, self.path("_open"), batch)
        else:
            files.delete(self.spark, self.path("_open"))

    def save_load(self, record: dict) -> None:
        files.write_text(self.spark, self._load_path(record["sequence"], record["batch_id"]), json.dumps(record))

    def _load_path(self, sequence: int, batch: str) -> str:
        return f"{self.path('_loads')}/{sequence:08d}-{batch}.json"
