"""Intermediate tables in the cluster's shared folder.

A staged table cuts lineage the way ``checkpoint()`` does, but as Parquet: later
passes prune columns, and every pass sees the same rows even after executors are
lost. The folder is the one the cluster names in ``spark.checkpoint.dir``.

Disk: a pass over many rows is made in slices, each a query of its own, and the
shuffle files of a write go when it ends. So what lies on disk at once is the
tables and the shuffles of one slice, not those of the whole job.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import ContextVar, copy_context
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.sources import files

# Rows that go through the wide shuffles of a pass at once, unless spark.lumbung.slice.rows says otherwise.
SLICE_ROWS = 24_000_000
# Whether Spark removes the shuffle files of a query when it ends, or when the driver collects its garbage.
_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
_parts: set[str] = set()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables; a private one only for local sessions without a setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/") + "/lumbung"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lumbung-")
        atexit.register(shutil.rmtree, _local_roots[app], True)
    return _local_roots[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's part of the shared folder, which is removed at exit."""
    part = f"{staging_root(spark)}/{spark.sparkContext.applicationId}"
    if part not in _parts:
        _parts.add(part)
        atexit.register(_remove, spark, part)
    return f"{part}/{name}-{uuid.uuid4().hex[:12]}"


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by then
        files.delete(spark, path)


_writing: dict[str, tuple[int, str | None]] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """The shuffle files of a write inside the block go when that write ends. Frames made inside must not be run twice."""
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _writing.get(session, (0, None))
        before = before if inside else spark.conf.get(_FREED, None)
        _writing[session] = (inside + 1, before)
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _writing.pop(session)
            if inside > 1:
                _writing[session] = (inside - 1, before)
            else:
                spark.conf.unset(_FREED) if before is None else spark.conf.set(_FREED, before)


def slices(spark: SparkSession, rows: int) -> int:
    """In how many slices a pass over so many rows is made."""
    return max(1, -(-rows // int(spark.conf.get("spark.lumbung.slice.rows", str(SLICE_ROWS)))))


def by_hash(key: str | list[str], n: int) -> list[Column]:
    """Conditions that deal rows into ``n`` slices; equal keys, null ones too, are in the same."""
    keys = [key] if isinstance(key, str) else key
    return [F.pmod(F.xxhash64(*keys), F.lit(n)) == nth for nth in range(n)] if n > 1 else [F.lit(True)]


def by_range(key: str, cuts: list) -> list[Column]:
    """Conditions that split rows behind each of the ascending cuts; rows without a key are in the first slice."""
    if not cuts:
        return [F.lit(True)]
    first = F.col(key).isNull() | (F.col(key) <= cuts[0])
    return [first, *[(F.col(key) > a) & (F.col(key) <= z) for a, z in zip(cuts, cuts[1:])], F.col(key) > cuts[-1]]


_staged: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh staged table and return a scan of it."""
    return stage_parts([df], name)


def stage_parts(parts: list[DataFrame], name: str) -> DataFrame:
    """``stage`` of the union of the parts, each written by a query of its own."""
    spark = parts[0].sparkSession
    path = new_folder(spark, name)
    in_job = _in_job.get()
    if in_job is not None:
        in_job.append(path)
    with shuffles_freed(spark):
        for part in parts:
            part.write.mode("append").option("compression", "zstd").parquet(path)
    rows = spark.read.schema(parts[0].schema).parquet(path)
    _staged[rows] = path
    return rows


def discard(rows: DataFrame) -> None:
    """Remove a staged table that nothing reads any more."""
    files.delete(rows.sparkSession, _staged.pop(rows))


_in_job: ContextVar[list[str] | None] = ContextVar("staged in the job", default=None)


@contextlib.contextmanager
def job(spark: SparkSession):
    """Drop the tables staged inside the block when it ends; its results must be written by then."""
    staged: list[str] = []
    token = _in_job.set(staged)
    try:
        yield
    finally:
        _in_job.reset(token)
        for path in staged:
            files.delete(spark, path)


def together(*steps: Callable[[], None]) -> None:
    """Run independent writes as concurrent Spark jobs of the same ``job``; the first failure is raised."""
    with ThreadPoolExecutor(min(8, max(1, len(steps)))) as pool:
        for done in [pool.submit(copy_context().run, step) for step in steps]:
            done.result()
