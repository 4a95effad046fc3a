"""Reading the dirty source CSVs.

Every column is read as text and typed later by explicit expressions, so no
value depends on what a type sniffer makes of its neighbours. Each row carries
``src_seq``, a long that grows in source order (file name, then line). Part files
of one source may have different headers and separators.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.functions.parsing import blanks_to_null
from lumbung.operators.keys import ROW_BITS
from lumbung.sources import files

# So many rows of a name and a number are some 50 MB.
BROADCAST_FILES = 500_000


def sniff(spark: SparkSession, path: str) -> tuple[str, list[str]]:
    """Separator and header names, from the first line. ``;`` wins ties."""
    return _header(files.first_line(spark, path) or "")


def _header(line: str) -> tuple[str, list[str]]:
    header = line.lstrip("\ufeff")
    separator = ";" if header.count(";") >= header.count(",") else ","
    return separator, header.split(separator)


def read_source(spark: SparkSession, folder: str, name: str, trim_header: bool = False) -> DataFrame | None:
    """The source ``folder/name`` (a file or a folder of part files), or None when it is absent."""
    path = f"{folder.rstrip('/')}/{name}"
    parts = files.data_files(spark, path)
    if not parts:
        return None
    groups = _by_header(spark, parts, trim_header)
    every = list(dict.fromkeys(n for _, names in groups for n in names))
    read = []
    for (separator, names), members in groups.items():
        raw = (
            spark.read.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
            .option("sep", separator)
            .option("header", True)
            .option("enforceSchema", True)
            .option("escape", '"')
            .csv(path if len(groups) == 1 else members)
        )
        ordered = _with_source_order(raw, parts)
        read.append(ordered.select(*[F.col(n) if n in names else F.lit(None).cast("string").alias(n) for n in every], "src_seq"))
    return blanks_to_null(reduce(DataFrame.union, read), "src_seq")


def _by_header(spark: SparkSession, parts: list[tuple[str, str, int]], trim: bool) -> dict[tuple[str, tuple[str, ...]], list[str]]:
    """(separator, column names) -> part files that begin with them, in source order.

    Parts may have their columns in another order or lack some: each group is read by its own header,
    and what it lacks is null. An empty part has no header line and no rows. First lines are read by
    some threads of the driver; a header is kept once, however many parts have it.
    """
    full = [file for file, _, size in parts if size] or [parts[0][0]]
    with ThreadPoolExecutor(min(16, len(full))) as pool:
        lines = pool.map(lambda file: files.first_line(spark, file), full)
        # A compressed part has bytes without having text.
        told = [(file, line) for file, line in zip(full, lines, strict=True) if line is not None] or [(full[0], "")]
        groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
        for file, (separator, names) in ((file, _header(line)) for file, line in told):
            names = tuple(n.strip('"').strip() if trim else n.strip('"') for n in names)
            if len(set(names)) < len(names):
                raise ValueError(f"{file} names a column twice: {', '.join(names)}")
            groups.setdefault((separator, names), []).append(file)
    return groups


def read_mandatory(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = read_source(spark, folder, name)
    if df is None:
        raise FileNotFoundError(f"{name} is missing in {folder}; this source is mandatory")
    return df


def _with_source_order(raw: DataFrame, parts: list[tuple[str, str, int]]) -> DataFrame:
    """Add ``src_seq`` = (blocks of earlier files + block within the file) << 33 | row within the scan task."""
    spark = raw.sparkSession
    granule = _smallest_block(spark)
    before, starts = 0, []
    for _, name, size in parts:
        starts.append((name, before))
        before += size // granule + 1
    if before >= 1 << (63 - ROW_BITS):
        raise ValueError("source has more file blocks than src_seq can number")
    block = F.floor(F.col("_metadata.file_block_start") / F.lit(granule))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    if len(parts) == 1:
        seq = F.shiftleft(block.cast("bigint"), ROW_BITS).bitwiseOR(row)
        return raw.withColumn("src_seq", seq)
    # One row per source file. Spark does not know that the list is short, so the size is checked here.
    first_blocks = spark.createDataFrame(starts, "_file string, _first bigint")
    if len(starts) <= BROADCAST_FILES:
        first_blocks = F.broadcast(first_blocks)
    seq = F.shiftleft(F.col("_first") + F.col("_block"), ROW_BITS).bitwiseOR(F.col("_row"))
    return (
        raw.select(
            "*", F.col("_metadata.file_name").alias("_file"), block.cast("bigint").alias("_block"), row.alias("_row")
        )
        .join(first_blocks, "_file", "left")
        .withColumn("src_seq", seq)
        .drop("_file", "_first", "_block", "_row")
    )


def _smallest_block(spark: SparkSession) -> int:
    """A lower bound on the bytes between two split starts of one file."""
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    limits = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    return max(1, min(to_bytes(spark.conf.get(limit)) for limit in limits))
