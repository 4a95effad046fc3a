"""Metric tables of the scalability report: append rows, read them back, export summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.sources import files

SCHEMAS = {
    "etl_benchmark": "scale string, mode string, rows_total_in_db bigint, rows_loaded bigint, "
                     "etl_time_sec double, throughput_rps double",
    "cube_benchmark": "scale string, n_rows bigint, median_build_sec double, min_build_sec double, "
                      "max_build_sec double, median_memory_mb double",
    "query_benchmark": "scale string, n_rows bigint, query string, complexity string, median_ms double, "
                       "p25_ms double, p75_ms double, min_ms double, max_ms double",
    "data_quality": "total_input_rows bigint, duplicate_removed bigint, negative_nominal_removed bigint, "
                    "invalid_date_removed bigint, out_of_range_removed bigint, total_records_removed bigint, "
                    "data_quality_rate_pct double, unknown_nasabah bigint, unknown_merchant bigint, "
                    "unknown_channel bigint, unknown_wilayah bigint, fact_rows_in_db bigint",
}


def append_metrics(rows: DataFrame, folder: str, kind: str) -> None:
    """Append metric rows, in the columns of their kind."""
    columns = [part.split()[0] for part in SCHEMAS[kind].split(", ")]
    rows.select(*columns).write.mode("append").option("header", True).csv(f"{folder}/{kind}.csv")


def read_metrics(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The metric rows so far; empty when there are none yet."""
    path = f"{folder}/{kind}.csv"
    if not files.exists(spark, path):
        return spark.createDataFrame([], SCHEMAS[kind])
    return spark.read.schema(SCHEMAS[kind]).option("header", True).csv(path)


def kept_path(folder: str, kind: str) -> str:
    """Where the summaries of a kind's files are kept."""
    return f"{folder}/kept_{kind}.parquet"


def read_kept(spark: SparkSession, folder: str, kind: str) -> DataFrame | None:
    """The summaries kept so far; None before the first. A kind has few files and rows for each."""
    path = kept_path(folder, kind)
    return spark.read.parquet(path) if files.exists(spark, path) else None


def read_new(spark: SparkSession, folder: str, kind: str) -> tuple[DataFrame | None, int]:
    """Metric rows of the files without a kept summary, with their ``file``, and how many files; None if there are none."""
    kept = read_kept(spark, folder, kind)
    seen = set() if kept is None else {r.file for r in kept.select("file").distinct().collect()}
    paths = [path for path, name, _ in files.data_files(spark, f"{folder}/{kind}.csv") if name not in seen]
    if not paths:
        return None, 0
    rows = spark.read.schema(SCHEMAS[kind]).option("header", True).csv(paths)
    return rows.withColumn("file", F.col("_metadata.file_name")), len(paths)


def write_summaries(summaries: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder per summary table."""
    for name, df in summaries.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/summary_{name}.csv")
