"""The scalability report: growth rates per layer and their ranking, from metric tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions.calendar import scale_index
from lumbung.operators.statistics import class_average, growth_rate, merged_growth_rate, moments, rank_by_growth
from lumbung.sources import metrics

RATE = ["growth_rate_ms_per_1k", "r2"]
ETL, CUBE = "ETL Pipeline", "Cube Construction"


def _etl_points(etl: DataFrame, *keep: str) -> DataFrame:
    return etl.select(*keep, F.col("rows_total_in_db").alias("x"), (F.col("etl_time_sec") * 1000).alias("y"))


def _cube_points(cube: DataFrame, *keep: str) -> DataFrame:
    return cube.select(*keep, F.col("n_rows").alias("x"), (F.col("median_build_sec") * 1000).alias("y"))


def _class_averages(query: DataFrame) -> DataFrame:
    return class_average(query, "complexity", "scale", "median_ms", "n_rows")


def _class_layer() -> Column:
    return F.concat(F.lit("OLAP Query ("), F.col("complexity"), F.lit(")"))


def _with_rate(rows: DataFrame, points: DataFrame) -> DataFrame:
    """All rows next to the one growth rate of the layer."""
    rate = growth_rate(points, [], "x", "y").select(F.struct(*RATE)).scalar()
    return rows.withColumn("_rate", rate).select("*", "_rate.*").drop("_rate")


def etl_summary(etl: DataFrame) -> DataFrame:
    rows = etl.select(
        "scale", F.col("rows_total_in_db").alias("rows_total"), "etl_time_sec", "throughput_rps", F.lit(ETL).alias("layer")
    )
    return _with_rate(rows, _etl_points(etl)).orderBy(scale_index(F.col("scale")), "rows_total")


def cube_summary(cube: DataFrame) -> DataFrame:
    rows = cube.select(
        "scale", "n_rows", "median_build_sec", "min_build_sec", "max_build_sec", "median_memory_mb", F.lit(CUBE).alias("layer")
    )
    return _with_rate(rows, _cube_points(cube)).orderBy(scale_index(F.col("scale")))


def query_summary(query: DataFrame) -> DataFrame:
    averages = _class_averages(query)
    rates = growth_rate(averages, ["complexity"], "n_rows", "avg_median_ms").select("complexity", *RATE)
    return averages.join(rates, "complexity").select(
        "scale", "n_rows", "complexity", F.bround("avg_median_ms", 3).alias("avg_median_ms"), *RATE, _class_layer().alias("layer")
    ).orderBy("complexity", scale_index(F.col("scale")))


def bottlenecks(etl: DataFrame, cube: DataFrame, query: DataFrame) -> DataFrame:
    """Layers by growth rate, the fastest growing first and flagged."""
    points = (
        _etl_points(etl).withColumn("layer", F.lit(ETL))
        .unionByName(_cube_points(cube).withColumn("layer", F.lit(CUBE)))
        .unionByName(_query_points(_class_averages(query)))
    )
    ranked = rank_by_growth(growth_rate(points, ["layer"], "x", "y"))
    return ranked.select("rank", "layer", *RATE, "is_bottleneck").orderBy("rank")


def _query_points(averages: DataFrame) -> DataFrame:
    return averages.select(F.col("n_rows").alias("x"), F.col("avg_median_ms").alias("y"), _class_layer().alias("layer"))


# -- the report, kept up append by append -----------------------------------------
# What is kept of each metric file. Layers with one point a row keep moments; the query layers' points are
# averages over files, so their sums and counts are kept.
def _kept_moments(points: DataFrame, layer: str) -> DataFrame:
    return moments(points, ["file"], "x", "y").withColumn("layer", F.lit(layer))


def _kept_averages(query: DataFrame) -> DataFrame:
    return query.groupBy("file", "complexity", "scale").agg(
        F.sum("median_ms").alias("total"), F.count("median_ms").alias("runs"), F.max("n_rows").alias("n_rows")
    )


_KEPT = {
    "etl_benchmark": lambda rows: _kept_moments(_etl_points(rows, "file"), ETL),
    "cube_benchmark": lambda rows: _kept_moments(_cube_points(rows, "file"), CUBE),
    "query_benchmark": _kept_averages,
}


def keep_up(spark: SparkSession, folder: str) -> dict[str, int]:
    """Summarise the metric files that came since the last call; the number of files read, by kind.

    A file is summarised once, under its name, in a table beside the metrics; a call that fails writes
    nothing of the kind it was at, so calling again takes the same files.
    """
    read = {}
    for kind, summarise in _KEPT.items():
        rows, read[kind] = metrics.read_new(spark, folder, kind)
        if rows is not None:
            summarise(rows).write.mode("append").parquet(metrics.kept_path(folder, kind))
    return read


def kept_bottlenecks(spark: SparkSession, folder: str) -> DataFrame:
    """``bottlenecks`` of all metrics in the folder, from what ``keep_up`` stored: no metric row is read."""
    found = []
    for kind in _KEPT:
        kept = metrics.read_kept(spark, folder, kind)
        if kept is None:
            continue
        if kind == "query_benchmark":
            averages = kept.groupBy("complexity", "scale").agg(
                F.max("n_rows").alias("n_rows"), F.try_divide(F.sum("total"), F.sum("runs")).alias("avg_median_ms")
            )
            found.append(growth_rate(_query_points(averages), ["layer"], "x", "y"))
        else:
            found.append(merged_growth_rate(kept, ["layer"]))
    if not found:
        raise ValueError(f"no metrics are kept in {folder}")
    ranked = rank_by_growth(reduce(DataFrame.unionByName, found))
    return ranked.select("rank", "layer", *RATE, "is_bottleneck").orderBy("rank")


def write_report(spark: SparkSession, folder: str) -> None:
    """The four summaries of the metrics stored in the folder, written beside them."""
    etl, cube, query = (metrics.read_metrics(spark, folder, f"{kind}_benchmark") for kind in ("etl", "cube", "query"))
    metrics.write_summaries({
        "etl": etl_summary(etl), "cube": cube_summary(cube), "query": query_summary(query), "bottleneck": bottlenecks(etl, cube, query),
    }, folder)


def memory_growth(cube: DataFrame) -> DataFrame:
    """MB per 1000 rows, over the cube builds."""
    return growth_rate(cube, [], "n_rows", "median_memory_mb").select(
        F.col("growth_rate_ms_per_1k").alias("growth_rate_mb_per_1k"), "r2"
    )
