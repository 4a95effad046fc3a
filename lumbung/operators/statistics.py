"""Growth rates, exact order statistics and throughput. Figures are rounded half to even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.sources.staging import stage


def moments(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """What a regression of ``y`` on ``x`` / 1000 needs of each group: count, means, centred sums, bounds of ``y``.

    Pairs with a null are left out. Rows of several batches are put together by ``merged_growth_rate``.
    """
    xk = F.col(x).cast("double") / 1000
    yd = F.col(y).cast("double")
    paired = F.when(xk.isNotNull(), yd)
    return df.groupBy(*by).agg(
        F.regr_count(yd, xk).alias("points"),
        F.regr_avgx(yd, xk).alias("mean_x"), F.regr_avgy(yd, xk).alias("mean_y"),
        F.regr_sxx(yd, xk).alias("sxx"), F.regr_sxy(yd, xk).alias("sxy"), F.regr_syy(yd, xk).alias("syy"),
        F.min(paired).alias("low"), F.max(paired).alias("high"),
    )


def merged_growth_rate(parts: DataFrame, by: list[str]) -> DataFrame:
    """``growth_rate`` of the rows whose ``moments`` are given, one row per group and batch.

    Sums stay centred: each part's are moved to the common mean, so large values do not cancel out.
    """
    n = F.col("points")
    whole = parts.groupBy(*by).agg(
        F.sum(n).alias("_n"), F.sum(n * F.col("mean_x")).alias("_x"), F.sum(n * F.col("mean_y")).alias("_y")
    ).select(*[F.col(c).alias(f"_by_{c}") for c in by], (F.try_divide("_x", "_n")).alias("_mx"), F.try_divide("_y", "_n").alias("_my"))
    same = F.lit(True)
    for c in by:
        same = same & parts[c].eqNullSafe(whole[f"_by_{c}"])
    away_x, away_y = F.col("mean_x") - F.col("_mx"), F.col("mean_y") - F.col("_my")
    sums = parts.join(whole, same).groupBy(*by).agg(
        F.sum(n).alias("points"), F.first("_mx").alias("_mx"), F.first("_my").alias("_my"),
        F.sum(F.col("sxx") + n * away_x * away_x).alias("_sxx"),
        F.sum(F.col("sxy") + n * away_x * away_y).alias("_sxy"),
        F.sum(F.col("syy") + n * away_y * away_y).alias("_syy"),
        F.min("low").alias("_low"), F.max("high").alias("_high"),
    )
    slope = F.when(F.col("_sxx") > 0, F.col("_sxy") / F.col("_sxx"))
    r2 = F.when((F.col("_sxx") > 0) & (F.col("_syy") > 0), F.col("_sxy") * F.col("_sxy") / (F.col("_sxx") * F.col("_syy")))
    return _rates(sums.withColumns({"_slope": slope, "_r2": r2}).withColumn("_intercept", F.col("_my") - F.col("_slope") * F.col("_mx")), by)


def growth_rate(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """Least-squares slope of ``y`` per 1000 units of ``x``, with intercept and R2, rounded to 4 places.

    R2 is 1 when ``y`` does not vary; slope and R2 are 0 with fewer than two points.
    """
    xk = F.col(x).cast("double") / 1000
    yd = F.col(y).cast("double")
    fit = df.groupBy(*by).agg(
        F.count(F.when(xk.isNotNull() & yd.isNotNull(), 1)).alias("points"),
        F.regr_slope(yd, xk).alias("_slope"),
        F.regr_intercept(yd, xk).alias("_intercept"),
        F.regr_r2(yd, xk).alias("_r2"),
        F.min(yd).alias("_low"),
        F.max(yd).alias("_high"),
    )
    return _rates(fit, by)


def _rates(fit: DataFrame, by: list[str]) -> DataFrame:
    enough = F.col("points") >= 2
    flat = F.col("_low") == F.col("_high")
    return fit.select(
        *by,
        "points",
        F.when(enough, F.bround(F.coalesce("_slope", F.lit(0.0)), 4)).otherwise(0.0).alias("growth_rate_ms_per_1k"),
        F.when(enough, F.bround("_intercept", 4)).alias("intercept_ms"),
        F.when(~enough, 0.0).when(flat, 1.0).otherwise(F.bround("_r2", 4)).alias("r2"),
    )


def order_statistics(df: DataFrame, by: list[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """Exact values at given ranks per group, however large a group is.

    ``ranks`` gives 1-based ranks as expressions over ``n``, the group's count.
    Equal values are counted together first. The distinct (group, value) pairs
    are range-partitioned, so a group may span many tasks; counts per (group,
    partition) tell which partition holds each rank, and only those partitions'
    values are walked.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    runs = stage(counts.orderBy(*by, value).withColumn("_part", F.spark_partition_id()), "ranks")

    sizes = runs.groupBy(*by, "_part").agg(F.sum("_c").alias("_size"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), r.cast("bigint").alias("rank")) for k, r in ranks.items()])
    chunks = (
        sizes.withColumn("n", F.sum("_size").over(group))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .withColumn("_ranks", F.filter(
            wanted, lambda r: (r["rank"] > F.col("_before")) & (r["rank"] <= F.col("_before") + F.col("_size"))
        ))
        .filter(F.size("_ranks") > 0)
        .select(*[F.col(c).alias(f"_g_{c}") for c in by], F.col("_part").alias("_g_part"), "n", "_before", "_ranks")
    )
    same = runs["_part"] == chunks["_g_part"]
    for c in by:
        same = same & runs[c].eqNullSafe(chunks[f"_g_{c}"])
    walked = runs.join(chunks, same)
    running = Window.partitionBy(*by, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("_c").over(running)
    hits = (
        walked.withColumn("_upto", upto)
        .withColumn("_hit", F.explode(F.filter(
            F.col("_ranks"), lambda r: (r["rank"] > F.col("_upto") - F.col("_c")) & (r["rank"] <= F.col("_upto"))
        )))
    )
    return hits.groupBy(*by, "n").agg(
        *[F.max(F.when(F.col("_hit.name") == k, F.col(value))).alias(k) for k in ranks]
    )


def run_statistics(df: DataFrame, by: list[str], value: str, places: int = 3) -> DataFrame:
    """Exact median, minimum and maximum per group."""
    n = F.col("n")
    found = order_statistics(df, by, value, {
        "_lower": F.floor((n + 1) / 2), "_upper": F.floor(n / 2) + 1, "_min": F.lit(1), "_max": n,
    })
    return found.select(
        *by,
        F.col("n").alias("runs"),
        F.bround((F.col("_lower") + F.col("_upper")) / 2, places).alias("median_ms"),
        F.bround("_min", places).alias("min_ms"),
        F.bround("_max", places).alias("max_ms"),
    )


def nearest_rank_quartiles(df: DataFrame, by: list[str], value: str, places: int = 3) -> DataFrame:
    """Quartiles without interpolation: the values at 0-based places n/4 and 3n/4."""
    n = F.col("n")
    found = order_statistics(df, by, value, {"p25": F.floor(n / 4) + 1, "p75": F.floor(n * 3 / 4) + 1})
    return found.select(
        *by, F.col("n").alias("runs"),
        F.bround("p25", places).alias("p25_ms"), F.bround("p75", places).alias("p75_ms"),
    )


def class_average(medians: DataFrame, complexity: str, scale: str, median: str, rows: str) -> DataFrame:
    """Average of the queries' medians per class and scale, with the scale's row count."""
    return medians.groupBy(complexity, scale).agg(
        F.max(rows).alias("n_rows"), F.avg(median).alias("avg_median_ms")
    )


def throughput(rows: Column, seconds: Column) -> Column:
    """Rows per second, one decimal; 0 when no time passed."""
    return F.bround(F.coalesce(F.try_divide(rows.cast("double"), seconds.cast("double")), F.lit(0.0)), 1)


def rank_by_growth(layers: DataFrame) -> DataFrame:
    """Layers ranked by growth rate; rank 1 is the bottleneck. One row per layer goes in."""
    order = Window.orderBy(F.col("growth_rate_ms_per_1k").desc(), F.col("layer"))
    return layers.withColumn("rank", F.row_number().over(order).cast("bigint")).withColumn(
        "is_bottleneck", F.col("rank") == 1
    )
