"""Growth rates, exact order statistics, quality and scalability reports."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lumbung.functions.rounding import round_binary
from lumbung.operators import quality
from lumbung.operators import statistics as st
from lumbung.plans import scalability
from lumbung.sources import metrics
from tests.test_operators import raw

ROWS = {"S": 4843, "M": 227832, "L": 450943, "XL": 897547}
# Published measurements: cube builds, memory, and class averages per scale.
BUILD = {"S": 12.741, "M": 17.951, "L": 21.491, "XL": 35.873}
MEMORY = {"S": 206.8, "M": 328.6, "L": 439.7, "XL": 681.0}
MEDIANS = {
    ("simple", "Q1"): [11.976, 17.27, 22.73, 47.176], ("simple", "Q2"): [16.024, 38.382, 60.421, 108.269],
    ("rollup", "Q3"): [10.706, 27.997, 39.502, 65.031], ("rollup", "Q4"): [10.675, 21.396, 33.575, 59.217],
    ("rollup", "Q5"): [12.786, 25.253, 33.128, 52.522],
    ("pivot", "Q6"): [8.508, 34.666, 63.333, 135.493], ("pivot", "Q7"): [8.933, 33.648, 57.841, 113.132],
}


def cube_frame(spark):
    return spark.createDataFrame(
        [(s, ROWS[s], BUILD[s], BUILD[s], BUILD[s], MEMORY[s]) for s in ROWS], metrics.SCHEMAS["cube_benchmark"]
    )


def query_frame(spark):
    data = [(s, ROWS[s], name, cls, ms[i], ms[i], ms[i], ms[i], ms[i]) for (cls, name), ms in MEDIANS.items() for i, s in enumerate(ROWS)]
    schema = "scale string, n_rows bigint, query string, complexity string, median_ms double, p25_ms double, p75_ms double, min_ms double, max_ms double"
    return spark.createDataFrame(data, schema)


def test_published_growth_rates(spark):
    got = scalability.cube_summary(cube_frame(spark)).first()
    assert (got.growth_rate_ms_per_1k, got.r2) == (25.7718, 0.9818)
    rates = {r.complexity: (r.growth_rate_ms_per_1k, r.r2) for r in scalability.query_summary(query_frame(spark)).collect()}
    assert rates == {"pivot": (0.1301, 0.9967), "simple": (0.0716, 0.9945), "rollup": (0.0527, 0.9986)}
    memory = scalability.memory_growth(cube_frame(spark)).first()
    assert (round(memory.growth_rate_mb_per_1k, 2), memory.r2) == (0.53, 0.9998)


def test_class_averages(spark):
    got = {(r.complexity, r.scale): r.avg_median_ms for r in scalability.query_summary(query_frame(spark)).collect()}
    assert got["simple", "S"] == 14.0 and got["rollup", "M"] == 24.882 and got["pivot", "XL"] == 124.312


def test_bottleneck_ranking(spark):
    etl = spark.createDataFrame([("S", "full", 1000, 1000, 1.0, 1000.0), ("M", "full", 2000, 1000, 1.001, 999.0)], metrics.SCHEMAS["etl_benchmark"])
    got = scalability.bottlenecks(etl, cube_frame(spark), query_frame(spark)).collect()
    assert [r.layer for r in got] == ["Cube Construction", "ETL Pipeline", "OLAP Query (pivot)", "OLAP Query (simple)", "OLAP Query (rollup)"]
    assert [r.rank for r in got] == [1, 2, 3, 4, 5] and [r.is_bottleneck for r in got] == [True] + [False] * 4


def test_growth_rate_of_little(spark):
    df = spark.createDataFrame([("one", 5, 1.0), ("flat", 1000, 2.0), ("flat", 3000, 2.0)], "g string, x int, y double")
    got = {r.g: (r.growth_rate_ms_per_1k, r.r2) for r in st.growth_rate(df, ["g"], "x", "y").collect()}
    assert got == {"one": (0.0, 0.0), "flat": (0.0, 1.0)}


def test_quartiles_take_the_nearest_rank(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (4, 2, 3, 1)], "g string, x double")
    got = st.nearest_rank_quartiles(df, ["g"], "x").first()
    assert (got.runs, got.p25_ms, got.p75_ms) == (4, 2.0, 4.0)


@pytest.mark.parametrize("by", [[], ["g"], ["g", "h"]])
def test_order_statistics_against_brute_force(spark, by):
    """A third of all rows in one group, many equal values, nulls."""
    rng = random.Random(3)
    data = []
    for i in range(3_000):
        hot = i % 3 == 0
        value = None if i % 97 == 0 else 1.5 if i % 5 == 0 else round(rng.uniform(0, 100), 1)
        data.append(("hot" if hot else f"g{i % 11}", "same" if hot else f"h{i % 2}", value))
    df = spark.createDataFrame(data, "g string, h string, x double").repartition(6)
    groups: dict[tuple, list[float]] = {}
    for g, h, x in data:
        if x is not None:
            groups.setdefault(tuple({"g": g, "h": h}[k] for k in by), []).append(x)
    runs = {tuple(r[k] for k in by): r for r in st.run_statistics(df, by, "x").collect()}
    quartiles = {tuple(r[k] for k in by): r for r in st.nearest_rank_quartiles(df, by, "x").collect()}
    assert set(runs) == set(groups) == set(quartiles)
    for key, xs in groups.items():
        xs.sort()
        n = len(xs)
        assert runs[key].runs == n
        assert runs[key].median_ms == pytest.approx(statistics.median(xs), abs=1e-3)
        assert (runs[key].min_ms, runs[key].max_ms) == (xs[0], xs[-1])
        assert (quartiles[key].p25_ms, quartiles[key].p75_ms) == (xs[n // 4], xs[3 * n // 4])


def test_throughput(spark):
    df = spark.createDataFrame([(100, 8.0), (5, 0.0)], "r int, s double")
    assert [x[0] for x in df.select(st.throughput(F.col("r"), F.col("s"))).collect()] == [12.5, 0.0]


def test_quality_counts_each_kind_on_first_copies(spark):
    rows = raw(
        spark, {"trx_id": "A"}, {"trx_id": "A", "nominal": "-1"}, {"trx_id": "B", "nominal": "-1", "tgl_transaksi": None},
        {"trx_id": "C", "tgl_transaksi": "31-13-2026"}, *[{"trx_id": f"D{i}"} for i in range(6)],
    )
    got = quality.input_quality(rows, ["src_seq"]).first()
    assert (got.total_input_rows, got.duplicate_removed, got.negative_nominal_removed, got.invalid_date_removed) == (10, 1, 1, 2)
    assert (got.total_records_removed, got.data_quality_rate_pct) == (4, 60.0)


def test_published_quality_rate(spark):
    rows = raw(spark, *[{"trx_id": f"T{i}", "nominal": "-1" if i < 57 else "1"} for i in range(4900)], *[{"trx_id": f"T{i}"} for i in range(100)])
    got = quality.input_quality(rows, ["src_seq"]).first()
    assert (got.total_input_rows, got.duplicate_removed, got.negative_nominal_removed, got.data_quality_rate_pct) == (5000, 100, 57, 96.86)


def test_metrics_round_trip(spark, tmp_path):
    folder = str(tmp_path)
    assert metrics.read_metrics(spark, folder, "cube_benchmark").count() == 0
    frame = cube_frame(spark)
    metrics.append_metrics(frame.filter("scale = 'S'"), folder, "cube_benchmark")
    metrics.append_metrics(frame.filter("scale <> 'S'"), folder, "cube_benchmark")
    back = metrics.read_metrics(spark, folder, "cube_benchmark")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))
    metrics.write_summaries({"cube": scalability.cube_summary(back)}, folder)
    assert spark.read.option("header", True).csv(f"{folder}/summary_cube.csv").count() == 4


def test_report_and_quality_rows_are_stored(spark, tmp_path):
    folder = str(tmp_path / "metrics")
    rows = raw(spark, {"trx_id": "A"}, {"trx_id": "A"}, {"trx_id": "B", "nominal": "99.999.999.999.999.999"})
    facts = spark.createDataFrame([(0, 1, 1, 1)], "nasabah_id bigint, merchant_id bigint, channel_id bigint, wilayah_id bigint")
    for _ in range(2):
        metrics.append_metrics(quality.quality_report(rows, ["src_seq"], facts), folder, "data_quality")
    stored = metrics.read_metrics(spark, folder, "data_quality").collect()
    assert [(r.duplicate_removed, r.out_of_range_removed, r.total_records_removed, r.unknown_nasabah) for r in stored] == [(1, 1, 2, 1)] * 2
    scales = [("S", 1000), ("M", 2000), ("L", 4000)]
    for kind, values in {
        "etl_benchmark": [(s, "full", n, n, n / 100.0, 100.0) for s, n in scales],
        "cube_benchmark": [(s, n, n / 1000.0, 1.0, 2.0, n / 10.0) for s, n in scales],
        "query_benchmark": [(s, n, "Q1", "simple", n / 50.0, 1.0, 2.0, 0.5, 3.0) for s, n in scales],
    }.items():
        metrics.append_metrics(spark.createDataFrame(values, metrics.SCHEMAS[kind]), folder, kind)
    scalability.write_report(spark, folder)
    sizes = {name: spark.read.option("header", True).csv(f"{folder}/summary_{name}.csv").count() for name in ("etl", "cube", "query", "bottleneck")}
    assert sizes == {"etl": 3, "cube": 3, "query": 3, "bottleneck": 3}


def test_merged_moments_equal_one_pass(spark):
    rng = random.Random(7)
    rows = [(g, i % 5, 1e7 + rng.random() * 100, rng.random() * 50 + g) for g in range(3) for i in range(200)]
    rows += [(7, 0, 1.0, 2.0), (8, 0, 5.0, 1.0), (8, 1, 5.0, 3.0), (9, 0, 1.0, 4.0), (9, 1, 2.0, 4.0), (None, 0, 1.0, 1.0), (None, 3, 3.0, 2.0), (10, 0, None, 1.0), (1, 2, None, 3.0)]
    df = spark.createDataFrame(rows, "g int, batch int, x double, y double")
    parts = st.moments(df, ["g", "batch"], "x", "y")
    merged = {r.g: r for r in st.merged_growth_rate(parts, ["g"]).collect()}
    at_once = {r.g: r for r in st.growth_rate(df, ["g"], "x", "y").collect()}
    merged[""], at_once[""] = st.merged_growth_rate(st.moments(df, ["batch"], "x", "y"), []).first(), st.growth_rate(df, [], "x", "y").first()
    assert merged.keys() == at_once.keys()
    for g, r in at_once.items():
        # The intercept lies ten million units away from the points, so its last places are not the same.
        assert [merged[g].points, merged[g].growth_rate_ms_per_1k, merged[g].r2] == [r.points, r.growth_rate_ms_per_1k, r.r2], g
        assert merged[g].intercept_ms == (r.intercept_ms if r.intercept_ms is None else pytest.approx(r.intercept_ms, rel=1e-8)), g


def test_kept_report_reads_only_new_files(spark, tmp_path):
    folder = str(tmp_path)
    cube, query = cube_frame(spark).coalesce(1), query_frame(spark).coalesce(1)
    metrics.append_metrics(cube.filter("scale IN ('S', 'M')").coalesce(1), folder, "cube_benchmark")
    assert scalability.keep_up(spark, folder) == {"etl_benchmark": 0, "cube_benchmark": 1, "query_benchmark": 0}
    metrics.append_metrics(cube.filter("scale IN ('L', 'XL')").coalesce(1), folder, "cube_benchmark")
    metrics.append_metrics(query.filter("query < 'Q4'").coalesce(1), folder, "query_benchmark")
    metrics.append_metrics(query.filter("query >= 'Q4'").coalesce(1), folder, "query_benchmark")
    assert scalability.keep_up(spark, folder) == {"etl_benchmark": 0, "cube_benchmark": 1, "query_benchmark": 2}
    assert set(scalability.keep_up(spark, folder).values()) == {0}
    etl = spark.createDataFrame([], metrics.SCHEMAS["etl_benchmark"])
    told = [r for r in scalability.bottlenecks(etl, cube, query).collect() if r.layer != scalability.ETL]
    assert [(r.layer, r.growth_rate_ms_per_1k, r.r2) for r in scalability.kept_bottlenecks(spark, folder).collect()] == [
        (r.layer, r.growth_rate_ms_per_1k, r.r2) for r in told]


def test_rounding_by_the_bits(spark):
    rng = random.Random(1)
    values = [2.675, 0.125, 1.005, -2.675, 0.0, 0.005, 0.015, 0.0049999, 5e-324, 1e15, 1e300, 562949953421311.9]
    values += [rng.randrange(10**9) / 1000 for _ in range(300)] + [rng.randrange(2**50) / 64 for _ in range(200)] + [rng.uniform(-1, 1) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for places in (0, 2, 4):
        rows = df.select("x", round_binary(F.col("x"), places).alias("r")).collect()
        assert [r.r for r in rows] == [round(r.x, places) for r in rows]
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("-inf"),)], "x double").select(round_binary(F.col("x"), 2).alias("r")).collect()
    assert odd[0].r is None and odd[1].r != odd[1].r and odd[2].r == float("-inf")
