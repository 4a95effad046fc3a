"""Scalability run: the same measurements at several scales, and the growth-rate ranking.

    python bench_scales.py /root/testdata/sf0.001 /root/testdata/sf0.01 /root/testdata/sf0.1
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from contract import bindings  # noqa: E402
from lumbung.fixed_values import SCALES  # noqa: E402
from lumbung.operators import statistics as st  # noqa: E402
from lumbung.plans import load, queries, scalability  # noqa: E402
from lumbung.session import local_session  # noqa: E402
from lumbung.sources import metrics  # noqa: E402
from lumbung.sources.warehouse import Warehouse  # noqa: E402

WARM_UPS, RUNS, BUILDS = 5, 15, 3


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def measure(spark, scale: str, sf_dir: str, scratch: str, warm: bool) -> None:
    folder, root = bindings.source_folder(spark, sf_dir), f"{scratch}/wh-{scale}"
    if not warm:
        load.load_full(spark, folder, root)                   # compiles and loads classes once
    seconds = timed(lambda: load.load_full(spark, folder, root))
    wh = Warehouse(spark, root)
    n = wh.load_record("full")["rows_loaded"]
    etl = spark.createDataFrame([(scale, "full", n, n, round(seconds, 3))], "scale string, mode string, rows_total_in_db bigint, rows_loaded bigint, etl_time_sec double")
    metrics.append_metrics(
        etl.withColumn("throughput_rps", st.throughput(F.col("rows_loaded"), F.col("etl_time_sec"))), scratch, "etl_benchmark"
    )

    def build() -> float:
        load.forget_cube(wh)
        return timed(lambda: load.refresh_cube(wh).count())

    builds = spark.createDataFrame([(scale, build()) for _ in range(BUILDS)], "scale string, sec double")
    row = st.run_statistics(builds, ["scale"], "sec").select(
        "scale", F.lit(n).cast("bigint").alias("n_rows"), F.col("median_ms").alias("median_build_sec"),
        F.col("min_ms").alias("min_build_sec"), F.col("max_ms").alias("max_build_sec"), F.lit(None).cast("double").alias("median_memory_mb"),
    )
    metrics.append_metrics(row, scratch, "cube_benchmark")

    cells = load.refresh_cube(wh).persist()
    cells.count()
    runs = []
    for name, (complexity, fn) in queries.benchmark_queries().items():
        for _ in range(WARM_UPS):
            fn(cells).collect()
        runs += [(scale, n, name, complexity, timed(lambda: fn(cells).collect()) * 1000) for _ in range(RUNS)]
    cells.unpersist()
    frame = spark.createDataFrame(runs, "scale string, n_rows bigint, query string, complexity string, ms double")
    by = ["scale", "n_rows", "query", "complexity"]
    metrics.append_metrics(
        st.run_statistics(frame, by, "ms").join(st.nearest_rank_quartiles(frame, by, "ms").drop("runs"), by), scratch, "query_benchmark"
    )


def main() -> None:
    spark = local_session("scales", os.environ.get("BENCH_CPUS", "*"))
    with tempfile.TemporaryDirectory(prefix="lumbung-scales-") as scratch:
        for nth, sf_dir in enumerate(sys.argv[1:]):
            measure(spark, SCALES[nth], sf_dir, scratch, warm=nth > 0)
        frames = [metrics.read_metrics(spark, scratch, kind) for kind in ("etl_benchmark", "cube_benchmark", "query_benchmark")]
        scalability.etl_summary(frames[0]).show(truncate=False)
        scalability.cube_summary(frames[1]).show(truncate=False)
        scalability.query_summary(frames[2]).show(truncate=False)
        scalability.bottlenecks(*frames).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
