"""Benchmark: the load, the cube build and the seven OLAP queries, as one JSON line.

Protocol: one timed full load and one timed batch load, median of three cube
builds, and for each query the median of repeated runs after discarded warm-ups.
Data: $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contract import bindings  # noqa: E402
from contract.queries import QUERIES  # noqa: E402
from lumbung.plans import load, queries  # noqa: E402
from lumbung.session import local_session  # noqa: E402
from lumbung.sources.warehouse import Warehouse  # noqa: E402

WARM_UPS, RUNS, BUILDS = 5, 15, 3
FILTERED = {"default_filters": {}, "diced": {"tahun": [1997, 1998], "channel": ["ATM", "QRIS"], "kota": ["Bandung", "Medan"]}}
# Operators timed on their own: one run each after the load.
OPERATORS = [
    "a17_dedupe_first", "w1_surrogate_keys", "j1_fk_lookup", "j5_cube_rows", "q6_top_merchants", "a9_rollup_time",
    "a18_growth_rate", "a20_run_stats", "a21_nearest_rank_quartiles", "e3_quality_report", "q0_filter_options",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session("bench", cpus)
    timed: dict[str, float] = {}

    folder = bindings.source_folder(spark, sf_dir)
    first, second = bindings.two_day_folders(spark, sf_dir)
    with tempfile.TemporaryDirectory(prefix="lumbung-bench-") as scratch:
        root = f"{scratch}/full"
        load.load_full(spark, first, f"{scratch}/days")
        timed["etl_incremental_load"] = seconds(lambda: load.load_batch(spark, second, f"{scratch}/days", "day-two"))
        timed["etl_full_load"] = seconds(lambda: load.load_full(spark, folder, root))
        wh = Warehouse(spark, root)
        facts = wh.load_record("full")["rows_loaded"]

        builds = []
        for _ in range(BUILDS):
            load.forget_cube(wh)
            builds.append(seconds(lambda: load.refresh_cube(wh).write.format("noop").mode("overwrite").save()))
        timed["cube_build"] = statistics.median(builds)
        cells = load.refresh_cube(wh).persist()
        cells.count()

        # The cells' shuffles are a few rows per member: two partitions are plenty.
        shuffles = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        runs = {name: fn for name, (_, fn) in queries.benchmark_queries().items()}
        runs |= {f"Q2_MonthlyTrend_{k}": (lambda rows, p=p: queries.monthly_trend(rows, p)) for k, p in FILTERED.items()}
        runs |= {f"Q12_Heatmap_{k}": (lambda rows, p=p: queries.heatmap(rows, p)) for k, p in FILTERED.items()}
        for name, fn in runs.items():
            for _ in range(WARM_UPS):
                fn(cells).collect()
            timed[name] = statistics.median(seconds(lambda: fn(cells).collect()) for _ in range(RUNS))
        cells.unpersist()
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)

    for name in OPERATORS:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timed[name] = seconds(lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())

    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": {name: round(value, 4) for name, value in timed.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "fact_rows": facts,
        "etl_rows_per_sec": round(facts / timed["etl_full_load"], 1),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
