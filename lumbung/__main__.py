"""Command line: ``spark-submit ... -m lumbung <job> ...`` or ``python -m lumbung <job> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lumbung.fixed_values import TRANSACTION_FILE
from lumbung.operators.quality import quality_report
from lumbung.plans import cuboids, load, scalability, upkeep
from lumbung.session import TUNING
from lumbung.sources import csv_source, export, metrics, synthetic
from lumbung.sources.synthetic import write_batches
from lumbung.sources.warehouse import Warehouse
from lumbung.streaming.batches import load_available


GENERATOR_OPTIONS = {
    "n_customers": synthetic.BATCH_CUSTOMERS, "n_merchants": synthetic.BATCH_MERCHANTS, "n_transactions": synthetic.BATCH_TRANSACTIONS,
    "first_customer": synthetic.FIRST_CUSTOMER, "first_merchant": synthetic.FIRST_MERCHANT, "first_transaction": synthetic.FIRST_TRANSACTION,
    "seed": 42, "first_day": synthetic.FIRST_DAY, "last_day": synthetic.LAST_DAY,
}


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lumbung")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *arguments: str) -> None:
        sub = jobs.add_parser(name, help=about)
        for argument in arguments:
            sub.add_argument(argument)

    job("full", "replace the warehouse by a source folder", "folder", "warehouse")
    job("incremental", "add a batch folder", "folder", "warehouse", "batch")
    job("stream", "add all new batch folders of a landing folder", "landing", "warehouse", "checkpoint")
    job("refresh", "bring the cube and its finer roll-ups up to date", "warehouse")
    job("plan", "choose the finer roll-ups anew from the facts there are", "warehouse")
    job("compact", "pack batches into few files, in a new version", "warehouse")
    job("vacuum", "remove old versions that no reader uses any more", "warehouse")
    job("quality", "append the data-quality report of a source folder to the metrics", "folder", "warehouse", "metrics")
    job("report", "summaries of the stored metrics", "metrics")
    job("export", "ordered CSVs of all tables", "warehouse", "folder")
    job("generate", "write dirty batches", "folder", "batches")
    for option, default in GENERATOR_OPTIONS.items():
        jobs.choices["generate"].add_argument(f"--{option.replace('_', '-')}", type=type(default), default=default)
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = SparkSession.builder.appName(f"lumbung {args.job}").getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in TUNING.items():
        if key.startswith("spark.sql.") and not submitted.contains(key):
            spark.conf.set(key, value)
    if args.job == "full":
        print(load.load_full(spark, args.folder, args.warehouse))
    elif args.job == "incremental":
        print(load.load_batch(spark, args.folder, args.warehouse, args.batch))
    elif args.job == "stream":
        load_available(spark, args.landing, args.warehouse, args.checkpoint).awaitTermination()
    elif args.job == "refresh":
        load.refresh_cube(Warehouse(spark, args.warehouse))
        cuboids.refresh(Warehouse(spark, args.warehouse))
    elif args.job == "plan":
        for chosen in cuboids.plan(Warehouse(spark, args.warehouse)):
            print(chosen["table"], chosen["rows"], ", ".join(chosen["levels"]))
    elif args.job == "compact":
        print(upkeep.compact(spark, args.warehouse))
    elif args.job == "vacuum":
        upkeep.vacuum(spark, args.warehouse)
    elif args.job == "quality":
        raw = csv_source.read_mandatory(spark, args.folder, TRANSACTION_FILE)
        report = quality_report(raw, ["src_seq"], Warehouse(spark, args.warehouse).facts())
        metrics.append_metrics(report, args.metrics, "data_quality")
        metrics.read_metrics(spark, args.metrics, "data_quality").show(truncate=False)
    elif args.job == "report":
        scalability.write_report(spark, args.metrics)
    elif args.job == "export":
        export.export_all(Warehouse(spark, args.warehouse), args.folder)
    elif args.job == "generate":
        options = {option: getattr(args, option) for option in GENERATOR_OPTIONS}
        print("\n".join(write_batches(spark, args.folder, int(args.batches), **options)))


if __name__ == "__main__":
    main()
