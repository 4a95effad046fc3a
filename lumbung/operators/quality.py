"""The data-quality report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.functions import parsing as p


def input_quality(raw: DataFrame, order_by: list) -> DataFrame:
    """One row of input counts.

    Faults are counted on the first copy of each transaction, each kind on its
    own: a row with two faults counts twice, but a negative amount is not
    counted as out of range too. Copies are counted before the shuffle, so one
    id with very many copies stays cheap.
    """
    checked = raw.select(
        "trx_id",
        F.struct(
            *order_by,
            p.is_negative_amount(F.col("nominal")).alias("negative"),
            (p.parse_amount(F.col("nominal")).isNull() | p.parse_fee(F.col("biaya_admin")).isNull()).alias("out_of_range"),
            p.parse_transaction_date(F.col("tgl_transaksi")).isNull().alias("bad_date"),
        ).alias("first"),
    )
    per_id = checked.groupBy("trx_id").agg(F.count("*").alias("copies"), F.min("first").alias("first"))
    counts = per_id.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("total_input_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_removed"),
        F.count_if("first.negative").alias("negative_nominal_removed"),
        F.count_if("first.bad_date").alias("invalid_date_removed"),
        F.count_if(F.col("first.out_of_range") & ~F.col("first.negative")).alias("out_of_range_removed"),
    )
    kinds = ["duplicate_removed", "negative_nominal_removed", "invalid_date_removed", "out_of_range_removed"]
    removed = reduce(lambda a, b: a + b, map(F.col, kinds))
    kept = F.col("total_input_rows") - F.col("total_records_removed")
    return counts.withColumn("total_records_removed", removed).withColumn(
        "data_quality_rate_pct",
        F.bround(F.try_divide(kept.cast("double"), F.col("total_input_rows").cast("double")) * 100, 2),
    )


def fact_quality(fact: DataFrame) -> DataFrame:
    """One row: facts that fell to the Unknown member, per dimension, and all facts."""
    return fact.agg(
        F.count_if(F.col("nasabah_id") == 0).alias("unknown_nasabah"),
        F.count_if(F.col("merchant_id") == 0).alias("unknown_merchant"),
        F.count_if(F.col("channel_id") == 0).alias("unknown_channel"),
        F.count_if(F.col("wilayah_id") == 0).alias("unknown_wilayah"),
        F.count("*").alias("fact_rows_in_db"),
    )


def quality_report(raw: DataFrame, order_by: list, fact: DataFrame) -> DataFrame:
    """Input counts and fact counts side by side, one row."""
    in_facts = fact_quality(fact).select(F.struct("*")).scalar()
    return input_quality(raw, order_by).withColumn("_facts", in_facts).select("*", "_facts.*").drop("_facts")
