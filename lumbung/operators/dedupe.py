"""Keep-first de-duplication and members in order of first appearance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """The first row per key in ``order_by`` order; null keys count as equal.

    ``row_number() = 1`` makes Spark keep one row per key in every input
    partition before the shuffle (WindowGroupLimit), so a key that holds a third
    of all rows sends at most one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def first_seen(df: DataFrame, members: list[str], seq: str = "src_seq") -> DataFrame:
    """Distinct members with the sequence of their first appearance, pre-aggregated before the shuffle."""
    return df.groupBy(*members).agg(F.min(seq).alias(seq))


def later_copies(df: DataFrame, key: str, seq: str = "src_seq") -> DataFrame:
    """The rows ``keep_first`` drops: all but the first of each key; null keys count as equal.

    Keys that occur more than once are found by a combined count. Their rows are joined, not gathered
    by a window, so Spark can split a key that holds a third of them.
    """
    repeated = df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), F.min(seq).alias("_first")).filter("_n > 1")
    joined = df.join(repeated, F.col(key).eqNullSafe(F.col("_key")) & (F.col(seq) > F.col("_first")))
    return joined.select(*df.columns)
