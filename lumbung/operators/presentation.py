"""Positional computations on query results: rank, shares, ratio to the maximum, peaks, previous month.

A result that is compared with its own total, maximum or month before is staged
first, so the facts behind it are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.calendar import month_index
from lumbung.sources.staging import stage


def share_of_total(df: DataFrame, value: str) -> DataFrame:
    """``share`` of the total per row, and whether its label is shown (from 5 % on)."""
    rows = stage(df, "result")
    share = F.round(F.try_divide(F.col(value), rows.agg(F.sum(value)).scalar()), 6)
    return rows.withColumn("share", share).withColumn("label_visible", F.col("share") >= 0.05)


def share_within(df: DataFrame, group: str, value: str) -> DataFrame:
    """``share_pct`` of each row within its group, one decimal; 0 in an empty group."""
    rows = stage(df, "result")
    totals = rows.groupBy(group).agg(F.sum(value).alias("_total"))
    pct = F.round(F.try_divide(F.col(value), F.col("_total")) * 100, 1)
    return rows.join(totals, group).withColumn("share_pct", F.coalesce(pct, F.lit(0.0))).drop("_total")


def _of_max(rows: DataFrame, value: str) -> Column:
    return F.coalesce(F.try_divide(F.col(value), rows.agg(F.max(value)).scalar()), F.lit(0.0))


def ratio_to_max(df: DataFrame, value: str) -> DataFrame:
    """``ratio`` to the largest value; 0 when the largest is 0."""
    rows = stage(df, "result")
    return rows.withColumn("ratio", F.round(_of_max(rows, value), 6))


def map_radius(df: DataFrame, value: str) -> DataFrame:
    """Circle radius on the map: 6 plus up to 24 by ratio to the maximum."""
    rows = stage(df, "result")
    return rows.withColumn("radius", F.round(6 + _of_max(rows, value) * 24, 4))


def rank_rows(top: DataFrame, order_by: list) -> DataFrame:
    """``peringkat`` 1..n on the few rows of a top-k result."""
    return top.withColumn("peringkat", F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))


def peak_flag(df: DataFrame, value: str, position: Column) -> DataFrame:
    """``is_peak`` on the largest value; the first in ``position`` order wins."""
    rows = stage(df, "result")
    place = F.struct(F.col(value), -position)
    return rows.withColumn("is_peak", place == rows.agg(F.max(place)).scalar())


def sorted_by(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Sort by a column and direction of the user's choice."""
    return df.orderBy(F.col(column).desc() if descending else F.col(column).asc())


def percent_change(now: Column, before: Column) -> Column:
    """Change in percent, two decimals; null when there is nothing to compare with."""
    return F.when(before != 0, F.bround((now - before) / before * 100, 2))


def month_over_month(months: DataFrame, values: list[str]) -> DataFrame:
    """``<value>_mom_pct`` against the calendar month before, null when that month is absent.

    Takes one row per (tahun, bulan). The month before is found by an equi join
    on a running month number, so gaps in the months are not skipped over.
    """
    number = F.col("tahun") * 12 + month_index(F.col("bulan"))
    numbered = stage(months, "result").withColumn("_m", number)
    before = numbered.select((F.col("_m") + 1).alias("_m"), *[F.col(c).alias(f"_prev_{c}") for c in values])
    joined = numbered.join(before, "_m", "left")
    return joined.select(
        *months.columns,
        *[percent_change(F.col(c), F.col(f"_prev_{c}")).alias(f"{c}_mom_pct") for c in values],
    )
