"""Calendar rows, calendar order, labels and date-range arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.fixed_values import MONTHS, SCALES, WEEKDAYS
from lumbung.functions.parsing import date_key


def _position(c: Column, members: list[str]) -> Column:
    return F.array_position(F.lit(members), c).cast("int")


def month_index(month_name: Column) -> Column:
    """1..12, and 0 for a name that is no month."""
    return _position(month_name, MONTHS)


def weekday_index(day_name: Column) -> Column:
    """1 = Monday .. 7 = Sunday, and 0 for a name that is no weekday."""
    return _position(day_name, WEEKDAYS)


def scale_index(scale: Column) -> Column:
    return _position(scale, SCALES)


def month_label(month_name: Column, year: Column) -> Column:
    """``Apr 2026``."""
    return F.concat(F.substring(month_name, 1, 3), F.lit(" "), year.cast("string"))


def day_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def money_label(c: Column) -> Column:
    """``1,234.50``: the display format of money measures."""
    return F.format_number(c, 2)


def in_billions(c: Column) -> Column:
    return F.round(c.cast("double") / 1_000_000_000, 2)


def in_millions(c: Column) -> Column:
    return F.round(c.cast("double") / 1_000_000, 2)


def previous_month(year: int, month_name: str) -> tuple[int, str]:
    """The month before; January goes to December of the year before. Raises on an unknown name."""
    at = MONTHS.index(month_name)
    return (year - 1, MONTHS[11]) if at == 0 else (year, MONTHS[at - 1])


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last``, with the calendar dimension's columns."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("d")
    )
    return calendar_rows(days, F.col("d"))


def calendar_rows(days: DataFrame, d: Column) -> DataFrame:
    return days.select(
        date_key(d).alias("waktu_id"),
        d.alias("tanggal"),
        F.date_format(d, "EEEE").alias("hari"),
        F.date_format(d, "MMMM").alias("bulan"),
        F.year(d).alias("tahun"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
    )


def split_date_range(ranges: DataFrame, first: str, last: str, parts: str) -> DataFrame:
    """Each row's [first, last] cut into ``parts`` back-to-back chunks; the first chunks take the rest days.

    Adds ``chunk`` (1..parts), ``chunk_first`` and ``chunk_last``.
    """
    n = F.col(parts)
    days = F.datediff(F.col(last), F.col(first)) + 1
    size = F.floor(days / n).cast("int")
    longer = days % n
    at = F.col("chunk") - 1
    offset = at * size + F.least(at, longer)
    length = size + F.when(at < longer, 1).otherwise(0)
    return (
        ranges.withColumn("chunk", F.explode(F.sequence(F.lit(1), n.cast("int"))))
        .withColumn("chunk_first", F.date_add(F.col(first), offset.cast("int")))
        .withColumn("chunk_last", F.date_add(F.col(first), (offset + length - 1).cast("int")))
    )
