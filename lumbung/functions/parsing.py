"""Raw text to typed values. Nothing here throws under ANSI mode: bad text becomes null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.fixed_values import BIRTH_DATE, NULL_TOKENS, TRANSACTION_DATE

AMOUNT = "decimal(18,2)"
BLANKS = " \t\n\r\x0b\x0c"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def blank_to_null(c: Column) -> Column:
    """Null for the tokens that stand for "no value" in a CSV."""
    longest = max(map(len, NULL_TOKENS))
    return F.when((F.octet_length(c) > longest) | ~c.isin(NULL_TOKENS), c)


def blanks_to_null(df: DataFrame, *keep: str) -> DataFrame:
    """``blank_to_null`` on every column but ``keep``."""
    return df.select(
        *[F.col(c) if c in keep else blank_to_null(F.col(c)).alias(c) for c in df.columns]
    )


def _plain(c: Column) -> Column:
    """``1.234.567,89`` -> ``1234567.89``."""
    return F.replace(F.replace(strip(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def _too_large(number: Column) -> Column:
    """A readable number that AMOUNT cannot hold."""
    size = F.abs(number.try_cast("double"))
    return number.try_cast(AMOUNT).isNull() & F.coalesce((size >= 1e15) & ~F.isnan(size), F.lit(False))


def _amount(number: Column) -> Column:
    return F.when(~_too_large(number), F.coalesce(number.try_cast(AMOUNT), F.lit(0).cast(AMOUNT)))


def parse_amount(c: Column) -> Column:
    """``1.234.567,89`` -> 1234567.89; null and unreadable text -> 0; a number out of range -> null."""
    return _amount(_plain(c))


def is_negative_amount(c: Column) -> Column:
    """The sign of the amount as it is written, before it is rounded: ``-0,004`` is negative."""
    number = _plain(c)
    readable = number.try_cast(AMOUNT).isNotNull() | _too_large(number)
    return readable & F.coalesce(number.try_cast("double") < 0, F.lit(False))


def parse_fee(c: Column) -> Column:
    """A number with a decimal point; null and unreadable text -> 0; a number out of range -> null."""
    return _amount(c)


def parse_transaction_date(c: Column) -> Column:
    return F.try_to_date(c, TRANSACTION_DATE)


def parse_birth_date(c: Column) -> Column:
    return F.try_to_date(c, BIRTH_DATE)


def date_key(d: Column) -> Column:
    """Date -> integer key YYYYMMDD."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def key_year(key: Column) -> Column:
    """YYYYMMDD -> YYYY."""
    return F.floor(key / 10000).cast("int")
