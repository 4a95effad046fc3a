"""Standardisation maps. Closed maps send the rest to a default, open maps let it pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions.parsing import strip


def _lookup(c: Column, table: dict) -> Column:
    """Value for ``c`` in a small fixed table, null on a miss. ``c`` is evaluated once per row."""
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.create_map(*pairs)[c]


def gender(c: Column) -> Column:
    return F.coalesce(_lookup(c, v.GENDER_CODES), F.lit(v.GENDER_UNKNOWN))


def segment(c: Column) -> Column:
    return F.coalesce(_lookup(c, v.SEGMENT_SPELLINGS), c, F.lit(v.SEGMENT_DEFAULT))


def category(c: Column) -> Column:
    return F.coalesce(c, F.lit(v.UNKNOWN))


def channel_of_fact(c: Column) -> Column:
    return F.coalesce(_lookup(F.upper(strip(c)), v.CHANNEL_CODES), F.lit(v.UNKNOWN_CHANNEL))


def channel_member(c: Column) -> Column:
    name = F.upper(strip(c))
    return F.coalesce(_lookup(name, v.CHANNEL_SPELLINGS), name)


def city_member(c: Column) -> Column:
    name = strip(c)
    return F.coalesce(_lookup(name, v.CITY_ALIASES), name)


def city_of_fact(c: Column) -> Column:
    return F.coalesce(city_member(c), F.lit(v.UNKNOWN))


def province(city: Column) -> Column:
    table = {name: info[0] for name, info in v.CITY_INFO.items()}
    return F.coalesce(_lookup(city, table), F.lit(v.UNKNOWN))


def region(city: Column) -> Column:
    table = {name: info[1] for name, info in v.CITY_INFO.items()}
    return F.coalesce(_lookup(city, table), F.lit(v.UNKNOWN))


def latitude(city: Column) -> Column:
    table = {name: at[0] for name, at in v.CITY_COORDS.items()}
    return F.coalesce(_lookup(city, table), F.lit(v.DEFAULT_COORDS[0]))


def longitude(city: Column) -> Column:
    table = {name: at[1] for name, at in v.CITY_COORDS.items()}
    return F.coalesce(_lookup(city, table), F.lit(v.DEFAULT_COORDS[1]))


def gender_label(c: Column) -> Column:
    return F.coalesce(_lookup(c, v.GENDER_LABELS), c)


def month_short(c: Column) -> Column:
    return F.coalesce(_lookup(c, v.MONTH_SHORT), c)


def weekday_short(c: Column) -> Column:
    return F.coalesce(_lookup(c, v.WEEKDAY_SHORT), c)
