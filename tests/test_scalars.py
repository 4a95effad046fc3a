"""Parsing, standardisation, labels, calendar."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions import calendar as cal
from lumbung.functions import mapping as m
from lumbung.functions import parsing as p

X = "x"


def test_amounts(column):
    raw = ["1.234.567,89", "-5.000", "100", "", "abc", " 7 ", "100.500", None, "\t1,5\n"]
    want = ["1234567.89", "-5000", "100", "0", "0", "7", "100500", "0", "1.5"]
    assert column(raw, p.parse_amount(F.col(X))) == [Decimal(w).quantize(Decimal("0.01")) for w in want]


def test_amounts_out_of_range_are_null_and_never_zero(column):
    raw = ["12.345.678.901.234.567,00", "-12.345.678.901.234.567", "9.999.999.999.999.999,99", "1e400", "nan", "-nan"]
    want = [None, None, Decimal("9999999999999999.99"), None, Decimal(0), Decimal(0)]
    assert column(raw, p.parse_amount(F.col(X))) == want
    assert column(["1e20", "12345678901234567", "-1e20"], p.parse_fee(F.col(X))) == [None] * 3


def test_the_sign_is_judged_before_rounding(column):
    raw = ["-0,004", "0,004", "-0", "-1", "-99.999.999.999.999.999", "-x", "", None]
    assert column(raw, p.is_negative_amount(F.col(X))) == [True, False, False, True, True, False, False, False]


def test_fees_keep_the_point(column):
    assert column(["2500", "1.5", "", "x", None], p.parse_fee(F.col(X))) == [
        Decimal("2500.00"), Decimal("1.50"), Decimal("0.00"), Decimal("0.00"), Decimal("0.00")
    ]


def test_transaction_dates(column):
    raw = ["13-04-2026", "5-4-2026", "31-13-2026", "01/02/2026", "", "04-13-2026", None]
    want = [datetime.date(2026, 4, 13), datetime.date(2026, 4, 5)] + [None] * 5
    assert column(raw, p.parse_transaction_date(F.col(X))) == want


def test_birth_dates(column):
    assert column(["05/12/1980", "31/02/1999", ""], p.parse_birth_date(F.col(X))) == [datetime.date(1980, 12, 5), None, None]


def test_date_key(column):
    key = p.date_key(p.parse_transaction_date(F.col(X)))
    assert column(["5-4-2026", "x"], key) == [20260405, None]
    assert column(["5-4-2026"], p.key_year(key)) == [2026]


def test_blank_tokens(column):
    raw = ["", "NA", "None", "null", "NaN", " ", "na", "UNKNOWN", "a long enough text"]
    assert column(raw, p.blank_to_null(F.col(X))) == [None] * 5 + [" ", "na", "UNKNOWN", "a long enough text"]


def test_gender_is_a_closed_map(column):
    raw = ["L", "P", "M", "Laki-laki", "Female", "Pria", "Wanita", "", None, "l"]
    assert column(raw, m.gender(F.col(X))) == ["L", "P", "L", "L", "P", "U", "U", "U", "U", "U"]


def test_segment_is_an_open_map(column):
    assert column(["Reguler", "RETAIL", "prio", "Private", None, "Gold"], m.segment(F.col(X))) == [
        "Reguler", "Reguler", "Prioritas", "Private", "Reguler", "Gold"
    ]


def test_channels_differ_for_facts_and_members(column):
    raw = ["atm", " bifast ", "EDC", None, "Bi_Fast"]
    assert column(raw, m.channel_of_fact(F.col(X))) == ["ATM", "BI_FAST", "UNKNOWN", "UNKNOWN", "BI_FAST"]
    assert column(raw, m.channel_member(F.col(X))) == ["ATM", "BI_FAST", "EDC", None, "BI_FAST"]


def test_cities(column):
    raw = ["BDG", " SBY", "Cirebon", None, "Jkt Sel"]
    assert column(raw, m.city_of_fact(F.col(X))) == ["Bandung", "Surabaya", "Cirebon", "Unknown", "Jakarta Selatan"]
    assert column(["Bandung", "Cirebon"], m.province(F.col(X))) == ["Jawa Barat", "Unknown"]
    assert column(["Denpasar", None], m.region(F.col(X))) == ["Bali & Nusa Tenggara", "Unknown"]
    assert column(["Medan", "Padang"], m.latitude(F.col(X))) == [3.5952, -2.5489]


def test_category(column):
    assert column(["Retail", None], m.category(F.col(X))) == ["Retail", "Unknown"]


def test_calendar_order_and_labels(column):
    assert column(["January", "December", "Unknown"], cal.month_index(F.col(X))) == [1, 12, 0]
    assert column(["Monday", "Sunday"], cal.weekday_index(F.col(X))) == [1, 7]
    assert column(["S", "XL"], cal.scale_index(F.col(X))) == [1, 4]
    assert column(["April"], cal.month_label(F.col(X), F.lit(2026))) == ["Apr 2026"]
    assert column(["1234.5"], cal.money_label(F.col(X).cast("double"))) == ["1,234.50"]
    assert column(["May", "Oddtober"], m.month_short(F.col(X))) == ["Mei", "Oddtober"]


def test_previous_month():
    assert cal.previous_month(2027, "January") == (2026, "December")
    assert cal.previous_month(2027, "March") == (2027, "February")
    with pytest.raises(ValueError):
        cal.previous_month(2027, "Maret")


def test_calendar_rows(spark):
    rows = cal.calendar(spark, "2001-01-01", "2030-12-31")
    assert rows.count() == 10957
    assert tuple(rows.filter("waktu_id = 20260405").first()) == (
        20260405, datetime.date(2026, 4, 5), "Sunday", "April", 2026, "Q2"
    )


@pytest.mark.parametrize("parts", [1, 3, 7, 20])
def test_split_date_range(spark, parts):
    first, last = datetime.date(2026, 4, 12), datetime.date(2030, 12, 31)
    df = spark.createDataFrame([(first, last, parts)], "a date, b date, n int")
    rows = cal.split_date_range(df, "a", "b", "n").orderBy("chunk").collect()
    sizes = [(r.chunk_last - r.chunk_first).days + 1 for r in rows]
    days = (last - first).days + 1
    assert sizes == [days // parts + (1 if i < days % parts else 0) for i in range(parts)]
    assert rows[0].chunk_first == first and rows[-1].chunk_last == last
    assert all((b.chunk_first - a.chunk_last).days == 1 for a, b in zip(rows, rows[1:]))


def test_fixed_tables_fit_together():
    assert set(v.CITY_ALIASES.values()) <= set(v.MASTER_CITIES) and len(v.MASTER_CITIES) == 16
    assert set(v.CITY_COORDS) <= set(v.MASTER_CITIES)
