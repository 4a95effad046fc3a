"""PII: format-preserving Feistel pseudonyms, with DataFrame functions only.

Found and validated: e-mail addresses, telephone numbers (a leading + and 8 to 15 digits, or groups
of 3, 3 and 4 digits), card numbers (13 to 19 digits that pass the Luhn check; of a run of groups that
fails, the longest groups in a row that pass, the first of them), IPv4 addresses
(four numbers up to 255) and dates (ISO, or day.month.year with a four-digit year) that exist and
fall in 1900 to 2099. Each value is permuted with a key within its format:

* text formats are cut in two halves; a round shifts every digit within the digits and every ASCII
  letter within the letters of its case by amounts hashed from the key, the round and the other
  half, so other characters and lengths stay; a card's last digit is then set to pass the check;
* addresses are pairs of 16-bit numbers, dates pairs (17 x 4297 = the days of 1900 to 2099); a round
  adds a hash of one of the two to the other, modulo its size.

Every round can be undone, so equal values get equal pseudonyms in all documents and different
values of a format different ones. Only punctuation and the domain of an address are kept.

Edge cases: null text stays null with zero counts, empty text empty; repeated rows change alike; an
empty table gives an empty result; ``pseudonymise`` replaces ``text`` and keeps all other columns, whatever their
names, but for columns named like a count, which the count replaces. A very long text is one row of
arrays of its matches; its plain parts are not cut further. Matches do not overlap: at one place the
first kind of ``ANY`` that fits is taken.

The key is a secret: it comes as an argument or from the session setting ``KEY_SETTING``. Without one a fresh
random key is drawn for the call, so values are linked within its result and nobody can undo it.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.llm.common import beside, put_back

KEY_SETTING = "spark.lumbung.pseudonyms.key"
ROUNDS = 6
# Formats (fixed values).
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){0,8}\.[A-Za-z]{2,24}"
IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)"
DATE = r"(?<![\d.\-])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d\.\d\d\.(?:19|20)\d\d)(?![\d\-])"
PHONE = r"\+\d{1,3}[ \-]?(?:\(\d{2,4}\)[ \-]?)?\d{2,4}(?:[ \-]?\d{2,4}){1,3}(?!\d)|(?<!\d)\(?\d{3}\)?[ \-]\d{3}-\d{4}(?!\d)"
CARD = r"(?<!\d)\d(?:[ \-]?\d){12,18}(?!\d)"
ANY = "|".join((EMAIL, IP, DATE, PHONE, CARD))
KINDS = ("email", "ip", "date", "phone", "card")
_DAYS = (17, 4297)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _luhn_sum(digits: Column, odd: int) -> Column:
    """Sum of the digits, doubled where the place from the right is ``odd`` modulo 2 (counted from 1)."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == (odd + 1) % 2, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.try_cast("int") + 1)).otherwise(c.try_cast("int")))
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def _shift(half: Column, digest: Column) -> Column:
    """Each digit and ASCII letter moved within its class by two hexadecimal digits of the digest (which repeats)."""

    def move(c: Column, i: Column) -> Column:
        step = F.conv(F.substring(digest, i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        for first, size in ((48, 10), (65, 26), (97, 26)):
            code = F.when((F.ascii(c) >= first) & (F.ascii(c) < first + size) & (F.octet_length(c) == 1), (F.ascii(c) - first + step) % size + first).otherwise(code)
        return F.when(F.octet_length(c) == 1, F.char(code)).otherwise(c)

    return F.when(F.length(half) == 0, half).otherwise(F.array_join(F.transform(F.split(half, ""), move), ""))


def _text_feistel(value: Column, key: str) -> Column:
    """Alternating rounds on the halves; written as a fold over round numbers, so the expression stays small."""
    cut = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))

    def turn(state: Column, n: Column) -> Column:
        even = n % 2 == 0
        digest = F.sha2(F.concat(F.lit(key + "|"), n.cast("string"), F.lit("|"), F.length(value).cast("string"), F.lit("|"), F.when(even, state["r"]).otherwise(state["l"])), 256)
        moved = _shift(F.when(even, state["l"]).otherwise(state["r"]), digest)
        return F.struct(F.when(even, moved).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise(moved).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _number_feistel(value: Column, sizes: tuple[int, int], key: str) -> Column:
    """A number below the product of the sizes, as quotient and remainder, each moved by a hash of the other in turn."""
    a, b = sizes
    start = F.struct(F.floor(value / b).cast("long").alias("l"), (value % b).cast("long").alias("r"))

    def turn(state: Column, n: Column) -> Column:
        even = n % 2 == 0
        digest = F.sha2(F.concat(F.lit(key + "|"), n.cast("string"), F.lit("|"), F.when(even, state["r"]).otherwise(state["l"]).cast("string")), 256)
        step = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
        return F.struct(F.when(even, (state["l"] + step) % a).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise((state["r"] + step) % b).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def _put_digits(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced one by one."""
    marks = F.split(value, "")
    done = F.aggregate(marks, F.struct(F.lit("").alias("t"), F.lit(0).alias("n")), lambda s, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(s["t"], F.substring(digits, s["n"] + 1, F.lit(1))).alias("t"), (s["n"] + 1).alias("n"))
    ).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["n"].alias("n"))))
    return done["t"]


def _date(value: Column) -> Column:
    iso = F.try_to_date(F.when(value.rlike(r"^\d{4}"), value), "yyyy-MM-dd")
    return F.coalesce(iso, F.try_to_date(F.when(value.rlike(r"^\d\d\."), value), "dd.MM.yyyy"))


def _card_span(value: Column) -> Column:
    """struct(n, back) of the longest whole groups of a run of digits that are a card number: n digits after the first -back; else null."""
    digits = _digits(value)
    sizes = F.transform(F.split(value, r"[ \-]"), lambda g: F.length(g))
    ends = F.transform(sizes, lambda g, i: F.aggregate(F.slice(sizes, 1, i + 1), F.lit(0), lambda a, x: a + x))
    spans = F.flatten(F.transform(sizes, lambda g, i: F.transform(ends, lambda e: F.struct((e - F.get(ends, i) + g).alias("n"), (g - F.get(ends, i)).alias("back")))))
    return F.array_max(F.filter(spans, lambda x: x["n"].between(13, 19) & (_luhn_sum(F.substring(digits, 1 - x["back"], x["n"]), 0) % 10 == 0)))


def kind(value: Column) -> Column:
    """Which of ``KINDS`` a match of ``ANY`` is after validation, else null."""
    digits = _digits(value)
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^{IP}$"), "ip")
        .when(value.rlike(rf"^{DATE}$"), F.when(_date(value).isNotNull(), "date"))
        .when(value.rlike(rf"^(?:{PHONE})$"), F.when(F.length(digits).between(8, 15), "phone"))
        .when(value.rlike(rf"^{CARD}$"), F.when(_card_span(value)["n"].isNotNull(), "card"))
    )


def _card(value: Column, digits: Column, span: Column, key: str) -> Column:
    body = _text_feistel(F.substring(digits, 1 - span["back"], span["n"] - 1), key + "|card")
    check = ((10 - _luhn_sum(body, 1) % 10) % 10).cast("string")
    return _put_digits(value, F.concat(F.substring(digits, F.lit(1), -span["back"]), body, check, F.substring(digits, 1 - span["back"] + span["n"], F.length(digits))))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a match; matches that fail their validation stay."""
    at = F.instr(value, "@")
    email = F.concat(_text_feistel(F.substring(value, F.lit(1), at - 1), key + "|email"), F.substring(value, at, F.length(value)))
    parts = F.split(value, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n * 256 + p.try_cast("int"))
    moved = _number_feistel(number, (1 << 16, 1 << 16), key + "|ip")
    ip = F.array_join(F.transform(F.array(*[F.lit(x) for x in (1 << 24, 1 << 16, 1 << 8, 1)]), lambda d: (F.floor(moved / d) % 256).cast("string")), ".")
    first = F.lit("1900-01-01").cast("date")
    day = F.date_add(first, _number_feistel(F.datediff(_date(value), first).cast("long"), _DAYS, key + "|date").cast("int"))
    date = F.when(value.rlike(r"^\d{4}"), F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "dd.MM.yyyy"))
    digits = _digits(value)
    lead = F.length(F.regexp_extract(value, r"^\+\d{1,3}(?=[ \-(])", 0)) - 1  # a country code that stands apart stays
    code = F.when(lead > 0, F.substring(digits, F.lit(1), lead)).otherwise(F.lit(""))
    phone = _put_digits(value, F.concat(code, _text_feistel(F.substring(digits, F.length(code) + 1, F.length(digits)), key + "|phone")))
    # Digits before and after the card stay.
    card = F.get(F.transform(F.array(_card_span(value)), lambda x: _card(value, digits, x, key)), 0)
    kinds = kind(value)
    return F.when(kinds == "email", email).when(kinds == "ip", ip).when(kinds == "date", date).when(kinds == "phone", phone).when(kinds == "card", card).otherwise(value)


def _is(name: str):
    return lambda x: x == name


def pseudonymise(docs: DataFrame, key: str | None = None) -> DataFrame:
    """All columns with ``text`` pseudonymised, and one count column ``n_<kind>`` for each kind."""
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None) or secrets.token_hex(32)
    found = docs.select(beside(docs, "text"), "text", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)).alias("found"))
    # Texts without a match, most of them, skip all that follows.
    parts = F.split("text", ANY, -1)
    mended = F.array_join(F.zip_with(parts, F.transform("found", lambda v: pseudonym(v, key)), lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")
    hit = F.size("found") > 0
    kinds = F.when(hit, F.transform("found", kind)).otherwise(F.array().cast("array<string>"))
    out = found.withColumn("kinds", kinds).withColumn("text", F.when(hit, mended).otherwise(F.col("text")))
    counts = [F.size(F.filter("kinds", _is(k))).alias(f"n_{k}") for k in KINDS]
    kept = docs.drop(*[f"n_{k}" for k in KINDS])
    return out.select(*put_back(kept, "text"), *counts)
