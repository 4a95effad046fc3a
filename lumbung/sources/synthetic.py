"""Dirty source batches, generated as a Spark job.

Every value is a function of the row's number and a seed, so a batch is the same
however it is partitioned.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions.calendar import calendar, split_date_range
from lumbung.sources.staging import shuffles_freed

# --- Fixed values: spellings found in the sources ------------------------------
GENDER_SPELLINGS = ["L", "P", "M", "Laki-laki", "Female", "Pria", "Wanita", ""]
SEGMENT_SPELLINGS = ["Reguler", "Prioritas", "RETAIL", "prio", "Private", ""]
CATEGORIES = ["Retail", "F&B", "Food & Beverage", "Health", "Kesehatan", "Market", "Electronics", ""]
CHANNEL_SPELLINGS = ["ATM", "BI_FAST", "BIFAST", "bifast", "QRIS", "qris", "ATM_LINK", "LIVIN", "livin"]
BAD_BIRTH_DATE, BAD_TRANSACTION_DATE = "31/02/1999", "31-13-2026"
FEES = ["0", "2500", "6500"]
# --- Fixed values: first and last transaction day of all batches ---------------
FIRST_DAY, LAST_DAY = "2026-04-12", "2030-12-31"
CALENDAR_DAYS = ("2001-01-01", "2030-12-31")
# --- Fixed values: numbers and sizes of the first batch -------------------------
BATCH_CUSTOMERS, BATCH_MERCHANTS, BATCH_TRANSACTIONS = 1000, 100, 10_000
FIRST_CUSTOMER, FIRST_MERCHANT, FIRST_TRANSACTION = 11_001, 5101, 205_000
KNOWN_CUSTOMER, KNOWN_MERCHANT = 10_001, 5001

PRIME = (1 << 31) - 1


@dataclass(frozen=True)
class Pool:
    """Codes ``<prefix><first> .. <prefix><first + size - 1>``."""

    prefix: str
    first: int
    size: int

    def pick(self, seed: int, salt: str) -> Column:
        return F.concat(F.lit(self.prefix), (F.lit(self.first) + _draw(seed, salt, self.size)).cast("string"))


def _draw(seed: int, salt: str, n: int | Column) -> Column:
    """A number in 0 .. n-1 for the row, by integer arithmetic that any SQL engine repeats.

    The row number is squared twice modulo a prime; salt and seed give the constant added between.
    """
    key = F.lit((zlib.crc32(salt.encode()) * 31 + seed) % PRIME).cast("bigint")
    x = (F.pmod(F.col("id").cast("bigint"), F.lit(PRIME)) + key) % PRIME
    y = x * 48271 % PRIME
    z = (y * y + key) % PRIME * 69621 % PRIME
    return (z * z + x) % PRIME % n


def _choice(seed: int, salt: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (_draw(seed, salt, len(values)) + 1).cast("int"))


def _day_between(seed: int, salt: str, first: str, last: str) -> Column:
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    return F.date_add(start, _draw(seed, salt, F.datediff(end, start) + 1).cast("int"))


def customers(ids: DataFrame, seed: int) -> DataFrame:
    """One customer per ``id``: 5 % without, 3 % with an impossible birth date."""
    roll = _draw(seed, "birth", 100)
    born = F.date_format(_day_between(seed, "born", "1960-01-01", "2005-12-31"), "dd/MM/yyyy")
    return ids.select(
        F.concat(F.lit("N-"), F.col("id").cast("string")).alias("nasabah_code"),
        F.concat(F.lit("Nasabah "), _draw(seed, "name", 288).cast("string")).alias("nama_lengkap"),
        _choice(seed, "gender", GENDER_SPELLINGS).alias("jenis_kelamin"),
        F.when(roll < 5, "").when(roll < 8, BAD_BIRTH_DATE).otherwise(born).alias("tanggal_lahir"),
        _choice(seed, "segment", SEGMENT_SPELLINGS).alias("segmen_nasabah"),
    )


def merchants(ids: DataFrame, seed: int) -> DataFrame:
    return ids.select(
        F.concat(F.lit("MCH-"), F.col("id").cast("string")).alias("merchant_code"),
        F.concat(F.lit("Toko "), F.col("id").cast("string")).alias("nama_merchant"),
        _choice(seed, "category", CATEGORIES).alias("kategori"),
    )


def local_number(whole: Column, cents: Column) -> Column:
    """1234567 -> ``1.234.567``; with cents -> ``1.234.567,05``."""
    grouped = F.translate(F.format_number(whole, 0), ",", ".")
    return F.concat(grouped, F.coalesce(F.concat(F.lit(","), F.lpad(cents.cast("string"), 2, "0")), F.lit("")))


def transactions(ids: DataFrame, customer_pool: Pool, merchant_pool: Pool, first: str, last: str, seed: int) -> DataFrame:
    """One transaction per ``id`` plus about 2 % exact copies, in mixed-up order.

    2 % without and 2 % with an impossible date, 2 % with one of the four
    references blank, 3 % negative amounts, 20 % with cents, 5 % without fee.
    """
    roll = _draw(seed, "date", 100)
    day = F.date_format(_day_between(seed, "day", first, last), "dd-MM-yyyy")
    blank = F.when(_draw(seed, "unknown", 100) < 2, _draw(seed, "which", 4)).otherwise(-1)
    amount = (F.lit(10_000) + _draw(seed, "amount", 9_990_001)).cast("bigint")
    cents = F.when(_draw(seed, "has_cents", 100) < 20, _draw(seed, "cents", 100))
    sign = F.when(_draw(seed, "sign", 100) < 3, "-").otherwise("")

    def unless_blank(at: int, value: Column) -> Column:
        return F.when(blank == at, "").otherwise(value)

    rows = ids.select(
        "id",
        F.concat(F.lit("TRX-"), F.col("id").cast("string")).alias("trx_id"),
        F.when(roll < 2, "").when(roll < 4, BAD_TRANSACTION_DATE).otherwise(day).alias("tgl_transaksi"),
        unless_blank(0, customer_pool.pick(seed, "customer")).alias("nasabah_code"),
        unless_blank(2, _choice(seed, "channel", CHANNEL_SPELLINGS)).alias("channel"),
        unless_blank(1, merchant_pool.pick(seed, "merchant")).alias("merchant_code"),
        unless_blank(3, _choice(seed, "city", v.MASTER_CITIES + list(v.CITY_ALIASES))).alias("kota"),
        F.concat(sign, local_number(amount, cents)).alias("nominal"),
        F.when(_draw(seed, "no_fee", 100) < 5, "").otherwise(_choice(seed, "fee", FEES)).alias("biaya_admin"),
        _draw(seed, "copy", 100).alias("_copy"),
    )
    copies = rows.select("*", F.explode(F.when(F.col("_copy") < 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_nth"))
    mixed = copies.orderBy(F.xxhash64("id", "_nth", F.lit(seed)), "id", "_nth")
    return mixed.drop("id", "_copy", "_nth")


def write_source(df: DataFrame, path: str, compression: str = "none") -> None:
    """A source CSV as the source systems write it: ``;``, header, blanks kept."""
    with shuffles_freed(df.sparkSession):
        (
            df.write.mode("overwrite").option("sep", ";").option("header", True).option("compression", compression)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )


def date_chunks(spark: SparkSession, batches: int, first: str = FIRST_DAY, last: str = LAST_DAY) -> list[tuple[str, str]]:
    """The days of each batch: back to back, in order."""
    whole = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last"), F.lit(batches).alias("n")
    )
    rows = split_date_range(whole, "first", "last", "n").orderBy("chunk").collect()
    return [(str(r.chunk_first), str(r.chunk_last)) for r in rows]


def write_batches(
    spark: SparkSession, folder: str, batches: int = 20, n_customers: int = BATCH_CUSTOMERS, n_merchants: int = BATCH_MERCHANTS,
    n_transactions: int = BATCH_TRANSACTIONS, first_customer: int = FIRST_CUSTOMER, first_merchant: int = FIRST_MERCHANT,
    first_transaction: int = FIRST_TRANSACTION, seed: int = 42, first_day: str = FIRST_DAY, last_day: str = LAST_DAY,
) -> list[str]:
    """Write ``batch_01 .. batch_NN``; transactions refer to every code issued so far. Returns the folders.

    The first folder also gets the calendar.
    """
    written = []
    for nth, (first, last) in enumerate(date_chunks(spark, batches, first_day, last_day)):
        path = f"{folder}/batch_{nth + 1:02d}"
        new_customer = first_customer + nth * n_customers
        new_merchant = first_merchant + nth * n_merchants
        new_transaction = first_transaction + nth * n_transactions
        customer_pool = Pool("N-", KNOWN_CUSTOMER, new_customer + n_customers - KNOWN_CUSTOMER)
        merchant_pool = Pool("MCH-", KNOWN_MERCHANT, new_merchant + n_merchants - KNOWN_MERCHANT)
        write_source(customers(spark.range(new_customer, new_customer + n_customers), seed), f"{path}/{v.CUSTOMER_FILE}")
        write_source(merchants(spark.range(new_merchant, new_merchant + n_merchants), seed), f"{path}/{v.MERCHANT_FILE}")
        ids = spark.range(new_transaction, new_transaction + n_transactions)
        write_source(transactions(ids, customer_pool, merchant_pool, first, last, seed + nth + 1), f"{path}/{v.TRANSACTION_FILE}")
        if nth == 0:
            write_source(calendar(spark, *CALENDAR_DAYS), f"{path}/{v.CALENDAR_FILE}")
        written.append(path)
    return written
