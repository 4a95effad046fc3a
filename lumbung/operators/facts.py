"""Raw transactions to fact rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions import mapping as m
from lumbung.functions import parsing as p
from lumbung.operators.dedupe import keep_first

FACT_COLUMNS = [
    "fact_id", "waktu_id", "nasabah_id", "channel_id", "wilayah_id", "merchant_id",
    "nominal_transaksi", "biaya_admin",
]
FACT_SCHEMA = (
    "fact_id bigint, waktu_id bigint, nasabah_id bigint, channel_id bigint, wilayah_id bigint, "
    "merchant_id bigint, nominal_transaksi decimal(18,2), biaya_admin decimal(18,2)"
)


def typed_transactions(raw: DataFrame, *keep: str) -> DataFrame:
    """Typed, standardised columns; one narrow projection ahead of every shuffle, no row dropped."""
    return raw.select(
        "trx_id",
        "tgl_transaksi",
        p.date_key(p.parse_transaction_date(F.col("tgl_transaksi"))).alias("waktu_id"),
        F.coalesce("nasabah_code", F.lit(v.UNKNOWN_CUSTOMER_CODE)).alias("nasabah_code"),
        F.coalesce("merchant_code", F.lit(v.UNKNOWN_MERCHANT_CODE)).alias("merchant_code"),
        m.channel_of_fact(F.col("channel")).alias("nama_channel"),
        m.channel_member(F.col("channel")).alias("channel_member"),
        m.city_of_fact(F.col("kota")).alias("kota"),
        m.city_member(F.col("kota")).alias("city_member"),
        p.parse_amount(F.col("nominal")).alias("nominal_transaksi"),
        p.is_negative_amount(F.col("nominal")).alias("is_negative"),
        p.parse_fee(F.col("biaya_admin")).alias("biaya_admin"),
        *keep,
    )


def content(columns: list[str]) -> Column:
    """A hash of what a raw row says, wherever it stands in whichever file; null and empty differ."""
    told = [F.coalesce(F.col(c), F.lit("\x00")) for c in sorted(columns) if c != "src_seq"]
    return F.md5(F.concat_ws("\x1f", *told))


def fault() -> Column:
    """Why a de-duplicated row cannot be loaded, null when it can; the first fault counts."""
    out_of_range = F.col("nominal_transaksi").isNull() | F.col("biaya_admin").isNull()
    return F.when(F.col("is_negative"), "negative_amount").when(out_of_range, "amount_out_of_range").when(
        F.col("waktu_id").isNull(), "invalid_date"
    )


def cleanse(raw: DataFrame, order_by: list, *keep: str) -> DataFrame:
    """De-duplicate by transaction id, then drop what has a fault."""
    first = keep_first(typed_transactions(raw, *keep), ["trx_id"], order_by)
    return first.filter(fault().isNull()).drop("is_negative")


def _spread(code: Column, unknown_code: str, row: str) -> Column:
    """The unknown code as many keys that match nothing, so its rows do not meet in one task.

    A miss gets id 0, which is what the unknown code stands for.
    """
    salt = F.pmod(F.xxhash64(row), F.lit(4096)).cast("string")
    return F.when(code == unknown_code, F.concat(F.lit("\x00"), salt)).otherwise(code)


def look_up_keys(
    tx: DataFrame, customers: DataFrame, merchants: DataFrame, channels: DataFrame, areas: DataFrame, row: str = "trx_id"
) -> DataFrame:
    """Natural keys to surrogate ids by four left joins; a miss gets 0. Unknown codes are spread by the column ``row``.

    No broadcast is forced: Spark broadcasts a dimension when its size is below
    the threshold, and otherwise sorts and merges with skew handling. Facts only
    ever name the listed channels, so that lookup is narrowed to them.
    """
    codes = sorted(set(v.CHANNEL_CODES.values()))
    with_keys = tx.withColumns({
        "_customer": _spread(F.col("nasabah_code"), v.UNKNOWN_CUSTOMER_CODE, row),
        "_merchant": _spread(F.col("merchant_code"), v.UNKNOWN_MERCHANT_CODE, row),
        "_city": _spread(F.col("kota"), v.UNKNOWN, row),
    })
    joined = (
        with_keys
        .join(channels.filter(F.col("nama_channel").isin(codes)).select("channel_id", "nama_channel"), "nama_channel", "left")
        .join(areas.select("wilayah_id", F.col("kota").alias("_city")), "_city", "left")
        .join(merchants.select("merchant_id", F.col("merchant_code").alias("_merchant")), "_merchant", "left")
        .join(customers.select("nasabah_id", F.col("nasabah_code").alias("_customer")), "_customer", "left")
    )
    ids = ["nasabah_id", "merchant_id", "channel_id", "wilayah_id"]
    return joined.drop("_customer", "_merchant", "_city").withColumns(
        {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ids}
    )


def in_calendar(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    return facts.join(calendar.select("waktu_id"), "waktu_id", "left_semi")


def not_in_calendar(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    return facts.join(calendar.select("waktu_id"), "waktu_id", "left_anti")


def newer_than(facts: DataFrame, mark: int | Column) -> DataFrame:
    """Rows after the high-water mark, strictly."""
    return facts.filter(F.col("waktu_id") > (mark if isinstance(mark, Column) else F.lit(mark)))


def not_newer_than(facts: DataFrame, mark: int | Column) -> DataFrame:
    return facts.filter(F.col("waktu_id") <= (mark if isinstance(mark, Column) else F.lit(mark)))


def high_water_mark(facts: DataFrame) -> Column:
    """The largest loaded day as a scalar subquery, 0 for an empty table."""
    return facts.agg(F.coalesce(F.max("waktu_id"), F.lit(0))).scalar()
