"""Dimension members from the raw sources.

Each builder returns members without surrogate ids, unique by natural key, with
``src_seq`` (and what else is needed) for the order of numbering.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions import mapping as m
from lumbung.functions import parsing as p
from lumbung.operators.dedupe import first_seen, keep_first


@dataclass(frozen=True)
class Dimension:
    table: str
    id_col: str
    key: str
    schema: str
    unknown: tuple | None

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.schema.split(", ")]


CALENDAR = Dimension(
    "dim_waktu", "waktu_id", "waktu_id",
    "waktu_id bigint, tanggal date, hari string, bulan string, tahun int, quarter string", None,
)
CUSTOMER = Dimension(
    "dim_nasabah", "nasabah_id", "nasabah_code",
    "nasabah_id bigint, nasabah_code string, nama_lengkap string, jenis_kelamin string, "
    "tanggal_lahir date, segmen_nasabah string",
    (0, v.UNKNOWN_CUSTOMER_CODE, v.UNKNOWN, v.GENDER_UNKNOWN, None, v.UNKNOWN),
)
MERCHANT = Dimension(
    "dim_merchant", "merchant_id", "merchant_code",
    "merchant_id bigint, merchant_code string, nama_merchant string, kategori string",
    (0, v.UNKNOWN_MERCHANT_CODE, v.UNKNOWN_MERCHANT_NAME, v.UNKNOWN),
)
CHANNEL = Dimension(
    "dim_channel", "channel_id", "nama_channel",
    "channel_id bigint, nama_channel string, jenis_channel string",
    (0, v.UNKNOWN_CHANNEL, v.UNKNOWN),
)
AREA = Dimension(
    "dim_wilayah", "wilayah_id", "kota",
    "wilayah_id bigint, kota string, provinsi string, region string",
    (0, v.UNKNOWN, v.UNKNOWN, v.UNKNOWN),
)
DIMENSIONS = [CALENDAR, CUSTOMER, MERCHANT, CHANNEL, AREA]


def calendar_members(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        F.col("waktu_id").try_cast("bigint").alias("waktu_id"),
        F.col("tanggal").try_cast("date").alias("tanggal"),
        "hari", "bulan",
        F.col("tahun").try_cast("int").alias("tahun"),
        "quarter", "src_seq",
    )
    return keep_first(typed.filter("waktu_id IS NOT NULL"), ["waktu_id"], ["src_seq"])


def customer_members(raw: DataFrame, order_by: list | None = None) -> DataFrame:
    typed = raw.withColumns({
        "jenis_kelamin": m.gender(F.col("jenis_kelamin")),
        "tanggal_lahir": p.parse_birth_date(F.col("tanggal_lahir")),
        "segmen_nasabah": m.segment(F.col("segmen_nasabah")),
    })
    return keep_first(typed, ["nasabah_code"], order_by or ["src_seq"])


def merchant_members(raw: DataFrame, order_by: list | None = None) -> DataFrame:
    typed = raw.withColumn("kategori", m.category(F.col("kategori")))
    return keep_first(typed, ["merchant_code"], order_by or ["src_seq"])


def members_in_transactions(typed: DataFrame, seq: str = "src_seq") -> DataFrame:
    """Channels and cities the raw transactions name, in one pass over them: (kind, member, seq)."""
    named = typed.select(
        F.explode(F.array(
            F.struct(F.lit("channel").alias("kind"), F.col("channel_member").alias("member")),
            F.struct(F.lit("kota").alias("kind"), F.col("city_member").alias("member")),
        )).alias("x"),
        F.col(seq),
    ).select("x.kind", "x.member", seq)
    return first_seen(named.filter("member IS NOT NULL"), ["kind", "member"], seq)


def channel_members(seen: DataFrame) -> DataFrame:
    return seen.filter("kind = 'channel'").select(
        F.col("member").alias("nama_channel"), F.lit(v.CHANNEL_KIND).alias("jenis_channel"), "src_seq"
    )


def master_cities(spark: SparkSession) -> DataFrame:
    """The 16 known cities, with sequences that come before any source row."""
    listed = F.array(*[F.lit(c) for c in v.MASTER_CITIES])
    cities = spark.range(1).select(F.posexplode(listed).alias("pos", "kota"))
    return cities.select("kota", (F.col("pos") - len(v.MASTER_CITIES)).cast("bigint").alias("src_seq"))


def area_members(seen: DataFrame) -> DataFrame:
    """Master cities first, then the other cities in the order seen, with province and island."""
    named = seen.filter("kind = 'kota'").select(F.col("member").alias("kota"), "src_seq")
    return enrich_city(first_seen(master_cities(seen.sparkSession).unionByName(named), ["kota"]))


def enrich_city(df: DataFrame) -> DataFrame:
    return df.withColumns({"provinsi": m.province(F.col("kota")), "region": m.region(F.col("kota"))})


def with_unknown(dim: Dimension, df: DataFrame) -> DataFrame:
    """Append the Unknown member (id 0)."""
    return df.select(*dim.columns).unionByName(unknown_member(df.sparkSession, dim))


def unknown_member(spark: SparkSession, dim: Dimension) -> DataFrame:
    values = zip(dim.schema.split(", "), dim.unknown)
    return spark.range(0, 1, 1, 1).select(*[F.lit(x).cast(c.split()[1]).alias(c.split()[0]) for c, x in values])


def new_members(members: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Members whose natural key the dimension does not hold yet; a missing key counts as a key."""
    known = existing.select(F.col(key).alias("_known"))
    return members.join(known, F.col(key).eqNullSafe(F.col("_known")), "left_anti")
