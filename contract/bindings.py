"""Bank-like inputs derived from the driver's Parquet tables.

The derivations make dirty raw sources (as the CSVs would be) and a clean star
out of ``lineitem``, ``orders``, ``customer``, ``part``, ``nation``, ``region``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import fixed_values as v
from lumbung.functions import mapping as m
from lumbung.functions.calendar import calendar, calendar_rows
from lumbung.functions.parsing import AMOUNT
from lumbung.operators.star import LEVELS_OF
from lumbung.plans import cuboids, upkeep
from lumbung.plans.load import load_batch, load_full, refresh_cube
from lumbung.sources import files
from lumbung.sources.staging import by_range, new_folder, slices
from lumbung.sources.synthetic import GENDER_SPELLINGS, SEGMENT_SPELLINGS, write_source
from lumbung.sources.warehouse import Warehouse

# The calendar ends before the last shipping day on purpose.
CALENDAR_DAYS = ("1995-01-01", "2001-08-31")
# "Loaded" rows of the incremental inputs end here.
LOADED_UNTIL = "1999-12-31"
# Members of these kinds are new on the second day of the incremental inputs.
NEW_SEGMENT, NEW_TYPE = "MACHINERY", "PROMO"
UNLISTED_CITY = "Cirebon"
# Amounts that do not fit, and whose sign is lost by rounding.
OUT_OF_RANGE, TINY_NEGATIVE = "12.345.678.901.234.567,00", "-0,004"

# Rows are distinct over all lineitem columns: together they are the source order.
LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cycle(at: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), (at + 1).cast("int"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def customers_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What dirty transactions are made of. Customers are joined to the orders, so line items are shuffled once."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def line_parts(spark: SparkSession, sf_dir: str) -> list[Column]:
    """Conditions that split line items into slices, one after the other in LINE_ORDER."""
    rows, key = table(spark, sf_dir, "lineitem"), LINE_ORDER[0]
    n = slices(spark, rows.count())
    at = rows.agg(F.percentile_approx(key, [nth / n for nth in range(1, n)], 10 * n)).first()[0] if n > 1 else None
    return by_range(key, sorted(set(at or [])))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty transactions, with ``src_seq`` (a struct in source order) and the line's ship day."""
    return customers_lines(spark, sf_dir).select(
        *dirty_columns(), F.struct(*LINE_ORDER).alias("src_seq"), F.col("l_shipdate").cast("date").alias("ship_day")
    )


def dirty_columns() -> list[Column]:
    """The texts of the transaction source, out of ``customers_lines``."""
    line = F.col("l_orderkey")
    dirt = (line + F.col("l_linenumber")) % 50
    cities = v.MASTER_CITIES + list(v.CITY_ALIASES) + [UNLISTED_CITY]
    channel = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "ATM")
        .when(F.col("o_orderpriority") == "2-HIGH", "bifast")
        .when(F.col("o_orderpriority") == "3-MEDIUM", " qris ")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "ATM_LINK")
        .otherwise("livin")
    )
    return [
        F.concat(F.lit("TRX-"), line.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("trx_id"),
        F.when(dirt == 1, "31-13-2026").when(dirt != 0, F.date_format("l_shipdate", "dd-MM-yyyy")).alias("tgl_transaksi"),
        F.when(line % 200 != 0, F.concat(F.lit("N-"), F.col("o_custkey").cast("string"))).alias("nasabah_code"),
        F.when(line % 200 != 1, channel).alias("channel"),
        F.when(line % 200 != 2, F.concat(F.lit("MCH-"), F.col("l_partkey").cast("string"))).alias("merchant_code"),
        F.when(line % 200 != 3, _cycle(F.col("c_nationkey") % 20, cities)).alias("kota"),
        F.when(F.col("l_partkey") % 97 == 5, OUT_OF_RANGE).when(F.col("l_partkey") % 97 == 6, TINY_NEGATIVE).otherwise(
            F.concat(
                F.when(F.col("l_partkey") % 33 == 0, "-").otherwise(""),
                F.translate(F.format_number("l_extendedprice", 2), ",.", ".,"),
            )
        ).alias("nominal"),
        F.when(line % 20 == 0, "").otherwise(((line % 3) * 2500).cast("string")).alias("biaya_admin"),
    ]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1960-01-01").cast("date"), ((key * 37) % 16000).cast("int"))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("N-"), key.cast("string")).alias("nasabah_code"),
        F.col("c_name").alias("nama_lengkap"),
        _cycle(key % 8, GENDER_SPELLINGS).alias("jenis_kelamin"),
        F.when(key % 20 == 0, "").when(key % 20 == 1, "31/02/1999").otherwise(F.date_format(born, "dd/MM/yyyy")).alias("tanggal_lahir"),
        _cycle(key % 6, SEGMENT_SPELLINGS).alias("segmen_nasabah"),
        key.alias("src_seq"),
        (F.col("c_mktsegment") == NEW_SEGMENT).alias("is_new"),
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("MCH-"), key.cast("string")).alias("merchant_code"),
        F.concat(F.col("p_name"), F.lit(" "), key.cast("string")).alias("nama_merchant"),
        F.when(key % 8 != 0, F.col("p_type")).alias("kategori"),
        key.alias("src_seq"),
        (F.col("p_type") == NEW_TYPE).alias("is_new"),
    )


def calendar_days(spark: SparkSession) -> DataFrame:
    return calendar(spark, *CALENDAR_DAYS)


# -- clean star ---------------------------------------------------------------
def clean_fact(spark: SparkSession, sf_dir: str, *levels: str) -> DataFrame:
    """Facts with the ids of the dimensions that have the levels; orders and customers are read only for those."""
    ids = {key for key, own in LEVELS_OF.values() if set(own) & set(levels)}
    source = {
        "waktu_id": F.col("l_shipdate").cast("date"), "nasabah_id": F.col("o_custkey"), "channel_id": F.col("o_orderpriority"),
        "wilayah_id": F.col("c_nationkey"), "merchant_id": F.col("l_partkey"),
    }
    rows = lines(spark, sf_dir) if ids & {"nasabah_id", "channel_id", "wilayah_id"} else table(spark, sf_dir, "lineitem")
    if "wilayah_id" in ids:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        rows = rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        *[column.alias(key) for key, column in source.items() if key in ids],
        F.col("l_extendedprice").cast(AMOUNT).alias("nominal_transaksi"),
        (F.col("l_extendedprice").cast(AMOUNT) * F.col("l_tax").cast("decimal(4,2)")).cast(AMOUNT).alias("biaya_admin"),
    )


def clean_dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    days = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    return {
        "dim_waktu": calendar_rows(days, F.col("d")).withColumn("waktu_id", F.col("tanggal")),
        "dim_nasabah": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("nasabah_id"),
            F.col("c_name").alias("nama_lengkap"),
            m.gender(_cycle(F.col("c_custkey") % 8, GENDER_SPELLINGS)).alias("jenis_kelamin"),
            F.col("c_mktsegment").alias("segmen_nasabah"),
        ),
        "dim_channel": table(spark, sf_dir, "orders").select(
            F.col("o_orderpriority").alias("channel_id"),
            F.col("o_orderpriority").alias("nama_channel"),
            F.lit(v.CHANNEL_KIND).alias("jenis_channel"),
        ).distinct(),
        "dim_wilayah": nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("wilayah_id"),
            F.col("n_name").alias("kota"),
            F.concat(F.col("r_name"), F.lit(" "), (F.col("n_nationkey") % 2).cast("string")).alias("provinsi"),
            F.col("r_name").alias("region"),
        ),
        "dim_merchant": table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("merchant_id"),
            F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string")).alias("nama_merchant"),
            F.col("p_type").alias("kategori"),
        ),
    }


# -- source folders and warehouses made from them -----------------------------
def write_folder(
    spark: SparkSession, sf_dir: str, folder: str, transactions: DataFrame, customers: DataFrame | None,
    merchants: DataFrame | None, days: DataFrame | None, **changed: Column,
) -> None:
    """Compressed source CSVs in source order; ``transactions`` are ``customers_lines``, ``changed`` texts other than usual.

    Lines are sorted slice by slice as numbers and told as text afterwards. The files of a slice are named behind those before.
    """
    parts, target = line_parts(spark, sf_dir), f"{folder}/{v.TRANSACTION_FILE}"
    for nth, part in enumerate(parts):
        told = transactions.filter(part).orderBy(*LINE_ORDER).select(*dirty_columns()).withColumns(changed)
        write_source(told, f"{target}/_slice" if nth else target, "gzip")
        if nth:
            for path, name, _ in files.data_files(spark, f"{target}/_slice"):
                files.rename(spark, path, f"{target}/part-~{nth:06d}-{name}")
            files.delete(spark, f"{target}/_slice")
    if customers is not None:
        write_source(customers.orderBy("src_seq").drop("src_seq", "is_new"), f"{folder}/{v.CUSTOMER_FILE}", "gzip")
    if merchants is not None:
        write_source(merchants.orderBy("src_seq").drop("src_seq", "is_new"), f"{folder}/{v.MERCHANT_FILE}", "gzip")
    if days is not None:
        write_source(days.orderBy("waktu_id"), f"{folder}/{v.CALENDAR_FILE}", "gzip")


_made: dict[tuple, str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> str:
    """The folder ``make`` filled for this session and data, filled at the first call."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made or not files.exists(spark, _made[key]):
        path = new_folder(spark, name)
        make(path)
        _made[key] = path
    return _made[key]


def source_folder(spark: SparkSession, sf_dir: str) -> str:
    """All raw sources as CSVs."""
    return _once(spark, sf_dir, "sources", lambda path: write_folder(
        spark, sf_dir, path, customers_lines(spark, sf_dir), raw_customers(spark, sf_dir),
        raw_merchants(spark, sf_dir), calendar_days(spark),
    ))


def repeated_members_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse after a full load whose sources name every seventh customer and every fifth merchant twice."""
    customers, merchants = raw_customers(spark, sf_dir), raw_merchants(spark, sf_dir)
    late = (F.col("src_seq") + 10**12).alias("src_seq")

    def again(rows: DataFrame, every: int, name: str) -> DataFrame:
        copies = rows.filter(F.col("src_seq") % every == 0).withColumn(name, F.lit("again")).select(*[late if c == "src_seq" else c for c in rows.columns])
        return rows.unionByName(copies)

    folder = _once(spark, sf_dir, "repeated-members", lambda path: write_folder(
        spark, sf_dir, path, customers_lines(spark, sf_dir), again(customers, 7, "nama_lengkap"), again(merchants, 5, "nama_merchant"), calendar_days(spark),
    ))
    return _once(spark, sf_dir, "repeated-members-warehouse", lambda path: load_full(spark, folder, path))


def loaded_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse after a full load of ``source_folder``."""
    folder = source_folder(spark, sf_dir)
    return _once(spark, sf_dir, "warehouse", lambda path: load_full(spark, folder, path))


def two_day_folders(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A first folder with the older rows and the known members, and a later one with all rows and all members."""
    first = _once(spark, sf_dir, "day-one", lambda path: write_folder(spark, sf_dir, path, early_lines(spark, sf_dir), *known_members(spark, sf_dir)))
    return first, second_folder(spark, sf_dir)


def second_folder(spark: SparkSession, sf_dir: str) -> str:
    rows, customers, merchants = (f(spark, sf_dir) for f in (customers_lines, raw_customers, raw_merchants))
    return _once(spark, sf_dir, "day-two", lambda path: write_folder(spark, sf_dir, path, rows, customers, merchants, None))


def early_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers_lines(spark, sf_dir).filter(F.col("l_shipdate").cast("date") <= F.lit(LOADED_UNTIL).cast("date"))


def known_members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, merchants and days of the first folder."""
    return raw_customers(spark, sf_dir).filter("NOT is_new"), raw_merchants(spark, sf_dir).filter("NOT is_new"), calendar_days(spark)


def incremental_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """A full load of the first folder and then a batch load of the second."""
    first, second = two_day_folders(spark, sf_dir)

    def load(path: str) -> None:
        load_full(spark, first, path)
        load_batch(spark, second, path, "day-two")

    return _once(spark, sf_dir, "warehouse-2", load)


def refreshed_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Cells made after the first folder, and brought up to date after the batch."""
    first, second = two_day_folders(spark, sf_dir)

    def load(path: str) -> None:
        load_full(spark, first, path)
        refresh_cube(Warehouse(spark, path))
        load_batch(spark, second, path, "day-two")
        refresh_cube(Warehouse(spark, path))

    return _once(spark, sf_dir, "warehouse-cells", load)


def reloaded_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Two batches into an empty warehouse, and then the first of them again."""
    first, second = two_day_folders(spark, sf_dir)

    def load(path: str) -> None:
        load_batch(spark, first, path, "day-one")
        load_batch(spark, second, path, "day-two")
        load_batch(spark, first, path, "day-one")

    return _once(spark, sf_dir, "warehouse-again", load)


def with_cuboids(spark: SparkSession, sf_dir: str) -> str:
    """``loaded_warehouse`` with its cells and finer roll-ups."""
    root = loaded_warehouse(spark, sf_dir)
    refresh_cube(Warehouse(spark, root))
    cuboids.refresh(Warehouse(spark, root))
    return root


def late_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Roll-ups made after the first folder; the batch came later and has no cells yet."""
    first, second = two_day_folders(spark, sf_dir)

    def load(path: str) -> None:
        load_full(spark, first, path)
        cuboids.refresh(Warehouse(spark, path))
        load_batch(spark, second, path, "day-two")

    return _once(spark, sf_dir, "warehouse-late", load)


def changed_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Two batches, and then the first of them again with rows it did not have and copies that changed."""
    early, known = early_lines(spark, sf_dir), known_members(spark, sf_dir)
    line = F.substring_index(F.substring_index("trx_id", "-", 2), "-", -1).cast("bigint")
    # The order of a line whose transaction has an id.
    order = F.when(F.col("l_linenumber").isNotNull(), F.col("l_orderkey"))

    def load(path: str) -> None:
        # The folders are made when they are loaded, and those of the first batch go when it is.
        write_folder(spark, sf_dir, f"{path}-short", early.filter(order % 7 != 3), *known)
        load_batch(spark, f"{path}-short", path, "day-one")
        files.delete(spark, f"{path}-short")
        load_batch(spark, second_folder(spark, sf_dir), path, "day-two")
        changed = F.when(line % 11 == 4, F.concat(F.lit("9"), "nominal")).otherwise(F.col("nominal"))
        write_folder(spark, sf_dir, f"{path}-changed", early, *known, nominal=changed)
        load_batch(spark, f"{path}-changed", path, "day-one")
        files.delete(spark, f"{path}-changed")

    return _once(spark, sf_dir, "warehouse-changed", load)


def packed_warehouse(spark: SparkSession, sf_dir: str) -> str:
    """Yearly batches with their cells, all but the last packed and the old version removed."""
    landing = yearly_landing(spark, sf_dir)

    def load(path: str) -> None:
        for name in files.child_names(spark, landing):
            load_batch(spark, f"{landing}/{name}", path, name)
        refresh_cube(Warehouse(spark, path))
        cuboids.refresh(Warehouse(spark, path))
        upkeep.compact(spark, path)
        upkeep.vacuum(spark, path)

    return _once(spark, sf_dir, "warehouse-packed", load)


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """Transactions in parts with two headers: as usual, and in reverse order by comma and without fees."""
    rows = raw_transactions(spark, sf_dir).drop("ship_day")
    odd = F.substring_index(F.substring_index("trx_id", "-", 2), "-", -1).cast("bigint") % 2 == 1

    def write(path: str) -> None:
        usual = ["trx_id", "tgl_transaksi", "nasabah_code", "channel", "merchant_code", "kota", "nominal", "biaya_admin"]
        write_source(rows.filter(~odd).select(*usual), f"{path}/{v.TRANSACTION_FILE}")
        rest = rows.filter(odd).select(*[c for c in reversed(usual) if c != "biaya_admin"])
        rest.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode("append").csv(f"{path}/{v.TRANSACTION_FILE}")

    return _once(spark, sf_dir, "mixed", write)


def yearly_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder with one batch per shipping year."""
    rows, shipped = customers_lines(spark, sf_dir), F.year(F.col("l_shipdate").cast("date"))

    def land(path: str) -> None:
        years = [r[0] for r in rows.select(shipped.alias("y")).distinct().orderBy("y").collect()]
        for nth, year in enumerate(years):
            first = nth == 0
            write_folder(
                spark, sf_dir, f"{path}/batch_{year}", rows.filter(shipped == year),
                raw_customers(spark, sf_dir) if first else None, raw_merchants(spark, sf_dir) if first else None,
                calendar_days(spark) if first else None,
            )

    return _once(spark, sf_dir, "landing", land)
