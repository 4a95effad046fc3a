"""Oracle SQL (DuckDB) for the registered queries, written independently of the library."""

from __future__ import annotations

from zlib import crc32

# --- Fixed values: cities, (city, province, island) in master order ------------
CITY_INFO = [
    ("Jakarta Selatan", "DKI Jakarta", "Jawa"),
    ("Bandung", "Jawa Barat", "Jawa"),
    ("Surabaya", "Jawa Timur", "Jawa"),
    ("Semarang", "Jawa Tengah", "Jawa"),
    ("Yogyakarta", "DI Yogyakarta", "Jawa"),
    ("Medan", "Sumatera Utara", "Sumatera"),
    ("Palembang", "Sumatera Selatan", "Sumatera"),
    ("Padang", "Sumatera Barat", "Sumatera"),
    ("Pekanbaru", "Riau", "Sumatera"),
    ("Banjarmasin", "Kalimantan Selatan", "Kalimantan"),
    ("Balikpapan", "Kalimantan Timur", "Kalimantan"),
    ("Pontianak", "Kalimantan Barat", "Kalimantan"),
    ("Makassar", "Sulawesi Selatan", "Sulawesi"),
    ("Manado", "Sulawesi Utara", "Sulawesi"),
    ("Denpasar", "Bali", "Bali & Nusa Tenggara"),
    ("Jayapura", "Papua", "Papua"),
]
# --- Fixed values: map positions (city, latitude, longitude) and the default centre
CITY_COORDS = [
    ("Bandung", -6.9175, 107.6191),
    ("Jakarta Selatan", -6.2615, 106.8106),
    ("Surabaya", -7.2575, 112.7521),
    ("Medan", 3.5952, 98.6722),
    ("Yogyakarta", -7.7956, 110.3695),
]
DEFAULT_COORDS = (-2.5489, 118.0149)

ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


CITY_LIST = "[" + ", ".join(_text(c) for c, _, _ in CITY_INFO) + ", 'BDG', 'Jkt Sel', 'SBY', 'Cirebon']"
CITIES = "(VALUES " + ", ".join(
    f"({i}, {_text(c)}, {_text(p)}, {_text(r)})" for i, (c, p, r) in enumerate(CITY_INFO, 1)
) + ") AS city(pos, kota, provinsi, region)"
COORDS = "(VALUES " + ", ".join(
    f"({_text(c)}, CAST({lat} AS DOUBLE), CAST({lon} AS DOUBLE))" for c, lat, lon in CITY_COORDS
) + ") AS place(kota, lat, lon)"

# -- building blocks: WITH parts, in the order they build on each other --------
RAW = f"""
raw AS (
  SELECT row_number() OVER (ORDER BY {ORDER}) AS seq,
    'TRX-' || l_orderkey || '-' || l_linenumber AS trx_id,
    CASE (l_orderkey + l_linenumber) % 50 WHEN 0 THEN NULL WHEN 1 THEN '31-13-2026'
      ELSE strftime(l_shipdate, '%d-%m-%Y') END AS tgl_transaksi,
    CASE WHEN l_orderkey % 200 <> 0 THEN 'N-' || o_custkey END AS nasabah_code,
    CASE WHEN l_orderkey % 200 <> 1 THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'ATM' WHEN '2-HIGH' THEN 'bifast'
      WHEN '3-MEDIUM' THEN ' qris ' WHEN '4-NOT SPECIFIED' THEN 'ATM_LINK' ELSE 'livin' END END AS channel,
    CASE WHEN l_orderkey % 200 <> 2 THEN 'MCH-' || l_partkey END AS merchant_code,
    CASE WHEN l_orderkey % 200 <> 3 THEN ({CITY_LIST})[c_nationkey % 20 + 1] END AS kota,
    CASE l_partkey % 97 WHEN 5 THEN '12.345.678.901.234.567,00' WHEN 6 THEN '-0,004' ELSE
      CASE WHEN l_partkey % 33 = 0 THEN '-' ELSE '' END
      || translate(format('{{:,.2f}}', l_extendedprice), ',.', '.,') END AS nominal,
    CASE WHEN l_orderkey % 20 = 0 THEN NULL ELSE CAST(l_orderkey % 3 * 2500 AS VARCHAR) END AS biaya_admin,
    CAST(l_shipdate AS DATE) AS ship_day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

MEMBER_CITY = "CASE trim(kota) WHEN 'BDG' THEN 'Bandung' WHEN 'Jkt Sel' THEN 'Jakarta Selatan' WHEN 'SBY' THEN 'Surabaya' ELSE trim(kota) END"
MEMBER_CHANNEL = "CASE upper(trim(channel)) WHEN 'BIFAST' THEN 'BI_FAST' ELSE upper(trim(channel)) END"
FACT_CHANNEL = """CASE WHEN upper(trim(channel)) = 'BIFAST' THEN 'BI_FAST'
      WHEN upper(trim(channel)) IN ('ATM', 'BI_FAST', 'QRIS', 'ATM_LINK', 'LIVIN') THEN upper(trim(channel)) ELSE 'UNKNOWN' END"""
PLAIN = "replace(replace(trim(nominal), '.', ''), ',', '.')"
AMOUNT = f"""CASE WHEN abs(TRY_CAST({PLAIN} AS DOUBLE)) < 1e16 OR TRY_CAST({PLAIN} AS DOUBLE) IS NULL
      THEN coalesce(TRY_CAST({PLAIN} AS DECIMAL(18,2)), 0) END"""
NEGATIVE = f"coalesce(TRY_CAST({PLAIN} AS DOUBLE) < 0, false)"
DATE = "CAST(TRY_STRPTIME(tgl_transaksi, '%d-%m-%Y') AS DATE)"


def _typed(name: str, source: str, where: str = "") -> str:
    """First copies with typed columns."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT seq, trx_id, tgl_transaksi, CAST(strftime({DATE}, '%Y%m%d') AS BIGINT) AS waktu_id,
      coalesce(nasabah_code, 'UNKNOWN') AS nasabah_code, coalesce(merchant_code, 'MCH-UNKNOWN') AS merchant_code,
      {FACT_CHANNEL} AS nama_channel, coalesce({MEMBER_CITY}, 'Unknown') AS kota, {AMOUNT} AS nominal_transaksi,
      {NEGATIVE} AS negative, coalesce(TRY_CAST(biaya_admin AS DECIMAL(18,2)), 0) AS biaya_admin, ship_day,
      row_number() OVER (PARTITION BY trx_id ORDER BY seq) AS nth
    FROM {source} {where}) WHERE nth = 1)"""


FIRST = RAW + "," + _typed("firsts", "raw")
CLEAN = FIRST + """,
clean AS (SELECT * FROM firsts WHERE NOT negative AND nominal_transaksi IS NOT NULL AND waktu_id IS NOT NULL)"""

RAW_CUSTOMER = """
raw_customer AS (
  SELECT c_custkey, c_mktsegment = 'MACHINERY' AS is_new, 'N-' || c_custkey AS nasabah_code, c_name AS nama_lengkap,
    (['L', 'P', 'M', 'Laki-laki', 'Female', 'Pria', 'Wanita', ''])[c_custkey % 8 + 1] AS jk,
    CASE c_custkey % 20 WHEN 0 THEN '' WHEN 1 THEN '31/02/1999'
      ELSE strftime(DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER), '%d/%m/%Y') END AS born,
    (['Reguler', 'Prioritas', 'RETAIL', 'prio', 'Private', ''])[c_custkey % 6 + 1] AS segmen
  FROM customer),
std_customer AS (
  SELECT c_custkey, is_new, nasabah_code, nama_lengkap,
    CASE WHEN jk IN ('L', 'M', 'Laki-laki') THEN 'L' WHEN jk IN ('P', 'Female') THEN 'P' ELSE 'U' END AS jenis_kelamin,
    strftime(TRY_STRPTIME(born, '%d/%m/%Y'), '%Y-%m-%d') AS tanggal_lahir,
    CASE segmen WHEN 'RETAIL' THEN 'Reguler' WHEN 'prio' THEN 'Prioritas' WHEN '' THEN 'Reguler' ELSE segmen END AS segmen_nasabah
  FROM raw_customer)"""

STD_MERCHANT = """
std_merchant AS (
  SELECT p_partkey, p_type = 'PROMO' AS is_new, 'MCH-' || p_partkey AS merchant_code, p_name || ' ' || p_partkey AS nama_merchant,
    CASE WHEN p_partkey % 8 = 0 THEN 'Unknown' ELSE p_type END AS kategori FROM part)"""

CALENDAR = """
calendar AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS waktu_id, strftime(d, '%Y-%m-%d') AS tanggal, dayname(d) AS hari,
    monthname(d) AS bulan, CAST(year(d) AS BIGINT) AS tahun, 'Q' || quarter(d) AS quarter
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-08-31', INTERVAL 1 DAY)) AS d))"""

DIM_CUSTOMER = RAW_CUSTOMER + """,
dim_nasabah AS (
  SELECT row_number() OVER (ORDER BY c_custkey) AS nasabah_id, * EXCLUDE (c_custkey, is_new) FROM std_customer
  UNION ALL SELECT 0, 'UNKNOWN', 'Unknown', 'U', NULL, 'Unknown')"""
DIM_MERCHANT = STD_MERCHANT + """,
dim_merchant AS (
  SELECT row_number() OVER (ORDER BY p_partkey) AS merchant_id, * EXCLUDE (p_partkey, is_new) FROM std_merchant
  UNION ALL SELECT 0, 'MCH-UNKNOWN', 'Unknown Merchant', 'Unknown')"""


def _dim_channel(source: str) -> str:
    return f"""
dim_channel AS (
  SELECT row_number() OVER (ORDER BY seq) AS channel_id, nama_channel, 'Digital' AS jenis_channel
  FROM (SELECT {MEMBER_CHANNEL} AS nama_channel, min(seq) AS seq FROM {source} WHERE channel IS NOT NULL GROUP BY 1)
  UNION ALL SELECT 0, 'UNKNOWN', 'Unknown')"""


def _dim_area(source: str) -> str:
    return f"""
city AS (SELECT * FROM {CITIES}),
dim_wilayah AS (
  SELECT row_number() OVER (ORDER BY pos NULLS LAST, seq) AS wilayah_id, kota,
    coalesce(provinsi, 'Unknown') AS provinsi, coalesce(region, 'Unknown') AS region
  FROM city FULL JOIN (SELECT {MEMBER_CITY} AS kota, min(seq) AS seq FROM {source} WHERE kota IS NOT NULL GROUP BY 1) USING (kota)
  UNION ALL SELECT 0, 'Unknown', 'Unknown', 'Unknown')"""


DIMS = ",".join([DIM_CUSTOMER, DIM_MERCHANT, _dim_channel("raw"), _dim_area("raw"), CALENDAR])
KEYS = """coalesce(n.nasabah_id, 0) AS nasabah_id, coalesce(m.merchant_id, 0) AS merchant_id,
    coalesce(c.channel_id, 0) AS channel_id, coalesce(w.wilayah_id, 0) AS wilayah_id"""
LOOKUPS = """LEFT JOIN dim_nasabah n USING (nasabah_code) LEFT JOIN dim_merchant m USING (merchant_code)
  LEFT JOIN dim_channel c USING (nama_channel) LEFT JOIN dim_wilayah w USING (kota)"""
WAREHOUSE = CLEAN + "," + DIMS + f""",
fact AS (
  SELECT row_number() OVER (ORDER BY seq) AS fact_id, waktu_id, {KEYS}, nominal_transaksi, biaya_admin
  FROM clean {LOOKUPS} WHERE waktu_id IN (SELECT waktu_id FROM calendar))"""
BANK = WAREHOUSE + """,
bank AS (
  SELECT tahun, quarter, bulan, hari, tanggal, segmen_nasabah, jenis_kelamin, nama_lengkap, jenis_channel, nama_channel,
    region, provinsi, kota, kategori, nama_merchant, nominal_transaksi, biaya_admin, fact_id
  FROM fact JOIN calendar USING (waktu_id) JOIN dim_nasabah USING (nasabah_id) JOIN dim_channel USING (channel_id)
    JOIN dim_wilayah USING (wilayah_id) JOIN dim_merchant USING (merchant_id))"""

STAR = """
star AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS tahun, 'Q' || quarter(l_shipdate) AS quarter, monthname(l_shipdate) AS bulan,
    dayname(l_shipdate) AS hari, strftime(l_shipdate, '%Y-%m-%d') AS tanggal,
    c_mktsegment AS segmen_nasabah,
    (['L', 'P', 'L', 'L', 'P', 'U', 'U', 'U'])[c_custkey % 8 + 1] AS jenis_kelamin, c_name AS nama_lengkap,
    'Digital' AS jenis_channel, o_orderpriority AS nama_channel,
    r_name AS region, r_name || ' ' || n_nationkey % 2 AS provinsi, n_name AS kota,
    p_type AS kategori, p_name || ' ' || p_partkey AS nama_merchant,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS nominal_transaksi,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS biaya_admin
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""

VOLUME = "CAST(sum(nominal_transaksi) AS DOUBLE) AS total_volume_transaksi"
FEE = "CAST(sum(biaya_admin) AS DOUBLE) AS total_biaya_admin"
COUNT = "count(*) AS jumlah_transaksi"

# What the default filter hides, per hierarchy.
HIDE_CUSTOMER = "segmen_nasabah <> 'Unknown' AND jenis_kelamin NOT IN ('Unknown', 'U') AND nama_lengkap <> 'Unknown'"
HIDE_CHANNEL = "jenis_channel <> 'Unknown' AND nama_channel <> 'Unknown'"
HIDE_AREA = "region <> 'Unknown' AND provinsi <> 'Unknown' AND kota <> 'Unknown'"
HIDE_MERCHANT = "kategori <> 'Unknown' AND nama_merchant <> 'Unknown'"
KNOWN = " AND ".join([HIDE_CUSTOMER, HIDE_CHANNEL, HIDE_AREA, HIDE_MERCHANT])


def _bank(select: str, rest: str = "") -> str:
    return f"WITH {BANK} {select} FROM bank {rest}"


def _level(level: str, alias: str | None = None, where: str = KNOWN) -> str:
    name = f"{level} AS {alias}" if alias else level
    return _bank(f"SELECT {name}, {VOLUME}, {COUNT}", f"WHERE {where} GROUP BY {level}")


def _star(select: str, group: str = "") -> str:
    return f"WITH {STAR} SELECT {select} FROM star" + (f" GROUP BY {group}" if group else "")


MONTH_NO = "month(strptime(bulan, '%B'))"
KPI = """coalesce(CAST(sum(nominal_transaksi) AS DOUBLE), 0) AS total_volume_transaksi,
  count(*) AS total_frekuensi_transaksi, coalesce(CAST(sum(biaya_admin) AS DOUBLE), 0) AS total_revenue_transaksi,
  coalesce(CAST(sum(nominal_transaksi) AS DOUBLE) / nullif(count(*), 0), 0) AS avg_nominal_transaksi"""
KPI_NAMES = ["total_volume_transaksi", "total_frekuensi_transaksi", "total_revenue_transaksi", "avg_nominal_transaksi"]
NO_TREND = ", ".join(f"CAST(NULL AS DOUBLE) AS trend_{k}" for k in KPI_NAMES)


def _trend(now: str, before: str) -> str:
    change = ", ".join(
        f"CASE WHEN b.{k} <> 0 THEN round_even((CAST(a.{k} AS DOUBLE) - b.{k}) / b.{k} * 100, 2) END AS trend_{k}" for k in KPI_NAMES
    )
    return f"""WITH {BANK}, a AS (SELECT {KPI} FROM bank WHERE {now}), b AS (SELECT {KPI} FROM bank WHERE {before})
    SELECT a.*, {change} FROM a, b"""


def _per_layer(layer: str, source: str) -> str:
    """Growth rates by SQL's own regression functions."""
    return f"""SELECT {layer}, count(*) AS points, round_even(regr_slope(y, x / 1000), 4) AS growth_rate_ms_per_1k,
      round_even(regr_intercept(y, x / 1000), 4) AS intercept_ms, round_even(regr_r2(y, x / 1000), 4) AS r2 FROM {source} GROUP BY {layer}"""


def _copies(name: str, source: str, where: str = "") -> str:
    """All but the first copy of each transaction."""
    return f"""
{name} AS (SELECT trx_id, tgl_transaksi, CAST(strftime({DATE}, '%Y%m%d') AS BIGINT) AS waktu_id FROM {source} {where}
  QUALIFY row_number() OVER (PARTITION BY trx_id ORDER BY seq) > 1)"""


# -- the incremental pair of folders ------------------------------------------
TWO_DAYS = RAW + "," + _typed("first_one", "raw", "WHERE ship_day <= DATE '1999-12-31'") + "," + _typed(
    "first_two", "raw"
) + """,
loaded AS (SELECT * FROM first_one WHERE NOT negative AND nominal_transaksi IS NOT NULL AND waktu_id IS NOT NULL),
batch AS (SELECT * FROM first_two WHERE NOT negative AND nominal_transaksi IS NOT NULL AND waktu_id IS NOT NULL),
mark AS (SELECT max(waktu_id) AS waktu_id, count(*) AS n FROM loaded)"""
TWO_DIMS = ",".join([RAW_CUSTOMER, STD_MERCHANT, CALENDAR, """
dim_nasabah AS (
  SELECT row_number() OVER (ORDER BY is_new, c_custkey) AS nasabah_id, * EXCLUDE (c_custkey, is_new) FROM std_customer
  UNION ALL SELECT 0, 'UNKNOWN', 'Unknown', 'U', NULL, 'Unknown'),
dim_merchant AS (
  SELECT row_number() OVER (ORDER BY is_new, p_partkey) AS merchant_id, * EXCLUDE (p_partkey, is_new) FROM std_merchant
  UNION ALL SELECT 0, 'MCH-UNKNOWN', 'Unknown Merchant', 'Unknown'),
raw_one AS (SELECT * FROM raw WHERE ship_day <= DATE '1999-12-31'),
raw_two AS (SELECT seq + (SELECT max(seq) FROM raw) AS seq, * EXCLUDE seq FROM raw),
raw_both AS (SELECT * FROM raw_one UNION ALL SELECT * FROM raw_two)""", _dim_channel("raw_both"), _dim_area("raw_both")])
# Each folder's facts only see the members there were at its load.
TWO_FACTS = TWO_DAYS + "," + TWO_DIMS + f""",
fact_one AS (
  SELECT row_number() OVER (ORDER BY seq) AS fact_id, waktu_id,
    CASE WHEN nasabah_id <= (SELECT count(*) FROM std_customer WHERE NOT is_new) THEN nasabah_id ELSE 0 END AS nasabah_id,
    CASE WHEN merchant_id <= (SELECT count(*) FROM std_merchant WHERE NOT is_new) THEN merchant_id ELSE 0 END AS merchant_id,
    channel_id, wilayah_id, nominal_transaksi, biaya_admin
  FROM (SELECT seq, waktu_id, {KEYS}, nominal_transaksi, biaya_admin FROM loaded {LOOKUPS}
        WHERE waktu_id IN (SELECT waktu_id FROM calendar))),
top AS (SELECT max(waktu_id) AS waktu_id, max(fact_id) AS fact_id FROM fact_one),
fact_two AS (
  SELECT row_number() OVER (ORDER BY seq) + (SELECT fact_id FROM top) AS fact_id, waktu_id, {KEYS}, nominal_transaksi, biaya_admin
  FROM batch {LOOKUPS}
  WHERE waktu_id IN (SELECT waktu_id FROM calendar) AND waktu_id > (SELECT waktu_id FROM top)),
fact AS (SELECT * FROM fact_one UNION ALL SELECT * FROM fact_two)"""

# -- a batch that came again behind a later one: orders of a seventh new, of an eleventh with another amount
LINE_NO = "CAST(split_part(trx_id, '-', 2) AS BIGINT)"
EARLY = "ship_day <= DATE '1999-12-31'"
ACCEPTED = "NOT negative AND nominal_transaksi IS NOT NULL AND waktu_id IN (SELECT waktu_id FROM calendar)"
CHANGED = RAW + f""",
raw_again AS (SELECT * REPLACE (CASE WHEN {LINE_NO} % 11 = 4 THEN '9' || nominal ELSE nominal END AS nominal) FROM raw WHERE {EARLY})""" + "," + ",".join([
    _typed("first_short", "raw", f"WHERE {EARLY} AND {LINE_NO} % 7 <> 3"), _typed("first_all", "raw"),
    _typed("first_new", "raw_again", f"WHERE {LINE_NO} % 7 = 3"),
    _copies("copies_short", "raw", f"WHERE {EARLY} AND {LINE_NO} % 7 <> 3"), _copies("copies_all", "raw"),
    _copies("copies_new", "raw_again", f"WHERE {LINE_NO} % 7 = 3"),
    TWO_DIMS.replace("raw_one AS (SELECT * FROM raw WHERE ship_day <= DATE '1999-12-31')", f"raw_one AS (SELECT * FROM raw WHERE {EARLY} AND {LINE_NO} % 7 <> 3)"),
]) + f""",
fact_one AS (
  SELECT row_number() OVER (ORDER BY seq) AS fact_id, waktu_id,
    CASE WHEN nasabah_id <= (SELECT count(*) FROM std_customer WHERE NOT is_new) THEN nasabah_id ELSE 0 END AS nasabah_id,
    CASE WHEN merchant_id <= (SELECT count(*) FROM std_merchant WHERE NOT is_new) THEN merchant_id ELSE 0 END AS merchant_id,
    channel_id, wilayah_id, nominal_transaksi, biaya_admin
  FROM (SELECT seq, waktu_id, {KEYS}, nominal_transaksi, biaya_admin FROM first_short {LOOKUPS} WHERE {ACCEPTED})),
top AS (SELECT max(waktu_id) AS waktu_id, max(fact_id) AS fact_id FROM fact_one),
fact_two AS (
  SELECT row_number() OVER (ORDER BY seq) + (SELECT fact_id FROM top) AS fact_id, waktu_id, {KEYS}, nominal_transaksi, biaya_admin
  FROM first_all {LOOKUPS} WHERE {ACCEPTED} AND waktu_id > (SELECT waktu_id FROM top)),
fact_new AS (
  SELECT row_number() OVER (ORDER BY seq) + (SELECT max(fact_id) FROM fact_two) AS fact_id, waktu_id, {KEYS}, nominal_transaksi, biaya_admin
  FROM first_new {LOOKUPS} WHERE {ACCEPTED}),
fact AS (SELECT * FROM fact_one UNION ALL SELECT * FROM fact_two UNION ALL SELECT * FROM fact_new)"""

FACT_OUT = """SELECT fact_id, waktu_id, nasabah_id, channel_id, wilayah_id, merchant_id,
  CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi, CAST(biaya_admin AS DOUBLE) AS biaya_admin FROM fact"""
REASON = """CASE WHEN negative THEN 'negative_amount' WHEN nominal_transaksi IS NULL THEN 'amount_out_of_range' WHEN waktu_id IS NULL THEN 'invalid_date'
    WHEN waktu_id NOT IN (SELECT waktu_id FROM calendar) THEN 'not_in_calendar'"""
VIEW_TOTALS = f"""WITH {TWO_FACTS} SELECT segmen_nasabah, provinsi, CAST(sum(nominal_transaksi) AS DOUBLE) AS volume, count(*) AS n
  FROM fact JOIN dim_nasabah USING (nasabah_id) JOIN dim_wilayah USING (wilayah_id) GROUP BY ALL"""
LEVELS_OUT = """tahun, quarter, bulan, hari, tanggal, segmen_nasabah, jenis_kelamin, nama_lengkap, jenis_channel,
  nama_channel, region, provinsi, kota, kategori, nama_merchant, CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi,
  CAST(biaya_admin AS DOUBLE) AS biaya_admin"""
GEO = f"""SELECT provinsi, kota, coalesce(lat, {DEFAULT_COORDS[0]}) AS lat, coalesce(lon, {DEFAULT_COORDS[1]}) AS lon,
  total_volume_transaksi, jumlah_transaksi
  FROM (SELECT provinsi, kota, {VOLUME}, {COUNT} FROM bank WHERE {KNOWN} GROUP BY ALL) LEFT JOIN {COORDS} USING (kota)"""
TOP = f"""SELECT nama_merchant, kategori, {VOLUME}, {COUNT} FROM bank WHERE {KNOWN} GROUP BY kategori, nama_merchant
  ORDER BY total_volume_transaksi DESC, nama_merchant, kategori LIMIT"""


def _grid(where: str) -> str:
    return f"""SELECT bulan, hari, count(fact_id) AS jumlah_transaksi
  FROM (SELECT DISTINCT bulan FROM bank WHERE {where}) CROSS JOIN (SELECT DISTINCT hari FROM calendar)
  LEFT JOIN (SELECT bulan, hari, fact_id FROM bank WHERE {where}) USING (bulan, hari) GROUP BY ALL"""


def _counts(where: str) -> str:
    return _bank(f"SELECT segmen_nasabah, jenis_kelamin, kategori, {VOLUME}, {COUNT}", f"WHERE {where} GROUP BY ALL")


def _roll(salt: str, n: int | str) -> str:
    """A draw of the generator for an order: its key squared twice modulo a prime, with a constant of the salt."""
    prime = 2147483647
    key = (crc32(salt.encode()) * 31 + 42) % prime
    x = f"((CAST(o_orderkey AS BIGINT) % {prime} + {key}) % {prime})"
    y = f"({x} * 48271 % {prime})"
    z = f"((({y} * {y}) + {key}) % {prime} * 69621 % {prime})"
    return f"(({z} * {z} + {x}) % {prime} % {n})"


def _pick(salt: str, values: list[str]) -> str:
    return f"([{', '.join(map(_text, values))}])[{_roll(salt, len(values))} + 1]"


GENERATED_CITIES = [c for c, _, _ in CITY_INFO] + ["BDG", "Jkt Sel", "SBY"]
GENERATED = f"""WITH drawn AS (SELECT *, CASE WHEN {_roll('unknown', 100)} < 2 THEN {_roll('which', 4)} ELSE -1 END AS blank,
    unnest(CASE WHEN {_roll('copy', 100)} < 2 THEN [0, 1] ELSE [0] END) AS nth FROM orders)
  SELECT 'TRX-' || o_orderkey AS trx_id,
    CASE WHEN {_roll('date', 100)} < 2 THEN '' WHEN {_roll('date', 100)} < 4 THEN '31-13-2026' ELSE strftime(
      DATE '2026-04-12' + CAST({_roll('day', "(DATE '2030-12-31' - DATE '2026-04-12' + 1)")} AS INTEGER), '%d-%m-%Y') END AS tgl_transaksi,
    CASE WHEN blank = 0 THEN '' ELSE 'N-' || {_roll('customer', '(SELECT count(*) FROM customer)')} END AS nasabah_code,
    CASE WHEN blank = 2 THEN '' ELSE {_pick('channel', ['ATM', 'BI_FAST', 'BIFAST', 'bifast', 'QRIS', 'qris', 'ATM_LINK', 'LIVIN', 'livin'])} END AS channel,
    CASE WHEN blank = 1 THEN '' ELSE 'MCH-' || {_roll('merchant', '(SELECT count(*) FROM part)')} END AS merchant_code,
    CASE WHEN blank = 3 THEN '' ELSE {_pick('city', GENERATED_CITIES)} END AS kota,
    CASE WHEN {_roll('sign', 100)} < 3 THEN '-' ELSE '' END
      || replace(format('{{:,}}', 10000 + {_roll('amount', 9990001)}), ',', '.')
      || CASE WHEN {_roll('has_cents', 100)} < 20 THEN ',' || lpad(CAST({_roll('cents', 100)} AS VARCHAR), 2, '0') ELSE '' END AS nominal,
    CASE WHEN {_roll('no_fee', 100)} < 5 THEN '' ELSE {_pick('fee', ['0', '2500', '6500'])} END AS biaya_admin
  FROM drawn"""

YEARS = "SELECT CAST(year(l_shipdate) AS BIGINT) AS tahun, * FROM lineitem"
QUARTILES = """years AS (SELECT CAST(year(l_shipdate) AS BIGINT) AS tahun, l_extendedprice AS x,
    row_number() OVER (PARTITION BY year(l_shipdate) ORDER BY l_extendedprice) AS rn,
    count(*) OVER (PARTITION BY year(l_shipdate)) AS n FROM lineitem)"""
METRICS = """
rows AS (SELECT (['S', 'M', 'L', 'XL'])[l_linenumber % 4 + 1] AS scale, l_linestatus AS query,
    CASE l_returnflag WHEN 'A' THEN 'simple' WHEN 'N' THEN 'rollup' ELSE 'pivot' END AS complexity,
    year(l_shipdate) AS y, l_quantity, l_extendedprice FROM lineitem),
sizes AS (SELECT scale, count(*) AS n_rows FROM rows GROUP BY scale),
etl AS (SELECT scale, y, count(*) AS n, sum(l_quantity) / 1000 AS sec FROM rows GROUP BY scale, y),
cube AS (SELECT scale, round_even(median(l_extendedprice), 3) / 1000 AS sec FROM rows GROUP BY scale),
query AS (SELECT scale, query, complexity, round_even(median(l_extendedprice), 3) AS ms FROM rows GROUP BY ALL),
class AS (SELECT complexity, scale, avg(ms) AS avg_ms FROM query GROUP BY ALL),
points AS (
  SELECT 'ETL Pipeline' AS layer, CAST(n AS DOUBLE) AS x, sec * 1000 AS y FROM etl
  UNION ALL SELECT 'Cube Construction', n_rows, sec * 1000 FROM cube JOIN sizes USING (scale)
  UNION ALL SELECT 'OLAP Query (' || complexity || ')', n_rows, avg_ms FROM class JOIN sizes USING (scale)),
rates AS (SELECT layer, round_even(regr_slope(y, x / 1000), 4) AS growth_rate_ms_per_1k, round_even(regr_r2(y, x / 1000), 4) AS r2
  FROM points GROUP BY layer)"""
MOM = ["total_volume_transaksi", "total_biaya_admin", "jumlah_transaksi", "rata_rata_nominal"]

ORACLE: dict[str, str] = {
    "f1_parse_nominal": f"WITH {RAW} SELECT trx_id, CAST({AMOUNT} AS DOUBLE) AS nominal FROM raw",
    "f2_parse_fee": f"WITH {RAW} SELECT trx_id, coalesce(TRY_CAST(biaya_admin AS DOUBLE), 0) AS biaya_admin FROM raw",
    "f3_parse_dates": f"""WITH {RAW} SELECT trx_id, CAST(strftime({DATE}, '%Y%m%d') AS BIGINT) AS waktu_id,
        strftime({DATE}, '%Y-%m-%d') AS tanggal FROM raw""",
    "f3_parse_birth_dates": f"WITH {RAW_CUSTOMER} SELECT nasabah_code, tanggal_lahir FROM std_customer",
    "f6_labels": """SELECT o_orderkey, substr(monthname(o_orderdate), 1, 3) || ' ' || year(o_orderdate) AS bulan_label,
        strftime(o_orderdate, '%Y-%m-%d') AS tanggal_label FROM orders""",
    "f9_split_date_range": """WITH r AS (
        SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE) AS f, CAST(max(o_orderdate) AS DATE) AS l, count(*) % 7 + 5 AS n
        FROM orders GROUP BY 1),
      p AS (SELECT *, l - f + 1 AS days, unnest(generate_series(1, n)) AS chunk FROM r),
      s AS (SELECT *, (chunk - 1) * (days // n) + least(chunk - 1, days % n) AS skip,
              days // n + CASE WHEN chunk - 1 < days % n THEN 1 ELSE 0 END AS len FROM p)
      SELECT o_orderpriority, chunk, strftime(f + CAST(skip AS INTEGER), '%Y-%m-%d') AS chunk_first,
        strftime(f + CAST(skip + len - 1 AS INTEGER), '%Y-%m-%d') AS chunk_last FROM s""",
    "f10_local_number": """SELECT p_partkey, replace(format('{:,}', CAST(floor(p_retailprice * 1000) AS BIGINT)), ',', '.')
        || CASE WHEN p_partkey % 5 = 0 THEN ',' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') ELSE '' END AS nominal FROM part""",
    "f11_labels": f"""WITH {BANK} SELECT CASE jenis_kelamin WHEN 'L' THEN 'Laki-laki' WHEN 'P' THEN 'Perempuan' ELSE 'Unknown' END AS gender,
        (['Jan', 'Feb', 'Mar', 'Apr', 'Mei', 'Jun', 'Jul', 'Agu', 'Sep', 'Okt', 'Nov', 'Des'])[{MONTH_NO}] AS bulan,
        CASE hari WHEN 'Monday' THEN 'Sen' WHEN 'Tuesday' THEN 'Sel' WHEN 'Wednesday' THEN 'Rab' WHEN 'Thursday' THEN 'Kam'
          WHEN 'Friday' THEN 'Jum' WHEN 'Saturday' THEN 'Sab' ELSE 'Min' END AS hari,
        round(CAST(sum(nominal_transaksi) AS DOUBLE) / 1000000000, 2) AS miliar,
        round(CAST(sum(nominal_transaksi) AS DOUBLE) / 1000000, 2) AS juta FROM bank GROUP BY ALL""",
    "f13_money_format": _star("kategori, format('{:,.2f}', CAST(sum(nominal_transaksi) AS DOUBLE)) AS volume", "kategori"),
    "p1_gender_map": f"WITH {RAW_CUSTOMER} SELECT nasabah_code, jenis_kelamin FROM std_customer",
    "p2_segment_map": f"WITH {RAW_CUSTOMER} SELECT nasabah_code, segmen_nasabah FROM std_customer",
    "p3_category_default": f"WITH {STD_MERCHANT} SELECT merchant_code, kategori FROM std_merchant",
    "p4_channel_map": f"WITH {RAW} SELECT channel AS raw, {FACT_CHANNEL} AS of_fact, {MEMBER_CHANNEL} AS member, count(*) AS n FROM raw GROUP BY ALL",
    "p6_city_alias": f"WITH {RAW} SELECT kota AS raw, coalesce({MEMBER_CITY}, 'Unknown') AS of_fact, {MEMBER_CITY} AS member, count(*) AS n FROM raw GROUP BY ALL",
    "a17_dedupe_first": f"""WITH {RAW} SELECT trx_id, tgl_transaksi, merchant_code, nominal, coalesce(biaya_admin, '') AS biaya_admin
        FROM raw QUALIFY row_number() OVER (PARTITION BY trx_id ORDER BY seq) = 1""",
    "p8_p9_fact_cleanse": f"""WITH {CLEAN} SELECT trx_id, waktu_id, nasabah_code, merchant_code, nama_channel, kota,
        CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi, CAST(biaya_admin AS DOUBLE) AS biaya_admin FROM clean""",
    "p8_p9_rejected_counts": f"""WITH {FIRST} SELECT CASE WHEN negative THEN 'negative_amount' WHEN nominal_transaksi IS NULL THEN 'amount_out_of_range'
        WHEN waktu_id IS NULL THEN 'invalid_date' ELSE 'accepted' END AS reason, count(*) AS n FROM firsts GROUP BY 1""",
    "w1_surrogate_keys": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id, o_orderkey FROM orders",
    "w2_continue_keys": """SELECT row_number() OVER (ORDER BY c_custkey) + (SELECT count(*) FROM customer WHERE c_mktsegment <> 'MACHINERY') AS nasabah_id,
        'N-' || c_custkey AS nasabah_code FROM customer WHERE c_mktsegment = 'MACHINERY'""",
    "j3_new_members_anti": "SELECT 'N-' || c_custkey AS nasabah_code, c_name AS nama_lengkap FROM customer WHERE c_mktsegment = 'MACHINERY'",
    "u1_unknown_member": f"WITH {DIM_MERCHANT} SELECT * FROM dim_merchant",
    "a24_ordered_distinct": f"WITH {RAW}, {_dim_channel('raw')} SELECT * FROM dim_channel",
    "u2_city_union": f"WITH {RAW}, {_dim_area('raw')} SELECT * FROM dim_wilayah",
    "j6_city_enrich": f"""WITH {RAW}, m AS (SELECT {MEMBER_CITY} AS kota, count(*) AS n FROM raw GROUP BY 1)
        SELECT m.kota, n, coalesce(provinsi, 'Unknown') AS provinsi, coalesce(region, 'Unknown') AS region
        FROM m LEFT JOIN {CITIES} ON m.kota = city.kota""",
    "j1_fk_lookup": f"WITH {WAREHOUSE} SELECT trx_id, {KEYS} FROM clean {LOOKUPS}",
    "j2_calendar_semi": f"WITH {CLEAN}, {CALENDAR} SELECT trx_id, waktu_id FROM clean WHERE waktu_id IN (SELECT waktu_id FROM calendar)",
    "j2_calendar_rejects": f"WITH {CLEAN}, {CALENDAR} SELECT trx_id, tgl_transaksi, waktu_id FROM clean WHERE waktu_id NOT IN (SELECT waktu_id FROM calendar)",
    "t1_high_water_load": f"""WITH {TWO_DAYS} SELECT row_number() OVER (ORDER BY seq) + (SELECT n FROM mark) AS fact_id, trx_id, waktu_id,
        CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi FROM batch WHERE waktu_id > (SELECT waktu_id FROM mark)""",
    "t3_late_rejects": f"""WITH {TWO_DAYS} SELECT trx_id, tgl_transaksi, waktu_id, 'late' AS reason FROM batch
        WHERE waktu_id <= (SELECT waktu_id FROM mark)""",
    "a15_high_water_mark": f"WITH {WAREHOUSE} SELECT max(waktu_id) AS max_waktu, max(fact_id) AS max_fact, count(*) AS rows FROM fact",
    "t2_dim_incremental": f"WITH {RAW}, {TWO_DIMS} SELECT * FROM dim_merchant",
    "t2_customers_incremental": f"WITH {RAW}, {TWO_DIMS} SELECT * FROM dim_nasabah",
    "t2_channels_incremental": f"WITH {RAW}, {TWO_DIMS} SELECT * FROM dim_channel",
    "t2_areas_incremental": f"WITH {RAW}, {TWO_DIMS} SELECT * FROM dim_wilayah",
    "t2_calendar_incremental": f"WITH {CALENDAR} SELECT * FROM calendar",
    "e1_full_load": f"WITH {WAREHOUSE} {FACT_OUT}",
    "e1_dim_nasabah": f"WITH {DIM_CUSTOMER} SELECT * FROM dim_nasabah",
    "e1_dim_waktu": f"WITH {CALENDAR} SELECT * FROM calendar",
    "e1_rejects": f"""WITH {FIRST}, {CALENDAR}, {_copies("copies", "raw")},
        judged AS (SELECT trx_id, tgl_transaksi, waktu_id, {REASON} END AS reason FROM firsts)
        SELECT * FROM judged WHERE reason IS NOT NULL UNION ALL SELECT *, 'duplicate' FROM copies""",
    "e2_changed_batch": f"WITH {CHANGED} {FACT_OUT}",
    "e2_changed_rejects": f"""WITH {CHANGED},
      judged AS (SELECT 'day-one' AS batch_id, {REASON} END AS reason FROM first_short
        UNION ALL SELECT 'day-two', {REASON} WHEN waktu_id <= (SELECT waktu_id FROM top) THEN 'late' END FROM first_all
        UNION ALL SELECT 'day-one.add1', {REASON} END FROM first_new
        UNION ALL SELECT 'day-one', 'duplicate' FROM copies_short UNION ALL SELECT 'day-two', 'duplicate' FROM copies_all
        UNION ALL SELECT 'day-one.add1', 'duplicate' FROM copies_new
        UNION ALL SELECT 'day-one.add1', 'changed_copy' FROM raw_again WHERE {LINE_NO} % 7 <> 3 AND {LINE_NO} % 11 = 4)
      SELECT batch_id, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL""",
    "e2_incremental_load": f"WITH {TWO_FACTS} {FACT_OUT}",
    "e2_reload_batch": f"WITH {TWO_FACTS} {FACT_OUT}",
    "e2_rejects": f"""WITH {TWO_FACTS}, {_copies("copies_one", "raw", "WHERE " + EARLY)}, {_copies("copies_two", "raw")},
      judged AS (SELECT 'full' AS batch_id, {REASON} END AS reason FROM first_one
        UNION ALL SELECT 'day-two', {REASON} WHEN waktu_id <= (SELECT waktu_id FROM top) THEN 'late' END FROM first_two
        UNION ALL SELECT 'full', 'duplicate' FROM copies_one UNION ALL SELECT 'day-two', 'duplicate' FROM copies_two)
      SELECT batch_id, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY ALL""",
    "t5_available_now_stream": f"""WITH {RAW}, {CALENDAR},
      firsts AS (SELECT year(ship_day) AS y, seq, CAST(strftime({DATE}, '%Y%m%d') AS BIGINT) AS waktu_id, {AMOUNT} AS amount, {NEGATIVE} AS negative
        FROM raw QUALIFY row_number() OVER (PARTITION BY year(ship_day), trx_id ORDER BY seq) = 1),
      kept AS (SELECT *, row_number() OVER (ORDER BY y, seq) AS fact_id FROM firsts
        WHERE NOT negative AND amount IS NOT NULL AND waktu_id IN (SELECT waktu_id FROM calendar))
      SELECT 'batch_' || y AS batch_id, count(*) AS rows, min(fact_id) AS first_id, max(fact_id) AS last_id,
        CAST(sum(amount) AS DOUBLE) AS volume FROM kept GROUP BY y""",
    "e3_quality_report": f"""WITH {WAREHOUSE},
      i AS (SELECT (SELECT count(*) FROM raw) AS total_input_rows,
        (SELECT count(*) FROM raw) - count(*) AS duplicate_removed,
        count(*) FILTER (negative) AS negative_nominal_removed, count(*) FILTER (waktu_id IS NULL) AS invalid_date_removed,
        count(*) FILTER (nominal_transaksi IS NULL AND NOT negative) AS out_of_range_removed FROM firsts),
      r AS (SELECT *, duplicate_removed + negative_nominal_removed + invalid_date_removed + out_of_range_removed AS total_records_removed FROM i)
      SELECT *, round_even(CAST(total_input_rows - total_records_removed AS DOUBLE) / total_input_rows * 100, 2) AS data_quality_rate_pct,
        (SELECT count(*) FROM fact WHERE nasabah_id = 0) AS unknown_nasabah, (SELECT count(*) FROM fact WHERE merchant_id = 0) AS unknown_merchant,
        (SELECT count(*) FROM fact WHERE channel_id = 0) AS unknown_channel, (SELECT count(*) FROM fact WHERE wilayah_id = 0) AS unknown_wilayah,
        (SELECT count(*) FROM fact) AS fact_rows_in_db FROM r""",
    "p18_unknown_keys": f"""WITH {WAREHOUSE} SELECT count(*) FILTER (nasabah_id = 0) AS unknown_nasabah,
        count(*) FILTER (merchant_id = 0) AS unknown_merchant, count(*) FILTER (channel_id = 0) AS unknown_channel,
        count(*) FILTER (wilayah_id = 0) AS unknown_wilayah, count(*) AS fact_rows_in_db FROM fact""",
    "s1_read_source_csv": f"WITH {RAW} SELECT trx_id, tgl_transaksi, nasabah_code, channel, merchant_code, kota, nominal, biaya_admin FROM raw",
    "s1_mixed_headers": f"""WITH {RAW} SELECT trx_id, tgl_transaksi, nasabah_code, channel, merchant_code, kota, nominal,
        CASE WHEN {LINE_NO} % 2 = 0 THEN biaya_admin END AS biaya_admin FROM raw""",
    "s1_source_order": f"WITH {RAW} SELECT seq AS line, trx_id, nominal FROM raw",
    "s12_ordered_export": f"WITH {DIM_MERCHANT} SELECT row_number() OVER (ORDER BY merchant_id) AS line, * FROM dim_merchant",
    "j4_star_view": f"""WITH {BANK} SELECT fact_id, tanggal, bulan, tahun, nama_lengkap, segmen_nasabah, jenis_kelamin, nama_channel, kota, provinsi,
        nama_merchant, kategori AS kategori_merchant, CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi,
        CAST(biaya_admin AS DOUBLE) AS biaya_admin FROM bank""",
    "s16_dirty_batch": GENERATED,
    "s11_view_rebuild": VIEW_TOTALS,
    "t6_view_after_batch": VIEW_TOTALS,
    "s11_stored_view": f"""WITH {TWO_FACTS} SELECT fact_id, tanggal, bulan, tahun, nama_lengkap, segmen_nasabah, jenis_kelamin, nama_channel,
        kota, provinsi, nama_merchant, kategori AS kategori_merchant, CAST(nominal_transaksi AS DOUBLE) AS nominal_transaksi,
        CAST(biaya_admin AS DOUBLE) AS biaya_admin
        FROM fact JOIN calendar USING (waktu_id) JOIN dim_nasabah USING (nasabah_id) JOIN dim_channel USING (channel_id)
          JOIN dim_wilayah USING (wilayah_id) JOIN dim_merchant USING (merchant_id)""",
    "j5_cube_rows": _bank(f"SELECT {LEVELS_OUT}"),
    "p17_level_defaults": f"""WITH {STAR} SELECT CASE WHEN tahun < 2001 THEN tahun ELSE 0 END AS tahun,
        CASE WHEN tahun < 2001 THEN quarter ELSE 'Unknown' END AS quarter, {VOLUME}, {COUNT} FROM star GROUP BY 1, 2""",
    "p12_slice": _level("segmen_nasabah", where="nama_channel = 'QRIS'"),
    "p13_dice": _level("segmen_nasabah", "segmen", f"""tahun IN (1997, 1998) AND quarter IN ('Q1', 'Q3') AND nama_channel IN ('ATM', 'QRIS')
        AND segmen_nasabah IN ('Reguler', 'Prioritas') AND kota IN ('Bandung', 'Medan', 'Cirebon', 'Surabaya') AND {HIDE_MERCHANT}"""),
    "p14_date_range": _level("nama_channel", "channel", f"tanggal BETWEEN '1997-03-15' AND '1998-02-10' AND {KNOWN}"),
    "p15_unknown_default": _counts(KNOWN),
    "p15_unknown_with_inclusion": _counts(f"segmen_nasabah IN ('Reguler', 'Prioritas', 'Private', 'Unknown') AND {HIDE_CHANNEL} AND {HIDE_AREA} AND {HIDE_MERCHANT}"),
    "p15_include_unknown": _counts("true"),
    "q0_filter_options": f"""WITH {BANK}, o AS (
        SELECT DISTINCT 'tahun' AS filter, CAST(tahun AS VARCHAR) AS nilai, CAST(tahun AS VARCHAR) AS ord FROM bank
        UNION SELECT 'quarter', quarter, quarter FROM bank UNION SELECT 'bulan', bulan, lpad(CAST({MONTH_NO} AS VARCHAR), 2, '0') FROM bank
        UNION SELECT 'channel', nama_channel, nama_channel FROM bank UNION SELECT 'segmen', segmen_nasabah, segmen_nasabah FROM bank
        UNION SELECT 'kategori', kategori, kategori FROM bank UNION SELECT 'provinsi', provinsi, provinsi FROM bank
        UNION SELECT 'kota', kota, kota FROM bank)
      SELECT filter, row_number() OVER (PARTITION BY filter ORDER BY ord) AS urutan, nilai FROM o
      UNION ALL SELECT 'min_date', 1, min(tanggal) FROM bank UNION ALL SELECT 'max_date', 1, max(tanggal) FROM bank""",
    "q1_kpi": _bank(f"SELECT {KPI}, {NO_TREND}", f"WHERE {KNOWN}"),
    "q1_kpi_mom": _trend(*[
        f"tahun = {y} AND bulan = '{m}' AND {KNOWN}" for y, m in ((1998, "January"), (1997, "December"))
    ]),
    "q1_kpi_mom_quarter": _trend(*[f"tahun = 1998 AND bulan = '{m}' AND quarter = 'Q2' AND {KNOWN}" for m in ("April", "March")]),
    "q1_kpi_empty": _bank(f"SELECT {KPI}, {NO_TREND}", f"WHERE tahun = 1900 AND {KNOWN}"),
    "q2_monthly_trend": _bank(
        f"SELECT 'month' AS granularity, substr(bulan, 1, 3) || ' ' || tahun AS label, {VOLUME}, {COUNT}", f"WHERE {KNOWN} GROUP BY tahun, bulan"
    ),
    "q2_daily_drilldown": _bank(
        f"SELECT 'day' AS granularity, tanggal AS label, {VOLUME}, {COUNT}", f"WHERE tahun = 1998 AND bulan = 'April' AND {KNOWN} GROUP BY tanggal"
    ),
    "q3_channel": _level("nama_channel", "channel"),
    "q4_segment": _level("segmen_nasabah", "segmen"),
    "q5_category": _level("kategori"),
    "q6_top_merchants": f"WITH {BANK} {TOP} 10",
    "q7_geographic": f"WITH {BANK} {GEO}",
    "q8_city_ranking": _level("kota"),
    "q9_gender": _level("jenis_kelamin"),
    "q10_channel_by_region": _bank("SELECT kota, " + ", ".join(
        f"count(*) FILTER (nama_channel = '{x}') AS \"{x}\"" for x in ("ATM", "ATM_LINK", "BI_FAST", "LIVIN", "QRIS")
    ), f"WHERE {KNOWN} GROUP BY kota"),
    "q11_daily": _level("hari"),
    "q12_heatmap": f"WITH {BANK} {_grid(KNOWN)}",
    "q13_segment_gender": _star(f"segmen_nasabah, jenis_kelamin, {VOLUME}", "1, 2"),
    "q14_city_channel": _star(f"kota, nama_channel, {COUNT}", "1, 2"),
    "q15_kpi": _star(KPI),
    "q15_channel": _star(f"nama_channel, {VOLUME}, {COUNT}", "1"),
    "q15_category": _star(f"kategori, {VOLUME}", "1"),
    "q15_city": _star(f"kota, {VOLUME}", "1"),
    "q15_month": _star(f"tahun, bulan, {VOLUME}", "1, 2"),
    "q15_weekday": _star(f"hari, {COUNT}", "1"),
    "q16_kpi": _star(KPI),
    "q16_monthly_trend": _star(f"tahun, bulan, {VOLUME}, {COUNT}", "1, 2"),
    "q16_channel": _star(f"nama_channel, {VOLUME}, {COUNT}", "1"),
    "q16_segment": _star(f"segmen_nasabah, {VOLUME}, {COUNT}", "1"),
    "q16_city": _star(f"kota, {VOLUME}, {COUNT}", "1"),
    "q16_channel_city": _star(f"kota, nama_channel, {COUNT}", "1, 2"),
    "q16_heatmap": _star(f"bulan, hari, {COUNT}", "1, 2"),
    "a8_drill_down": _star(f"region, provinsi, kota, {VOLUME}, {FEE}, {COUNT}", "1, 2, 3"),
    "a9_rollup_time": _star(
        f"""tahun, quarter, bulan, tanggal, CAST(4 - bit_count(CAST(grouping(tahun, quarter, bulan, tanggal) AS BIGINT)) AS BIGINT) AS depth,
        {VOLUME}, {COUNT}""", "ROLLUP (tahun, quarter, bulan, tanggal)"),
    "a9_cube_geo_channel": _star(
        f"region, nama_channel, segmen_nasabah, grouping(region, nama_channel, segmen_nasabah) AS gid, {VOLUME}, {COUNT}",
        "CUBE (region, nama_channel, segmen_nasabah)"),
    "a4_average": _star(f"kategori, nama_channel, {FEE}, CAST(sum(nominal_transaksi) AS DOUBLE) / count(*) AS rata_rata_nominal", "1, 2"),
    "a9_cuboid_segment": _level("segmen_nasabah", "segmen"),
    "a14_date_bounds": _bank("SELECT min(tanggal) AS min_date, max(tanggal) AS max_date"),
    "s17_cube_refresh": f"""WITH {TWO_FACTS} SELECT region, kategori, {VOLUME}, {COUNT}
        FROM fact JOIN dim_wilayah USING (wilayah_id) JOIN dim_merchant USING (merchant_id) GROUP BY 1, 2""",
    "s17_merchant_months": f"""WITH {TWO_FACTS} SELECT kategori, nama_merchant, tahun, bulan, {VOLUME}, {COUNT}
        FROM fact JOIN calendar USING (waktu_id) JOIN dim_nasabah USING (nasabah_id) JOIN dim_channel USING (channel_id)
          JOIN dim_wilayah USING (wilayah_id) JOIN dim_merchant USING (merchant_id) WHERE {KNOWN} GROUP BY ALL""",
    "s17_customers": f"""WITH {BANK}, t AS (SELECT segmen_nasabah, nama_lengkap, {VOLUME}, {FEE}, {COUNT} FROM bank WHERE {KNOWN} GROUP BY ALL)
        SELECT *, round(total_volume_transaksi / sum(total_volume_transaksi) OVER (PARTITION BY segmen_nasabah) * 100, 1) AS share_pct FROM t""",
    "s17_chosen_rollups": f"WITH {BANK} SELECT CAST(sum(nominal_transaksi) AS DOUBLE) AS volume, count(*) AS n, true AS several FROM bank",
    "w3_merchant_rank": f"WITH {BANK}, t AS ({TOP} 10) SELECT *, row_number() OVER (ORDER BY total_volume_transaksi DESC, nama_merchant) AS peringkat FROM t",
    "w4_share": f"""WITH {BANK}, t AS (SELECT kategori, {VOLUME}, {COUNT} FROM bank WHERE {KNOWN} GROUP BY kategori)
        SELECT *, round(total_volume_transaksi / sum(total_volume_transaksi) OVER (), 6) AS share,
          round(total_volume_transaksi / sum(total_volume_transaksi) OVER (), 6) >= 0.05 AS label_visible FROM t""",
    "w5_city_channel_share": f"""WITH {BANK}, t AS (SELECT kota, nama_channel, {COUNT} FROM bank GROUP BY kota, nama_channel)
        SELECT *, round(jumlah_transaksi / CAST(sum(jumlah_transaksi) OVER (PARTITION BY kota) AS DOUBLE) * 100, 1) AS share_pct FROM t""",
    "w6_ratio_to_max": f"""WITH {BANK}, t AS ({_grid(KNOWN)})
        SELECT *, round(jumlah_transaksi / CAST(max(jumlah_transaksi) OVER () AS DOUBLE), 6) AS ratio FROM t""",
    "w6_map_radius": f"WITH {BANK}, t AS ({GEO}) SELECT *, round(6 + total_volume_transaksi / max(total_volume_transaksi) OVER () * 24, 4) AS radius FROM t",
    "w8_peak_day": f"""WITH {BANK}, t AS (SELECT hari, {VOLUME}, {COUNT}, min(isodow(CAST(tanggal AS DATE))) AS i FROM bank WHERE {KNOWN} GROUP BY hari)
        SELECT hari, total_volume_transaksi, jumlah_transaksi, row_number() OVER (ORDER BY jumlah_transaksi DESC, i) = 1 AS is_peak FROM t""",
    "w9_mom_series": f"""WITH {BANK}, t AS (SELECT tahun, bulan, tahun * 12 + {MONTH_NO} AS m, {VOLUME}, {FEE}, {COUNT},
          CAST(sum(nominal_transaksi) AS DOUBLE) / count(*) AS rata_rata_nominal FROM bank WHERE {KNOWN} GROUP BY tahun, bulan)
        SELECT a.tahun, a.bulan, """ + ", ".join(
        f"CASE WHEN b.{k} <> 0 THEN round_even((CAST(a.{k} AS DOUBLE) - b.{k}) / b.{k} * 100, 2) END AS {k}_mom_pct" for k in MOM
    ) + " FROM t a LEFT JOIN t b ON b.m = a.m - 1",
    "o7_sorted_table": f"""WITH {BANK} SELECT row_number() OVER (ORDER BY nama_merchant DESC, kategori DESC) AS place,
        nama_merchant, kategori, {VOLUME}, {COUNT} FROM bank WHERE {KNOWN} GROUP BY kategori, nama_merchant""",
    "a18_growth_rate": "WITH p AS (SELECT l_returnflag, l_quantity AS x, l_extendedprice AS y FROM lineitem) " + _per_layer("l_returnflag", "p"),
    "a20_run_stats": f"""SELECT tahun, count(*) AS runs, round_even(median(l_extendedprice), 3) AS median_ms, round_even(min(l_extendedprice), 3) AS min_ms,
        round_even(max(l_extendedprice), 3) AS max_ms FROM ({YEARS}) GROUP BY tahun""",
    "a20_run_stats_overall": """SELECT count(*) AS runs, round_even(median(l_extendedprice), 3) AS median_ms, round_even(min(l_extendedprice), 3) AS min_ms,
        round_even(max(l_extendedprice), 3) AS max_ms FROM lineitem""",
    "a21_nearest_rank_quartiles": f"""WITH {QUARTILES} SELECT tahun, n AS runs, round_even(max(x) FILTER (rn = n // 4 + 1), 3) AS p25_ms,
        round_even(max(x) FILTER (rn = 3 * n // 4 + 1), 3) AS p75_ms FROM years GROUP BY tahun, n""",
    "a22_throughput": f"""SELECT tahun, count(*) AS rows_loaded, sum(l_quantity) AS etl_time_sec,
        round_even(count(*) / sum(l_quantity), 1) AS throughput_rps FROM ({YEARS}) GROUP BY tahun""",
    "a19_class_average": f"""WITH {METRICS} SELECT complexity, scale, n_rows, round_even(avg_ms, 3) AS avg_median_ms
        FROM class JOIN sizes USING (scale)""",
    "w7_bottleneck_rank": "WITH p AS (SELECT p_brand AS layer, l_quantity AS x, l_extendedprice AS y FROM lineitem JOIN part ON l_partkey = p_partkey), g AS ("
    + _per_layer("layer", "p")
    + """) SELECT *, row_number() OVER (ORDER BY growth_rate_ms_per_1k DESC, layer) AS rank,
        row_number() OVER (ORDER BY growth_rate_ms_per_1k DESC, layer) = 1 AS is_bottleneck FROM g""",
    "e4_scalability_report": f"""WITH {METRICS} SELECT row_number() OVER (ORDER BY growth_rate_ms_per_1k DESC, layer) AS rank, layer,
        growth_rate_ms_per_1k, r2, row_number() OVER (ORDER BY growth_rate_ms_per_1k DESC, layer) = 1 AS is_bottleneck FROM rates""",
    "e4_query_summary": f"""WITH {METRICS} SELECT scale, n_rows, complexity, round_even(avg_ms, 3) AS avg_median_ms, growth_rate_ms_per_1k, r2, layer
        FROM class JOIN sizes USING (scale) JOIN rates ON layer = 'OLAP Query (' || complexity || ')'""",
    "s14_metrics_append": f"""WITH {METRICS} SELECT scale, n AS rows_total, sec AS etl_time_sec, round_even(n / sec, 1) AS throughput_rps, layer,
        growth_rate_ms_per_1k, r2 FROM etl JOIN rates ON layer = 'ETL Pipeline'""",
}

ORACLE["s10_packed_batches"] = ORACLE["t5_available_now_stream"]
ORACLE["s10_packed_cells"] = f"""WITH {RAW}, {CALENDAR}, {STD_MERCHANT},
  firsts AS (SELECT CAST(strftime({DATE}, '%Y%m%d') AS BIGINT) AS waktu_id, {AMOUNT} AS nominal_transaksi, {NEGATIVE} AS negative,
      coalesce(merchant_code, 'MCH-UNKNOWN') AS merchant_code, {FACT_CHANNEL} AS nama_channel
    FROM raw QUALIFY row_number() OVER (PARTITION BY year(ship_day), trx_id ORDER BY seq) = 1)
  SELECT tahun, nama_channel, coalesce(kategori, 'Unknown') AS kategori, {VOLUME}, {COUNT}
  FROM firsts JOIN calendar USING (waktu_id) LEFT JOIN std_merchant USING (merchant_code)
  WHERE NOT negative AND nominal_transaksi IS NOT NULL GROUP BY ALL"""

ORACLE["e4_kept_up_report"] = ORACLE["e4_scalability_report"]
ORACLE["f7_round_half_even"] = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(format('{:.2f}', l_extendedprice / 1000) AS DOUBLE) AS price,
  CAST(format('{:.2f}', l_quantity / 8) AS DOUBLE) AS eighths FROM lineitem"""

ORACLE["e1_member_rejects"] = """SELECT 'dim_nasabah' AS dimension, 'N-' || c_custkey AS code, 'duplicate' AS reason FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT 'dim_merchant', 'MCH-' || p_partkey, 'duplicate' FROM part WHERE p_partkey % 5 = 0"""
ORACLE["e1_first_members"] = f"WITH {DIM_MERCHANT} SELECT * FROM dim_merchant"
