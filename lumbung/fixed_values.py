"""Fixed values that results depend on: lookup tables, orders, member names, formats."""

# --- Fixed values: cities, (province, island) in master order -----------------
CITY_INFO = {
    "Jakarta Selatan": ("DKI Jakarta", "Jawa"),
    "Bandung": ("Jawa Barat", "Jawa"),
    "Surabaya": ("Jawa Timur", "Jawa"),
    "Semarang": ("Jawa Tengah", "Jawa"),
    "Yogyakarta": ("DI Yogyakarta", "Jawa"),
    "Medan": ("Sumatera Utara", "Sumatera"),
    "Palembang": ("Sumatera Selatan", "Sumatera"),
    "Padang": ("Sumatera Barat", "Sumatera"),
    "Pekanbaru": ("Riau", "Sumatera"),
    "Banjarmasin": ("Kalimantan Selatan", "Kalimantan"),
    "Balikpapan": ("Kalimantan Timur", "Kalimantan"),
    "Pontianak": ("Kalimantan Barat", "Kalimantan"),
    "Makassar": ("Sulawesi Selatan", "Sulawesi"),
    "Manado": ("Sulawesi Utara", "Sulawesi"),
    "Denpasar": ("Bali", "Bali & Nusa Tenggara"),
    "Jayapura": ("Papua", "Papua"),
}
MASTER_CITIES = list(CITY_INFO)

# --- Fixed values: spellings of cities ----------------------------------------
CITY_ALIASES = {"BDG": "Bandung", "Jkt Sel": "Jakarta Selatan", "SBY": "Surabaya"}

# --- Fixed values: map positions (latitude, longitude) and the default centre --
CITY_COORDS = {
    "Bandung": (-6.9175, 107.6191),
    "Jakarta Selatan": (-6.2615, 106.8106),
    "Surabaya": (-7.2575, 112.7521),
    "Medan": (3.5952, 98.6722),
    "Yogyakarta": (-7.7956, 110.3695),
}
DEFAULT_COORDS = (-2.5489, 118.0149)

# --- Fixed values: gender codes (closed map) and default ----------------------
GENDER_CODES = {"M": "L", "Laki-laki": "L", "L": "L", "P": "P", "Female": "P"}
GENDER_UNKNOWN = "U"

# --- Fixed values: segment spellings (open map) and default -------------------
SEGMENT_SPELLINGS = {"RETAIL": "Reguler", "prio": "Prioritas"}
SEGMENT_DEFAULT = "Reguler"

# --- Fixed values: channels facts may use (closed map, after trim + upper) ----
CHANNEL_CODES = {
    "ATM": "ATM",
    "BI_FAST": "BI_FAST",
    "BIFAST": "BI_FAST",
    "QRIS": "QRIS",
    "ATM_LINK": "ATM_LINK",
    "LIVIN": "LIVIN",
}
# Channel members only have this one spelling mended (open map).
CHANNEL_SPELLINGS = {"BIFAST": "BI_FAST"}
CHANNEL_KIND = "Digital"

# --- Fixed values: names of the Unknown members (id 0) ------------------------
UNKNOWN = "Unknown"
UNKNOWN_CUSTOMER_CODE = "UNKNOWN"
UNKNOWN_MERCHANT_CODE = "MCH-UNKNOWN"
UNKNOWN_MERCHANT_NAME = "Unknown Merchant"
UNKNOWN_CHANNEL = "UNKNOWN"

# --- Fixed values: calendar order ---------------------------------------------
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# --- Fixed values: short labels for presentation ------------------------------
MONTH_SHORT = {
    "January": "Jan", "February": "Feb", "March": "Mar", "April": "Apr",
    "May": "Mei", "June": "Jun", "July": "Jul", "August": "Agu",
    "September": "Sep", "October": "Okt", "November": "Nov", "December": "Des",
}
WEEKDAY_SHORT = {
    "Monday": "Sen", "Tuesday": "Sel", "Wednesday": "Rab", "Thursday": "Kam",
    "Friday": "Jum", "Saturday": "Sab", "Sunday": "Min",
}
GENDER_LABELS = {"L": "Laki-laki", "P": "Perempuan", "U": "Unknown"}

# --- Fixed values: text that a CSV reader takes as "no value" ------------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- Fixed values: date formats of the sources (day first) --------------------
TRANSACTION_DATE = "d-M-yyyy"
BIRTH_DATE = "d/M/yyyy"

# --- Fixed values: scale labels in growing order ------------------------------
SCALES = ["S", "M", "L", "XL"]

# --- Fixed values: source file names ------------------------------------------
CUSTOMER_FILE = "nasabah_crm.csv"
MERCHANT_FILE = "merchant_mms.csv"
TRANSACTION_FILE = "transaksi_raw.csv"
CALENDAR_FILE = "dim_waktu_clean.csv"
