"""Fixed values that must equal the source system's for results to agree.

Everything in the block below is stated plainly, in the order the source
system uses, because the column order of the "affected columns" report and the
header names of the landed sheets depend on it.
"""

from __future__ import annotations

# --- fixed values (must match the source system exactly) -------------------

# Numeric report columns, in declared order.
NUMERIC_COLS = [
    "Nilai barang dagangan bruto (LIVE) (Rp)",
    "Produk yang ditambahkan",
    "Produk Terjual",
    "Pesanan SKU yang dibuat",
    "Pesanan SKU (LIVE)",
    "Produk yang terjual dari LIVE",
    "Pembeli",
    "Harga Rata-Rata (Rp)",
    "GMV yang didapat dari LIVE (Rp)",
    "Penonton",
    "Live Stream Dilihat",
    "Durasi menonton rata-rata (Siaran LIVE)",
    "Komentar",
    "Live Dibagikan",
    "Suka pada LIVE",
    "Pengikut baru (Video kreator)",
    "Produk Dilihat",
    "Klik Produk",
]

# Percentage / rate columns, in declared order.
PERCENT_COLS = [
    "Rasio pesanan per klik (LIVE)",
    "CTR",
]

DATE_COL = "Tanggal"
CREATOR_ID_COL = "ID Kreator"

# Snake-case columns removed from bronze (missing ones are ignored).
BRONZE_DROP_COLS = [
    "gmv_live_rp",
    "gmv_tidak_langsung_dari_live_rp",
    "produk_yang_terjual_melalui_live",
    "produk_yang_terjual_dari_live_secara_tidak_langsung",
]

# Bronze columns whose canonical text feeds the raw row hash, in order.
RAW_HASH_COLS = ["waktu_live", "toko", "id_kreator", "produk_yang_ditambahkan", "produk_dilihat"]

# Characters deleted by the snake-case rename (after lower, strip, space -> "_").
SNAKE_DELETE_CHARS = ".()%/-"

# Tokens: a cell is "blank" (blank-row test) when its stripped, lower-cased
# text is one of these.
BLANK_TOKENS = ["", "-", "nan", "none", "nat"]
# Tokens: a cell "has no content" (corruption test) when its lower-cased
# stripped text is one of these.
EMPTY_TOKENS = ["", "nan", "none", "-", "n/a"]
# Tokens turned into a missing date before date parsing (case-sensitive).
DATE_NULL_TOKENS = ["", "-", "nan", "None"]

# Characters allowed in a numeric cell besides whitespace:
# digits . , R p # -
NUMERIC_ALLOWED = r"0-9.,Rp#\-"
# Characters allowed in a percentage cell besides whitespace:
# digits . , % # -
PERCENT_ALLOWED = r"0-9.,%#\-"

# Spreadsheet day-serial epoch, and the largest serial the source accepts.
SERIAL_EPOCH = "1899-12-30"
SERIAL_MAX_DAYS = 106751

# Two-digit years: 69..99 -> 19yy, 00..68 -> 20yy.
TWO_DIGIT_YEAR_PIVOT = 69

# Names of months in dates that spell them.
ENGLISH_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
                  "November", "December"]

# Error-manifest literal values.
INVALID_DATE = "INVALID_DATE"
STATUS_OPEN = "open"
STATUS_FIXED = "fixed"
REASON_NUMERIC = "numeric_mixed"
REASON_DATE = "date_unparsable"

# Grid layout of a landed worksheet: header on row index 2, data from 3.
HEADER_ROW = 2
FIRST_DATA_ROW = 3

# Hash separator and reason separator.
HASH_SEP = "||"
REASON_SEP = "|"

# --- values built from a rule ------------------------------------------------

# Python's notion of whitespace (str.isspace), which the source system's
# strip() and regex \s use. All such code points lie below U+3001.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def java_class_escape(chars: str) -> str:
    """Escape characters for use inside a Java regex character class."""
    return "".join(f"\\u{ord(c):04x}" for c in chars)


WS_CLASS = java_class_escape(WHITESPACE)
