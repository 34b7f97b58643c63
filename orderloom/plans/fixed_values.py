"""Values that the results depend on, kept in one place.

Everything below is a FIXED VALUE: a column name, label, threshold, pattern or
text that must be exactly this for the results to be right. The operators take
these as default arguments, so another table can bring its own.
"""

from dataclasses import dataclass

# --- fixed values: landing table -------------------------------------------

LANDING_SEPARATOR = ";"

# header in the landing file -> working column name
LANDING_RENAMES = {
    "total_qty": "qty",
    "total_weight_gr": "weight_gr",
    "total_returned_qty": "returned_qty",
    "Total Diskon": "discount",
    "num_product_categories": "category_count",
    "Status Pesanan": "order_status",
    "Alasan Pembatalan": "cancel_reason",
    "Opsi Pengiriman": "ship_method",
    "Metode Pembayaran": "pay_method",
    "Kota/Kabupaten": "city",
    "Provinsi": "province",
    "Ongkos Kirim Dibayar oleh Pembeli": "ship_fee",
    "Estimasi Potongan Biaya Pengiriman": "ship_disc",
    "Total Pembayaran": "payment",
    "Perkiraan Ongkos Kirim": "ship_est",
    "Waktu Pesanan Dibuat": "order_timestamp",
}

KEY = "order_id"

# every landing column but the key and the date, in table order
CONTENT_COLUMNS = [
    "qty", "weight_gr", "returned_qty", "discount", "product_categories",
    "category_count", "order_status", "cancel_reason", "ship_method",
    "pay_method", "city", "province", "ship_fee", "ship_disc", "payment",
    "ship_est", "order_timestamp",
]
RAW_COLUMNS = [KEY, *CONTENT_COLUMNS, "order_date"]

# the columns that make two orders "the same", before and after date repair
DUPLICATE_COLUMNS_RAW = [*CONTENT_COLUMNS, "order_date"]
DUPLICATE_COLUMNS_CLEAN = [*CONTENT_COLUMNS, "order_date_clean"]
# the short list used on the typed table
DUPLICATE_COLUMNS_SHORT = ["qty", "city", "payment", "order_timestamp"]

NUMERIC_TEXT_COLUMNS = [
    "qty", "weight_gr", "returned_qty", "discount", "category_count",
    "ship_fee", "ship_disc", "payment", "ship_est",
]
CATEGORY_TEXT_COLUMNS = [
    "order_status", "cancel_reason", "ship_method", "pay_method", "city",
    "province",
]
# only this column loses its decimal suffix before its length is compared
NUMERIC_SUFFIX = {"qty": ".0"}

# --- fixed values: key format ----------------------------------------------

KEY_LENGTH = 11
KEY_PREFIX = "ORD"
KEY_JOINER = "_"
KEY_PATTERN = r"^ORD_\d{7}$"
KEY_FIRST_NUMBER = 1
KEY_LAST_NUMBER = 21001

# --- fixed values: categories ----------------------------------------------

CANCELLED = "Batal"
DONE = "Selesai"
RECEIVED = "Pesanan Diterima"
IN_TRANSIT = "Sedang Dikirim"
SENT = "Telah Dikirim"
RECEIVED_PATTERN = "%Pesanan diterima, namun Pembeli masih dapat%"
RECEIVED_PATTERN_AUDIT = (
    "%Pesanan diterima, namun Pembeli masih dapat mengajukan pengembalian%"
)
NOT_CANCELLED_REASON = "Tidak Dibatalkan"
CANCELLED_REASON_PATTERN = "Dibatalkan%"
FREE_PAYMENT = "Free (No Payment)"
CASH_ON_DELIVERY = "Cash On Delivery"
INSTANT = "Instant"
SAME_DAY = "Same Day"
HEAVY_CATEGORY_PATTERN = "%Seal / Baut / Roof%"

# --- fixed values: thresholds (rupiah, grams, pieces) ----------------------

HIGH_VALUE = 100_000
MID_VALUE = 50_000
FEW_PIECES = 2
BULK_PIECES = 10
HEAVY_ITEM_GR = 10_000
TOO_HEAVY_ITEM_GR = 20_000
HEAVY_FAST_GR = 50_000
TOO_HEAVY_INSTANT_GR = 100_000
GAP_OUTLIER = 30_000
GAP_OUTLIER_SHARE = 0.5
GAP_SUSPICIOUS = 15_000
TILES = 10

# --- fixed values: labels of the flags --------------------------------------

NORMAL = "Normal"
WEIGHT_LABELS = (
    "Invalid_Per_Item_Too_Heavy", "Invalid_Instant_Too_Heavy",
    "Suspicious_Per_Item_Heavy", "Suspicious_Fast_Shipping_Heavy",
)
PAYMENT_LABELS = (
    "Suspicious_High_Value_Low_Qty", "High_Value_Heavy_Category", "High_Value_Bulk", "High_Value",
)
SEGMENT_LABELS = ("High Value", "Mid Value", "Low Value")
SHIPPING_LABELS = ("Outlier", "Suspicious")
COD_LABELS = ("COD_1", "COD_2", "COD_3", "COD_4", "COD_5", "COD_6", "COD_Other")
NON_COD = "Non_COD"
COD_PROBLEMS = COD_LABELS[:2]



@dataclass(frozen=True)
class Terms:
    """What flags and rules go by; another table brings its own with ``replace``."""

    cancelled: str = CANCELLED
    done: str = DONE
    received: str = RECEIVED
    in_transit: str = IN_TRANSIT
    sent: str = SENT
    not_cancelled_reason: str = NOT_CANCELLED_REASON
    cancelled_reason_pattern: str = CANCELLED_REASON_PATTERN
    free_payment: str = FREE_PAYMENT
    cash_on_delivery: str = CASH_ON_DELIVERY
    instant: str = INSTANT
    same_day: str = SAME_DAY
    heavy_category_pattern: str = HEAVY_CATEGORY_PATTERN
    high_value: int = HIGH_VALUE
    mid_value: int = MID_VALUE
    few_pieces: int = FEW_PIECES
    bulk_pieces: int = BULK_PIECES
    heavy_item_gr: int = HEAVY_ITEM_GR
    too_heavy_item_gr: int = TOO_HEAVY_ITEM_GR
    heavy_fast_gr: int = HEAVY_FAST_GR
    too_heavy_instant_gr: int = TOO_HEAVY_INSTANT_GR
    gap_outlier: int = GAP_OUTLIER
    gap_outlier_share: float = GAP_OUTLIER_SHARE
    gap_suspicious: int = GAP_SUSPICIOUS
    normal: str = NORMAL
    weight_labels: tuple[str, ...] = WEIGHT_LABELS
    payment_labels: tuple[str, ...] = PAYMENT_LABELS
    segment_labels: tuple[str, ...] = SEGMENT_LABELS
    shipping_labels: tuple[str, ...] = SHIPPING_LABELS
    cod_labels: tuple[str, ...] = COD_LABELS
    non_cod: str = NON_COD
    cod_problems: tuple[str, ...] = COD_PROBLEMS


TERMS = Terms()

# --- fixed values: date formats --------------------------------------------

DATE_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]"
TIMESTAMP_GLOB = "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9] [0-9][0-9]:[0-9][0-9]*"
LOCAL_ZONE = "Asia/Jakarta"  # UTC+7 all year

# --- fixed values: audit log -----------------------------------------------

AUDIT_KEY = [KEY, "attribute", "reason", "source_table"]
AUDIT_COLUMNS = [
    "log_id", "logged_at", KEY, "attribute", "reason", "solution",
    "source_table", "total_rows", "problematic_rows",
]
RAW_TABLE = "raw_INA_sales"
TYPED_TABLE = "INA_sales"

# name -> (attribute, reason, solution, source table); a reason of None means
# that the row's own flag is the reason
AUDIT_TEXTS = {
    "duplicates": (
        "ALL Column (kecuali order_id)",
        "Duplicate rows",
        "Delete",
        RAW_TABLE,
    ),
    "blank_qty": ("qty", "Blank qty", "Delete", RAW_TABLE),
    "blank_pay": ("pay_method", "Blank pay_method", "Delete", RAW_TABLE),
    "invalid_date": (
        "order_date",
        "Invalid data tanggal (wrong format DD/MM/YYYY, blank rows, abnormal date)",
        "Rearrange invalid order_date dan query data tanggal dari order_timestamp",
        RAW_TABLE,
    ),
    "status": (
        "order_status",
        "Pengkategorian order_status belum seragam (uniform)",
        'Rename data "Pesanan diterima, namun...." --> "Pesanan Diterima"',
        RAW_TABLE,
    ),
    "ship_method": (
        "ship_method",
        "Pengkategorian ship_method belum seragam (uniform)",
        "Update data ship_method menggunakan external resource cleaned (ref_ship_method_category)",
        RAW_TABLE,
    ),
    "pay_method": (
        "pay_method",
        "Penamaan pay_method belum seragam (uniform)",
        "Update data pay_method menggunakan external resource cleaned (ref_payment_category)",
        RAW_TABLE,
    ),
    "province": (
        "province",
        "Penamaan province belum sesuai standar",
        "Rename data province sesuai standar menggunakan external resource cleaned (ref_prov_city)",
        RAW_TABLE,
    ),
    "city": (
        "city",
        "Penamaan city belum sesuai standar",
        "Rename data city sesuai standar menggunakan external resource cleaned (ref_prov_city)",
        RAW_TABLE,
    ),
    "zero_payment": (
        "payment",
        "Invalid zero payment",
        "Delete invalid zero payment",
        TYPED_TABLE,
    ),
    "ship_disc": (
        "ship_disc, ship_est",
        "Invalid ship_disc dan ship_est",
        "Delete invalid ship_disc dan ship_est",
        TYPED_TABLE,
    ),
    "weight_flag": (
        "weight_gr, qty, shipping_category",
        None,
        "flagging weight",
        TYPED_TABLE,
    ),
    "payment_flag": ("payment", None, "flagging payment", TYPED_TABLE),
    "shipping_flag": ("ship_fee, ship_est", None, "flagging shipping", TYPED_TABLE),
}
