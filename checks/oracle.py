"""The expected results as SQL for an in-process database on the given tables.

Each text is a list of common table expressions, the inputs of ``fixtures``
restated in SQL, followed by the query.
"""

from __future__ import annotations

from orderloom.plans import fixed_values as fv

from . import fixtures as fx
from .catalog import AS_OF, COMPLETE_COLUMNS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _values(name: str, rows: list[tuple], columns: list[str]) -> str:
    body = ", ".join("(" + ", ".join(_text(v) for v in row) + ")" for row in rows)
    return f"{name}({', '.join(columns)}) AS (VALUES {body})"


def _choice(number: str, choices: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_text(c)}" for i, c in enumerate(choices))
    return f"CASE {number} % {len(choices)} {whens} END"


def _list(columns: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


def _planted(name: str) -> str:
    whens = "".join(
        f" WHEN k % {divisor} = 0 THEN {'NULL' if value is None else _text(value)}"
        for divisor, column, value in fx.PLANTED
        if column == name
    )
    return f"CASE{whens} ELSE {name} END AS {name}" if whens else name


def whole(c: str) -> str:
    """The longest leading whole number of a text; 0 if there is none."""
    digits = rf"regexp_extract({c}, '^\s*([+-]?\d+)', 1)"
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN {digits} = '' THEN 0 "
        f"ELSE CAST({digits} AS BIGINT) END"
    )


def as_date(c: str) -> str:
    shaped = rf"regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}}')"
    return f"CASE WHEN {shaped} THEN TRY_CAST({c} AS DATE) END"


def as_timestamp(c: str) -> str:
    shaped = rf"regexp_full_match({c}, '\d{{4}}-\d{{2}}-\d{{2}} \d{{2}}:\d{{2}}')"
    return f"CASE WHEN {shaped} THEN TRY_CAST({c} || ':00' AS TIMESTAMP) END"


def iso(c: str) -> str:
    return (
        f"CASE WHEN contains({c}, '/') THEN {c}[7:10] || '-' || {c}[4:5] || '-' || {c}[1:2] "
        f"ELSE {c} END"
    )


CLEAN_DATE = f"coalesce({as_date(iso('order_date'))}, {as_date('order_timestamp[1:10]')})"

_INPUTS = [
    f"""part_label AS (
  SELECT p_partkey, p_size, p_type,
         CASE p_type WHEN 'PROMO' THEN {_text(fx.PROMO_LABEL)} ELSE p_type END AS label
  FROM part)""",
    """order_lines AS (
  SELECT l_orderkey, CAST(20 * sum(l_quantity * p_size) AS BIGINT) AS weight,
         count(*) FILTER (WHERE l_returnflag = 'R') AS returned
  FROM lineitem JOIN part_label ON l_partkey = p_partkey GROUP BY l_orderkey)""",
    """order_types AS (
  SELECT l_orderkey, count(*) AS types, string_agg(label, ', ' ORDER BY p_type) AS labels
  FROM (SELECT DISTINCT l_orderkey, p_type, label
        FROM lineitem JOIN part_label ON l_partkey = p_partkey)
  GROUP BY l_orderkey)""",
    """order_base AS (
  SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS d,
         strftime(o_orderdate, '%d/%m/%Y') AS day_first, *
  FROM orders
  JOIN order_lines ON order_lines.l_orderkey = o_orderkey
  JOIN order_types ON order_types.l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)""",
    f"""order_copies AS (
  SELECT 0 AS shift, * FROM order_base
  UNION ALL SELECT {fx.COPY_AS_IS}, * FROM order_base WHERE k % 499 = 0
  UNION ALL SELECT {fx.COPY_OTHER_DATE}, * FROM order_base WHERE k % 1497 = 0)""",
    f"""raw_plain AS (
  SELECT k, CASE WHEN k % 499 <> 0 AND k % 67 <> 0 AND k % {fx.SHORT_ID} = 0 THEN 'ORD_' || k
         WHEN k % 499 <> 0 AND k % 67 <> 0 AND k % {fx.WRONG_ID} = 0
           THEN 'XRD-0' || lpad(CAST(k AS VARCHAR), {fx.KEY_DIGITS}, '0')
         WHEN k % 499 <> 0 AND k % 67 <> 0 AND k % {fx.NULL_ID} = 0 THEN NULL
         WHEN k % 499 <> 0 AND k % 67 <> 0 AND k % {fx.SHARED_ID} = 0 THEN {_text(fx.SHARED)}
         ELSE 'ORD_' || shift || lpad(CAST(k AS VARCHAR), {fx.KEY_DIGITS}, '0') END AS order_id,
    CASE WHEN k % 67 = 0 THEN '' WHEN k % 2 = 0 THEN CAST(1 + k % 20 AS VARCHAR) || '.0'
         ELSE CAST(1 + k % 20 AS VARCHAR) END AS qty,
    CAST(weight AS VARCHAR) AS weight_gr,
    CAST(returned AS VARCHAR) AS returned_qty,
    CAST(k % 11 * 500 AS VARCHAR) AS discount,
    labels AS product_categories,
    CAST(types + CASE WHEN k % 211 = 0 THEN 1 ELSE 0 END AS VARCHAR) AS category_count,
    CASE WHEN o_orderstatus = 'F' THEN 'Selesai' WHEN o_orderstatus = 'O' THEN 'Batal'
         WHEN k % 3 = 0 THEN 'Sedang Dikirim' ELSE {_text(fx.STATUS_LONG)} END AS order_status,
    CASE WHEN o_orderstatus = 'O' THEN {_choice('k', fx.REASONS)}
         ELSE {_text(fx.REASON_NONE)} END AS cancel_reason,
    {_choice('k', fx.SHIP_METHODS)} AS ship_method,
    CASE WHEN k % 97 = 0 THEN '' ELSE {_choice('k', fx.PAY_METHODS)} END AS pay_method,
    'KAB. ' || n_name AS city,
    r_name AS province,
    CAST(k % 13 * 3000 AS VARCHAR) AS ship_fee,
    CAST(k % 37 * 1000 AS VARCHAR) AS ship_disc,
    CASE WHEN k % 41 = 0 THEN '0'
         ELSE CAST(CAST(floor(o_totalprice / 2500) AS BIGINT) * 1000 AS VARCHAR) END AS payment,
    CAST(k % 41 * 1000 AS VARCHAR) AS ship_est,
    d || ' ' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(k % 60 AS VARCHAR), 2, '0') AS order_timestamp,
    CASE WHEN k % 89 = 0 THEN '' WHEN k % 83 = 0 THEN '2024-13-40'
         WHEN k % 7 = 0 AND shift <> {fx.COPY_OTHER_DATE} THEN day_first ELSE d END AS order_date
  FROM order_copies)""",
    f"raw_sales AS (SELECT {', '.join(_planted(c) for c in fv.RAW_COLUMNS)} FROM raw_plain)",
    _values("map_ship", fx.MAP_SHIP, fx.MAP_SHIP_COLUMNS),
    _values("map_pay", fx.MAP_PAY, fx.MAP_PAY_COLUMNS),
    _values("map_cancel", fx.MAP_CANCEL, fx.MAP_CANCEL_COLUMNS),
    """map_place AS (
  SELECT coalesce(r_name, '') AS province, coalesce('Prov ' || r_name, '') AS province_new,
         'KAB. ' || n_name AS city, n_name AS city_new
  FROM nation LEFT JOIN region ON n_nationkey = r_regionkey)""",
    f"""order_category AS (
  SELECT DISTINCT 'ORD_0' || lpad(CAST(k AS VARCHAR), {fx.KEY_DIGITS}, '0') AS order_id, label AS product_category
  FROM order_base JOIN lineitem ON lineitem.l_orderkey = k
  JOIN part_label ON l_partkey = p_partkey)""",
    """ship_lookup AS (SELECT DISTINCT ship_method_new, shipping_category, shipping_carrier FROM map_ship)""",
]


def _mapped(name: str, source: str) -> str:
    """The row-local cleaning of a text table, with the clean date."""
    kept = [c for c in fv.RAW_COLUMNS if c not in
            ("order_status", "ship_method", "pay_method", "city", "province")]
    return f"""{name} AS (
  SELECT {_list(kept, 's.')}, {CLEAN_DATE} AS order_date_clean,
    CASE WHEN s.order_status ILIKE {_text(fv.RECEIVED_PATTERN)} THEN {_text(fv.RECEIVED)}
         ELSE s.order_status END AS order_status,
    coalesce(ship.ship_method_new, s.ship_method) AS ship_method,
    coalesce(pay.pay_method_new, s.pay_method) AS pay_method,
    coalesce(town.city_new, s.city) AS city,
    coalesce(prov.province_new, s.province) AS province
  FROM {source} s
  LEFT JOIN map_ship ship ON ship.ship_method = s.ship_method
  LEFT JOIN map_pay pay ON pay.pay_method = s.pay_method
  LEFT JOIN map_place town ON town.city = s.city
  LEFT JOIN (SELECT * FROM map_place WHERE province <> '') prov ON prov.province = s.province
  WHERE s.qty IS DISTINCT FROM '' AND s.pay_method IS DISTINCT FROM '')"""


_NUMBERS = fv.NUMERIC_TEXT_COLUMNS
_TEXTS = ["order_id", "product_categories", "order_status", "cancel_reason", "ship_method",
          "pay_method", "city", "province"]
TYPED_SELECT = (
    ", ".join(f"trim({c}) AS {c}" for c in _TEXTS)
    + ", "
    + ", ".join(f"{whole(f'nullif({c}, {_text(str())})')} AS {c}" for c in _NUMBERS)
    + f", {as_timestamp('order_timestamp')} AS order_timestamp, order_date_clean"
)

WEIGHT_FLAG = f"""CASE
    WHEN qty < {fv.BULK_PIECES} AND weight_gr / nullif(CAST(qty AS DOUBLE), 0) > {fv.TOO_HEAVY_ITEM_GR}
      THEN 'Invalid_Per_Item_Too_Heavy'
    WHEN shipping_category = 'Instant' AND weight_gr > {fv.TOO_HEAVY_INSTANT_GR}
      THEN 'Invalid_Instant_Too_Heavy'
    WHEN qty < {fv.BULK_PIECES} AND weight_gr / nullif(CAST(qty AS DOUBLE), 0) > {fv.HEAVY_ITEM_GR}
      THEN 'Suspicious_Per_Item_Heavy'
    WHEN shipping_category IN ('Instant', 'Same Day') AND weight_gr > {fv.HEAVY_FAST_GR}
      THEN 'Suspicious_Fast_Shipping_Heavy'
    ELSE 'Normal' END"""
PAYMENT_FLAG = f"""CASE
    WHEN payment IS NULL OR payment <= {fv.HIGH_VALUE} THEN 'Normal'
    WHEN product_categories ILIKE {_text(fv.HEAVY_CATEGORY_PATTERN)} THEN 'High_Value_Heavy_Category'
    WHEN qty <= {fv.FEW_PIECES} AND product_categories IS NOT NULL
      THEN 'Suspicious_High_Value_Low_Qty'
    WHEN qty >= {fv.BULK_PIECES} THEN 'High_Value_Bulk'
    ELSE 'High_Value' END"""
PAYMENT_SEGMENT = f"""CASE WHEN payment >= {fv.HIGH_VALUE} THEN 'High Value'
    WHEN payment >= {fv.MID_VALUE} THEN 'Mid Value' ELSE 'Low Value' END"""
SHIPPING_FLAG = f"""CASE
    WHEN abs(ship_fee - ship_est) > {fv.GAP_OUTLIER}
      AND abs(ship_fee - ship_est) / nullif(CAST(ship_est AS DOUBLE), 0) > {fv.GAP_OUTLIER_SHARE}
      THEN 'Outlier'
    WHEN abs(ship_est - ship_disc - ship_fee) > {fv.GAP_SUSPICIOUS} THEN 'Suspicious'
    ELSE 'Normal' END"""
COD_STATUS = """CASE
    WHEN pay_method IS DISTINCT FROM 'Cash On Delivery' THEN 'Non_COD'
    WHEN payment = 0 THEN CASE
      WHEN order_status IN ('Selesai', 'Pesanan Diterima') THEN 'COD_1'
      WHEN order_status IN ('Sedang Dikirim', 'Telah Dikirim') THEN 'COD_4'
      WHEN order_status = 'Batal' THEN 'COD_6' ELSE 'COD_Other' END
    WHEN payment > 0 THEN CASE
      WHEN order_status = 'Batal' THEN 'COD_2'
      WHEN order_status IN ('Selesai', 'Pesanan Diterima') THEN 'COD_3'
      WHEN order_status IN ('Sedang Dikirim', 'Telah Dikirim') THEN 'COD_5' ELSE 'COD_Other' END
    ELSE 'COD_Other' END"""

# never NULL: an unknown payment is no violation, an unknown excuse is none
ZERO_PAYMENT = (
    "(payment IS NOT DISTINCT FROM 0 AND (order_status = 'Batal'"
    " OR pay_method = 'Free (No Payment)') IS NOT TRUE)"
)
ABOVE_DISC = "(ship_disc <= ship_est) IS NOT TRUE"


def _typed(name: str, source: str) -> str:
    return f"""{name} AS (
  SELECT *, {WEIGHT_FLAG} AS weight_flag, {PAYMENT_FLAG} AS payment_flag,
    {PAYMENT_SEGMENT} AS payment_segment, {SHIPPING_FLAG} AS shipping_flag
  FROM (SELECT t.*, l.shipping_category, l.shipping_carrier, c.cancel_by, c.reason AS sub_reason
        FROM (SELECT {TYPED_SELECT} FROM {source}) t
        LEFT JOIN ship_lookup l ON l.ship_method_new = t.ship_method
        LEFT JOIN map_cancel c ON c.cancel_reason = t.cancel_reason))"""


def _without_first(name: str, source: str, cols: list[str]) -> str:
    """All rows but those with the smallest id of a duplicate group."""
    return f"""{name} AS (
  SELECT * FROM {source} WHERE order_id IS NULL OR order_id NOT IN (
    SELECT order_id FROM ({_dup_groups(source, cols)}) WHERE order_id IS NOT NULL))"""


def _dup_groups(source: str, cols: list[str]) -> str:
    part = f"PARTITION BY {_list(cols)}"
    return f"""SELECT * EXCLUDE (place) FROM (
      SELECT count(*) OVER ({part}) AS group_rows, *,
        row_number() OVER ({part} ORDER BY order_id NULLS FIRST) AS place FROM {source})
    WHERE group_rows > 1 AND place = 1"""


_STAGES = [
    _mapped("cleaned_sales", "raw_sales"),
    _typed("typed_sales", "cleaned_sales"),
    _without_first("unique_raw", "raw_sales", fv.DUPLICATE_COLUMNS_RAW),
    "with_qty AS (SELECT * FROM unique_raw WHERE qty IS DISTINCT FROM '')",
    "with_pay AS (SELECT * FROM with_qty WHERE pay_method IS DISTINCT FROM '')",
    _mapped("repaired", "unique_raw"),
    _without_first("clean", "repaired", fv.DUPLICATE_COLUMNS_CLEAN),
    _typed("flagged", "clean"),
    f"valid_payment AS (SELECT * FROM flagged WHERE NOT {ZERO_PAYMENT})",
    "final AS (SELECT * FROM valid_payment WHERE ship_disc <= ship_est)",
    """fact AS (
  SELECT order_id, order_date_clean AS order_date, order_timestamp,
    strftime(order_date_clean, '%Y') AS year_order_date,
    strftime(order_date_clean, '%Y-%m') AS month_order_date,
    strftime(order_timestamp, '%H:%M') || ':00' AS time_order_date,
    category_count, qty, returned_qty, weight_gr, order_status, cancel_by, sub_reason, discount,
    payment, pay_method, payment_segment, ship_method, ship_fee, ship_disc, ship_est,
    shipping_category, shipping_carrier, ship_fee - ship_disc AS net_shipping, city, province,
    weight_flag AS flag_weight, payment_flag AS flag_payment, shipping_flag AS flag_shipping
  FROM final)""",
]


def _sql(body: str) -> str:
    return "WITH " + ",\n".join(_INPUTS + _STAGES) + "\n" + body


# --- report builders --------------------------------------------------------


def _each(cols: list[str], template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in cols)


def _numeric_profile(cols: list[str], strip: bool) -> str:
    text = "replace(value, '.0', '')" if strip else "value"
    stacked = _each(cols, "SELECT '{c}' AS attribute, {c} AS value FROM raw_sales")
    return f"""SELECT attribute, value, length({text}) AS text_length,
      length(CAST({whole('value')} AS VARCHAR)) AS number_length, count(value) AS value_rows
    FROM ({stacked}) GROUP BY attribute, value
    HAVING length({text}) <> length(CAST({whole('value')} AS VARCHAR))"""


def _null_blank(cols: list[str]) -> str:
    stacked = _each(cols, "SELECT '{c}' AS attribute, {c} AS value FROM raw_sales")
    return f"""SELECT attribute, CASE WHEN value IS NULL THEN 'null' ELSE 'blank' END AS status,
      count(value) AS value_rows, count(*) AS table_rows
    FROM ({stacked}) WHERE value IS NULL OR value = '' GROUP BY 1, 2"""


def _padding(cols: list[str]) -> str:
    stacked = _each(cols, "SELECT '{c}' AS attribute, {c} AS value FROM raw_sales")
    return f"""SELECT attribute, value, count(value) AS value_rows, 'Problem' AS status
    FROM ({stacked}) WHERE value IS NULL OR value <> trim(value) GROUP BY attribute, value"""


def _reconcile(source: str, col: str) -> str:
    text = f"CAST({col} AS VARCHAR)"
    arranged = as_date(iso("t"))
    return f"""SELECT 'order_date' AS attribute, count(*) AS total_rows,
      CAST(sum(CASE WHEN a = day THEN 1 ELSE 0 END) AS BIGINT) AS same_rows,
      CAST(sum(CASE WHEN a IS NULL AND t = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_rows,
      CAST(sum(CASE WHEN a IS NULL AND t <> '' THEN 1 ELSE 0 END) AS BIGINT) AS abnormal_rows
    FROM (SELECT t, {arranged} AS a, day
          FROM (SELECT {text} AS t, {as_date('order_timestamp[1:10]')} AS day FROM {source}))"""


def _dup_rows(source: str, cols: list[str]) -> str:
    return f"""SELECT * FROM (
      SELECT *, count(*) OVER (PARTITION BY {_list(cols)}) AS group_rows FROM {source})
    WHERE group_rows > 1"""


def _std(col: str, mapping: str, new: str) -> str:
    return f"""SELECT order_id, CASE WHEN m.{col} IS NULL THEN s.{col} ELSE m.{new} END AS {col}
    FROM raw_sales s LEFT JOIN (SELECT DISTINCT {col}, {new} FROM {mapping} WHERE {col} <> '') m
      ON m.{col} = s.{col}"""


def _domain(col: str, mapping: str, new: str) -> str:
    return f"""SELECT order_id, {col} FROM typed_sales
    WHERE {col} NOT IN (SELECT {new} FROM {mapping} WHERE {new} <> '')"""


def _ntile(source: str, measure: str, name: str) -> str:
    return f"""SELECT CAST(bucket AS BIGINT) AS bucket, round(avg(v)) AS avg_{name},
      min(v) AS min_{name}, max(v) AS max_{name}, count(*) AS total
    FROM (SELECT {measure} AS v, ntile(10) OVER (ORDER BY {measure} NULLS FIRST) AS bucket FROM {source})
    GROUP BY bucket"""


_FUTURE = (
    f"(order_date_clean >= DATE '{AS_OF[:10]}' OR order_timestamp >= "
    f"CAST(CAST(TIMESTAMP '{AS_OF}' + INTERVAL 7 HOURS AS DATE) AS TIMESTAMP))"
)
_INCOMPLETE = "(" + " OR ".join(
    f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''" for c in COMPLETE_COLUMNS
) + ")"
_MISMATCH = (
    "((cancel_reason = 'Tidak Dibatalkan' AND order_status = 'Batal')"
    " OR (order_status <> 'Batal' AND cancel_reason ILIKE 'dibatalkan%'))"
)
_RULES = {
    "returned_gt_qty": "returned_qty > qty",
    "free_but_paid": "pay_method = 'Free (No Payment)' AND payment > 0",
    "invalid_zero_payment": ZERO_PAYMENT,
    "discount_gt_total": "discount > payment + ship_fee AND order_status <> 'Batal'",
    "invalid_ship_disc": ABOVE_DISC,
    "ship_fee_gt_est": "(ship_fee <= ship_est) IS NOT TRUE",
    "status_reason_mismatch": _MISMATCH,
    "return_not_done": "returned_qty > 0 AND order_status <> 'Selesai'",
    "date_ts_mismatch": "CAST(order_timestamp AS DATE) <> order_date_clean",
    "per_item_weight": "qty < 10 AND weight_gr / 1000.0::DOUBLE / nullif(qty, 0) > 10",
    "fast_ship_heavy": "shipping_category IN ('Instant', 'Same Day')"
    " AND round(weight_gr / 1000.0::DOUBLE, 3) > 50",
    "cod_problem": f"{COD_STATUS} IN ('COD_1', 'COD_2')",
    "future_dates": _FUTURE,
    "incomplete_rows": _INCOMPLETE,
}


def _relation(name: str, table: str, col: str, parent: str, parent_col: str) -> str:
    named = f"(SELECT {col} AS v FROM {table} WHERE {col} <> '')"
    members = f"(SELECT {parent_col} AS v, count(*) AS n FROM {parent} WHERE {parent_col} <> '' GROUP BY 1)"
    return f"""SELECT '{name}' AS reference, (SELECT count(*) FROM {table}) AS rows,
      (SELECT count(*) FROM {table} WHERE coalesce({col}, '') = '') AS empty_rows,
      (SELECT count(*) FROM {named} WHERE v NOT IN (SELECT v FROM {members})) AS orphan_rows,
      (SELECT count(DISTINCT v) FROM {named} WHERE v NOT IN (SELECT v FROM {members})) AS orphan_values,
      (SELECT count(*) FROM {members}) AS members,
      (SELECT count(*) FROM {members} WHERE v NOT IN (SELECT v FROM {named})) AS unused_members,
      (SELECT count(*) FROM {members} WHERE n > 1) AS repeated_members"""


def _rule(name: str, columns: str) -> str:
    return f"SELECT {columns} FROM typed_sales WHERE {_RULES[name]}"


def _audit(entry: str, source: str, where: str = "true", reason: str | None = None) -> str:
    attribute, fixed, solution, table = fv.AUDIT_TEXTS[entry]
    return f"""SELECT order_id, {_text(attribute)} AS attribute,
      {f'min({reason})' if reason else _text(fixed)} AS reason, {_text(solution)} AS solution,
      {_text(table)} AS source_table, (SELECT count(order_id) FROM {source}) AS total_rows,
      count(order_id) AS problematic_rows
    FROM {source} WHERE {where} GROUP BY order_id"""


def _audit_dups(source: str, cols: list[str]) -> str:
    attribute, fixed, solution, table = fv.AUDIT_TEXTS["duplicates"]
    return f"""SELECT min(order_id) AS order_id, {_text(attribute)} AS attribute,
      {_text(fixed)} AS reason, {_text(solution)} AS solution, {_text(table)} AS source_table,
      (SELECT count(order_id) FROM {source}) AS total_rows, count(*) AS problematic_rows
    FROM {source} GROUP BY {_list(cols)} HAVING count(*) > 1"""


_AUDITS = {
    "duplicates": _audit_dups("raw_sales", fv.DUPLICATE_COLUMNS_RAW),
    "blank_qty": _audit("blank_qty", "unique_raw", "qty = ''"),
    "status": _audit(
        "status", "with_qty", f"order_status ILIKE {_text(fv.RECEIVED_PATTERN_AUDIT)}"
    ),
    "ship_method": _audit("ship_method", "with_qty"),
    "blank_pay": _audit("blank_pay", "with_qty", "pay_method = ''"),
    "pay_method": _audit("pay_method", "with_pay"),
    "city": _audit("city", "with_pay"),
    "province": _audit("province", "with_pay"),
    "invalid_date": _audit("invalid_date", "with_pay", f"({as_date('order_date')}) IS NULL"),
    "duplicates_clean": _audit_dups("repaired", fv.DUPLICATE_COLUMNS_CLEAN),
    "weight_flag": _audit("weight_flag", "flagged", "weight_flag <> 'Normal'", "weight_flag"),
    "zero_payment": _audit("zero_payment", "flagged", ZERO_PAYMENT),
    "payment_flag": _audit(
        "payment_flag", "valid_payment", "payment_flag <> 'Normal'", "payment_flag"
    ),
    "ship_disc": _audit("ship_disc", "valid_payment", ABOVE_DISC),
    "shipping_flag": _audit("shipping_flag", "final", "shipping_flag <> 'Normal'", "shipping_flag"),
}


def _numbered(entries: list[str]) -> str:
    """Entries with the ids they get when they are appended one after the other."""
    steps = " UNION ALL ".join(
        f"SELECT {i} AS step, * FROM ({_AUDITS[e]})" for i, e in enumerate(entries)
    )
    return f"""SELECT * EXCLUDE (step), row_number() OVER (ORDER BY step, order_id NULLS FIRST) AS log_id
    FROM ({steps})"""


def _broken_constraints() -> str:
    text_columns = ["order_id", "product_categories", "order_status", "cancel_reason",
                    "ship_method", "pay_method", "city", "province"]
    checks = [(f"{c} not null", f"{c} IS NULL") for c in text_columns + fv.NUMERIC_TEXT_COLUMNS]
    checks += [(f"length(order_id) = {fx.ID_LENGTH}", f"length(order_id) <> {fx.ID_LENGTH}")]
    checks += [(f"{c} > 0", f"{c} <= 0") for c in ("qty", "weight_gr", "category_count")]
    checks += [
        (f"{c} >= 0", f"{c} < 0")
        for c in ("returned_qty", "discount", "ship_fee", "ship_disc", "payment", "ship_est")
    ]
    rows = " UNION ALL ".join(
        f"SELECT order_id, {_text(name)} AS \"constraint\", CAST(1 AS BIGINT) AS violations "
        f"FROM loaded WHERE {broken}"
        for name, broken in checks
    )
    return (
        f"{rows} UNION ALL SELECT order_id, 'order_id unique', count(*) FROM loaded "
        "WHERE order_id IS NOT NULL GROUP BY order_id HAVING count(*) > 1"
    )


_LOADED = f"""loaded AS (
  SELECT {TYPED_SELECT} FROM (SELECT *, {CLEAN_DATE} AS order_date_clean FROM raw_sales))"""

_RAW = _list(fv.RAW_COLUMNS)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # sources and sinks
    q["scan_landing_text"] = "SELECT " + ", ".join(
        f"coalesce({c}, '') AS {c}" for c in fv.RAW_COLUMNS
    ) + " FROM raw_sales"
    q["landing_rejects"] = """SELECT coalesce(order_id, '') || ';' || coalesce(qty, '')
        || CASE WHEN order_id LIKE '%3' THEN ';' || coalesce(city, '') || ';more' ELSE '' END AS line
      FROM raw_sales WHERE order_id LIKE '%3' OR order_id LIKE '%7'"""
    q["scan_mapping_dedup"] = """
      SELECT DISTINCT 'city' AS list, city AS key, city_new AS value FROM map_place WHERE city <> ''
      UNION ALL
      SELECT DISTINCT 'province', province, province_new FROM map_place WHERE province <> ''"""
    q["snapshot_backup"] = "SELECT * FROM typed_sales"
    q["export_roundtrip"] = (
        "SELECT coalesce(COLUMNS(*), '') AS '\\0' FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM fact)"
    )

    # profiles
    q["rename_columns"] = f"SELECT {_RAW} FROM raw_sales"
    q["peek_limit"] = (f"SELECT {_RAW} FROM raw_sales ORDER BY "
      + ", ".join(f"{c} NULLS FIRST" for c in fv.RAW_COLUMNS)
      + " LIMIT 100")
    q["distinct_len"] = f"""SELECT DISTINCT length(order_id) AS key_length FROM raw_sales
      WHERE length(order_id) <> {fx.ID_LENGTH}"""
    q["id_format_check"] = """SELECT DISTINCT left(order_id, 3) AS prefix, order_id[4:4] AS joiner
      FROM raw_sales WHERE left(order_id, 3) <> 'ORD' AND order_id[4:4] <> '_'"""
    q["id_format_strict"] = (
        f"SELECT order_id FROM raw_sales WHERE NOT regexp_full_match(order_id, {_text(fx.ID_PATTERN[1:-1])})"
    )
    q["suffix_in_sequence"] = f"""SELECT order_id, {whole('order_id[6:24]')} AS key_number
      FROM raw_sales WHERE {whole('order_id[6:24]')} NOT IN
        (SELECT unnest(generate_series(1, {fv.KEY_LAST_NUMBER})))"""
    q["dup_keys_or_null"] = """SELECT order_id, count(order_id) AS key_rows FROM raw_sales
      GROUP BY order_id HAVING count(order_id) > 1 OR order_id IS NULL"""
    q["numeric_format_profile_qty"] = _numeric_profile(["qty"], strip=True)
    q["numeric_format_profile_plain"] = _numeric_profile(fv.NUMERIC_TEXT_COLUMNS, strip=False)
    q["null_blank_profile"] = _null_blank(["qty"])
    q["null_blank_profile_all"] = _null_blank(fv.NUMERIC_TEXT_COLUMNS + fv.CATEGORY_TEXT_COLUMNS)
    q["blank_categories"] = """SELECT product_categories, count(product_categories) AS value_rows
      FROM raw_sales WHERE coalesce(product_categories, '') = '' GROUP BY product_categories"""
    q["trim_profile"] = _padding(fv.CATEGORY_TEXT_COLUMNS)
    q["value_frequencies"] = "SELECT attribute, value, count(value) AS value_rows FROM (" + _each(
        fv.CATEGORY_TEXT_COLUMNS, "SELECT '{c}' AS attribute, {c} AS value FROM raw_sales"
    ) + ") GROUP BY attribute, value"
    q["invalid_dates"] = f"""SELECT order_date AS value, count(order_date) AS value_rows
      FROM raw_sales WHERE ({as_date('order_date')}) IS NULL GROUP BY order_date"""
    q["abnormal_dates"] = q["invalid_dates"].replace(
        "GROUP BY", "AND order_date NOT LIKE '%/%' AND order_date <> '' GROUP BY"
    )
    q["invalid_timestamps"] = f"""SELECT order_timestamp AS value,
        count(order_timestamp) AS value_rows FROM raw_sales
      WHERE ({as_timestamp('order_timestamp')}) IS NULL GROUP BY order_timestamp"""
    q["date_reconcile"] = _reconcile("raw_sales", "order_date")
    q["glob_date_check"] = """SELECT order_id, order_date FROM raw_sales
      WHERE order_date NOT GLOB '[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]'"""
    q["sqlite_int_cast"] = "SELECT order_id, " + ", ".join(
        f"{whole(c)} AS {c}" for c in ("qty", "weight_gr", "order_date", "pay_method")
    ) + " FROM raw_sales"
    q["like_ci"] = f"""SELECT order_id, order_status FROM raw_sales
      WHERE order_status ILIKE {_text(fv.RECEIVED_PATTERN)}"""
    q["invalid_dates_after"] = """SELECT CAST(order_date_clean AS VARCHAR) AS value,
        count(order_date_clean) AS value_rows FROM cleaned_sales
      WHERE order_date_clean IS NULL GROUP BY order_date_clean"""
    q["abnormal_dates_after"] = q["invalid_dates_after"].replace("GROUP BY", "AND false GROUP BY")
    q["date_reconcile_after"] = _reconcile("cleaned_sales", "order_date_clean")

    # duplicates
    raw_cols, clean_cols = fv.DUPLICATE_COLUMNS_RAW, fv.DUPLICATE_COLUMNS_CLEAN
    q["dup_groups"] = _dup_groups("raw_sales", raw_cols)
    q["dup_rows_full"] = _dup_rows("raw_sales", raw_cols)
    q["dedup_one_per_group"] = "SELECT * FROM unique_raw"
    q["dedup_keep_first"] = f"""SELECT * FROM raw_sales QUALIFY
      row_number() OVER (PARTITION BY {_list(raw_cols)} ORDER BY order_id NULLS FIRST) = 1"""
    q["dup_groups_4col"] = _dup_groups("typed_sales", fv.DUPLICATE_COLUMNS_SHORT)
    q["dup_groups_after"] = _dup_groups("repaired", clean_cols)
    q["dup_rows_after"] = _dup_rows("repaired", clean_cols)
    q["dedup_after"] = "SELECT * FROM clean"
    q["dup_rows_final"] = _dup_rows("final", clean_cols)

    # cleaning
    q["drop_blank"] = "SELECT * FROM raw_sales WHERE qty IS DISTINCT FROM ''"
    q["unify_status"] = f"""SELECT order_id, CASE
        WHEN order_status ILIKE {_text(fv.RECEIVED_PATTERN)} THEN {_text(fv.RECEIVED)}
        ELSE order_status END AS order_status FROM raw_sales"""
    q["date_repair"] = f"""SELECT order_id, order_date, order_timestamp,
      {CLEAN_DATE} AS order_date_clean FROM raw_sales"""
    q["std_ship_method"] = _std("ship_method", "map_ship", "ship_method_new")
    q["std_pay_method"] = _std("pay_method", "map_pay", "pay_method_new")
    q["std_city"] = _std("city", "map_place", "city_new")
    q["std_province"] = _std("province", "map_place", "province_new")
    typed_columns = "order_id, qty, weight_gr, returned_qty, discount, product_categories, " \
        "category_count, order_status, cancel_reason, ship_method, pay_method, city, province, " \
        "ship_fee, ship_disc, payment, ship_est, order_timestamp, order_date_clean"
    q["load_typed"] = f"SELECT {typed_columns} FROM typed_sales"

    # the typed table
    q["key_uniqueness"] = """SELECT count(*) AS total_rows, count(DISTINCT order_id) AS total_keys,
      CASE WHEN count(*) = count(DISTINCT order_id) THEN 'Unique' ELSE 'Not Unique' END AS status
      FROM typed_sales"""
    q["enrich_shipping"] = """SELECT order_id, ship_method, shipping_category, shipping_carrier
      FROM typed_sales"""
    q["enrich_cancel"] = "SELECT order_id, cancel_reason, cancel_by, sub_reason FROM typed_sales"
    q["per_item_weight"] = """SELECT order_id, product_categories,
        weight_gr / 1000.0::DOUBLE / nullif(qty, 0) AS per_item_kg, weight_gr / 1000.0::DOUBLE AS weight_kg, qty
      FROM typed_sales WHERE qty < 10 AND weight_gr / 1000.0::DOUBLE / nullif(qty, 0) > 10"""
    q["fast_ship_heavy"] = """SELECT order_id, ship_method, shipping_carrier,
        round(weight_gr / 1000.0::DOUBLE, 3) AS weight_kg FROM typed_sales
      WHERE shipping_category IN ('Instant', 'Same Day')
        AND round(weight_gr / 1000.0::DOUBLE, 3) > 50"""
    q["weight_flag"] = "SELECT order_id, weight_flag FROM typed_sales"
    q["payment_flag"] = "SELECT order_id, payment_flag FROM typed_sales"
    q["payment_segment"] = "SELECT order_id, payment, payment_segment FROM typed_sales"
    q["shipping_flag"] = "SELECT order_id, shipping_flag FROM typed_sales"
    q["cod_status"] = f"""SELECT order_id, order_status, payment, pay_method,
        {COD_STATUS} AS cod_payment_status FROM typed_sales
      WHERE {COD_STATUS} IN ('COD_1', 'COD_2')"""
    q["cod_status_dist"] = f"""SELECT {COD_STATUS} AS cod_payment_status, count(*) AS total
      FROM typed_sales GROUP BY 1"""
    kept = f"(SELECT * FROM typed_sales WHERE NOT {ZERO_PAYMENT})"
    q["ntile_payment"] = _ntile(kept, "payment", "payment")
    q["ntile_ship_gap"] = _ntile(
        f"(SELECT * FROM {kept} WHERE ship_disc <= ship_est)", "abs(ship_fee - ship_est)", "selisih"
    )
    q["high_value_orders"] = "SELECT order_id, qty, payment FROM typed_sales WHERE payment > 100000"
    q["rule_returned_gt_qty"] = _rule("returned_gt_qty", "order_id, returned_qty, qty")
    q["free_but_paid"] = _rule("free_but_paid", "DISTINCT pay_method, payment")
    q["invalid_zero_payment"] = _rule(
        "invalid_zero_payment", "order_id, order_status, pay_method, payment"
    )
    q["drop_invalid_zero_payment"] = f"SELECT * FROM typed_sales WHERE NOT {ZERO_PAYMENT}"
    q["rule_discount_gt_total"] = _rule(
        "discount_gt_total", "order_id, order_status, discount, payment, ship_fee"
    )
    q["invalid_ship_disc"] = _rule("invalid_ship_disc", "order_id, ship_disc, ship_est")
    q["drop_invalid_ship_disc"] = "SELECT * FROM typed_sales WHERE ship_disc <= ship_est"
    q["rule_ship_fee_gt_est"] = _rule("ship_fee_gt_est", "order_id, ship_fee, ship_disc, ship_est")
    q["status_reason_mismatch"] = _rule(
        "status_reason_mismatch", "order_id, cancel_reason, order_status"
    )
    q["rule_return_not_done"] = _rule("return_not_done", "*")
    q["date_ts_mismatch"] = _rule("date_ts_mismatch", "order_id, order_timestamp, order_date_clean")
    q["future_dates"] = _rule("future_dates", "*")
    q["rule_incomplete_rows"] = _rule("incomplete_rows", "*")
    q["validation_report"] = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS violations FROM typed_sales WHERE {broken}"
        for name, broken in [
            *_RULES.items(),
            *[
                (f"domain_{c}", f"{c} NOT IN (SELECT {new} FROM {mapping} WHERE {new} <> '')")
                for c, mapping, new in [
                    ("ship_method", "map_ship", "ship_method_new"),
                    ("pay_method", "map_pay", "pay_method_new"),
                    ("city", "map_place", "city_new"),
                    ("province", "map_place", "province_new"),
                ]
            ],
        ]
    ) + """ UNION ALL SELECT 'category_count_mismatch', count(*) FROM typed_sales
      JOIN (SELECT order_id, count(product_category) AS n FROM order_category GROUP BY order_id) r
        USING (order_id) WHERE category_count <> n"""
    q["domain_ship_method"] = _domain("ship_method", "map_ship", "ship_method_new")
    q["domain_pay_method"] = _domain("pay_method", "map_pay", "pay_method_new")
    q["domain_city"] = _domain("city", "map_place", "city_new")
    q["domain_province"] = _domain("province", "map_place", "province_new")
    q["high_value_by_category"] = """SELECT product_category, count(*) AS total
      FROM typed_sales JOIN order_category USING (order_id) WHERE payment > 100000
      GROUP BY product_category"""
    q["category_count_mismatch"] = """SELECT order_id, category_count,
        count(product_category) AS category_count_ref
      FROM typed_sales JOIN order_category USING (order_id) GROUP BY order_id, category_count
      HAVING category_count <> count(product_category)"""

    # extracts
    second = "(qty % 2 = 1) IS NOT TRUE"
    q["append_extract"] = f"""SELECT order_id, qty, payment, coalesce(reason, 'appended') AS reason FROM (
        SELECT *, CASE WHEN extract = 2 AND order_id IN (
              SELECT order_id FROM parts WHERE extract = 1 AND n = 1 AND order_id IS NOT NULL) THEN 'known'
            WHEN n > 1 AND order_id IS NOT NULL THEN 'repeated' END AS reason
        FROM parts)"""
    parts = f"""parts AS (SELECT *, count(*) OVER (PARTITION BY extract, order_id) AS n FROM (
      SELECT 1 AS extract, * FROM typed_sales WHERE qty % 2 = 1
      UNION ALL SELECT 2, * FROM typed_sales WHERE {second} OR qty = 7))
    """
    q["append_extract"] = f"SELECT * FROM (WITH {parts} {q['append_extract']})"
    q["dedup_across_extracts"] = "SELECT * FROM unique_raw"
    q["ntile_payment_merged"] = q["ntile_payment"]
    q["value_frequencies_merged"] = q["value_frequencies"]
    q["relations_report"] = " UNION ALL ".join(
        _relation(*r) for r in [
            ("sales.order_id > order_categories.order_id", "raw_sales", "order_id", "order_category", "order_id"),
            ("sales.pay_method > pay_methods.pay_method", "raw_sales", "pay_method", "map_pay", "pay_method"),
            ("sales.ship_method > ship_methods.ship_method", "raw_sales", "ship_method", "map_ship", "ship_method"),
            ("sales.cancel_reason > cancel_reasons.cancel_reason", "raw_sales", "cancel_reason", "map_cancel", "cancel_reason"),
            ("sales.province > places.province", "raw_sales", "province", "map_place", "province"),
            ("sales.city > places.city", "raw_sales", "city", "map_place", "city"),
            ("fact.pay_method > dim_payments.pay_method", "fact", "pay_method", "map_pay", "pay_method_new"),
            ("fact.order_id > dim_order_category.order_id", "fact", "order_id",
             "(SELECT * FROM order_category WHERE order_id IN (SELECT order_id FROM fact))", "order_id"),
        ]
    )

    # audit log
    for key, entry in {
        "audit_duplicates": "duplicates",
        "audit_blank_qty": "blank_qty",
        "audit_blank_pay": "blank_pay",
        "audit_invalid_date": "invalid_date",
        "audit_status": "status",
        "audit_duplicates_clean": "duplicates_clean",
        "audit_zero_payment": "zero_payment",
        "audit_ship_disc": "ship_disc",
        "audit_weight_flag": "weight_flag",
        "audit_payment_flag": "payment_flag",
        "audit_shipping_flag": "shipping_flag",
    }.items():
        q[key] = _AUDITS[entry]
    q["audit_std_all"] = " UNION ALL ".join(
        _AUDITS[e] for e in ("ship_method", "pay_method", "province", "city")
    )
    q["audit_append_unique"] = _numbered(["blank_qty", "invalid_date", "blank_pay"])
    q["audit_mirror"] = _numbered(["weight_flag", "ship_disc"])
    q["audit_mirror_stream"] = _AUDITS["payment_flag"]
    q["audit_summary"] = (
        "SELECT solution, attribute, count(DISTINCT order_id) AS orders, count(*) AS entries FROM ("
        + " UNION ALL ".join(f"({a})" for a in _AUDITS.values())
        + ") GROUP BY solution, attribute"
    )

    # star schema
    q["fact_sales"] = "SELECT * FROM fact"
    q["dim_order_category"] = """SELECT order_id, product_category FROM order_category
      WHERE order_id IN (SELECT order_id FROM fact)"""
    q["dim_payments"] = """SELECT pay_method_new AS pay_method, payment_category,
      (SELECT count(*) FROM fact WHERE fact.pay_method = pay_method_new) AS orders FROM map_pay"""
    q["dim_payments_unique"] = q["dim_payments"].replace("SELECT pay", "SELECT DISTINCT pay", 1)
    q["star_rollup"] = """SELECT payment_category, product_category, count(*) AS orders,
        CAST(sum(payment) AS BIGINT) AS payment_total
      FROM fact JOIN order_category USING (order_id)
      JOIN (SELECT DISTINCT pay_method_new AS pay_method, payment_category FROM map_pay)
        USING (pay_method) GROUP BY 1, 2"""
    q["star_rollup_sliced"] = """SELECT month_order_date, payment_category, product_category,
        count(*) AS orders, CAST(sum(payment) AS BIGINT) AS payment_total
      FROM fact JOIN order_category USING (order_id)
      JOIN (SELECT DISTINCT pay_method_new AS pay_method, payment_category FROM map_pay)
        USING (pay_method)
      WHERE month_order_date BETWEEN '1997-01' AND '1997-06' GROUP BY 1, 2, 3"""
    stages = [
        ("raw", "raw_sales"), ("duplicates", f"({_AUDITS['duplicates']})"), ("without_duplicates", "unique_raw"), ("with_qty", "with_qty"),
        ("with_pay_method", "with_pay"), ("repaired", "repaired"),
        ("duplicates_clean", f"({_AUDITS['duplicates_clean']})"), ("clean", "clean"),
        ("flagged", "flagged"), ("with_valid_payment", "valid_payment"), ("final", "final"),
        ("fact", "fact"),
        ("dim_order_category", "order_category WHERE order_id IN (SELECT order_id FROM fact)"),
        ("dim_payments", "map_pay"),
        ("audit_log", "(" + " UNION ALL ".join(f"({a})" for a in _AUDITS.values()) + ")"),
    ]
    q["prepare_summary"] = " UNION ALL ".join(
        f"SELECT '{name}' AS stage, count(*) AS rows FROM {source}" for name, source in stages
    )

    out = {name: _sql(body) for name, body in q.items()}

    # the typed table as loaded without cleaning
    loaded = "WITH " + ",\n".join([*_INPUTS, _LOADED]) + "\n"
    broken = _broken_constraints()
    out["constraint_violations"] = loaded + broken
    out["constraint_enforce"] = loaded + f"""SELECT * FROM loaded WHERE order_id IS NOT NULL
      AND order_id NOT IN (SELECT order_id FROM ({broken}) WHERE order_id IS NOT NULL)"""
    out["constraint_quarantine"] = loaded + f"""SELECT order_id,
      CASE WHEN order_id IS NULL OR order_id IN (SELECT order_id FROM ({broken})) THEN 'rejected'
           ELSE 'accepted' END AS side FROM loaded"""
    return out
