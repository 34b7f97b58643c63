"""Inputs of the registered queries, derived from the given tables by Spark.

``raw_sales`` is an all-text order table with planted defects, one row per
order with line items; the other tables are the mappings that go with it. The
derived tables are written once per session and data folder as stage tables;
the queries scan those, as they would scan a landing table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators.flags import add_flags
from orderloom.operators.standardize import date_repair, drop_blank, standardize, unify_value
from orderloom.operators.typed import load_typed
from orderloom.plans import fixed_values as fv
from orderloom.operators import audit
from orderloom.plans.prepare import (
    Inputs, Stages, add_categories, all_audit_entries, build_stages, standardize_places,
)
from orderloom.plans.stage_store import new_stage_path, write_stage

# Order ids: a digit that tells the order itself (0) from its planted copies, then
# the key in the width of the longest 64-bit number. No key is cut, no copy meets
# an order.
KEY_DIGITS = 19
COPY_AS_IS, COPY_OTHER_DATE = 5, 6
ID_LENGTH = len("ORD_") + 1 + KEY_DIGITS
ID_PATTERN = rf"^ORD_\d{{{1 + KEY_DIGITS}}}$"

# Planted defects, by the remainder 0 of the order key: (divisor, column, text).
# The first that fits wins; None is NULL.
PLANTED = [
    (331, "product_categories", ""), (523, "product_categories", None),
    (337, "order_timestamp", "2024-02-30 10:00"), (347, "order_timestamp", ""),
    (349, "order_date", "2020-02-29"),
    (353, "cancel_reason", fv.NOT_CANCELLED_REASON),
    (563, "cancel_reason", "Dibatalkan / shelf was empty"),
    (433, "cancel_reason", None),
    (431, "order_status", None),
    (509, "ship_method", None),
    (359, "pay_method", "Barter"), (521, "pay_method", None),
    (367, "city", "KAB. NOWHERE"), (439, "city", None),
    (373, "province", "NOWHERE"), (443, "province", None),
    (449, "qty", "0"),
    (397, "weight_gr", ""), (457, "weight_gr", "0"),
    (401, "returned_qty", ""), (463, "returned_qty", "-1"),
    (409, "discount", ""), (467, "discount", "-500"),
    (421, "category_count", ""), (461, "category_count", "0"),
    (419, "ship_fee", ""), (479, "ship_fee", "-1000"),
    (389, "ship_disc", ""), (487, "ship_disc", "-1000"),
    (379, "payment", ""), (491, "payment", "-1000"),
    (383, "ship_est", ""), (503, "ship_est", "-1000"),
]
# Planted ids, for orders without copies: too short, wrong start, NULL, and one
# id that many orders share.
SHORT_ID, WRONG_ID, NULL_ID, SHARED_ID = 307, 311, 313, 317
SHARED = "ORD_9" + "0" * KEY_DIGITS

PROMO_LABEL = "Seal / Baut / Roof"

STATUS = {"F": fv.DONE, "O": fv.CANCELLED}
STATUS_LONG = "Pesanan diterima, namun Pembeli masih dapat mengajukan pengembalian"
REASON_NONE = "none given"
REASONS = ["Dibatalkan / buyer changed plans", "Dibatalkan / shelf was empty", "Dibatalkan / no transfer in time"]
# raw name -> canonical name, carrier and category; the categories are those that rules compare
MAP_SHIP_COLUMNS = ["ship_method", "ship_method_new", "shipping_carrier", "shipping_category"]
MAP_SHIP = [
    ("river barge", "Barge", "Delta Line", "Freight"),
    ("barge, shared hold", "Barge Shared", "Delta Line", "Freight"),
    ("pedal courier v1", "Pedal Courier", "Swift Wheels", fv.INSTANT),
    ("Pedal courier", "Pedal Courier", "Swift Wheels", fv.INSTANT),
    ("noon tram", "Noon Tram", "City Rails", fv.SAME_DAY),
    ("tram/noon", "Noon Tram", "City Rails", fv.SAME_DAY),
    ("post bag B", "Post Bag", "Valley Post", "Letter"),
    ("night owl", "Night Owl", "Owl Freight", "Overnight"),
    ("drone", "Drone", "Unknown", fv.INSTANT),
    ("tram evening", "Evening Tram", "City Rails", fv.SAME_DAY),
]
# what orders name; the last one is in no mapping
SHIP_METHODS = [
    "river barge", "barge, shared hold", "pedal courier v1", "tram/noon", "post bag B", "night owl",
    "drone", "tram evening", " own pick-up ",
]
MAP_PAY_COLUMNS = ["pay_method", "pay_method_new", "payment_category"]
MAP_PAY = [
    (fv.CASH_ON_DELIVERY, fv.CASH_ON_DELIVERY, "At the door"),
    ("pay driver", fv.CASH_ON_DELIVERY, "At the door"),
    ("purse balance", "Purse", "Stored value"),
    ("PURSE BALANCE", "Purse", "Stored value"),
    ("waived", fv.FREE_PAYMENT, "Gratis"),
    ("card portal", "Card", "Bank"),
    ("by month", "Monthly Bill", "Credit"),
]
PAY_METHODS = ["pay driver", "purse balance", "by month", "waived", "card portal"]
MAP_CANCEL_COLUMNS = ["cancel_id", "cancel_by", "reason", "cancel_reason"]
MAP_CANCEL = [
    ("R1", "buyer", "changed plans", REASONS[0]),
    ("R2", "shop", "shelf was empty", REASONS[1]),
    ("R3", "clock", "no transfer in time", REASONS[2]),
    ("R4", "nobody", "none", REASON_NONE),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(number: Column, choices: list[str]) -> Column:
    """The choice at index ``number % len(choices)``."""
    return F.element_at(
        F.array(*[F.lit(c) for c in choices]), (number % len(choices)).cast("int") + 1
    )


def order_id(key: Column, copy: Column) -> Column:
    number = F.lpad(key.cast("string"), KEY_DIGITS, "0")
    return F.concat(F.lit("ORD_"), copy.cast("string"), number)


def _labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items reduced to (order, part), with the part's size and label."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_partkey")
        .agg(
            F.sum("l_quantity").alias("pieces"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    label = F.when(F.col("p_type") == "PROMO", F.lit(PROMO_LABEL)).otherwise(F.col("p_type"))
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_type", label.alias("label"))
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def derive_raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_order = (
        _labelled_lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(
            F.sum(F.col("pieces") * F.col("p_size")).alias("weight"),
            F.sum("returned").alias("returned"),
            # at most one entry per type of part
            F.sort_array(F.collect_set(F.struct("p_type", "label"))).alias("types"),
        )
    )
    places = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )
    orders = (
        table(spark, sf_dir, "orders")
        .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("k", F.col("o_orderkey"))
        .withColumn("d", F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    # the order itself and its planted copies
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when(F.col("k") % 499 == 0, F.lit(COPY_AS_IS)),
            F.when(F.col("k") % 1497 == 0, F.lit(COPY_OTHER_DATE)),
        )
    )
    rows = orders.withColumn("shift", F.explode(copies))
    k, d = F.col("k"), F.col("d")

    def multiple(n: int) -> Column:
        return k % n == 0

    day_first = F.date_format("o_orderdate", "dd/MM/yyyy")
    written_date = (
        F.when(multiple(89), F.lit(""))
        .when(multiple(83), F.lit("2024-13-40"))
        .when(multiple(7), F.when(F.col("shift") == COPY_OTHER_DATE, d).otherwise(day_first))
        .otherwise(d)
    )
    pieces = (k % 20 + 1).cast("string")
    cancelled = F.col("o_orderstatus") == "O"
    status = F.when(F.col("o_orderstatus") == "F", F.lit(STATUS["F"])).when(
        cancelled, F.lit(STATUS["O"])
    )
    alone = ~multiple(499) & ~multiple(67)
    key = (
        F.when(alone & multiple(SHORT_ID), F.concat(F.lit("ORD_"), k.cast("string")))
        .when(alone & multiple(WRONG_ID), F.concat(F.lit("XRD-0"), F.lpad(k.cast("string"), KEY_DIGITS, "0")))
        .when(alone & multiple(NULL_ID), F.lit(None))
        .when(alone & multiple(SHARED_ID), F.lit(SHARED))
        .otherwise(order_id(k, F.col("shift")))
    )
    columns = {
        "order_id": key,
        "qty": F.when(multiple(67), F.lit("")).when(
            multiple(2), F.concat(pieces, F.lit(".0"))
        ).otherwise(pieces),
        "weight_gr": (F.col("weight") * 20).cast("bigint"),
        "returned_qty": F.col("returned"),
        "discount": k % 11 * 500,
        "product_categories": F.array_join("types.label", ", "),
        "category_count": F.size("types") + F.when(multiple(211), 1).otherwise(0),
        "order_status": status.when(multiple(3), F.lit(fv.IN_TRANSIT)).otherwise(
            F.lit(STATUS_LONG)
        ),
        "cancel_reason": F.when(cancelled, _pick(k, REASONS)).otherwise(F.lit(REASON_NONE)),
        "ship_method": _pick(k, SHIP_METHODS),
        "pay_method": F.when(multiple(97), F.lit("")).otherwise(_pick(k, PAY_METHODS)),
        "city": F.concat(F.lit("KAB. "), F.col("n_name")),
        "province": F.col("r_name"),
        "ship_fee": k % 13 * 3000,
        "ship_disc": k % 37 * 1000,
        "payment": F.when(multiple(41), F.lit(0)).otherwise(
            F.floor(F.col("o_totalprice") / 2500) * 1000
        ),
        "ship_est": k % 41 * 1000,
        "order_timestamp": F.concat(
            d, F.lit(" "), F.lpad((k % 24).cast("string"), 2, "0"),
            F.lit(":"), F.lpad((k % 60).cast("string"), 2, "0"),
        ),
        "order_date": written_date,
    }

    def planted(name: str, text: Column) -> Column:
        for divisor, column, value in reversed(PLANTED):
            if column == name:
                text = F.when(multiple(divisor), F.lit(value)).otherwise(text)
        return text.alias(name)

    return rows.select(*[planted(n, c.cast("string")) for n, c in columns.items()])


def derive_order_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order, category) of the original orders, each pair once."""
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(
        table(spark, sf_dir, "customer").select("c_custkey"),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    pairs = _labelled_lines(spark, sf_dir).select("l_orderkey", "label").distinct()
    return pairs.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(
        order_id(F.col("l_orderkey"), F.lit(0)).alias("order_id"),
        F.col("label").alias("product_category"),
    )


def derive_map_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lists side by side: cities in every row, provinces in the first few."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(
        region, F.col("n_nationkey") == F.col("r_regionkey"), "left"
    ).select(
        F.coalesce("r_name", F.lit("")).alias("province"),
        F.coalesce(F.concat(F.lit("Prov "), F.col("r_name")), F.lit("")).alias("province_new"),
        F.concat(F.lit("KAB. "), F.col("n_name")).alias("city"),
        F.col("n_name").alias("city_new"),
    )


_STAGES: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, label: str, build):
    slot = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), label)
    if slot not in _STAGES:
        _STAGES[slot] = build()
    return _STAGES[slot]


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "raw_sales",
                 lambda: write_stage(derive_raw_sales(spark, sf_dir), "raw_sales"))


def order_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "order_category",
                 lambda: write_stage(derive_order_category(spark, sf_dir), "order_category"))


def _mapping(spark: SparkSession, name: str, rows: list, columns: list[str]) -> DataFrame:
    # stored like every mapping, so that the planner knows its size
    return _once(spark, "", name,
                 lambda: write_stage(spark.createDataFrame(rows, columns), name))


def map_ship(spark: SparkSession) -> DataFrame:
    return _mapping(spark, "map_ship", MAP_SHIP, MAP_SHIP_COLUMNS)


def map_pay(spark: SparkSession) -> DataFrame:
    return _mapping(spark, "map_pay", MAP_PAY, MAP_PAY_COLUMNS)


def map_cancel(spark: SparkSession) -> DataFrame:
    return _mapping(spark, "map_cancel", MAP_CANCEL, MAP_CANCEL_COLUMNS)


def map_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "map_place",
                 lambda: write_stage(derive_map_place(spark, sf_dir), "map_place"))


def derive_cleaned_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_sales`` with blanks dropped, categories mapped and dates repaired,
    but with its duplicates."""
    df = drop_blank(drop_blank(raw_sales(spark, sf_dir), "qty"), "pay_method")
    df = unify_value(df, "order_status", fv.RECEIVED_PATTERN, fv.RECEIVED)
    df = standardize(df, "ship_method", map_ship(spark), "ship_method", "ship_method_new")
    df = standardize(df, "pay_method", map_pay(spark), "pay_method", "pay_method_new")
    df = standardize_places(df, map_place(spark, sf_dir))
    return date_repair(df, "order_date", "order_timestamp")


def derive_typed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = load_typed(derive_cleaned_sales(spark, sf_dir))
    return add_flags(add_categories(typed, map_ship(spark), map_cancel(spark)))


def typed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "typed_sales",
                 lambda: write_stage(derive_typed_sales(spark, sf_dir), "typed_sales"))


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        sales=raw_sales(spark, sf_dir),
        ship_methods=map_ship(spark),
        pay_methods=map_pay(spark),
        cancel_reasons=map_cancel(spark),
        places=map_place(spark, sf_dir),
        order_categories=order_category(spark, sf_dir),
    )


def stages(spark: SparkSession, sf_dir: str) -> Stages:
    return _once(spark, sf_dir, "stages", lambda: build_stages(inputs(spark, sf_dir)))


def audit_log(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The paths of a log and its mirror, appended in two batches that overlap."""

    def build() -> tuple[str, str]:
        entries = all_audit_entries(stages(spark, sf_dir))
        paths = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
        some = F.coalesce(F.col(fv.KEY).endswith("1") | F.col(fv.KEY).endswith("2"), F.lit(False))
        audit.append_audit(entries.where(some), *paths, order_by=["step", fv.KEY])
        # an entry without a key repeats nothing, all others of the first batch are known
        audit.append_audit(entries, *paths, order_by=["step", fv.KEY])
        return paths

    return _once(spark, sf_dir, "audit_log", build)
