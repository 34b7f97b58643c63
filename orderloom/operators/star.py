"""The star schema: one fact table, two dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import is_blank

# fixed values: columns of the fact table in order; a pair renames
FACT_COLUMNS = [
    "order_id",
    ("order_date_clean", "order_date"),
    "order_timestamp",
    "year_order_date",
    "month_order_date",
    "time_order_date",
    "category_count",
    "qty",
    "returned_qty",
    "weight_gr",
    "order_status",
    "cancel_by",
    "sub_reason",
    "discount",
    "payment",
    "pay_method",
    "payment_segment",
    "ship_method",
    "ship_fee",
    "ship_disc",
    "ship_est",
    "shipping_category",
    "shipping_carrier",
    "net_shipping",
    "city",
    "province",
    ("weight_flag", "flag_weight"),
    ("payment_flag", "flag_payment"),
    ("shipping_flag", "flag_shipping"),
]


def fact_sales(df: DataFrame) -> DataFrame:
    """Analysis-ready orders; net shipping may be negative."""
    minute = F.date_format("order_timestamp", "HH:mm")
    derived = df.withColumns(
        {
            "year_order_date": F.date_format("order_date_clean", "yyyy"),
            "month_order_date": F.date_format("order_date_clean", "yyyy-MM"),
            "time_order_date": F.concat(minute, F.lit(":00")),
            "net_shipping": F.col("ship_fee") - F.col("ship_disc"),
        }
    )
    pairs = [c if isinstance(c, tuple) else (c, c) for c in FACT_COLUMNS]
    return derived.select(*[F.col(old).alias(new) for old, new in pairs])


def dim_order_category(categories: DataFrame, fact: DataFrame) -> DataFrame:
    """Categories of the orders in the fact table, one row per order and category."""
    return categories.select("order_id", "product_category").join(
        fact.select("order_id"), "order_id", "left_semi"
    )


def dim_payments(mapping: DataFrame) -> DataFrame:
    """Canonical payment methods, one row per row of the mapping (repeats stay)."""
    return mapping.select(F.col("pay_method_new").alias("pay_method"), "payment_category")


def dim_payments_unique(mapping: DataFrame) -> DataFrame:
    """Canonical payment methods, each once, fit to be joined with the fact."""
    methods = dim_payments(mapping)
    return methods.where(F.col("pay_method").isNotNull() & ~is_blank("pay_method")).distinct()


def star_rollup(fact: DataFrame, categories: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders and payments per payment category and product category.

    The categories are reduced per order before the join, so repeated child
    rows neither fan out nor pile up in one task.
    """
    members = categories.groupBy("order_id", "product_category").agg(
        F.count(F.lit(1)).alias("__members")
    )
    return (
        fact.select("order_id", "pay_method", "payment")
        .join(payments, "pay_method")
        .join(members, "order_id")
        .groupBy("payment_category", "product_category")
        .agg(
            F.sum("__members").alias("orders"),
            F.sum(F.col("payment") * F.col("__members")).alias("payment_total"),
        )
        .orderBy("payment_category", "product_category")
    )


SLICE = "month_order_date"


def calendar(fact: DataFrame) -> DataFrame:
    """The months of the fact table with their year, quarter and half-year.

    Of a fact table that is published by month only the folders are listed.
    """
    month = F.substring(SLICE, 6, 2).cast("int")
    return (
        fact.select(SLICE)
        .where(F.col(SLICE).isNotNull())
        .distinct()
        .select(
            SLICE,
            F.substring(SLICE, 1, 4).alias("year"),
            F.ceil(month / 3).cast("int").alias("quarter"),
            F.ceil(month / 6).cast("int").alias("half"),
        )
    )


def sliced_rollup(
    fact: DataFrame, categories: DataFrame, payments: DataFrame, months: DataFrame, where: Column
) -> DataFrame:
    """:func:`star_rollup` per month, of the months of a calendar that meet ``where``.

    With a fact table that is published by month (``publish(…,
    partition_by=[SLICE])``) Spark reads the chosen months' folders only, by
    dynamic partition pruning. The rows of an order's categories are counted for
    the orders of those months alone.
    """
    chosen = months.where(where).select(SLICE)
    sliced = fact.select(SLICE, "order_id", "pay_method", "payment").join(chosen, SLICE)
    per_order = sliced.groupBy(SLICE, "order_id", "pay_method").agg(
        F.count(F.lit(1)).alias("__orders"), F.sum("payment").alias("__payment")
    )
    members = categories.groupBy("order_id", "product_category").agg(F.count(F.lit(1)).alias("__members"))
    return (
        per_order.join(payments, "pay_method")
        .join(members, "order_id")
        .groupBy(SLICE, "payment_category", "product_category")
        .agg(
            F.sum(F.col("__orders") * F.col("__members")).alias("orders"),
            F.sum(F.col("__payment") * F.col("__members")).alias("payment_total"),
        )
        .orderBy(SLICE, "payment_category", "product_category")
    )
