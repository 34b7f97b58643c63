"""Business rules on the typed table.

A rule is a condition that marks a violation plus the columns its report shows.
Row rules of any number are counted together in one scan by :func:`validate`.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import any_of, is_true, like_ignoring_case, local_now, rounded
from ..plans import fixed_values as fv
from ..plans.fixed_values import Terms
from .flags import cod_status
from .standardize import domain_members, drop_where, not_in_domain

col = F.col


@dataclass(frozen=True)
class RowRule:
    """``broken`` is built when used, so a rule needs no session to be declared."""

    name: str
    broken: Callable[[], Column]
    shows: tuple[str, ...]


def _per_piece_kg() -> Column:
    return F.try_divide(col("weight_gr") / F.lit(1000.0), col("qty").cast("double"))


def _weight_kg() -> Column:
    return rounded(col("weight_gr") / F.lit(1000.0), 3)


def row_rules(terms: Terms = fv.TERMS) -> dict[str, RowRule]:
    """The rules on single rows by name, in the order of the report."""

    def zero_payment() -> Column:
        excused = (col("order_status") == terms.cancelled) | (col("pay_method") == terms.free_payment)
        return (col("payment") == 0) & ~is_true(excused)

    def above_estimate(what: str) -> Column:
        return ~is_true(col(what) <= col("ship_est"))

    def reason_mismatch() -> Column:
        cancelled = col("order_status") == terms.cancelled
        return ((col("cancel_reason") == terms.not_cancelled_reason) & cancelled) | (
            (col("order_status") != terms.cancelled)
            & like_ignoring_case("cancel_reason", terms.cancelled_reason_pattern)
        )

    rules = [
        RowRule(
            "returned_gt_qty",
            lambda: col("returned_qty") > col("qty"),
            ("order_id", "returned_qty", "qty"),
        ),
        RowRule(
            "free_but_paid",
            lambda: (col("pay_method") == terms.free_payment) & (col("payment") > 0),
            ("pay_method", "payment"),
        ),
        RowRule(
            "invalid_zero_payment",
            zero_payment,
            ("order_id", "order_status", "pay_method", "payment"),
        ),
        RowRule(
            "discount_gt_total",
            lambda: (col("discount") > col("payment") + col("ship_fee"))
            & (col("order_status") != terms.cancelled),
            ("order_id", "order_status", "discount", "payment", "ship_fee"),
        ),
        RowRule(
            "invalid_ship_disc",
            lambda: above_estimate("ship_disc"),
            ("order_id", "ship_disc", "ship_est"),
        ),
        RowRule(
            "ship_fee_gt_est",
            lambda: above_estimate("ship_fee"),
            ("order_id", "ship_fee", "ship_disc", "ship_est"),
        ),
        RowRule(
            "status_reason_mismatch",
            reason_mismatch,
            ("order_id", "cancel_reason", "order_status"),
        ),
        RowRule(
            "return_not_done",
            lambda: (col("returned_qty") > 0) & (col("order_status") != terms.done),
            ("order_id", "returned_qty", "order_status"),
        ),
        RowRule(
            "date_ts_mismatch",
            lambda: col("order_timestamp").cast("date") != col("order_date_clean"),
            ("order_id", "order_timestamp", "order_date_clean"),
        ),
        RowRule(
            "per_item_weight",
            lambda: (col("qty") < terms.bulk_pieces) & (_per_piece_kg() > terms.heavy_item_gr / 1000),
            ("order_id", "product_categories", "weight_gr", "qty"),
        ),
        RowRule(
            "fast_ship_heavy",
            lambda: col("shipping_category").isin(terms.instant, terms.same_day)
            & (_weight_kg() > terms.heavy_fast_gr / 1000),
            ("order_id", "ship_method", "shipping_carrier", "weight_gr"),
        ),
        RowRule(
            "cod_problem",
            lambda: cod_status(terms).isin(*terms.cod_problems),
            ("order_id", "order_status", "payment", "pay_method"),
        ),
    ]
    return {rule.name: rule for rule in rules}


ROW_RULES = row_rules()


def violations(df: DataFrame, rule: str | RowRule, all_columns: bool = False) -> DataFrame:
    """The rows that break a rule."""
    rule = ROW_RULES[rule] if isinstance(rule, str) else rule
    found = df.where(rule.broken())
    return found if all_columns else found.select(*rule.shows)


def drop_violations(df: DataFrame, rule: str | RowRule) -> DataFrame:
    """The rows that keep a rule (or whose case is unknown)."""
    rule = ROW_RULES[rule] if isinstance(rule, str) else rule
    return drop_where(df, rule.broken())


def incomplete(df: DataFrame, cols: list[str]) -> Column:
    """NULL in any of the columns, or a blank in a text column."""
    tests = []
    for name in cols:
        tests.append(col(name).isNull())
        if isinstance(df.schema[name].dataType, StringType):
            tests.append(is_true(col(name) == ""))
    return any_of(tests)


def future(as_of: Column | None = None) -> Column:
    """Dates from today on, or timestamps from the local midnight on.

    ``as_of`` is the UTC wall clock; by default the current one. The local day
    is that of a zone seven hours ahead.
    """
    if as_of is None:
        utc, local = local_now("UTC"), local_now(fv.LOCAL_ZONE)
    else:
        utc = as_of.cast("timestamp_ntz")
        local = utc + F.expr("INTERVAL 7 HOURS")
    midnight = local.cast("date").cast("timestamp_ntz")
    return is_true(col("order_date_clean") >= utc.cast("date")) | is_true(
        col("order_timestamp") >= midnight
    )


# --- profiles ---------------------------------------------------------------


def per_item_weight(df: DataFrame, terms: Terms = fv.TERMS) -> DataFrame:
    """Orders of few pieces whose pieces weigh more than 10 kg each."""
    return (
        violations(df, row_rules(terms)["per_item_weight"])
        .select(
            "order_id",
            "product_categories",
            _per_piece_kg().alias("per_item_kg"),
            (col("weight_gr") / F.lit(1000.0)).alias("weight_kg"),
            "qty",
        )
        .orderBy("product_categories", "per_item_kg")
    )


def fast_ship_heavy(df: DataFrame, terms: Terms = fv.TERMS) -> DataFrame:
    """Instant and same-day parcels above 50 kg, on the rounded weight."""
    return violations(df, row_rules(terms)["fast_ship_heavy"]).select(
        "order_id", "ship_method", "shipping_carrier", _weight_kg().alias("weight_kg")
    )


def high_value_orders(df: DataFrame, terms: Terms = fv.TERMS) -> DataFrame:
    return (
        df.where(col("payment") > terms.high_value)
        .select("order_id", "qty", "payment")
        .orderBy(col("payment").desc())
    )


def high_value_by_category(df: DataFrame, categories: DataFrame, terms: Terms = fv.TERMS) -> DataFrame:
    """High-value orders per category.

    Both sides are reduced to counts per order before they meet, so that no
    order can fill a task however often it is repeated.
    """
    orders = (
        df.where(col("payment") > terms.high_value)
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("__orders"))
    )
    members = categories.groupBy("order_id", "product_category").agg(
        F.count(F.lit(1)).alias("__members")
    )
    return (
        orders.join(members, "order_id")
        .groupBy("product_category")
        .agg(F.sum(col("__orders") * col("__members")).alias("total"))
        .orderBy(col("total").desc(), "product_category")
    )


def _reference_counts(categories: DataFrame) -> DataFrame:
    return categories.groupBy("order_id").agg(F.count("product_category").alias("category_count_ref"))


def category_count_mismatch(df: DataFrame, categories: DataFrame) -> DataFrame:
    """Orders whose stored category count differs from their rows in the child table."""
    return (
        df.select("order_id", "category_count")
        .join(_reference_counts(categories), "order_id")
        .where(col("category_count") != col("category_count_ref"))
    )


# --- the fused report -------------------------------------------------------


def validate(
    df: DataFrame,
    rules: list[RowRule] | None = None,
    complete: list[str] | None = None,
    as_of: Column | None = None,
    domains: dict[str, tuple[DataFrame, str]] | None = None,
    categories: DataFrame | None = None,
) -> DataFrame:
    """(rule, violations) of all row rules from a single scan of ``df``.

    ``domains`` adds domain checks, ``{column: (domain table, its column)}``,
    and ``categories`` the check of the stored category counts; members and
    counts are looked up in the same pass.
    """
    broken = {r.name: r.broken() for r in (rules or list(ROW_RULES.values()))}
    broken["future_dates"] = future(as_of)
    broken["incomplete_rows"] = incomplete(df, complete or df.columns)
    for name, (domain, domain_col) in (domains or {}).items():
        member, found = f"__{name}_member", f"__{name}_found"
        members = domain_members(domain, domain_col, member).withColumn(found, F.lit(True))
        df = df.join(members, col(name) == col(member), "left")
        broken[f"domain_{name}"] = col(name).isNotNull() & col(found).isNull()
    if categories is not None:
        df = df.join(_reference_counts(categories), "order_id", "left")
        broken["category_count_mismatch"] = col("category_count") != col("category_count_ref")
    counts = df.agg(*[F.count_if(is_true(c)).alias(name) for name, c in broken.items()])
    return counts.unpivot([], list(broken), "rule", "violations")


def domain_violations(
    df: DataFrame, col_name: str, domain: DataFrame, domain_col: str, key: str = fv.KEY
) -> DataFrame:
    return not_in_domain(df.select(key, col_name), col_name, domain, domain_col)
