"""Row-local quality flags and segments; one projection, no joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import like_ignoring_case, ratio
from ..plans import fixed_values as fv
from ..plans.fixed_values import Terms

col = F.col


def _first_match(conditions: list[Column], labels: tuple[str, ...], default: str) -> Column:
    pairs = list(zip(conditions, labels, strict=True))
    out = F.when(pairs[0][0], F.lit(pairs[0][1]))
    for condition, label in pairs[1:]:
        out = out.when(condition, F.lit(label))
    return out.otherwise(F.lit(default))


def weight_flag(terms: Terms = fv.TERMS) -> Column:
    """Parcels too heavy per piece, or too heavy for their shipping category."""
    per_piece = ratio("weight_gr", "qty")
    few = col("qty") < terms.bulk_pieces
    fast = col("shipping_category").isin(terms.instant, terms.same_day)
    instant = col("shipping_category") == terms.instant
    return _first_match(
        [
            few & (per_piece > terms.too_heavy_item_gr),
            instant & (col("weight_gr") > terms.too_heavy_instant_gr),
            few & (per_piece > terms.heavy_item_gr),
            fast & (col("weight_gr") > terms.heavy_fast_gr),
        ],
        terms.weight_labels,
        terms.normal,
    )


def payment_flag(terms: Terms = fv.TERMS) -> Column:
    """Kinds of payments above the high-value line (the line itself is normal)."""
    high = col("payment") > terms.high_value
    heavy = like_ignoring_case("product_categories", terms.heavy_category_pattern)
    return _first_match(
        [
            high & (col("qty") <= terms.few_pieces) & ~heavy,
            high & heavy,
            high & (col("qty") >= terms.bulk_pieces),
            high,
        ],
        terms.payment_labels,
        terms.normal,
    )


def payment_segment(terms: Terms = fv.TERMS) -> Column:
    """High, mid and low value (the line itself is high)."""
    *labels, low = terms.segment_labels
    lines = [col("payment") >= terms.high_value, col("payment") >= terms.mid_value]
    return _first_match(lines, tuple(labels), low)


def shipping_gap() -> Column:
    return F.abs(col("ship_fee") - col("ship_est"))


def shipping_flag(terms: Terms = fv.TERMS) -> Column:
    """Shipping fees far from the estimate; an estimate of 0 has no share."""
    far = shipping_gap() > terms.gap_outlier
    share = ratio(shipping_gap(), "ship_est") > terms.gap_outlier_share
    unexplained = F.abs(col("ship_est") - col("ship_disc") - col("ship_fee"))
    return _first_match([far & share, unexplained > terms.gap_suspicious], terms.shipping_labels, terms.normal)


def cod_status(terms: Terms = fv.TERMS) -> Column:
    """Cash-on-delivery orders by status and payment; the first two are problems."""
    cod = col("pay_method") == terms.cash_on_delivery
    unpaid, paid = col("payment") == 0, col("payment") > 0
    arrived = col("order_status").isin(terms.done, terms.received)
    moving = col("order_status").isin(terms.in_transit, terms.sent)
    cancelled = col("order_status") == terms.cancelled
    return _first_match(
        [
            cod & unpaid & arrived, cod & paid & cancelled, cod & paid & arrived,
            cod & unpaid & moving, cod & paid & moving, cod & unpaid & cancelled, cod,
        ],
        terms.cod_labels,
        terms.non_cod,
    )


def add_flags(df: DataFrame, terms: Terms = fv.TERMS) -> DataFrame:
    """All four derived flags; needs ``shipping_category``."""
    return df.withColumns(
        {
            "weight_flag": weight_flag(terms),
            "payment_flag": payment_flag(terms),
            "payment_segment": payment_segment(terms),
            "shipping_flag": shipping_flag(terms),
        }
    )
