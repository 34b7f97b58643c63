"""Cleaning of text columns: blanks, unified values, lookups, dates.

Lookups are left joins with a de-duplicated mapping table. No join hint is
given: Spark broadcasts the mapping while its size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot
values by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    day_first_to_iso,
    is_blank,
    is_true,
    like_ignoring_case,
    read_date,
)
from ..sources.landing import one_row_per_key

_KEY = "__lookup_key"
_FOUND = "__lookup_found"


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE WHERE: an unknown condition keeps the row."""
    return df.where(~is_true(condition))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Delete rows whose text is ``''``; NULL rows stay."""
    return df.where(~is_blank(col))


def unify_value(df: DataFrame, col: str, pattern: str, value: str) -> DataFrame:
    """Replace every text that matches the LIKE pattern by ``value``."""
    hit = like_ignoring_case(col, pattern)
    return df.withColumn(col, F.when(hit, F.lit(value)).otherwise(F.col(col)))


def standardize(
    df: DataFrame, col: str, mapping: DataFrame, key: str, value: str
) -> DataFrame:
    """Replace values found in the mapping; keep the others as they are.

    A key that maps to NULL or to a blank is replaced by just that.
    """
    lookup = one_row_per_key(mapping, key, [value]).select(
        F.col(key).alias(_KEY), F.col(value).alias("__lookup_value"), F.lit(True).alias(_FOUND)
    )
    replaced = F.when(F.col(_FOUND), F.col("__lookup_value")).otherwise(F.col(col))
    return (
        df.join(lookup, F.col(col) == F.col(_KEY), "left")
        .withColumn(col, replaced)
        .drop(_KEY, "__lookup_value", _FOUND)
    )


def enrich(
    df: DataFrame, col: str, mapping: DataFrame, key: str, values: dict[str, str]
) -> DataFrame:
    """Add mapped columns, ``{mapping column: new column}``; NULL when not found.

    All columns of one mapping come in by one join.
    """
    lookup = one_row_per_key(mapping, key, list(values)).select(
        F.col(key).alias(_KEY), *[F.col(v).alias(new) for v, new in values.items()]
    )
    return df.join(lookup, F.col(col) == F.col(_KEY), "left").drop(_KEY)


def date_repair(
    df: DataFrame, date_col: str, timestamp_col: str, clean_col: str = "order_date_clean"
) -> DataFrame:
    """Add a clean date: as written, rearranged, or else the timestamp's day.

    A clean column that is there already is only filled where it is NULL.
    """
    repaired = F.coalesce(
        read_date(day_first_to_iso(date_col)),
        read_date(F.substring(timestamp_col, 1, 10)),
    )
    if clean_col in df.columns:
        repaired = F.coalesce(F.col(clean_col), repaired)
    return df.withColumn(clean_col, repaired)


def domain_members(domain: DataFrame, domain_col: str, name: str) -> DataFrame:
    """The distinct values of a domain without NULLs and blanks, as column ``name``."""
    return (
        domain.where(F.col(domain_col).isNotNull() & ~is_blank(domain_col))
        .select(F.col(domain_col).alias(name))
        .distinct()
    )


def not_in_domain(df: DataFrame, col: str, domain: DataFrame, domain_col: str) -> DataFrame:
    """Rows whose value is not in the domain.

    A NULL value is unknown and not reported; NULLs and blanks in the domain
    are no members of it.
    """
    members = domain_members(domain, domain_col, _KEY)
    return df.where(F.col(col).isNotNull()).join(
        members, F.col(col) == F.col(_KEY), "left_anti"
    )
