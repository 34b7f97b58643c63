"""Read-only reports on the columns of a table.

Reports over several columns take one scan: the columns are turned into
(attribute, value) rows, rows without a finding are dropped before the
shuffle, and the rest is counted with partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import (
    day_first_to_iso,
    is_blank,
    read_date,
    read_timestamp,
    text_length,
    whole_number,
)
from ..plans import fixed_values as fv


def _stacked(df: DataFrame, cols: list[str]) -> DataFrame:
    """(attribute, value) rows for text columns."""
    return df.select(*cols).unpivot([], cols, "attribute", "value")


# --- rows and keys ----------------------------------------------------------


def peek(df: DataFrame, n: int, order_by: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, of an order if one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def duplicate_or_null_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and the NULL key (counted as 0)."""
    return (
        df.groupBy(key)
        .agg(F.count(key).alias("key_rows"))
        .where((F.col("key_rows") > 1) | F.col(key).isNull())
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, distinct keys, and whether the two agree."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    totals = counted.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count(key).alias("total_keys"),
    )
    unique = F.col("total_rows") == F.col("total_keys")
    return totals.withColumn(
        "status", F.when(unique, F.lit("Unique")).otherwise(F.lit("Not Unique"))
    )


def key_length_outliers(df: DataFrame, key: str, length: int = fv.KEY_LENGTH) -> DataFrame:
    """Distinct key lengths other than the right one."""
    return (
        df.select(text_length(key).alias("key_length"))
        .where(F.col("key_length") != length)
        .distinct()
    )


def key_prefix_outliers(
    df: DataFrame, key: str, prefix: str = fv.KEY_PREFIX, joiner: str = fv.KEY_JOINER
) -> DataFrame:
    """Distinct key starts where prefix AND joiner are both wrong."""
    n = len(prefix)
    return (
        df.select(
            F.substring(key, 1, n).alias("prefix"),
            F.substring(key, n + 1, len(joiner)).alias("joiner"),
        )
        .where((F.col("prefix") != prefix) & (F.col("joiner") != joiner))
        .distinct()
    )


def key_format_outliers(df: DataFrame, key: str, pattern: str = fv.KEY_PATTERN) -> DataFrame:
    """Keys that do not match the whole format."""
    return df.where(~F.col(key).rlike(pattern)).select(key)


def key_number_outliers(
    df: DataFrame,
    key: str,
    first: int = fv.KEY_FIRST_NUMBER,
    last: int = fv.KEY_LAST_NUMBER,
    start: int = len(fv.KEY_PREFIX + fv.KEY_JOINER) + 1,
    length: int = 7,
) -> DataFrame:
    """Keys whose number is outside ``first`` … ``last``.

    The numbers have no gaps, so membership is a range test and needs no join
    with a generated sequence.
    """
    number = whole_number(F.substring(key, start, length))
    return df.select(key, number.alias("key_number")).where(
        ~F.col("key_number").between(first, last)
    )


# --- values -----------------------------------------------------------------


def numeric_format_profile(
    df: DataFrame, cols: list[str], suffix: dict[str, str] | None = None
) -> DataFrame:
    """Texts whose length differs from the length of the number read from them.

    ``suffix`` names, per column, a text that is removed (everywhere) before
    the length is taken.
    """
    suffix = suffix or {}
    compared = F.col("value")
    for name, text in suffix.items():
        compared = F.when(
            F.col("attribute") == name, F.replace("value", F.lit(text), F.lit(""))
        ).otherwise(compared)
    found = (
        _stacked(df, cols)
        .withColumn("text_length", text_length(compared))
        .withColumn("number", whole_number("value"))
        .withColumn("number_length", text_length(F.col("number").cast("string")))
        .where(F.col("text_length") != F.col("number_length"))
    )
    return (
        found.groupBy("attribute", "value", "text_length", "number", "number_length")
        .agg(F.count("value").alias("value_rows"))
        .orderBy("attribute", "number", "value")
        .drop("number")
    )


def null_blank_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Blank and NULL rows per column, all from one aggregate.

    ``value_rows`` counts values, so it is 0 for NULLs; ``table_rows`` counts
    rows. A status without rows is not listed.
    """
    status = lambda c, name, found: F.struct(
        F.lit(c).alias("attribute"),
        F.lit(name).alias("status"),
        (found if name == "blank" else F.lit(0).cast("long")).alias("value_rows"),
        found.alias("table_rows"),
    )
    counts = df.agg(
        *[F.count_if(is_blank(c)).alias(f"b{i}") for i, c in enumerate(cols)],
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)],
    )
    found = [status(c, "blank", F.col(f"b{i}")) for i, c in enumerate(cols)]
    found += [status(c, "null", F.col(f"n{i}")) for i, c in enumerate(cols)]
    return counts.select(F.inline(F.array(*found))).where("table_rows > 0")


def blank_values(df: DataFrame, col: str) -> DataFrame:
    """The blank and the NULL value of one column with their counts."""
    return (
        df.where(F.col(col).isNull() | is_blank(col))
        .groupBy(col)
        .agg(F.count(col).alias("value_rows"))
    )


def padding_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Values with leading or trailing blanks (NULL counts as a problem too)."""
    tidy = text_length("value") == text_length(F.trim("value"))
    return (
        _stacked(df, cols)
        .where(~F.coalesce(tidy, F.lit(False)))
        .groupBy("attribute", "value")
        .agg(F.count("value").alias("value_rows"))
        .withColumn("status", F.lit("Problem"))
        .orderBy("attribute", "value")
    )


def value_frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every value of every column with its count."""
    return (
        _stacked(df, cols)
        .groupBy("attribute", "value")
        .agg(F.count("value").alias("value_rows"))
    )


# --- dates ------------------------------------------------------------------


def invalid_dates(df: DataFrame, col: str) -> DataFrame:
    """Texts that are no date, with counts (0 for NULL)."""
    return (
        df.where(read_date(col).isNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(col).alias("value_rows"))
        .orderBy("value")
    )


def abnormal_dates(df: DataFrame, col: str) -> DataFrame:
    """Invalid dates that are neither blank nor day-first."""
    kept = ~F.col("value").contains("/") & (F.col("value") != "")
    return invalid_dates(df, col).where(kept)


def invalid_timestamps(df: DataFrame, col: str) -> DataFrame:
    """Texts that are no timestamp, with counts (0 for NULL)."""
    return (
        df.where(read_timestamp(col).isNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(col).alias("value_rows"))
    )


def date_reconcile(df: DataFrame, date_col: str, timestamp_col: str) -> DataFrame:
    """One row: how many dates equal their timestamp's day, are blank, are abnormal.

    Sums over no rows are NULL.
    """
    arranged = read_date(day_first_to_iso(date_col))
    day = read_date(F.substring(timestamp_col, 1, 10))
    rows = df.select(
        F.col(date_col).alias("text"), arranged.alias("arranged"), day.alias("day")
    )

    def rows_where(condition: Column) -> Column:
        return F.sum(condition.cast("int"))

    unreadable = F.col("arranged").isNull()
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        rows_where(F.col("arranged") == F.col("day")).alias("same_rows"),
        rows_where(unreadable & (F.col("text") == "")).alias("blank_rows"),
        rows_where(unreadable & (F.col("text") != "")).alias("abnormal_rows"),
    ).select(F.lit("order_date").alias("attribute"), "*")
