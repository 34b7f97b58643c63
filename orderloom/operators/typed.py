"""The typed table: loading it from text, and the constraints on it."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import (
    any_of,
    is_true,
    matches_glob,
    read_date,
    read_timestamp,
    text_length,
    whole_number_or_null,
)
from ..plans import fixed_values as fv
from ..plans.group_joins import join_groups
from ..plans.stage_store import write_stage

# --- loading ----------------------------------------------------------------

READERS: dict[str, Callable[[str], Column]] = {
    "text": F.trim,
    "whole": whole_number_or_null,
    "timestamp": lambda c: read_timestamp(F.trim(c)),
    "date": lambda c: read_date(F.trim(c)),
}

# fixed values: the typed table, in column order
TYPED_COLUMNS = {
    "order_id": "text",
    "qty": "whole",
    "weight_gr": "whole",
    "returned_qty": "whole",
    "discount": "whole",
    "product_categories": "text",
    "category_count": "whole",
    "order_status": "text",
    "cancel_reason": "text",
    "ship_method": "text",
    "pay_method": "text",
    "city": "text",
    "province": "text",
    "ship_fee": "whole",
    "ship_disc": "whole",
    "payment": "whole",
    "ship_est": "whole",
    "order_timestamp": "timestamp",
    "order_date_clean": "date",
}


def load_typed(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """Text to types: trimmed texts, whole numbers, timestamps, dates.

    A blank number is NULL; an unreadable date or timestamp is NULL.
    """
    columns = columns or TYPED_COLUMNS

    def read(name: str, kind: str) -> Column:
        # a column with a type of its own, such as a repaired date, is kept
        is_text = isinstance(df.schema[name].dataType, StringType)
        return READERS[kind](name) if is_text else F.col(name)

    return df.select(*[read(name, kind).alias(name) for name, kind in columns.items()])


# --- constraints ------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    """A named condition. As in SQL CHECK, an unknown result passes."""

    name: str
    holds: Callable[[], Column]


def not_null(col: str) -> Constraint:
    return Constraint(f"{col} not null", lambda: F.col(col).isNotNull())


def positive(col: str) -> Constraint:
    return Constraint(f"{col} > 0", lambda: F.col(col) > 0)


def not_negative(col: str) -> Constraint:
    return Constraint(f"{col} >= 0", lambda: F.col(col) >= 0)


def of_length(col: str, n: int) -> Constraint:
    return Constraint(f"length({col}) = {n}", lambda: text_length(col) == n)


def written_as(col: str, glob: str, reader: Callable[[Column], Column]) -> Constraint:
    """Text of a given shape that can also be read."""

    def holds() -> Column:
        text = F.col(col)
        return matches_glob(text, glob) & F.when(
            text.isNotNull(), reader(text).isNotNull()
        )

    return Constraint(f"{col} readable", holds)


def sales_constraints(
    text_dates: bool = False, key_length: int = fv.KEY_LENGTH
) -> list[Constraint]:
    """The constraints of the typed order table.

    Dates and timestamps that are still text (``text_dates``) have to be
    well-formed and readable; with types of their own they always are.
    """
    whole_positive = ["qty", "weight_gr", "category_count"]
    whole_from_zero = ["returned_qty", "discount", "ship_fee", "ship_disc", "payment", "ship_est"]
    required = [
        c for c in TYPED_COLUMNS if c not in ("order_timestamp", "order_date_clean")
    ]
    readable = [
        written_as("order_timestamp", fv.TIMESTAMP_GLOB, read_timestamp),
        written_as("order_date_clean", fv.DATE_GLOB, read_date),
    ]
    return (
        [not_null(c) for c in required]
        + [of_length(fv.KEY, key_length)]
        + [positive(c) for c in whole_positive]
        + [not_negative(c) for c in whole_from_zero]
        + (readable if text_dates else [])
    )


def failed_constraints(constraints: list[Constraint]) -> Column:
    """The names of the constraints that a row breaks, as an array."""
    return F.array_compact(
        F.array(
            *[
                F.when(is_true(~c.holds()), F.lit(c.name)).otherwise(
                    F.lit(None).cast("string")
                )
                for c in constraints
            ]
        )
    )


def _repeated_keys(df: DataFrame, key: str) -> DataFrame:
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("violations"))
        .where(F.col("violations") > 1)
    )


def constraint_violations(
    df: DataFrame, key: str, constraints: list[Constraint], unique: bool = True
) -> DataFrame:
    """(key, constraint, violations): one row per broken constraint and row,
    and one per repeated key with the number of rows that share it."""
    any_broken = any_of([is_true(~c.holds()) for c in constraints])
    broken = df.where(any_broken).select(
        key,
        F.explode(failed_constraints(constraints)).alias("constraint"),
        F.lit(1).cast("bigint").alias("violations"),
    )
    if not unique:
        return broken
    repeated = _repeated_keys(df, key).select(
        key, F.lit(f"{key} unique").alias("constraint"), "violations"
    )
    return broken.unionByName(repeated)


def checked_rows(
    df: DataFrame, key: str, constraints: list[Constraint], unique: bool = True
) -> DataFrame:
    """``df`` with ``failed``, the names of the constraints that each row breaks.

    With ``unique`` all rows of a repeated key break one.
    """
    checked = df.withColumn("failed", failed_constraints(constraints))
    if unique:
        repeated = write_stage(_repeated_keys(df, key), "repeated-keys")
        counted = join_groups(checked, repeated, [key], how="left")
        shared = F.array_append("failed", F.lit(f"{key} unique"))
        checked = counted.withColumn(
            "failed", F.when(F.col("violations").isNull(), F.col("failed")).otherwise(shared)
        ).drop("violations")
    return checked


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) out of :func:`checked_rows`; rejected rows keep ``failed``."""
    ok = F.size("failed") == 0
    return checked.where(ok).drop("failed"), checked.where(~ok)


def quarantine(
    df: DataFrame, key: str, constraints: list[Constraint], unique: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected rows carry ``failed``, the broken constraints.

    With ``unique`` all rows of a repeated key are rejected.
    """
    return split_checked(checked_rows(df, key, constraints, unique))


def enforce(
    df: DataFrame, key: str, constraints: list[Constraint], unique: bool = True
) -> DataFrame:
    """``df`` unchanged, in a form that fails the job on the first broken constraint.

    The guard is a filter, so no choice of columns can leave it out. Its passing
    branch is marked as changing from call to call, which keeps Spark from
    moving it ahead of filters that ``df`` already has.
    """
    failed = failed_constraints(constraints)
    if unique and _repeated_keys(df, key).limit(1).count():
        raise ValueError(f"constraint failed: {key} unique")
    message = F.concat(
        F.lit("constraint failed: "), F.concat_ws(", ", failed), F.lit(" at "),
        F.coalesce(F.col(key).cast("string"), F.lit("NULL")),
    )
    return df.where(
        F.when(F.size(failed) > 0, F.raise_error(message).cast("boolean")).otherwise(
            F.spark_partition_id() >= 0
        )
    )
