"""Declared relations between tables, all checked in one report.

A reference says that a column of one table names members of another. Each
table is scanned once for all references it takes part in, and values are
counted on the map side, so a value that a third of all rows share is one
number per task. One grouping by (reference, value) brings both sides together;
neither table is joined to the other and no value list is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import is_blank


@dataclass(frozen=True)
class Reference:
    """``column`` of ``table`` names the members in ``parent_column`` of ``parent``."""

    table: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column} > {self.parent}.{self.parent_column}"


def _sides(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """(reference, value, own, parent): rows of each side by value, each table read once."""
    wanted: dict[str, list[tuple[int, str, bool]]] = {}
    for i, r in enumerate(references):
        wanted.setdefault(r.table, []).append((i, r.column, True))
        wanted.setdefault(r.parent, []).append((i, r.parent_column, False))
    parts = []
    for name, uses in wanted.items():
        entry = [
            F.struct(
                F.lit(i).alias("i"),
                F.lit(own).alias("own"),
                F.col(f"`{column}`").cast("string").alias("value"),
            )
            for i, column, own in uses
        ]
        parts.append(tables[name].select(F.explode(F.array(*entry)).alias("e")).select("e.*"))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("i", "value")
        .agg(F.count_if("own").alias("own"), F.count_if(~F.col("own")).alias("parent"))
    )


def _sum(what: str, where: Column) -> Column:
    return F.coalesce(F.sum(F.when(where, F.col(what))), F.lit(0))


def check_relations(tables: dict[str, DataFrame], references: list[Reference]) -> DataFrame:
    """One row per reference, in both directions.

    ``rows`` of the referring table, those with a NULL or blank value, and
    ``orphan_rows`` and ``orphan_values`` that name no member; ``members``
    (distinct, not NULL, not blank), those that nothing names, and those that
    are listed more than once.
    """
    counted = _sides(tables, references)
    named = F.col("value").isNotNull() & ~is_blank("value")
    own, parent = F.col("own") > 0, F.col("parent") > 0
    report = counted.groupBy("i").agg(
        F.sum("own").alias("rows"),
        _sum("own", ~named).alias("empty_rows"),
        _sum("own", named & ~parent).alias("orphan_rows"),
        F.count_if(named & own & ~parent).alias("orphan_values"),
        F.count_if(named & parent).alias("members"),
        F.count_if(named & parent & ~own).alias("unused_members"),
        F.count_if(named & (F.col("parent") > 1)).alias("repeated_members"),
    )
    # tables without rows have no line in the counts
    names = reduce(
        lambda c, r: c.when(F.col("i") == r[0], r[1].name), enumerate(references), F.when(F.lit(False), "")
    )
    every = tables[references[0].table].sparkSession.range(len(references)).select(F.col("id").cast("int").alias("i"))
    figures = [c for c in report.columns if c != "i"]
    return (
        every.join(report, "i", "left")
        .select("i", names.alias("reference"), *[F.coalesce(c, F.lit(0)).alias(c) for c in figures])
        .orderBy("i")
        .drop("i")
    )


# fixed values: the relations that the data model declares
SALES_REFERENCES = [
    Reference("sales", "order_id", "order_categories", "order_id"),
    Reference("sales", "pay_method", "pay_methods", "pay_method"),
    Reference("sales", "ship_method", "ship_methods", "ship_method"),
    Reference("sales", "cancel_reason", "cancel_reasons", "cancel_reason"),
    Reference("sales", "province", "places", "province"),
    Reference("sales", "city", "places", "city"),
]
FACT_REFERENCES = [
    Reference("fact", "pay_method", "dim_payments", "pay_method"),
    Reference("fact", "order_id", "dim_order_category", "order_id"),
]
