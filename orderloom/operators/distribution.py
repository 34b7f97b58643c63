"""Exact NTILE statistics without sorting the table in one place.

The statistics of a tile depend on the values only, so equal values are counted
first; a value held by a third of all rows becomes one row. The distinct values
are then sorted into ranges of about equal size, however close together they
lie, and ranked inside their range. The one small task that adds up the ranges
sees one number per partition of the sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import rounded
from ..plans import fixed_values as fv
from ..plans.stage_store import write_stage


def ntile_profile(
    df: DataFrame,
    measure: Column,
    name: str,
    tiles: int = fv.TILES,
) -> DataFrame:
    """Average, minimum, maximum and row count of each of ``tiles`` equal parts.

    ``measure`` is a whole number; the rows are ranked by it as NTILE does,
    with the larger tiles first. Counting and sorting the values is a job that
    runs when this is called. Columns: bucket, avg_, min_, max_``name``,
    total.
    """
    counted = (
        df.select(measure.cast("bigint").alias("v"))
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return ntile_of_counts(counted, name, tiles)


def ntile_of_counts(counted: DataFrame, name: str, tiles: int = fv.TILES) -> DataFrame:
    """The same of values ``v``, each once, with the number ``n`` of their rows."""
    # stored, so that the offsets and the ranks come from the same ranges
    ranges = write_stage(
        counted.orderBy(F.col("v").asc_nulls_first()).withColumn(
            "part", F.spark_partition_id()
        ),
        "value-ranges",
    )
    all_parts = Window.orderBy("part")
    parts_before = (
        ranges.groupBy("part")
        .agg(F.sum("n").alias("part_rows"))
        .select(
            "part",
            (
                F.sum("part_rows").over(all_parts.rowsBetween(Window.unboundedPreceding, 0))
                - F.col("part_rows")
            ).alias("rows_before"),
            F.sum("part_rows")
            .over(all_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("total_rows"),
        )
    )
    within = (
        Window.partitionBy("part")
        .orderBy(F.col("v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = ranges.join(F.broadcast(parts_before), "part").select(
        "v",
        (F.col("rows_before") + F.sum("n").over(within)).alias("last"),
        "n",
        F.expr(f"total_rows div {tiles}").alias("q"),
        F.expr(f"total_rows % {tiles}").alias("r"),
    ).withColumn("first", F.expr("last - n + 1"))

    # the first r tiles hold q + 1 rows, the others q
    def tile_of(rank: str) -> str:
        return (
            f"if({rank} <= r * (q + 1), ({rank} + q) div (q + 1), "
            f"r + ({rank} - r * (q + 1) + q - 1) div greatest(q, 1))"
        )

    parts = ranked.select(
        "v", "first", "last", "q", "r",
        F.expr(f"explode(sequence({tile_of('first')}, {tile_of('last')}))").alias("bucket"),
    ).select(
        "bucket",
        "v",
        F.expr(
            "least(last, bucket * q + least(bucket, r))"
            " - greatest(first, (bucket - 1) * q + least(bucket - 1, r) + 1) + 1"
        ).alias("n"),
    )
    weighted = F.sum(F.col("v").cast("decimal(38,0)") * F.col("n"))
    with_value = F.sum(F.when(F.col("v").isNotNull(), F.col("n")))
    return (
        parts.groupBy("bucket")
        .agg(
            rounded(F.try_divide(weighted.cast("double"), with_value.cast("double"))).alias(
                f"avg_{name}"
            ),
            F.min("v").alias(f"min_{name}"),
            F.max("v").alias(f"max_{name}"),
            F.sum("n").alias("total"),
        )
        .orderBy("bucket")
    )
