"""Profiles that add up: counts of values, kept per extract and merged.

A tally is a table (attribute, value, n). Tallies of parts of a table add up to
that of the whole, so frequencies and deciles of a growing table are read from
the tallies of its extracts, and its rows are scanned once, when they come in.
Stored tallies are partitioned by attribute: a profile of one column opens its
folders only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sources import ledger
from .distribution import ntile_of_counts

SCHEMA = StructType([StructField("value", StringType()), StructField("n", LongType()), StructField("attribute", StringType())])


def tally(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """The rows of each value of each measure, NULL included, from one scan."""
    stacked = F.array(*[F.struct(F.lit(n).alias("attribute"), c.cast("string").alias("value")) for n, c in measures.items()])
    return (
        df.select(F.explode(stacked).alias("e"))
        .groupBy("e.attribute", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*SCHEMA.names)
    )


def add_tally(counted: DataFrame, path: str, name: str) -> None:
    """Store the tally of the extract ``name``; the same name again replaces it."""
    spark, run = counted.sparkSession, uuid.uuid4().hex
    counted.select(*SCHEMA.names).write.partitionBy("attribute").parquet(f"{path}/run={run}")
    while not ledger.commit(spark, path, ledger.next_number(ledger.entries(spark, path)), {"extract": name, "run": run}):
        pass


def read_tally(spark: SparkSession, path: str, attributes: list[str] | None = None) -> DataFrame:
    """The tally of all extracts together, of all attributes or of some."""
    runs = {e["extract"]: e["run"] for e in ledger.entries(spark, path)}
    if not runs:
        return spark.createDataFrame([], SCHEMA)
    folders = [f"{path}/run={r}" for r in runs.values()]
    stored = spark.read.schema(SCHEMA).option("basePath", path).parquet(*folders)
    wanted = stored if attributes is None else stored.where(F.col("attribute").isin(attributes))
    return wanted.groupBy("attribute", "value").agg(F.sum("n").alias("n")).select(*SCHEMA.names)


def frequencies(counted: DataFrame) -> DataFrame:
    """(attribute, value, value_rows); as COUNT of the column does, NULL counts 0."""
    rows = F.when(F.col("value").isNull(), 0).otherwise(F.col("n")).cast("bigint")
    return counted.select("attribute", "value", rows.alias("value_rows"))


def tiles(counted: DataFrame, attribute: str, name: str, number: int = 10) -> DataFrame:
    """The profile of equal tiles of a whole-number measure, out of a tally."""
    own = counted.where(F.col("attribute") == attribute)
    return ntile_of_counts(own.select(F.col("value").cast("bigint").alias("v"), "n"), name, number)
