"""Writing tables: CSV exports, stored tables, published versions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from . import ledger


def export_csv(df: DataFrame, path: str, sep: str = ",", one_file: bool = False) -> None:
    """A CSV folder with headers; ``one_file`` is for small tables only."""
    out = df.coalesce(1) if one_file else df
    (
        out.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def create_table_as(df: DataFrame, path: str, if_not_exists: bool = False) -> DataFrame:
    """CREATE TABLE AS: fails on an existing table, or leaves it as it is."""
    df.write.mode("ignore" if if_not_exists else "errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def publish(
    df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = 2
) -> DataFrame:
    """A new version of the table ``path``, which takes the place of the last one
    when it is complete; returns the version that was written.

    Each version has a folder of its own, and one small ledger entry makes it
    the current one. A job that is killed before leaves the last version as it
    is. The folders of the last ``keep`` versions stay, for readers that have
    opened the one before.
    """
    spark = df.sparkSession
    folder = ledger.new_folder(path)
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    observed.write.partitionBy(*partition_by or []).parquet(folder)
    entry = {"folder": folder.removeprefix(f"{path}/"), "schema": df.schema.json(), "rows": counted.get["rows"]}
    while not ledger.commit(spark, path, ledger.next_number(ledger.entries(spark, path)), entry):
        pass
    # a few at a time, those before are gone already
    for old in ledger.entries(spark, path)[:-keep][-4:]:
        ledger.remove(spark, f"{path}/{old['folder']}")
    return _version(spark, path, entry)


def _version(spark: SparkSession, path: str, entry: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(entry["schema"]))
    # partition columns come last in the files, but not in the table
    return spark.read.schema(schema).parquet(f"{path}/{entry['folder']}").select(*[f"`{c}`" for c in schema.names])


def published_rows(spark: SparkSession, path: str) -> int:
    """The number of rows of the current version, as counted when it was written."""
    return _current(spark, path)["rows"]


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a published table."""
    return _version(spark, path, _current(spark, path))


def _current(spark: SparkSession, path: str) -> dict:
    known = ledger.entries(spark, path)
    if not known:
        raise FileNotFoundError(f"nothing has been published under {path}")
    return known[-1]


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """A full copy that takes the place of the previous one when it is complete."""
    return publish(df, path)
