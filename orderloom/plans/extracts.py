"""Tables that grow by extracts: keys that stay unique, duplicates across extracts.

An extract is a batch with a name. Its data is written to folders of its own and
counts from the moment that the table's ledger names it; an append that finds
another one entered first starts anew from the new state.

What has to be known of earlier extracts is kept beside the rows, partitioned by
a hash of the key or of the content into ``BUCKETS`` folders, so an append opens
the folders that its own rows fall into and no others.
"""

from __future__ import annotations

import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources import ledger
from .group_joins import join_groups
from .stage_store import write_stage

BUCKETS = 64
BUCKET = "bucket"
RUN = "run"
REASON = "reason"
KNOWN, REPEATED = "known", "repeated"
_HASH = "__hash"
_ROWS = "__rows"


class Extract(NamedTuple):
    """The rows that an append has added, and those it has set aside with ``reason``."""

    appended: DataFrame
    rejected: DataFrame


def _store(df: DataFrame, path: str, part: str, partition_by: list[str] | None = None) -> str:
    """Write a folder of one of the table's parts; its name.

    Rows that are partitioned are brought together first, in shares of about equal
    bytes, so that not every task writes a file for every bucket.
    """
    run = uuid.uuid4().hex
    together = df.hint("rebalance", *partition_by) if partition_by else df
    together.write.partitionBy(*partition_by or []).parquet(f"{path}/{part}/{RUN}={run}")
    return run


def _read(spark: SparkSession, path: str, part: str, runs: list[str], schema: StructType) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{part}/{RUN}={r}" for r in runs]
    read = spark.read.schema(schema).option("basePath", f"{path}/{part}").parquet(*folders)
    return read.select(*[f"`{c}`" for c in schema.names])


def _current(spark: SparkSession, path: str, without: str | None = None) -> tuple[list[dict], dict[str, dict]]:
    """All entries of the ledger, and the last one of each other extract by its name."""
    known = ledger.entries(spark, path)
    last = {e["extract"]: e for e in known}
    last.pop(without, None)
    return known, last


def _schema(entry: dict) -> StructType:
    return StructType.fromJson(entry["schema"])


def read_extracts(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were appended to a table."""
    known, last = _current(spark, path)
    if not known:
        raise FileNotFoundError(f"nothing has been appended to {path}")
    return _read(spark, path, "rows", [e["rows"] for e in last.values()], _schema(known[-1]))


def _same_columns(df: DataFrame, known: list[dict]) -> None:
    if known and _schema(known[-1]).simpleString() != df.schema.simpleString():
        raise ValueError(f"the table has {_schema(known[-1]).simpleString()}, the extract {df.schema.simpleString()}")


# --- a key over all extracts -------------------------------------------------


def known_keys(spark: SparkSession, path: str, key: StructField, buckets: list[int], entries: list[dict]) -> DataFrame:
    """(key): the stored keys in some buckets; folders of other buckets are not opened."""
    schema = StructType([StructField(key.name, key.dataType), StructField(BUCKET, IntegerType())])
    stored = _read(spark, path, "keys", [e["keys"] for e in entries], schema)
    return stored.where(F.col(BUCKET).isin(buckets)).select(f"`{key.name}`")


def append_extract(df: DataFrame, path: str, key: str, name: str, on_repeat: str = "set_aside") -> Extract:
    """Append the rows of an extract whose key is new to the table ``path``.

    A row whose key an earlier extract has (reason ``known``) or the extract
    itself has more than once (``repeated``) is set aside, or stops the append
    before anything is entered with ``on_repeat="stop"``. A NULL key equals
    nothing, as in a UNIQUE constraint. Beside the rows the keys are stored,
    partitioned by their hash; of the earlier ones only the partitions that the
    extract touches are read, and no row of an earlier extract. Giving a name
    again replaces that extract.
    """
    if on_repeat not in ("set_aside", "stop"):
        raise ValueError(f"unknown choice for repeated keys: {on_repeat}")
    spark, field = df.sparkSession, df.schema[key]
    touched = Observation()
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")
    marked = df.withColumn(BUCKET, bucket).observe(touched, F.collect_set(BUCKET).alias("buckets"))
    stored = write_stage(marked, "extract")
    repeats = write_stage(
        stored.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(_ROWS))
        .where(F.col(_ROWS) > 1),
        "repeated-keys",
    )
    while True:
        entries, last = _current(spark, path, name)
        _same_columns(df, entries)
        held = known_keys(spark, path, field, touched.get["buckets"], list(last.values()))
        counted = join_groups(stored, repeats, [key], how="left")
        flagged = counted.join(held.withColumn("__held", F.lit(True)), key, "left")
        reason = F.when(F.col("__held"), KNOWN).when(F.col(_ROWS).isNotNull(), REPEATED)
        checked = write_stage(flagged.select(*stored.columns, reason.alias(REASON)), "checked-extract")
        fresh = checked.where(F.col(REASON).isNull())
        rejected = checked.where(F.col(REASON).isNotNull()).select(*[f"`{c}`" for c in df.columns], REASON)
        if on_repeat == "stop" and (bad := rejected.first()) is not None:
            raise ValueError(f"key {bad[key]!r} is {bad[REASON]}")
        rows = _store(fresh.select(*[f"`{c}`" for c in df.columns]), path, "rows")
        keys = _store(fresh.where(F.col(key).isNotNull()).select(key, BUCKET), path, "keys", [BUCKET])
        aside = _store(rejected, path, "rejected")
        entry = {"extract": name, "rows": rows, "keys": keys, "rejected": aside, "schema": df.schema.jsonValue()}
        if ledger.commit(spark, path, ledger.next_number(entries), entry):
            return Extract(_read(spark, path, "rows", [rows], df.schema), _read(spark, path, "rejected", [aside], rejected.schema))
        for part, run in (("rows", rows), ("keys", keys), ("rejected", aside)):
            ledger.remove(spark, f"{path}/{part}/{RUN}={run}")


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that the extracts of a table have set aside, with ``reason``."""
    known, last = _current(spark, path)
    schema = _schema(known[-1]).add(REASON, "string")
    return _read(spark, path, "rejected", [e["rejected"] for e in last.values()], schema)


# --- duplicates across extracts ----------------------------------------------


def add_extract(df: DataFrame, path: str, cols: list[str], key: str, name: str) -> None:
    """Add an extract to a table that loses, of each group of rows alike in ``cols``,
    the row with the smallest key.

    Stored are the rows and the number of rows of each content hash, both by
    buckets of the hash, and the first key of each group of duplicates. The new
    hashes are counted together with those of the buckets they fall into; only
    rows whose hash occurs more than once then are read, from the buckets of
    such hashes alone, and their real columns are compared. Earlier extracts are
    not read otherwise. :func:`read_deduplicated` gives the rows that
    ``drop_one_per_duplicate_group`` leaves of all extracts put together. A name
    can be given once.
    """
    if any(e["extract"] == name for e in ledger.entries(df.sparkSession, path)):
        raise ValueError(f"extract {name} is part of the table already")
    spark = df.sparkSession
    hashed = df.withColumn(_HASH, F.xxhash64(*cols)).withColumn(
        BUCKET, F.pmod(F.col(_HASH), F.lit(BUCKETS)).cast("int")
    )
    rows = _store(hashed, path, "rows", [BUCKET])
    own_rows = _read(spark, path, "rows", [rows], hashed.schema)
    touched = Observation()
    counted = own_rows.groupBy(BUCKET, _HASH).agg(F.count(F.lit(1)).alias(_ROWS))
    hashes = _store(counted.observe(touched, F.collect_set(BUCKET).alias("buckets")), path, "hashes", [BUCKET])
    counts = StructType([StructField(_HASH, LongType()), StructField(_ROWS, LongType()), StructField(BUCKET, IntegerType())])
    own = _read(spark, path, "hashes", [hashes], counts)
    first_schema = StructType([StructField(_HASH, LongType()), StructField(key, df.schema[key].dataType), StructField(_ROWS, LongType()), StructField(BUCKET, IntegerType())])
    while True:
        entries, last = _current(spark, path, name)
        _same_columns(df, entries)
        if any(e["extract"] == name for e in entries):
            raise ValueError(f"extract {name} is part of the table already")
        earlier = _read(spark, path, "hashes", [e["hashes"] for e in last.values()], counts)
        earlier = earlier.where(F.col(BUCKET).isin(touched.get["buckets"]))
        # counts of one hash in different extracts add up; the new ones decide which matter
        total = own.withColumn("__own", F.lit(1)).unionByName(earlier.withColumn("__own", F.lit(0)))
        hit = Observation()
        repeated = (
            total.groupBy(BUCKET, _HASH)
            .agg(F.sum(_ROWS).alias(_ROWS), F.max("__own").alias("__own"))
            .where((F.col(_ROWS) > 1) & (F.col("__own") == 1))
            .select(BUCKET, _HASH)
            .observe(hit, F.collect_set(BUCKET).alias("buckets"))
        )
        hits = write_stage(repeated, "repeated-hashes")
        members = _members(spark, path, [*[e["rows"] for e in last.values()], rows], hashed.schema, hit.get["buckets"])
        firsts = (
            join_groups(members, hits, [BUCKET, _HASH])
            .groupBy(BUCKET, _HASH, *cols)
            .agg(F.count(F.lit(1)).alias(_ROWS), F.min(F.struct(key)).alias("__first"))
            .where(F.col(_ROWS) > 1)
            .select(_HASH, F.col(f"__first.{key}").alias(key), _ROWS, BUCKET)
        )
        # the buckets that are written anew keep the groups that were not touched
        parts = dict(entries[-1]["firsts"]) if entries else {}
        old = _read_firsts(spark, path, {b: r for b, r in parts.items() if int(b) in hit.get["buckets"]}, first_schema)
        kept = old.join(hits.select(_HASH), _HASH, "left_anti").select(*first_schema.names)
        run = _store(kept.unionByName(firsts), path, "firsts", [BUCKET])
        parts |= {str(b): run for b in hit.get["buckets"]}
        entry = {"extract": name, "rows": rows, "hashes": hashes, "firsts": parts, "key": key, "schema": df.schema.jsonValue()}
        if ledger.commit(spark, path, ledger.next_number(entries), entry):
            return
        ledger.remove(spark, f"{path}/firsts/{RUN}={run}")


def _members(spark: SparkSession, path: str, runs: list[str], schema: StructType, buckets: list[int]) -> DataFrame:
    return _read(spark, path, "rows", runs, schema).where(F.col(BUCKET).isin(buckets))


def _read_firsts(spark: SparkSession, path: str, parts: dict[str, str], schema: StructType) -> DataFrame:
    """The first keys of the buckets, each from the run that has written it last."""
    by_run: dict[str, list[int]] = {}
    for bucket, run in parts.items():
        by_run.setdefault(run, []).append(int(bucket))
    read = [_read(spark, path, "firsts", [run], schema).where(F.col(BUCKET).isin(own)) for run, own in by_run.items()]
    return reduce(DataFrame.unionByName, read, spark.createDataFrame([], schema))


def duplicate_firsts(spark: SparkSession, path: str) -> DataFrame:
    """(key, group_rows): the rows that duplicates across all extracts lose."""
    entry = ledger.entries(spark, path)[-1]
    key = _schema(entry)[entry["key"]]
    schema = StructType([StructField(_HASH, LongType()), StructField(key.name, key.dataType), StructField(_ROWS, LongType()), StructField(BUCKET, IntegerType())])
    return _read_firsts(spark, path, entry["firsts"], schema).select(f"`{key.name}`", F.col(_ROWS).alias("group_rows"))


def read_deduplicated(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all extracts without the first of each group of duplicates."""
    entry = ledger.entries(spark, path)[-1]
    gone = duplicate_firsts(spark, path).select(entry["key"])
    return read_extracts(spark, path).join(gone, entry["key"], "left_anti").select(*[f"`{c}`" for c in _schema(entry).names])
