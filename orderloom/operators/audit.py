"""The audit log: one row per order and anomaly, append-only and mirrored.

Every append is one folder of the log, which counts from the moment that the
log's ledger names it. An entry of the ledger holds the batch, its folder, the
highest id and the counts of all kinds of actions so far. An append that finds
that another one was first starts anew from the new state, so ids and audit
keys stay unique. Writing the same batch again replaces its folder.

The mirror has a ledger of its own and is brought up to that of the log, batch
by batch, after each append; what a failed job has left out, the next one adds.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..functions import any_of, is_true, local_now
from ..plans import fixed_values as fv
from ..sources import ledger
from ..plans.group_joins import join_groups
from ..plans.stage_store import write_stage
from .dedup import counted_firsts

AUDIT_SCHEMA = StructType(
    [
        StructField(name, LongType() if name in ("log_id", "total_rows", "problematic_rows")
                    else TimestampNTZType() if name == "logged_at"
                    else StringType())
        for name in fv.AUDIT_COLUMNS
    ]
)
BATCH = "batch_id"
KIND = "kind"
KINDS = 256


# --- entries ----------------------------------------------------------------


@dataclass(frozen=True)
class LogText:
    """What an entry says: changed attribute, reason, solution, source table.

    Without a reason of its own, the entry's reason is read from a column.
    """

    attribute: str
    reason: str | None
    solution: str
    source_table: str


def log_text(entry: str | LogText) -> LogText:
    """The text of an entry, or one of the fixed texts by its name."""
    return entry if isinstance(entry, LogText) else LogText(*fv.AUDIT_TEXTS[entry])


def _texts(text: LogText) -> dict[str, Column]:
    return {
        "attribute": F.lit(text.attribute),
        "reason": F.lit(text.reason),
        "solution": F.lit(text.solution),
        "source_table": F.lit(text.source_table),
    }


@dataclass(frozen=True)
class LogStep:
    """The log entries of one change: of the rows of ``table`` that meet ``where``."""

    step: int
    entry: str | LogText
    table: str
    where: Column
    reason: str | None = None


def audit_entries(
    df: DataFrame,
    entry: str | LogText,
    where: Column | None = None,
    reason: str | None = None,
    key: str = fv.KEY,
    total: int | None = None,
) -> DataFrame:
    """Log rows for the orders of ``df`` that meet ``where`` (all by default).

    ``entry`` is the text, or the name of a fixed one; ``reason`` names a
    column that replaces its reason. ``df`` has to be the table as it is before
    the change; ``total`` is its number of rows with a key, if it is known.
    """
    everything = F.lit(True)
    step = LogStep(0, entry, "all", everything if where is None else where, reason)
    totals = None if total is None else {"all": total}
    return fused_entries(df, {"all": everything}, [step], key, totals).drop("step")


def audit_duplicates(
    df: DataFrame, cols: list[str], key: str = fv.KEY, firsts: DataFrame | None = None,
    entry: str | LogText = "duplicates", total: int | None = None,
) -> DataFrame:
    """Log rows for the orders that ``drop_one_per_duplicate_group`` deletes.

    Here ``problematic_rows`` is the size of the group. ``firsts`` is the
    result of ``first_of_each_group`` and ``total`` the table's number of rows
    with a key, if they are known.
    """
    if firsts is None or total is None:
        known = counted_firsts(df, cols, key)
        firsts, total = known.firsts, known.table_keys
    return firsts.select(
        F.col(key).alias(fv.KEY),
        *[text.alias(name) for name, text in _texts(log_text(entry)).items()],
        F.lit(total).cast("bigint").alias("total_rows"),
        F.col("group_rows").cast("bigint").alias("problematic_rows"),
    )


def fused_entries(
    df: DataFrame, members: dict[str, Column], steps: list[LogStep], key: str = fv.KEY,
    totals: dict[str, int] | None = None,
) -> DataFrame:
    """The entries of many changes from one scan.

    ``members`` says for each table, all of them row-local selections of
    ``df``, which rows it has. ``totals`` are the rows with a key that each of
    them has; they are counted by a scan of their own if they are not known.
    The rows of a key are counted per change in one grouping, on the map side
    first, so a key may occur any number of times; what is shuffled are counts,
    the texts are added afterwards. A NULL key has one entry per change, with a
    count of 0. The result has the columns of :func:`audit_entries` and ``step``.
    """
    has_key = F.col(key).isNotNull()
    if totals is None:
        counted = F.struct(*[F.count_if(is_true(m) & has_key).alias(t) for t, m in members.items()])
        scanned = df.agg(counted.alias("totals")).scalar()
        total = {t: scanned.getField(t) for t in members}
    else:
        total = {t: F.lit(totals[t]).cast("bigint") for t in members}
    hits = {i: is_true(members[s.table]) & is_true(s.where) for i, s in enumerate(steps)}
    counts = [F.count_if(hit).alias(f"__n{i}") for i, hit in hits.items()]
    reasons = [
        F.min(F.when(hits[i], F.col(s.reason))).alias(f"__why{i}")
        for i, s in enumerate(steps)
        if s.reason
    ]
    per_key = (
        df.where(any_of(list(hits.values())))
        .groupBy(F.col(key).alias(fv.KEY))
        .agg(*counts, *reasons)
    )
    # what differs between orders goes through the explode, the texts of the step after it
    told = [log_text(s.entry) for s in steps]
    found = [
        F.when(
            F.col(f"__n{i}") > 0,
            F.struct(
                F.lit(i).alias("i"),
                (F.col(f"__why{i}") if s.reason else F.lit(None).cast("string")).alias("why"),
                F.when(F.col(fv.KEY).isNull(), 0).otherwise(F.col(f"__n{i}")).cast("bigint").alias("rows"),
            ),
        )
        for i, s in enumerate(steps)
    ]

    def by_step(values: list[Column]) -> Column:
        return F.get(F.array(*values), F.col("e.i"))

    # without a reason of its own a step's reason is the row's, NULL too
    fixed = [F.lit(None if s.reason else t.reason).cast("string") for s, t in zip(steps, told, strict=True)]
    each = per_key.select(fv.KEY, F.explode(F.array(*found)).alias("e")).where(F.col("e").isNotNull())
    return each.select(
        fv.KEY,
        by_step([F.lit(t.attribute) for t in told]).alias("attribute"),
        F.coalesce(by_step(fixed), "e.why").alias("reason"),
        by_step([F.lit(t.solution) for t in told]).alias("solution"),
        by_step([F.lit(t.source_table) for t in told]).alias("source_table"),
        by_step([total[s.table] for s in steps]).alias("total_rows"),
        F.col("e.rows").alias("problematic_rows"),
        by_step([F.lit(s.step) for s in steps]).alias("step"),
    )


# --- appending --------------------------------------------------------------


def kind_of_entry() -> Column:
    """The partition of the log that an entry belongs to, one of ``KINDS``.

    It follows from a column of the audit key, so a repeat of an entry can only
    be in the same partition, and so can another entry on the same attribute.
    """
    return F.pmod(F.xxhash64("attribute"), F.lit(KINDS)).cast("int")


def batches(spark: SparkSession, path: str) -> dict[str, dict]:
    """The ledger's last entry of each batch, by the batch's name."""
    return {e["batch"]: e for e in ledger.entries(spark, path)}


def read_log(spark: SparkSession, path: str, without_batch: str | None = None) -> DataFrame:
    """The log's rows; an absent log is empty."""
    known = batches(spark, path)
    known.pop(without_batch, None)
    return _read_parts(spark, path, list(known.values())).select(*AUDIT_SCHEMA.names)


def _read_parts(spark: SparkSession, path: str, parts: list[dict]) -> DataFrame:
    """The rows of some entries with their kind, the column that they are partitioned by."""
    schema = StructType([*AUDIT_SCHEMA.fields, StructField(BATCH, StringType()), StructField(KIND, IntegerType())])
    folders = [f"{path}/{BATCH}={e['folder']}" for e in parts if e["folder"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _once(batch: DataFrame) -> DataFrame:
    """One row per audit key; as in a UNIQUE constraint, a NULL in it equals nothing.

    Repeats are rare, so only 8-byte hashes of the keys are shuffled to find
    the rows that may be some; all others pass through.
    """
    whole = F.lit(True)
    for name in fv.AUDIT_KEY:
        whole = whole & F.col(name).isNotNull()
    hashed = batch.withColumn("__hash", F.when(whole, F.xxhash64(*fv.AUDIT_KEY)))
    repeated = write_stage(
        hashed.where(F.col("__hash").isNotNull())
        .groupBy("__hash")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .where(F.col("__rows") > 1),
        "repeated-entries",
    )
    marked = join_groups(hashed, repeated, ["__hash"], how="left")
    single = marked.where(F.col("__rows").isNull()).select(*batch.columns)
    return single.unionByName(one_per_key(marked.where(F.col("__rows").isNotNull()).select(*batch.columns)))


def one_per_key(batch: DataFrame) -> DataFrame:
    """One row per audit key by grouping all rows; those with a NULL in it all stay."""
    others = [c for c in batch.columns if c not in fv.AUDIT_KEY]
    # a number for each row whose key equals nothing
    alone = F.when(F.greatest(*[F.col(c).isNull() for c in fv.AUDIT_KEY]), F.monotonically_increasing_id())
    return (
        batch.withColumn("__alone", alone)
        .groupBy(*fv.AUDIT_KEY, "__alone")
        .agg(F.min(F.struct(*others)).alias("__row"))
        .select(*[F.col(c) if c in fv.AUDIT_KEY else F.col(f"__row.{c}").alias(c) for c in batch.columns])
    )


def new_entries(batch: DataFrame, log: DataFrame, unique_batch: bool = False) -> DataFrame:
    """Rows of the batch whose audit key is neither in the log nor repeated.

    With ``unique_batch`` the caller vouches that the batch repeats no key.
    """
    once = batch if unique_batch else _once(batch)
    return once.join(log.select(*fv.AUDIT_KEY), fv.AUDIT_KEY, "left_anti").select(*batch.columns)


def place_rows(df: DataFrame, order_by: list[str]) -> DataFrame:
    """A stage table of range-sorted rows with their partition and position."""
    placed = df.orderBy(*order_by).withColumn("__place", F.monotonically_increasing_id())
    return write_stage(placed, "placed-rows")


def number_rows(placed: DataFrame, start: Column, name: str) -> DataFrame:
    """Turn the places of :func:`place_rows` into consecutive numbers ``start + 1`` …

    Only the row counts per partition, one number each, are summed up in one
    place; the rows stay where they are.
    """
    partition = F.shiftright("__place", 33)
    position = F.col("__place").bitwiseAND(F.lit(2**33 - 1))
    sizes = placed.groupBy(partition.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select(
        "__part", (F.sum("__size").over(before) - F.col("__size")).alias("__offset")
    )
    return (
        placed.withColumn("__part", partition)
        .join(F.broadcast(offsets), "__part")
        .withColumn(name, start + F.col("__offset") + position + 1)
        .drop("__part", "__place", "__offset")
    )


def _store(entries: DataFrame, path: str) -> tuple[str, int]:
    """Write a folder that no ledger names yet: its name and its number of rows."""
    folder, counted = uuid.uuid4().hex, Observation()
    observed = entries.observe(counted, F.count(F.lit(1)).alias("rows"))
    observed.write.partitionBy(KIND).parquet(f"{path}/{BATCH}={folder}")
    return folder, counted.get["rows"]


def append_audit(
    batch: DataFrame,
    log_path: str,
    mirror_path: str,
    batch_id: str | None = None,
    strict: bool = False,
    order_by: list[str] | None = None,
    unique_batch: bool = False,
) -> DataFrame:
    """Append a batch of entries to the log and to its mirror; return the new rows.

    Entries that are in the log already are skipped; with ``strict`` they raise
    an error before anything is written. Ids go on from the log's highest, in
    the order of ``order_by`` (columns that only serve the order are dropped).

    The batch is stored first. Of the log only the partitions of the batch's
    kinds of entries are read; the highest id and the counts so far come from
    the ledger. The new rows are written once, with their ids, and counted as
    they are written.
    """
    spark = batch.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    seen = Observation()
    figures = [F.count(F.lit(1)).alias("rows"), F.collect_set(KIND).alias("kinds")]
    stored = write_stage(batch.withColumn(KIND, kind_of_entry()).observe(seen, *figures), "entries")
    once = stored if unique_batch else _once(stored)
    while True:
        known = ledger.entries(spark, log_path)
        others = {e["batch"]: e for e in known}
        replaced = others.pop(batch_id, None)
        held, new = None, once
        if others:
            # a filter on a partition column: folders of other kinds are not opened
            held = _read_parts(spark, log_path, list(others.values())).where(F.col(KIND).isin(seen.get["kinds"]))
            new = new_entries(once, held, unique_batch=True)
        placed = place_rows(new, order_by or [fv.KEY])
        if strict and placed.count() != seen.get["rows"]:
            raise ValueError("audit entries repeat a key: " + ", ".join(fv.AUDIT_KEY))
        start = max((e["last_id"] for e in others.values()), default=0)
        numbered = (
            number_rows(placed, F.lit(start), "log_id")
            .withColumn("logged_at", local_now(fv.LOCAL_ZONE))
            .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in AUDIT_SCHEMA.fields], KIND)
        )
        folder, rows = _store(numbered, log_path)
        before = None if replaced else (known[-1]["counts"] if known else [])
        entry = {
            "batch": batch_id, "folder": folder, "last_id": start + rows,
            "counts": _counts(spark, log_path, folder, held, before, others),
        }
        if ledger.commit(spark, log_path, ledger.next_number(known), entry):
            break
        # another append was first: its entries and ids count
        ledger.remove(spark, f"{log_path}/{BATCH}={folder}")
    catch_up(spark, log_path, mirror_path)
    return _read_parts(spark, log_path, [entry]).select(*AUDIT_SCHEMA.names)


_ACTION = ("solution", "attribute")


def _counts(
    spark: SparkSession, path: str, folder: str, held: DataFrame | None, before: list | None, others: dict
) -> list[list]:
    """Orders and entries per kind of action, of the log with a new batch.

    Counts add up, because an order is counted by the first batch that has it
    for the action, and the entries on an attribute share a partition of the
    log. Only when a batch is replaced the log is counted again.
    """
    part = _read_parts(spark, path, [{"folder": folder}])
    if before is None:
        rows = _per_action(_read_parts(spark, path, [*others.values(), {"folder": folder}]))
        before = []
    else:
        rows = _per_action(part, held)
    total = {(s, a): (orders, found) for s, a, orders, found in before}
    every = F.collect_list(F.struct(*_ACTION, "orders", "entries"))
    for solution, attribute, *more in rows.agg(every).first()[0]:  # one per kind of change
        orders, found = total.get((solution, attribute), (0, 0))
        total[solution, attribute] = (orders + more[0], found + more[1])
    return [[*action, *numbers] for action, numbers in total.items()]


def _per_action(rows: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """(solution, attribute, orders, entries); orders that ``held`` has are not counted."""
    per_order = rows.groupBy(*_ACTION, fv.KEY).agg(F.count(F.lit(1)).alias("rows"))
    if held is not None:
        earlier = held.select(*_ACTION, fv.KEY).distinct().withColumn("earlier", F.lit(True))
        per_order = per_order.join(earlier, [*_ACTION, fv.KEY], "left")
        order = F.when(F.col("earlier").isNull(), F.col(fv.KEY))
    else:
        order = F.col(fv.KEY)
    return per_order.groupBy(*_ACTION).agg(F.count(order).alias("orders"), F.sum("rows").alias("entries"))


def catch_up(spark: SparkSession, log_path: str, mirror_path: str) -> int:
    """Copy to the mirror every batch of the log's ledger that it does not have;
    returns how many were missing. Ids and times are copied as they are."""
    copied = 0
    while True:
        there = ledger.entries(spark, mirror_path)
        missing = [e for e in ledger.entries(spark, log_path) if e["number"] >= ledger.next_number(there)]
        if not missing:
            return copied
        entry = {k: v for k, v in missing[0].items() if k != "number"}
        current = batches(spark, log_path)[entry["batch"]]["number"] == missing[0]["number"]
        if current:
            folder, _ = _store(_read_parts(spark, log_path, missing[:1]).drop(BATCH), mirror_path)
        else:
            # replaced by a later entry, with which its rows come
            folder = batches(spark, mirror_path).get(entry["batch"], {}).get("folder")
        if ledger.commit(spark, mirror_path, missing[0]["number"], {**entry, "folder": folder}):
            copied += 1
        elif current:
            ledger.remove(spark, f"{mirror_path}/{BATCH}={folder}")


def audit_summary(log: DataFrame) -> DataFrame:
    """Orders and log rows per kind of action, counted from the rows."""
    return _per_action(log).orderBy(*_ACTION)


def log_summary(spark: SparkSession, path: str) -> DataFrame:
    """The same from the counts in the ledger; no row of the log is read."""
    known = ledger.entries(spark, path)
    schema = "solution string, attribute string, orders long, entries long"
    return spark.createDataFrame(known[-1]["counts"] if known else [], schema).orderBy(*_ACTION)
