"""The whole preparation: landing table and mappings to fact, dimensions, log.

The plan is cut where a result is read by several later steps: the landing
table, the repaired table (input of the second duplicate pass and of its log
entries) and the flagged table (input of the rules, the deletes and the log).
All other steps are row-local or broadcast lookups and stay one job.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import is_blank, is_true, like_ignoring_case, read_date
from ..operators import audit, dedup, flags, rules, star
from ..operators.standardize import (
    date_repair,
    drop_blank,
    enrich,
    standardize,
    unify_value,
)
from ..operators.typed import TYPED_COLUMNS, Constraint, checked_rows, enforce, load_typed, split_checked
from ..sources import landing, ledger, sinks
from . import fixed_values as fv
from .stage_store import collected_stages, remove_stages, write_counted, write_stage


@dataclass(frozen=True)
class Inputs:
    """The landing table (renamed, all text) and the mapping tables."""

    sales: DataFrame
    ship_methods: DataFrame
    pay_methods: DataFrame
    cancel_reasons: DataFrame
    places: DataFrame
    order_categories: DataFrame


# fixed values: headers of the mapping files
MAPPING_COLUMNS = {
    "ship_methods": ["ship_method", "ship_method_new", "shipping_carrier", "shipping_category"],
    "pay_methods": ["pay_method", "pay_method_new", "payment_category"],
    "cancel_reasons": ["cancel_id", "cancel_by", "reason", "cancel_reason"],
    "places": ["province", "province_new", "city", "city_new"],
    "order_categories": ["order_id", "product_category"],
}


def read_inputs(
    spark: SparkSession,
    sales: str,
    sales_sep: str = fv.LANDING_SEPARATOR,
    mapping_sep: str = ",",
    **mappings: str,
) -> Inputs:
    """The inputs from delimited files; ``mappings`` gives a path per mapping.

    The landing text is parsed once and kept as a columnar stage table, since
    every later step reads only some of its columns. Its own header decides the
    order of its columns. The order categories, one row per order and category,
    are as long as the sales and are kept the same way.
    """
    missing = set(MAPPING_COLUMNS) ^ set(mappings)
    if missing:
        raise ValueError(f"paths missing or unknown: {sorted(missing)}")
    text = landing.rename_columns(
        landing.read_landing(spark, sales, sep=sales_sep), fv.LANDING_RENAMES
    )
    tables = {
        name: landing.read_landing(spark, path, MAPPING_COLUMNS[name], mapping_sep)
        for name, path in mappings.items()
    }
    tables["order_categories"] = write_stage(tables["order_categories"], "order-categories")
    return Inputs(sales=write_stage(text.select(*fv.RAW_COLUMNS), "landed-sales"), **tables)


@dataclass(frozen=True)
class Stages:
    """The order table after each change, as the next step and the log see it.

    ``counts`` holds the rows of each, ``keys`` those with an order id; both are
    counted while the stage tables are written. ``rejected`` are the rows that
    break a constraint, if there are constraints.
    """

    raw: DataFrame
    duplicates: DataFrame
    without_duplicates: DataFrame
    with_qty: DataFrame
    with_pay_method: DataFrame
    repaired: DataFrame
    duplicates_clean: DataFrame
    clean: DataFrame
    flagged: DataFrame
    with_valid_payment: DataFrame
    final: DataFrame
    rejected: DataFrame | None = None
    counts: dict[str, int] = field(default_factory=dict)
    keys: dict[str, int] = field(default_factory=dict)


def _counted_selections(base: str) -> dict[str, Column]:
    """What to count when a stored table is written: the rows of the tables that are
    selections of it, and those with a key."""
    has_key = F.col(fv.KEY).isNotNull()
    members = _members().get(base, {base: F.lit(True)})
    out = {name: is_true(m) for name, m in members.items()}
    return out | {f"keys of {name}": m & has_key for name, m in out.items()}


def standardize_places(df: DataFrame, places: DataFrame) -> DataFrame:
    df = standardize(df, "city", places, "city", "city_new")
    return standardize(df, "province", places, "province", "province_new")


def add_categories(df: DataFrame, ship_methods: DataFrame, cancel_reasons: DataFrame) -> DataFrame:
    """Shipping category and carrier, cancelling side and reason."""
    df = enrich(
        df, "ship_method", ship_methods, "ship_method_new",
        {"shipping_category": "shipping_category", "shipping_carrier": "shipping_carrier"},
    )
    return enrich(
        df, "cancel_reason", cancel_reasons, "cancel_reason",
        {"cancel_by": "cancel_by", "reason": "sub_reason"},
    )


def build_stages(
    inputs: Inputs, constraints: list[Constraint] | None = None, strict: bool = False
) -> Stages:
    """Run the cleaning and validation steps in order.

    With ``constraints``, rows that break one are left out of the typed table,
    or stop the run if ``strict``.
    """
    key = fv.KEY
    raw = inputs.sales
    found: dict[str, int] = {}

    def stored(df: DataFrame, name: str) -> DataFrame:
        out, counts = write_counted(df, name.replace("_", "-"), _counted_selections(name))
        found.update(counts)
        return out

    first = dedup.counted_firsts(raw, fv.DUPLICATE_COLUMNS_RAW, key)
    # read by the cleaning and by eight kinds of log entries
    without_duplicates = stored(
        dedup.drop_one_per_duplicate_group(raw, fv.DUPLICATE_COLUMNS_RAW, key, first.firsts),
        "without_duplicates",
    )
    with_qty = drop_blank(without_duplicates, "qty")
    unified = unify_value(with_qty, "order_status", fv.RECEIVED_PATTERN, fv.RECEIVED)
    shipped = standardize(
        unified, "ship_method", inputs.ship_methods, "ship_method", "ship_method_new"
    )
    with_pay_method = drop_blank(shipped, "pay_method")
    paid_by = standardize(
        with_pay_method, "pay_method", inputs.pay_methods, "pay_method", "pay_method_new"
    )
    placed = standardize_places(paid_by, inputs.places)
    repaired = stored(date_repair(placed, "order_date", "order_timestamp"), "repaired")

    second = dedup.counted_firsts(repaired, fv.DUPLICATE_COLUMNS_CLEAN, key)
    clean = dedup.drop_one_per_duplicate_group(
        repaired, fv.DUPLICATE_COLUMNS_CLEAN, key, second.firsts
    )
    typed, rejected = load_typed(clean), None
    if constraints is not None and strict:
        typed = enforce(typed, key, constraints)
    elif constraints is not None:
        checked, counts = write_counted(
            checked_rows(typed, key, constraints), "checked", {"clean": F.lit(True)}
        )
        found.update(counts)
        typed, rejected = split_checked(checked)
    categorised = add_categories(typed, inputs.ship_methods, inputs.cancel_reasons)
    flagged = stored(flags.add_flags(categorised), "flagged")

    with_valid_payment = rules.drop_violations(flagged, "invalid_zero_payment")
    final = rules.drop_violations(with_valid_payment, "invalid_ship_disc")
    keys = {n.removeprefix("keys of "): c for n, c in found.items() if n.startswith("keys of ")}
    counts = {n: c for n, c in found.items() if not n.startswith("keys of ")}
    # every row that is not set aside is kept from the typed load to the flags
    counts = {"clean": counts["flagged"]} | counts
    counts |= {"raw": first.table_rows, "duplicates": first.groups, "duplicates_clean": second.groups}
    return Stages(
        raw, first.firsts, without_duplicates, with_qty, with_pay_method, repaired,
        second.firsts, clean, flagged, with_valid_payment, final, rejected,
        counts, keys | {"raw": first.table_keys, "repaired": second.table_keys},
    )


def _members() -> dict[str, dict[str, Column]]:
    """Per table that is read, the tables that are row-local selections of it."""
    everything = F.lit(True)
    with_qty = ~is_blank("qty")
    paid = ~is_true(rules.ROW_RULES["invalid_zero_payment"].broken())
    shipped = ~is_true(rules.ROW_RULES["invalid_ship_disc"].broken())
    return {
        "without_duplicates": {
            "without_duplicates": everything,
            "with_qty": with_qty,
            "with_pay_method": with_qty & ~is_blank("pay_method"),
        },
        "flagged": {
            "flagged": everything,
            "with_valid_payment": paid,
            "final": paid & shipped,
        },
    }


def log_steps() -> list[audit.LogStep]:
    """Every change that is logged row by row, with the table just before it.

    Steps 0 and 9 are the two duplicate passes.
    """
    everything = F.lit(True)
    longer = like_ignoring_case("order_status", fv.RECEIVED_PATTERN_AUDIT)

    def rule(name: str) -> Column:
        return rules.ROW_RULES[name].broken()

    def flag(step: int, name: str, table: str) -> audit.LogStep:
        return audit.LogStep(step, name, table, F.col(name) != "Normal", reason=name)

    return [
        audit.LogStep(1, "blank_qty", "without_duplicates", is_blank("qty")),
        audit.LogStep(2, "status", "with_qty", longer),
        audit.LogStep(3, "ship_method", "with_qty", everything),
        audit.LogStep(4, "blank_pay", "with_qty", is_blank("pay_method")),
        audit.LogStep(5, "pay_method", "with_pay_method", everything),
        audit.LogStep(6, "city", "with_pay_method", everything),
        audit.LogStep(7, "province", "with_pay_method", everything),
        audit.LogStep(8, "invalid_date", "with_pay_method", read_date("order_date").isNull()),
        flag(10, "weight_flag", "flagged"),
        audit.LogStep(11, "zero_payment", "flagged", rule("invalid_zero_payment")),
        flag(12, "payment_flag", "with_valid_payment"),
        audit.LogStep(13, "ship_disc", "with_valid_payment", rule("invalid_ship_disc")),
        flag(14, "shipping_flag", "final"),
    ]


# step of a duplicate pass -> table before it, its stored groups, the columns compared
DUPLICATE_PASSES = {
    "duplicates": (0, "raw", fv.DUPLICATE_COLUMNS_RAW),
    "duplicates_clean": (9, "repaired", fv.DUPLICATE_COLUMNS_CLEAN),
}


def _duplicate_entries(stages: Stages, name: str) -> DataFrame:
    _, table, cols = DUPLICATE_PASSES[name]
    firsts = getattr(stages, name)
    return audit.audit_duplicates(getattr(stages, table), cols, firsts=firsts, total=stages.keys[table])


def audit_batch(stages: Stages, entry: str) -> DataFrame:
    """The log entries of one change."""
    if entry in DUPLICATE_PASSES:
        return _duplicate_entries(stages, entry)
    step = next(s for s in log_steps() if s.entry == entry)
    return audit.audit_entries(
        getattr(stages, step.table), entry, step.where, step.reason, total=stages.keys[step.table]
    )


def audit_batches(stages: Stages) -> dict[str, DataFrame]:
    """The log entries of every change, each as a table of its own."""
    return {e: audit_batch(stages, e) for e in [*DUPLICATE_PASSES, *[s.entry for s in log_steps()]]}


def audit_entries_of(stages: Stages, entries: list[str]) -> DataFrame:
    """The log entries of the named changes: one scan and one grouping per stored table."""
    parts = []
    for base, members in _members().items():
        own = [s for s in log_steps() if s.table in members and s.entry in entries]
        if own:
            parts.append(audit.fused_entries(getattr(stages, base), members, own, totals=stages.keys))
    return reduce(DataFrame.unionByName, parts)


def all_audit_entries(stages: Stages) -> DataFrame:
    """One table of all log entries with ``step``, the place of their change.

    No audit key is repeated: an order has one entry per change and all changes
    differ in their texts, only an order that is the first of several groups of
    duplicates has to be listed once.
    """
    parts = [
        audit.one_per_key(_duplicate_entries(stages, name)).withColumn("step", F.lit(step))
        for name, (step, _, _) in DUPLICATE_PASSES.items()
    ]
    parts.append(audit_entries_of(stages, [s.entry for s in log_steps()]))
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Prepared:
    """The published results, and the rows of every stage and result by name.

    ``stages`` is there if the stage tables were kept.
    """

    fact: DataFrame
    dim_order_category: DataFrame
    dim_payments: DataFrame
    audit_log: DataFrame
    counts: dict[str, int]
    stages: Stages | None


def prepare(
    inputs: Inputs,
    out: str,
    constraints: list[Constraint] | None = None,
    strict: bool = False,
    csv: bool = False,
    backup: bool = False,
    run: str | None = None,
    keep_stages: bool = False,
) -> Prepared:
    """Run everything and publish fact, dimensions and audit log under ``out``.

    Each table is published as a new version when it is complete; until then,
    and after a failure, readers see the last one. The log comes first, so no
    published change lacks its entries. It grows by one batch per run, and
    entries that an earlier run has logged are skipped. A run that is given a
    name replaces the batch of that name; without one it replaces none.
    ``backup`` publishes a copy of the typed table as it was before any row was
    deleted from it. Rows that break a constraint are published as
    ``rejected_sales``. Stage tables are removed at the end, also after a
    failure, unless they are to be kept.
    """
    spark = inputs.sales.sparkSession
    with collected_stages() as made:
        try:
            done = _prepare(inputs, out, constraints, strict, csv, backup, run)
        except BaseException:
            remove_stages(spark, made)
            raise
    if keep_stages:
        return done
    remove_stages(spark, made)
    return Prepared(**{**done.__dict__, "stages": None})


def _prepare(
    inputs: Inputs, out: str, constraints: list[Constraint] | None, strict: bool, csv: bool,
    backup: bool, run: str | None,
) -> Prepared:
    stages = build_stages(inputs, constraints, strict)
    spark = stages.raw.sparkSession
    log_path, mirror_path = f"{out}/audit_log", f"{out}/backup_audit_log"
    # entries of one step differ in their order, those of two steps in their texts
    audit.append_audit(
        all_audit_entries(stages), log_path, mirror_path,
        batch_id=run, order_by=["step", fv.KEY], unique_batch=True,
    )
    if backup:
        sinks.snapshot(stages.flagged.select(*TYPED_COLUMNS), f"{out}/backup_sales")
    if stages.rejected is not None:
        sinks.publish(stages.rejected, f"{out}/rejected_sales")
    fact = sinks.publish(star.fact_sales(stages.final), f"{out}/fact_sales")
    categories = sinks.publish(
        star.dim_order_category(inputs.order_categories, fact), f"{out}/dim_order_category"
    )
    payments = sinks.publish(star.dim_payments(inputs.pay_methods), f"{out}/dim_payments")
    if csv:
        sinks.export_csv(fact, f"{out}/csv/fact_sales")
        sinks.export_csv(categories, f"{out}/csv/dim_order_category")
        sinks.export_csv(payments, f"{out}/csv/dim_payments", one_file=True)
    published = {"fact": "fact_sales", "dim_order_category": "dim_order_category", "dim_payments": "dim_payments"}
    counts = {name: stages.counts[name] for name in STAGE_NAMES}
    counts |= {name: sinks.published_rows(spark, f"{out}/{table}") for name, table in published.items()}
    counts["audit_log"] = sum(entries for *_, entries in ledger.entries(spark, log_path)[-1]["counts"])
    return Prepared(fact, categories, payments, audit.read_log(spark, log_path), counts, stages)


STAGE_NAMES = [f.name for f in fields(Stages) if f.name not in ("rejected", "counts", "keys")]


def stage_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """(step, stage, rows) of counts by name, in their order; nothing is scanned."""
    numbered = [(i, name, rows) for i, (name, rows) in enumerate(counts.items())]
    return spark.createDataFrame(numbered, "step int, stage string, rows long").orderBy("step")
