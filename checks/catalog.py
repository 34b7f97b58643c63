"""The registered queries: name -> (spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions import like_ignoring_case, matches_glob, whole_number
from orderloom.operators import audit, dedup, distribution, flags, profile, relations, rules, star, tallies
from orderloom.operators.standardize import (
    date_repair,
    drop_blank,
    standardize,
    unify_value,
)
from orderloom.operators.typed import (
    TYPED_COLUMNS,
    constraint_violations,
    enforce,
    load_typed,
    quarantine,
    sales_constraints,
)
from orderloom.plans import extracts, fixed_values as fv
from orderloom.plans.prepare import (
    add_categories,
    audit_batch,
    audit_entries_of,
    prepare,
    stage_counts,
)
from orderloom.plans.stage_store import new_stage_path, write_stage
from orderloom.sources import landing, sinks
from orderloom.streaming.audit_stream import mirror_stream

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = "2001-07-01 00:00:00"
COMPLETE_COLUMNS = [*TYPED_COLUMNS, "shipping_category", "shipping_carrier", "cancel_by", "sub_reason"]


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def on_raw(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: build(fx.raw_sales(spark, sf_dir))


def on_typed(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    REGISTRY[name] = lambda spark, sf_dir: build(fx.typed_sales(spark, sf_dir))


def on_stages(name: str, build) -> None:
    REGISTRY[name] = lambda spark, sf_dir: build(fx.stages(spark, sf_dir))


KEY = fv.KEY

# --- sources and sinks ------------------------------------------------------


@query
def scan_landing_text(spark, sf_dir):
    """The landing table through a separated text file with its own headers."""
    raw = fx.raw_sales(spark, sf_dir)
    headers = {new: old for old, new in fv.LANDING_RENAMES.items()}
    path = new_stage_path(spark, "landing-text")
    sinks.export_csv(landing.rename_columns(raw, headers), path, sep=fv.LANDING_SEPARATOR)
    # the file has its columns in one order, the table in another
    columns = [headers.get(c, c) for c in reversed(raw.columns)]
    return landing.rename_columns(landing.read_landing(spark, path, columns), fv.LANDING_RENAMES)


@query
def landing_rejects(spark, sf_dir):
    """Lines that are a field too short or too long, out of a landing text."""
    raw = fx.raw_sales(spark, sf_dir)
    fields = [F.coalesce(c, F.lit("")) for c in (KEY, "qty", "city")]
    line = (
        F.when(F.col(KEY).endswith("7"), F.concat_ws(";", *fields[:2]))
        .when(F.col(KEY).endswith("3"), F.concat_ws(";", *fields, F.lit("more")))
        .otherwise(F.concat_ws(";", *fields))
    )
    path = new_stage_path(spark, "broken-text")
    sinks.export_csv(raw.select(line.alias(f"{KEY};qty;city")), path)
    return landing.rejected_lines(spark, path)


@query
def scan_mapping_dedup(spark, sf_dir):
    """The two place lists out of one mapping file."""
    path = new_stage_path(spark, "mapping-text")
    sinks.export_csv(fx.map_place(spark, sf_dir), path)
    columns = ["city_new", "city", "province_new", "province"]
    cities, provinces = landing.split_places(landing.read_landing(spark, path, columns, ","))
    return cities.toDF("key", "value").select(F.lit("city").alias("list"), "*").unionByName(
        provinces.toDF("key", "value").select(F.lit("province").alias("list"), "*")
    )


@query
def snapshot_backup(spark, sf_dir):
    path = new_stage_path(spark, "snapshot")
    return sinks.snapshot(fx.typed_sales(spark, sf_dir), path)


@query
def export_roundtrip(spark, sf_dir):
    """The exported fact table as read back from CSV."""
    fact = star.fact_sales(fx.stages(spark, sf_dir).final)
    path = new_stage_path(spark, "export")
    sinks.export_csv(fact, path)
    return landing.read_landing(spark, path, fact.columns, ",")


# --- profiles of the landing table ------------------------------------------


@query
def rename_columns(spark, sf_dir):
    raw = fx.raw_sales(spark, sf_dir)
    headers = {new: old for old, new in fv.LANDING_RENAMES.items()}
    return landing.rename_columns(landing.rename_columns(raw, headers), fv.LANDING_RENAMES)


on_raw("peek_limit", lambda df: profile.peek(df, 100, fv.RAW_COLUMNS))
on_raw("distinct_len", lambda df: profile.key_length_outliers(df, KEY, fx.ID_LENGTH))
on_raw("id_format_check", lambda df: profile.key_prefix_outliers(df, KEY))
on_raw("id_format_strict", lambda df: profile.key_format_outliers(df, KEY, fx.ID_PATTERN))
on_raw("suffix_in_sequence", lambda df: profile.key_number_outliers(df, KEY, start=6, length=fx.KEY_DIGITS))
on_raw("dup_keys_or_null", lambda df: profile.duplicate_or_null_keys(df, KEY))
on_raw(
    "numeric_format_profile_qty",
    lambda df: profile.numeric_format_profile(df, ["qty"], fv.NUMERIC_SUFFIX),
)
on_raw(
    "numeric_format_profile_plain",
    lambda df: profile.numeric_format_profile(df, fv.NUMERIC_TEXT_COLUMNS),
)
on_raw("null_blank_profile", lambda df: profile.null_blank_profile(df, ["qty"]))
on_raw(
    "null_blank_profile_all",
    lambda df: profile.null_blank_profile(df, fv.NUMERIC_TEXT_COLUMNS + fv.CATEGORY_TEXT_COLUMNS),
)
on_raw("blank_categories", lambda df: profile.blank_values(df, "product_categories"))
on_raw("trim_profile", lambda df: profile.padding_profile(df, fv.CATEGORY_TEXT_COLUMNS))
on_raw("value_frequencies", lambda df: profile.value_frequencies(df, fv.CATEGORY_TEXT_COLUMNS))
on_raw("invalid_dates", lambda df: profile.invalid_dates(df, "order_date"))
on_raw("abnormal_dates", lambda df: profile.abnormal_dates(df, "order_date"))
on_raw("invalid_timestamps", lambda df: profile.invalid_timestamps(df, "order_timestamp"))
on_raw("date_reconcile", lambda df: profile.date_reconcile(df, "order_date", "order_timestamp"))
on_raw(
    "glob_date_check",
    lambda df: df.where(~matches_glob("order_date", fv.DATE_GLOB)).select(KEY, "order_date"),
)
on_raw(
    "sqlite_int_cast",
    lambda df: df.select(
        KEY,
        *[whole_number(c).alias(c) for c in ("qty", "weight_gr", "order_date", "pay_method")],
    ),
)
on_raw(
    "like_ci",
    lambda df: df.where(like_ignoring_case("order_status", fv.RECEIVED_PATTERN.upper())).select(
        KEY, "order_status"
    ),
)


def _clean_dates_as_text(spark, sf_dir):
    cleaned = fx.derive_cleaned_sales(spark, sf_dir)
    return cleaned.withColumn("order_date_clean", F.col("order_date_clean").cast("string"))


@query
def invalid_dates_after(spark, sf_dir):
    return profile.invalid_dates(_clean_dates_as_text(spark, sf_dir), "order_date_clean")


@query
def abnormal_dates_after(spark, sf_dir):
    return profile.abnormal_dates(_clean_dates_as_text(spark, sf_dir), "order_date_clean")


@query
def date_reconcile_after(spark, sf_dir):
    cleaned = _clean_dates_as_text(spark, sf_dir)
    return profile.date_reconcile(cleaned, "order_date_clean", "order_timestamp")


# --- duplicates -------------------------------------------------------------

on_raw("dup_groups", lambda df: dedup.duplicate_groups(df, fv.DUPLICATE_COLUMNS_RAW, KEY))
on_raw("dup_rows_full", lambda df: dedup.duplicate_rows(df, fv.DUPLICATE_COLUMNS_RAW, KEY))
on_raw(
    "dedup_one_per_group",
    lambda df: dedup.drop_one_per_duplicate_group(df, fv.DUPLICATE_COLUMNS_RAW, KEY),
)
on_raw(
    "dedup_keep_first",
    lambda df: dedup.drop_duplicates_keep_first(df, fv.DUPLICATE_COLUMNS_RAW, KEY),
)
on_typed("dup_groups_4col", lambda df: dedup.duplicate_groups(df, fv.DUPLICATE_COLUMNS_SHORT, KEY))
on_stages(
    "dup_groups_after",
    lambda s: dedup.duplicate_groups(s.repaired, fv.DUPLICATE_COLUMNS_CLEAN, KEY),
)
on_stages(
    "dup_rows_after",
    lambda s: dedup.duplicate_rows(s.repaired, fv.DUPLICATE_COLUMNS_CLEAN, KEY),
)
on_stages("dedup_after", lambda s: s.clean)
on_stages(
    "dup_rows_final",
    lambda s: dedup.duplicate_rows(s.final, fv.DUPLICATE_COLUMNS_CLEAN, KEY),
)

# --- cleaning ---------------------------------------------------------------

on_raw("drop_blank", lambda df: drop_blank(df, "qty"))
on_raw(
    "unify_status",
    lambda df: unify_value(df, "order_status", fv.RECEIVED_PATTERN, fv.RECEIVED).select(
        KEY, "order_status"
    ),
)
on_raw("date_repair", lambda df: date_repair(df, "order_date", "order_timestamp").select(
    KEY, "order_date", "order_timestamp", "order_date_clean"))


@query
def std_ship_method(spark, sf_dir):
    raw = fx.raw_sales(spark, sf_dir).select(KEY, "ship_method")
    return standardize(raw, "ship_method", fx.map_ship(spark), "ship_method", "ship_method_new")


@query
def std_pay_method(spark, sf_dir):
    raw = fx.raw_sales(spark, sf_dir).select(KEY, "pay_method")
    return standardize(raw, "pay_method", fx.map_pay(spark), "pay_method", "pay_method_new")


@query
def std_city(spark, sf_dir):
    raw = fx.raw_sales(spark, sf_dir).select(KEY, "city")
    return standardize(raw, "city", fx.map_place(spark, sf_dir), "city", "city_new")


@query
def std_province(spark, sf_dir):
    raw = fx.raw_sales(spark, sf_dir).select(KEY, "province")
    return standardize(raw, "province", fx.map_place(spark, sf_dir), "province", "province_new")


REGISTRY["load_typed"] = lambda spark, sf_dir: load_typed(fx.derive_cleaned_sales(spark, sf_dir))


def _typed_with_defects(spark, sf_dir):
    """The landing table loaded as it is: blank numbers become NULL."""
    raw = fx.raw_sales(spark, sf_dir)
    return load_typed(date_repair(raw, "order_date", "order_timestamp"))


REGISTRY["constraint_violations"] = lambda spark, sf_dir: constraint_violations(
    _typed_with_defects(spark, sf_dir), KEY, sales_constraints(key_length=fx.ID_LENGTH)
)


@query
def constraint_enforce(spark, sf_dir):
    """The rows that keep every constraint, through the form that stops on a bad row."""
    checks = sales_constraints(key_length=fx.ID_LENGTH)
    accepted, _ = quarantine(_typed_with_defects(spark, sf_dir), KEY, checks)
    return enforce(accepted, KEY, checks)


@query
def constraint_quarantine(spark, sf_dir):
    accepted, rejected = quarantine(_typed_with_defects(spark, sf_dir), KEY, sales_constraints(key_length=fx.ID_LENGTH))
    return accepted.select(KEY, F.lit("accepted").alias("side")).unionByName(
        rejected.select(KEY, F.lit("rejected").alias("side"))
    )


# --- the typed table --------------------------------------------------------

on_typed("key_uniqueness", lambda df: profile.key_uniqueness(df, KEY))


@query
def enrich_shipping(spark, sf_dir):
    typed = fx.typed_sales(spark, sf_dir).select(KEY, "ship_method", "cancel_reason")
    both = add_categories(typed, fx.map_ship(spark), fx.map_cancel(spark))
    return both.select(KEY, "ship_method", "shipping_category", "shipping_carrier")


@query
def enrich_cancel(spark, sf_dir):
    typed = fx.typed_sales(spark, sf_dir).select(KEY, "ship_method", "cancel_reason")
    both = add_categories(typed, fx.map_ship(spark), fx.map_cancel(spark))
    return both.select(KEY, "cancel_reason", "cancel_by", "sub_reason")


on_typed("per_item_weight", rules.per_item_weight)
on_typed("fast_ship_heavy", rules.fast_ship_heavy)
on_typed("weight_flag", lambda df: df.select(KEY, flags.weight_flag().alias("weight_flag")))
on_typed("payment_flag", lambda df: df.select(KEY, flags.payment_flag().alias("payment_flag")))
on_typed(
    "payment_segment",
    lambda df: df.select(KEY, "payment", flags.payment_segment().alias("payment_segment")),
)
on_typed("shipping_flag", lambda df: df.select(KEY, flags.shipping_flag().alias("shipping_flag")))
on_typed(
    "cod_status",
    lambda df: df.select(
        KEY, "order_status", "payment", "pay_method", flags.cod_status().alias("cod_payment_status")
    ).where(F.col("cod_payment_status").isin("COD_1", "COD_2")),
)
on_typed(
    "cod_status_dist",
    lambda df: df.groupBy(flags.cod_status().alias("cod_payment_status")).agg(
        F.count(F.lit(1)).alias("total")
    ),
)
on_typed(
    "ntile_payment",
    lambda df: distribution.ntile_profile(
        rules.drop_violations(df, "invalid_zero_payment"), F.col("payment"), "payment"
    ),
)
on_typed(
    "ntile_ship_gap",
    lambda df: distribution.ntile_profile(
        rules.drop_violations(
            rules.drop_violations(df, "invalid_zero_payment"), "invalid_ship_disc"
        ),
        flags.shipping_gap(),
        "selisih",
    ),
)
on_typed("high_value_orders", rules.high_value_orders)

on_typed("rule_returned_gt_qty", lambda df: rules.violations(df, "returned_gt_qty"))
on_typed("free_but_paid", lambda df: rules.violations(df, "free_but_paid").distinct())
on_typed("invalid_zero_payment", lambda df: rules.violations(df, "invalid_zero_payment"))
on_typed("drop_invalid_zero_payment", lambda df: rules.drop_violations(df, "invalid_zero_payment"))
on_typed("rule_discount_gt_total", lambda df: rules.violations(df, "discount_gt_total"))
on_typed("invalid_ship_disc", lambda df: rules.violations(df, "invalid_ship_disc"))
on_typed("drop_invalid_ship_disc", lambda df: rules.drop_violations(df, "invalid_ship_disc"))
on_typed("rule_ship_fee_gt_est", lambda df: rules.violations(df, "ship_fee_gt_est"))
on_typed("status_reason_mismatch", lambda df: rules.violations(df, "status_reason_mismatch"))
on_typed(
    "rule_return_not_done",
    lambda df: rules.violations(df, "return_not_done", all_columns=True),
)
on_typed("date_ts_mismatch", lambda df: rules.violations(df, "date_ts_mismatch"))
on_typed("future_dates", lambda df: df.where(rules.future(F.lit(AS_OF).cast("timestamp_ntz"))))
on_typed(
    "rule_incomplete_rows", lambda df: df.where(rules.incomplete(df, COMPLETE_COLUMNS))
)


@query
def validation_report(spark, sf_dir):
    """All row rules and all domain checks from one scan."""
    return rules.validate(
        fx.typed_sales(spark, sf_dir),
        complete=COMPLETE_COLUMNS,
        as_of=F.lit(AS_OF).cast("timestamp_ntz"),
        domains={
            "ship_method": (fx.map_ship(spark), "ship_method_new"),
            "pay_method": (fx.map_pay(spark), "pay_method_new"),
            "city": (fx.map_place(spark, sf_dir), "city_new"),
            "province": (fx.map_place(spark, sf_dir), "province_new"),
        },
        categories=fx.order_category(spark, sf_dir),
    )


def _domain(name, col, mapping, canonical):
    REGISTRY[name] = lambda spark, sf_dir: rules.domain_violations(
        fx.typed_sales(spark, sf_dir), col, mapping(spark, sf_dir), canonical
    )


_domain("domain_ship_method", "ship_method", lambda s, d: fx.map_ship(s), "ship_method_new")
_domain("domain_pay_method", "pay_method", lambda s, d: fx.map_pay(s), "pay_method_new")
_domain("domain_city", "city", fx.map_place, "city_new")
_domain("domain_province", "province", fx.map_place, "province_new")


@query
def high_value_by_category(spark, sf_dir):
    return rules.high_value_by_category(
        fx.typed_sales(spark, sf_dir), fx.order_category(spark, sf_dir)
    )


@query
def category_count_mismatch(spark, sf_dir):
    return rules.category_count_mismatch(
        fx.typed_sales(spark, sf_dir), fx.order_category(spark, sf_dir)
    )


# --- extracts ---------------------------------------------------------------


def _every_second(df):
    """A first extract and the rest, by the amount of pieces."""
    first = F.coalesce(F.col("qty") % 2 == 1, F.lit(False))
    return df.where(first), df.where(~first)


@query
def append_extract(spark, sf_dir):
    """Two extracts under one key; the second repeats orders of the first."""
    one, other = _every_second(fx.typed_sales(spark, sf_dir))
    path = new_stage_path(spark, "extracts")
    extracts.append_extract(one, path, KEY, "first")
    extracts.append_extract(other.unionByName(one.where("qty = 7")), path, KEY, "second")
    appended = extracts.read_extracts(spark, path).withColumn("reason", F.lit("appended"))
    return appended.unionByName(extracts.rejected_rows(spark, path)).select(KEY, "qty", "payment", "reason")


@query
def dedup_across_extracts(spark, sf_dir):
    """One row less per group of duplicates, of two extracts that were added in turn."""
    raw = fx.raw_sales(spark, sf_dir)
    original = F.coalesce((F.substring(KEY, 5, 1) == "0") | (F.substring(KEY, -1, 1) < "5"), F.lit(True))
    path = new_stage_path(spark, "extracts")
    extracts.add_extract(raw.where(original), path, fv.DUPLICATE_COLUMNS_RAW, KEY, "first")
    extracts.add_extract(raw.where(~original), path, fv.DUPLICATE_COLUMNS_RAW, KEY, "second")
    return extracts.read_deduplicated(spark, path)


@query
def ntile_payment_merged(spark, sf_dir):
    """Deciles out of the stored tallies of two extracts."""
    path = new_stage_path(spark, "tallies")
    for name, part in zip(("first", "second"), _every_second(fx.typed_sales(spark, sf_dir))):
        kept = rules.drop_violations(part, "invalid_zero_payment")
        tallies.add_tally(tallies.tally(kept, {"payment": F.col("payment"), "qty": F.col("qty")}), path, name)
    return tallies.tiles(tallies.read_tally(spark, path, ["payment"]), "payment", "payment")


@query
def value_frequencies_merged(spark, sf_dir):
    """Frequencies of all category columns out of the stored tallies of two extracts."""
    path = new_stage_path(spark, "tallies")
    raw = fx.raw_sales(spark, sf_dir)
    first = F.coalesce(F.col(KEY).endswith("1"), F.lit(False))
    for name, part in (("first", raw.where(first)), ("second", raw.where(~first))):
        tallies.add_tally(tallies.tally(part, {c: F.col(c) for c in fv.CATEGORY_TEXT_COLUMNS}), path, name)
    return tallies.frequencies(tallies.read_tally(spark, path))


@query
def relations_report(spark, sf_dir):
    """All declared relations in both directions, before and after the preparation."""
    done, inputs = fx.stages(spark, sf_dir), fx.inputs(spark, sf_dir)
    fact = star.fact_sales(done.final)
    tables = {
        "sales": inputs.sales, "order_categories": inputs.order_categories,
        "pay_methods": inputs.pay_methods, "ship_methods": inputs.ship_methods,
        "cancel_reasons": inputs.cancel_reasons, "places": inputs.places,
        "fact": fact, "dim_payments": star.dim_payments(inputs.pay_methods),
        "dim_order_category": star.dim_order_category(inputs.order_categories, fact),
    }
    return relations.check_relations(tables, relations.SALES_REFERENCES + relations.FACT_REFERENCES)


# --- audit log --------------------------------------------------------------


def _audit(name: str, entries: list[str]) -> None:
    def build(stages):
        if len(entries) == 1:
            return audit_batch(stages, entries[0])
        return audit_entries_of(stages, entries).drop("step")

    on_stages(name, build)


_audit("audit_duplicates", ["duplicates"])
_audit("audit_blank_qty", ["blank_qty"])
_audit("audit_blank_pay", ["blank_pay"])
_audit("audit_invalid_date", ["invalid_date"])
_audit("audit_status", ["status"])
_audit("audit_std_all", ["ship_method", "pay_method", "province", "city"])
_audit("audit_duplicates_clean", ["duplicates_clean"])
_audit("audit_zero_payment", ["zero_payment"])
_audit("audit_ship_disc", ["ship_disc"])
_audit("audit_weight_flag", ["weight_flag"])
_audit("audit_payment_flag", ["payment_flag"])
_audit("audit_shipping_flag", ["shipping_flag"])


@query
def audit_append_unique(spark, sf_dir):
    """Three appends of which the last repeats the first; ids go on counting."""
    batches = {e: audit_batch(fx.stages(spark, sf_dir), e) for e in ("blank_qty", "invalid_date", "blank_pay")}
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(batches["blank_qty"], log, mirror)
    audit.append_audit(batches["invalid_date"], log, mirror)
    audit.append_audit(batches["blank_qty"].unionByName(batches["blank_pay"]), log, mirror)
    return audit.read_log(spark, log).drop("logged_at")


@query
def audit_mirror(spark, sf_dir):
    """The mirror after two appends, one of them repeated under its name."""
    batches = {e: audit_batch(fx.stages(spark, sf_dir), e) for e in ("weight_flag", "ship_disc")}
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(batches["weight_flag"], log, mirror, batch_id="weight")
    audit.append_audit(batches["ship_disc"], log, mirror, batch_id="ship-disc")
    audit.append_audit(batches["ship_disc"], log, mirror, batch_id="ship-disc")
    return audit.read_log(spark, mirror).drop("logged_at")


@query
def audit_mirror_stream(spark, sf_dir):
    """The mirror after a stream of entries has been written to both sinks."""
    source = new_stage_path(spark, "entries")
    entries = sinks.create_table_as(audit_batch(fx.stages(spark, sf_dir), "payment_flag"), source)
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    stream = spark.readStream.schema(entries.schema).parquet(source)
    mirror_stream(stream, log, mirror, new_stage_path(spark, "offsets")).awaitTermination()
    return audit.read_log(spark, mirror).drop("logged_at", "log_id")


@query
def audit_summary(spark, sf_dir):
    """Counts of a log of two batches, as its ledger holds them."""
    log, _ = fx.audit_log(spark, sf_dir)
    return audit.log_summary(spark, log)



# --- star schema and the whole run ------------------------------------------

on_stages("fact_sales", lambda s: star.fact_sales(s.final))


@query
def dim_order_category(spark, sf_dir):
    fact = star.fact_sales(fx.stages(spark, sf_dir).final)
    return star.dim_order_category(fx.order_category(spark, sf_dir), fact)


def _with_orders(spark, sf_dir, payments):
    """A payment dimension with the fact orders of each of its rows."""
    fact = star.fact_sales(fx.stages(spark, sf_dir).final)
    orders = fact.groupBy("pay_method").agg(F.count(F.lit(1)).alias("orders"))
    return payments.join(orders, "pay_method", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


@query
def dim_payments(spark, sf_dir):
    return _with_orders(spark, sf_dir, star.dim_payments(fx.map_pay(spark)))


@query
def dim_payments_unique(spark, sf_dir):
    return _with_orders(spark, sf_dir, star.dim_payments_unique(fx.map_pay(spark)))


@query
def star_rollup(spark, sf_dir):
    fact = star.fact_sales(fx.stages(spark, sf_dir).final)
    return star.star_rollup(
        fact, fx.order_category(spark, sf_dir), star.dim_payments_unique(fx.map_pay(spark))
    )


SLICED = "year = '1997' AND half = 1"


@query
def star_rollup_sliced(spark, sf_dir):
    """The rollup of half a year's months, out of a fact table published by month."""
    path = new_stage_path(spark, "fact")
    fact = sinks.publish(star.fact_sales(fx.stages(spark, sf_dir).final), path, partition_by=[star.SLICE])
    months = write_stage(star.calendar(fact), "calendar")
    payments = star.dim_payments_unique(fx.map_pay(spark))
    return star.sliced_rollup(fact, fx.order_category(spark, sf_dir), payments, months, F.expr(SLICED))


@query
def prepare_summary(spark, sf_dir):
    """The whole preparation: rows of every stage and of the stored results."""
    done = prepare(fx.inputs(spark, sf_dir), new_stage_path(spark, "prepared"))
    return stage_counts(spark, done.counts).drop("step")
