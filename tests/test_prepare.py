"""The whole preparation: from files, its invariants, repetition, streaming."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from orderloom.operators import audit, dedup, profile, rules, star
from orderloom.operators.typed import sales_constraints
from orderloom.plans import fixed_values as fv
from orderloom.plans import prepare as prepare_module
from orderloom.plans.prepare import (
    MAPPING_COLUMNS, STAGE_NAMES, all_audit_entries, audit_batches, prepare, read_inputs, stage_counts,
)
from orderloom.plans.stage_store import new_stage_path, stage_paths
from orderloom.sources import landing, sinks
from orderloom.streaming.audit_stream import mirror_stream


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """The derived inputs as read from text; ids that are NULL or shared have tests of their own."""
    given = fx.inputs(spark, sf_dir)
    good = F.col("order_id").isNotNull() & (F.col("order_id") != fx.SHARED)
    return type(given)(**{**given.__dict__, "sales": given.sales.where(good).na.fill("")})


@pytest.fixture(scope="module")
def out(spark):
    return new_stage_path(spark, "prepared")


@pytest.fixture(scope="module")
def done(inputs, out):
    return prepare(inputs, out, csv=True, keep_stages=True)


def test_files_give_the_same_result(spark, inputs, done):
    base = new_stage_path(spark, "files")
    headers = {new: old for old, new in fv.LANDING_RENAMES.items()}
    # the file may order its columns as it likes
    shuffled = landing.rename_columns(inputs.sales.select(*sorted(inputs.sales.columns)), headers)
    sinks.export_csv(shuffled, f"{base}/sales", sep=";")
    names = ["ship_methods", "pay_methods", "cancel_reasons", "places", "order_categories"]
    for name in names:
        sinks.export_csv(getattr(inputs, name), f"{base}/{name}")
    paths = {name: f"{base}/{name}" for name in names}
    read = read_inputs(spark, f"{base}/sales", **paths)
    again = prepare(read, f"{base}/out")
    assert rows(again.fact) == rows(done.fact)
    assert rows(again.dim_order_category) == rows(done.dim_order_category)
    with pytest.raises(ValueError, match="places"):
        read_inputs(spark, f"{base}/sales", **{n: p for n, p in paths.items() if n != "places"})


def test_rows_in_less_rows_deleted_is_rows_out(done):
    log = done.audit_log.where(F.col("solution").contains("elete"))
    deleted = log.select("order_id").distinct().count()
    assert deleted == log.count()
    assert done.stages.raw.count() - deleted == done.fact.count()


def test_deleted_orders_are_the_logged_ones(done):
    gone = done.stages.raw.select("order_id").subtract(done.fact.select("order_id"))
    logged = done.audit_log.where(F.col("solution").contains("elete")).select("order_id")
    assert rows(gone) == rows(logged)


def test_deleting_rules_find_nothing_afterwards(done):
    report = {r.rule: r.violations for r in rules.validate(done.stages.final).collect()}
    assert report["invalid_zero_payment"] == report["invalid_ship_disc"] == 0
    assert profile.null_blank_profile(done.stages.clean, ["qty", "pay_method"]).count() == 0


def test_ids_follow_the_steps(done):
    ids = [r.log_id for r in done.audit_log.orderBy("log_id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    firsts = done.audit_log.groupBy("attribute", "reason").agg(F.min("log_id").alias("first"))
    order = [r.attribute for r in firsts.orderBy("first").collect()]
    assert order.index("qty") < order.index("ship_method") < order.index("pay_method")


def test_mirror_is_a_copy(spark, done, out):
    assert rows(audit.read_log(spark, f"{out}/backup_audit_log")) == rows(done.audit_log)


def test_fact_and_dimensions_fit(done):
    fact = done.fact
    unique = star.dim_payments_unique(fx.map_pay(fact.sparkSession))
    known = fact.where("pay_method <> 'Barter'")
    assert fact.join(unique, "pay_method").count() == known.count() < fact.count()
    assert done.dim_order_category.join(fact, "order_id", "left_anti").count() == 0


def test_csv_export_holds_the_fact(spark, done, out):
    text = landing.read_landing(spark, f"{out}/csv/fact_sales", sep=",")
    assert text.columns == done.fact.columns
    assert text.count() == done.fact.count()


def test_running_again_changes_nothing(inputs, out, done):
    before = rows(done.fact), rows(done.audit_log.drop("logged_at"))
    made = set(stage_paths(done.fact.sparkSession))
    again = prepare(inputs, out)
    assert set(stage_paths(done.fact.sparkSession)) == made and again.stages is None
    assert (rows(again.fact), rows(again.audit_log.drop("logged_at"))) == before


def test_another_run_adds_only_what_is_new(spark, inputs):
    base = new_stage_path(spark, "runs")
    some = F.substring("order_id", -1, 1) < "5"
    part = type(inputs)(**{**inputs.__dict__, "sales": inputs.sales.where(some)})
    first = prepare(part, base, run="monday", backup=True)
    assert sinks.read_published(spark, f"{base}/backup_sales").count() == first.counts["flagged"]
    before = rows(first.audit_log)
    whole = prepare(inputs, base, run="tuesday", keep_stages=True)
    log = whole.audit_log
    assert set(before) <= set(rows(log))
    assert log.select("log_id").distinct().count() == log.count()
    assert log.select(*fv.AUDIT_KEY).distinct().count() == log.count()
    assert {r.order_id for r in log.where("attribute = 'city'").collect()} == {
        r.order_id for r in whole.stages.with_pay_method.select("order_id").collect()
    }


def test_unnamed_runs_keep_the_log(spark, inputs):
    base = new_stage_path(spark, "unnamed")
    some = F.substring("order_id", -1, 1) < "5"
    part = type(inputs)(**{**inputs.__dict__, "sales": inputs.sales.where(some)})
    rest = type(inputs)(**{**inputs.__dict__, "sales": inputs.sales.where(~some)})
    before = rows(prepare(part, base).audit_log)
    log = prepare(rest, base).audit_log
    assert before and set(before) < set(rows(log))
    assert log.select("log_id").distinct().count() == log.count()


def test_constraints_filter_or_stop(inputs, spark):
    out = new_stage_path(spark, "kept")
    kept = prepare(inputs, out, constraints=sales_constraints(key_length=fx.ID_LENGTH))
    assert kept.fact.count() == kept.counts["final"] == kept.counts["fact"] > 0
    assert kept.counts["clean"] - kept.counts["flagged"] == sinks.published_rows(spark, f"{out}/rejected_sales") > 0
    bad = inputs.sales.withColumn("qty", F.when(F.col("order_id") == "ORD_00000000000000000005", "0").otherwise(F.col("qty")))
    broken = type(inputs)(**{**inputs.__dict__, "sales": bad})
    fewer = prepare(broken, new_stage_path(spark, "fewer"), constraints=sales_constraints(key_length=fx.ID_LENGTH))
    assert fewer.counts["flagged"] == kept.counts["flagged"] - 1
    assert fewer.counts["clean"] == kept.counts["clean"]
    with pytest.raises(Exception, match="qty > 0"):
        prepare(broken, new_stage_path(spark, "stop"), constraints=sales_constraints(key_length=fx.ID_LENGTH), strict=True)


def test_fused_and_separate_entries_agree(done):
    fused = all_audit_entries(done.stages)
    separate = audit_batches(done.stages)
    columns = separate["city"].columns
    assert rows(fused.select(*columns)) == sorted(
        (row for df in separate.values() for row in rows(df)), key=repr
    )
    # two scans and two groupings for the 13 changes that are logged row by row, and
    # one per duplicate pass over the few first keys
    plan = fused._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2
    assert plan.count("Aggregate [order_id") == 4


def test_repeated_order_ids_are_grouped(spark, inputs):
    double = inputs.sales.unionByName(inputs.sales.where("order_id = 'ORD_00000000000000000005'").withColumn("city", F.lit("x")))
    done = prepare(type(inputs)(**{**inputs.__dict__, "sales": double}), new_stage_path(spark, "double"))
    again = done.audit_log.where("order_id = 'ORD_00000000000000000005' and attribute = 'city'").collect()
    assert [r.problematic_rows for r in again] == [2]


def test_second_pass_finds_what_the_first_could_not(done):
    # a copy whose date was written in another form
    assert done.stages.duplicates_clean.count() > 0
    left = dedup.duplicate_groups(done.stages.clean, fv.DUPLICATE_COLUMNS_CLEAN, fv.KEY)
    assert left.count() == 0


def test_counts_are_those_of_the_tables(done):
    stages = done.stages
    assert done.counts == {
        **{name: getattr(stages, name).count() for name in STAGE_NAMES},
        **{name: getattr(done, name).count() for name in ("fact", "dim_order_category", "dim_payments", "audit_log")},
    }
    for name, keys in stages.keys.items():
        assert keys == getattr(stages, name).where("order_id IS NOT NULL").count()


def test_a_killed_run_leaves_the_last_results(spark, inputs, monkeypatch):
    base = new_stage_path(spark, "killed")
    before = rows(prepare(inputs, base).fact)
    made = set(stage_paths(spark))
    part = type(inputs)(**{**inputs.__dict__, "sales": inputs.sales.where("order_id < 'ORD_00000000000000000100'")})

    def broken(df):
        return star.fact_sales(df).withColumn("qty", F.raise_error(F.lit("killed")).cast("bigint"))

    monkeypatch.setattr(prepare_module, "star", type("Broken", (), {**star.__dict__, "fact_sales": staticmethod(broken)}))
    with pytest.raises(Exception, match="killed"):
        prepare(part, base)
    monkeypatch.undo()
    assert rows(sinks.read_published(spark, f"{base}/fact_sales")) == before
    assert set(stage_paths(spark)) == made
    assert rows(prepare(part, base).fact) != before


def test_stage_counts_only_fall(done):
    counts = {r.stage: r.rows for r in stage_counts(done.fact.sparkSession, done.counts).collect()}
    chain = ["raw", "without_duplicates", "with_qty", "with_pay_method", "repaired", "clean",
             "flagged", "with_valid_payment", "final"]
    assert [counts[c] for c in chain] == sorted((counts[c] for c in chain), reverse=True)


def test_stream_takes_up_where_it_stopped(spark, done):
    batches = audit_batches(done.stages)
    base = new_stage_path(spark, "stream")
    source, log, mirror = f"{base}/in", f"{base}/log", f"{base}/mirror"
    first, second = batches["weight_flag"], batches["ship_disc"]
    first.coalesce(1).write.parquet(source)
    stream = lambda: spark.readStream.schema(first.schema).parquet(source)
    mirror_stream(stream(), log, mirror, f"{base}/offsets").awaitTermination()
    second.coalesce(1).write.mode("append").parquet(source)
    mirror_stream(stream(), log, mirror, f"{base}/offsets").awaitTermination()
    mirror_stream(stream(), log, mirror, f"{base}/offsets").awaitTermination()
    columns = first.columns
    expected = rows(first.unionByName(second))
    assert rows(audit.read_log(spark, log).select(*columns)) == expected
    assert rows(audit.read_log(spark, mirror)) == rows(audit.read_log(spark, log))
    # a stream that lost its offsets finds its entries in the log
    mirror_stream(stream(), log, mirror, f"{base}/new-offsets").awaitTermination()
    assert rows(audit.read_log(spark, log).select(*columns)) == expected
    # a stream of another source replaces nothing
    other = batches["payment_flag"]
    other.write.parquet(f"{base}/other")
    more = spark.readStream.schema(other.schema).parquet(f"{base}/other")
    mirror_stream(more, log, mirror, f"{base}/other-offsets").awaitTermination()
    assert rows(audit.read_log(spark, log).select(*columns)) == rows(first.unionByName(second).unionByName(other))


def test_command_line(spark, inputs, capsys):
    from orderloom.__main__ import main

    base = new_stage_path(spark, "command")
    headers = {new: old for old, new in fv.LANDING_RENAMES.items()}
    sinks.export_csv(landing.rename_columns(inputs.sales, headers), f"{base}/sales", sep=";")
    arguments = ["--sales", f"{base}/sales", "--out", f"{base}/out", "--csv"]
    arguments += ["--key-length", str(fx.ID_LENGTH)]
    for name in MAPPING_COLUMNS:
        sinks.export_csv(getattr(inputs, name), f"{base}/{name}")
        arguments += ["--" + name.replace("_", "-"), f"{base}/{name}"]
    main(arguments)
    shown = capsys.readouterr().out
    assert "without_duplicates" in shown and "Delete invalid zero payment" in shown
    assert sinks.read_published(spark, f"{base}/out/fact_sales").count() > 0
