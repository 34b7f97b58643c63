"""What the physical plans must and must not contain."""

import ast
import contextlib
import io
import pathlib
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.catalog import REGISTRY
from orderloom.operators import distribution, profile
from orderloom.plans.stage_store import write_stage

ROOT = pathlib.Path(__file__).resolve().parent.parent


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ROW_LOCAL = [
    "drop_blank", "unify_status", "date_repair", "weight_flag", "payment_flag", "shipping_flag",
    "payment_segment", "fact_sales", "invalid_zero_payment", "drop_invalid_ship_disc",
]


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_local_steps_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan(REGISTRY[name](spark, sf_dir))


def test_lookups_broadcast_the_mapping_and_leave_the_rows_in_place(spark, sf_dir):
    text = plan(fx.derive_typed_sales(spark, sf_dir))
    assert text.count("BroadcastHashJoin") == 6
    assert "SortMergeJoin" not in text
    # the only shuffles are those of the mapping tables, below the broadcasts
    assert text.count("Exchange hashpartitioning") == 6


def test_typed_load_is_compiled(spark, sf_dir):
    """No generated method exceeds the 8000 bytes above which the JVM interprets."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    text = io.StringIO()
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        with contextlib.redirect_stdout(text):
            fx.derive_typed_sales(spark, sf_dir).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_lookups_beyond_the_broadcast_size_are_shuffled(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        df = REGISTRY["std_city"](spark, sf_dir)
        assert "BroadcastHashJoin" not in plan(df)
        shuffled = sorted(df.collect(), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert shuffled == sorted(REGISTRY["std_city"](spark, sf_dir).collect(), key=repr)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(REGISTRY["high_value_orders"](spark, sf_dir))
    assert "GreaterThan(payment,100000)" in text
    assert "ReadSchema: struct<order_id:string,qty:bigint,payment:bigint>" in text


def test_tiles_rank_distinct_values_only(spark):
    # the one place that sees everything sees partitions of the sort, not rows
    df = write_stage(spark.range(50000).select((F.col("id") % 4321).alias("v")), "tiles")
    out = distribution.ntile_profile(df, F.col("v"), "v")
    text = plan(out)
    assert text.count("SinglePartition") == 1
    single = text[: text.index("SinglePartition")].splitlines()[-3:]
    assert any("part" in line for line in single)
    assert [r.total for r in out.collect()] == [5000] * 10


def test_fused_reports_scan_once(spark, sf_dir):
    for name in ("null_blank_profile_all", "numeric_format_profile_plain", "trim_profile",
                 "date_reconcile"):
        assert plan(REGISTRY[name](spark, sf_dir)).count("FileScan") == 1


def test_validation_reads_the_table_once(spark, sf_dir):
    text = plan(REGISTRY["validation_report"](spark, sf_dir))
    assert text.count("typed_sales-") == 1
    # four domains, and the category counts of an order
    assert text.count("BroadcastHashJoin") + text.count("SortMergeJoin") == 5


def test_library_fetches_no_tables():
    """No collect, pandas or RDD in library code; ``first`` only on one-row totals."""
    banned = {"collect", "toPandas", "toLocalIterator", "rdd", "localCheckpoint", "crossJoin",
              "cache", "persist", "foreach", "pandas_udf", "udf"}
    for path in (ROOT / "orderloom").rglob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute):
                assert node.attr not in banned, f"{path}: {node.attr}"


def test_profiles_drop_clean_values_before_the_shuffle(spark, sf_dir):
    text = plan(profile.padding_profile(fx.raw_sales(spark, sf_dir), ["city", "ship_method"]))
    assert text.index("Exchange hashpartitioning") < text.index("Filter")
