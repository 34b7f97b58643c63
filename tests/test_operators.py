"""Operators on literal rows, against brute force and on their hard cases."""

import datetime as dt
import threading
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom.operators import audit, dedup, distribution, flags, profile, rules, star, typed
from orderloom.operators.standardize import (
    date_repair,
    drop_blank,
    drop_where,
    enrich,
    not_in_domain,
    standardize,
    unify_value,
)
from orderloom.plans import fixed_values as fv
from orderloom.plans.group_joins import join_groups, without_keys
from orderloom.plans.stage_store import new_stage_path, stage_paths, write_stage
from orderloom.sources import landing, ledger, sinks


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- duplicates -------------------------------------------------------------

COPIES = [
    ("k1", "a", "x"), ("k2", "a", "x"),                     # two
    ("k3", "b", None), ("k4", "b", None), ("k5", "b", None),  # three, with NULL
    ("k6", "c", "x"), ("k7", None, "c"),                     # none
]


@pytest.fixture(scope="module")
def copies(spark):
    return spark.createDataFrame(COPIES, "k string, u string, v string")


def test_duplicate_groups_show_the_smallest_key(copies):
    got = rows(dedup.duplicate_groups(copies, ["u", "v"], "k"))
    assert got == [(2, "k1", "a", "x"), (3, "k3", "b", None)]


def test_duplicate_rows_list_all_members(copies):
    got = rows(dedup.duplicate_rows(copies, ["u", "v"], "k"))
    assert [(r[0], r[3]) for r in got] == [("k1", 2), ("k2", 2), ("k3", 3), ("k4", 3), ("k5", 3)]


def test_one_row_per_group_is_deleted_not_all_surplus(copies):
    once = dedup.drop_one_per_duplicate_group(copies, ["u", "v"], "k")
    assert [r[0] for r in rows(once)] == ["k2", "k4", "k5", "k6", "k7"]
    twice = dedup.drop_one_per_duplicate_group(once, ["u", "v"], "k")
    assert [r[0] for r in rows(twice)] == ["k2", "k5", "k6", "k7"]


def test_keep_first(copies):
    kept = dedup.drop_duplicates_keep_first(copies, ["u", "v"], "k")
    assert [r[0] for r in rows(kept)] == ["k1", "k3", "k6", "k7"]


def test_hash_collisions_change_nothing(spark):
    # xxhash64 skips NULLs, so these two rows share a hash without being equal
    df = spark.createDataFrame([("k1", "a", None), ("k2", None, "a")], "k string, u string, v string")
    assert df.select(F.xxhash64("u", "v")).distinct().count() == 1
    assert rows(dedup.duplicate_groups(df, ["u", "v"], "k")) == []
    assert rows(dedup.duplicate_rows(df, ["u", "v"], "k")) == []


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["x", None])), min_size=1, max_size=40))
def test_duplicates_against_brute_force(spark, pairs):
    data = [(f"k{i:02d}", u, v) for i, (u, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k string, u string, v string")
    groups = defaultdict(list)
    for k, u, v in data:
        groups[u, v].append(k)
    firsts = {min(g) for g in groups.values() if len(g) > 1}
    got = dedup.drop_one_per_duplicate_group(df, ["u", "v"], "k")
    assert {r.k for r in got.collect()} == {k for k, _, _ in data} - firsts


@pytest.fixture
def no_broadcast(spark):
    """Joins are shuffled, and partitions above a few kilobytes count as skewed."""
    given_values = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4kb",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1kb",
    }
    before = {k: spark.conf.get(k, None) for k in given_values}
    for k, v in given_values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("how", ["left_semi", "inner", "left"])
@pytest.mark.parametrize("shuffled", [False, True])
def test_join_gives_the_same_by_broadcast_and_by_shuffle(spark, how, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    # one group holds a third of all rows; NULL is a group like any other
    data = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"g{i % 11}") for i in range(300)]
    df = spark.createDataFrame(data, "id int, g string")
    wanted = df.groupBy("g").agg(F.count(F.lit(1)).alias("n")).where("g is null or g in ('hot', 'g1')")
    groups = write_stage(wanted, "test-groups")
    got = join_groups(df, groups, ["g"], how)
    sizes = {r.g: r.n for r in groups.collect()}
    if how == "left_semi":
        expected = [(i, g) for i, g in data if g in sizes]
    elif how == "inner":
        expected = [(i, g, sizes[g]) for i, g in data if g in sizes]
    else:
        expected = [(i, g, sizes.get(g)) for i, g in data]
    assert rows(got) == sorted(expected, key=repr)


def test_a_third_of_equal_rows_is_split(spark, no_broadcast):
    # the copies agree in every column, the key included; long, as they compress well
    copy = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id"))
    long = F.when(copy == -1, F.repeat(F.sha2(F.lit("same"), 256), 60)).otherwise(copy.cast("string"))
    df = write_stage(spark.range(0, 30000, 1, 16).select(copy.alias("k"), long.alias("v")), "copies")
    got = dedup.duplicate_rows(df, ["v"], "k")
    assert got.agg(F.count("*"), F.min("group_rows")).first() == (10000, 10000)
    groups = write_stage(df.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "all-groups")
    joined = join_groups(df, groups, ["v"], "inner")
    assert len(joined.collect()) == 30000
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shuffled", [False, True])
def test_without_keys_keeps_null_keys(spark, shuffled, request):
    if shuffled:
        request.getfixturevalue("no_broadcast")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = write_stage(spark.createDataFrame([("a",)], "k string"), "test-keys")
    assert rows(without_keys(df, keys, "k")) == [("b",), (None,)]


# --- cleaning ---------------------------------------------------------------


def test_unknown_conditions_delete_nothing(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "c string")
    assert rows(drop_blank(df, "c")) == [("x",), (None,)]
    assert rows(drop_where(df, F.col("c") == "")) == [("x",), (None,)]


def test_standardize(spark):
    df = spark.createDataFrame([("COD",), ("cod",), ("x",), ("",), (None,), ("n",)], "c string")
    mapping = spark.createDataFrame(
        [("COD", "Cash"), ("COD", "Cash"), ("", "never"), ("n", None), (None, "never")],
        "c string, c_new string",
    )
    once = standardize(df, "c", mapping, "c", "c_new")
    assert rows(once) == sorted([("Cash",), ("cod",), ("x",), ("",), (None,), (None,)], key=repr)
    assert rows(standardize(once, "c", mapping, "c", "c_new")) == rows(once)


def test_enrich_is_null_when_not_found_and_never_fans_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    mapping = spark.createDataFrame([("a", "1", "p"), ("a", "1", "p")], "c string, v string, w string")
    got = enrich(df, "c", mapping, "c", {"v": "new_v", "w": "new_w"})
    assert rows(got) == [("a", "1", "p"), ("b", None, None), (None, None, None)]


def test_domain_ignores_blanks_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("z",), ("",), (None,)], "c string")
    domain = spark.createDataFrame([("a",), ("",), (None,)], "d string")
    assert rows(not_in_domain(df, "c", domain, "d")) == [("",), ("z",)]


def test_unify_value(spark):
    df = spark.createDataFrame([("xx PESANAN yy",), ("other",), (None,)], "c string")
    assert rows(unify_value(df, "c", "%pesanan%", "P")) == [("P",), ("other",), (None,)]


def test_date_repair(spark):
    df = spark.createDataFrame(
        [("2024-05-06", "2024-01-01 10:00"), ("06/05/2024", "2024-01-01 10:00"),
         ("", "2024-01-01 10:00"), ("2024-13-40", "2024-01-01 10:00"), (None, "bad")],
        "d string, t string",
    )
    got = [r.c for r in date_repair(df, "d", "t", "c").collect()]
    day, first = dt.date(2024, 5, 6), dt.date(2024, 1, 1)
    assert got == [day, day, first, first, None]
    # a value that is there is not touched
    again = date_repair(df.withColumn("c", F.lit(dt.date(2000, 1, 1))), "d", "t", "c")
    assert {r.c for r in again.collect()} == {dt.date(2000, 1, 1)}


# --- profiles ---------------------------------------------------------------


def test_profiles_of_nulls_and_blanks(spark):
    df = spark.createDataFrame([("",), ("",), (None,), ("x ",)], "c string")
    assert rows(profile.null_blank_profile(df, ["c"])) == [("c", "blank", 2, 2), ("c", "null", 0, 1)]
    assert rows(profile.blank_values(df, "c")) == [("", 2), (None, 0)]
    assert rows(profile.padding_profile(df, ["c"])) == [
        ("c", "x ", 1, "Problem"), ("c", None, 0, "Problem"),
    ]


def test_numeric_format_profile_strips_everywhere(spark):
    df = spark.createDataFrame([("10.0",), ("10.05",), ("7",), ("",)], "qty string")
    got = rows(profile.numeric_format_profile(df, ["qty"], {"qty": ".0"}))
    assert got == [("qty", "", 0, 1, 1), ("qty", "10.05", 3, 2, 1)]


def test_key_checks(spark):
    keys = ["ORD_0000001", "ORD_0021001", "ORD_0021002", "XRD_0000001", "XRD-0000001", "ORD_12ab"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    assert rows(profile.key_prefix_outliers(df, "k")) == [("XRD", "-")]
    assert rows(profile.key_format_outliers(df, "k")) == [
        ("ORD_12ab",), ("XRD-0000001",), ("XRD_0000001",),
    ]
    assert rows(profile.key_number_outliers(df, "k")) == [("ORD_0021002", 21002)]
    assert rows(profile.key_length_outliers(df, "k")) == [(8,)]


def test_key_uniqueness_and_repeats(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(profile.duplicate_or_null_keys(df, "k")) == [("a", 2), (None, 0)]
    assert rows(profile.key_uniqueness(df, "k")) == [(4, 2, "Not Unique")]
    assert rows(profile.key_uniqueness(df.limit(0), "k")) == [(0, 0, "Unique")]


def test_reconcile_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "d string, t string")
    assert rows(profile.date_reconcile(empty, "d", "t")) == [("order_date", 0, None, None, None)]


# --- distribution -----------------------------------------------------------


def brute_ntile(data, tiles):
    ordered = sorted(data, key=lambda v: (v is not None, v))
    q, r = divmod(len(ordered), tiles)
    out, at = [], 0
    for b in range(1, tiles + 1):
        part = ordered[at : at + q + (b <= r)]
        at += len(part)
        if part:
            known = [v for v in part if v is not None]
            mean = sum(known) / len(known) if known else None
            out.append((b, mean, min(known, default=None), max(known, default=None), len(part)))
    return out


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.one_of(st.none(), st.integers(-(10**12), 10**12), st.integers(-3, 3), st.just(0)),
        max_size=120,
    ),
    st.integers(1, 12),
)
def test_ntile_against_brute_force(spark, data, tiles):
    df = spark.createDataFrame([(v,) for v in data], "v bigint")
    got = [tuple(r) for r in distribution.ntile_profile(df, F.col("v"), "v", tiles).collect()]
    expected = brute_ntile(data, tiles)
    assert [(g[0], *g[2:]) for g in got] == [(e[0], *e[2:]) for e in expected]
    for g, e in zip(got, expected):
        assert g[1] is e[1] is None or abs(g[1] - e[1]) <= 0.5 + 1e-9 * abs(e[1])


# --- flags and rules --------------------------------------------------------


def typed_row(**given_values):
    base = dict(
        order_id="ORD_0000001", qty=1, weight_gr=100, returned_qty=0, discount=0,
        product_categories="x", category_count=1, order_status="Selesai",
        cancel_reason="Tidak dibatalkan", ship_method="Reguler", pay_method="ShopeePay",
        city="c", province="p", ship_fee=0, ship_disc=0, payment=1000, ship_est=0,
        order_timestamp=dt.datetime(2001, 6, 1, 10), order_date_clean=dt.date(2001, 6, 1),
        shipping_category="Regular", shipping_carrier="SPX", cancel_by="-", sub_reason="-",
    )
    return {**base, **given_values}


SCHEMA = (
    "order_id string, qty long, weight_gr long, returned_qty long, discount long, "
    "product_categories string, category_count long, order_status string, cancel_reason string, "
    "ship_method string, pay_method string, city string, province string, ship_fee long, "
    "ship_disc long, payment long, ship_est long, order_timestamp timestamp_ntz, "
    "order_date_clean date, shipping_category string, shipping_carrier string, "
    "cancel_by string, sub_reason string"
)


def typed_frame(spark, *changes):
    data = [typed_row(**c) for c in changes]
    names = [p.split()[0] for p in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in data], SCHEMA)


FLAG_CASES = [
    ("payment_flag", dict(payment=100000), "Normal"),
    ("payment_flag", dict(payment=100001, qty=2), "Suspicious_High_Value_Low_Qty"),
    ("payment_flag", dict(payment=100001, qty=2, product_categories="a SEAL / baut / roof"),
     "High_Value_Heavy_Category"),
    ("payment_flag", dict(payment=100001, qty=10), "High_Value_Bulk"),
    ("payment_flag", dict(payment=100001, qty=5), "High_Value"),
    ("payment_flag", dict(payment=None), "Normal"),
    ("payment_segment", dict(payment=100000), "High Value"),
    ("payment_segment", dict(payment=50000), "Mid Value"),
    ("payment_segment", dict(payment=None), "Low Value"),
    ("shipping_flag", dict(ship_fee=40000, ship_est=0), "Suspicious"),  # no share of 0
    ("shipping_flag", dict(ship_fee=40000, ship_est=1), "Outlier"),
    ("shipping_flag", dict(ship_fee=100, ship_est=15100), "Normal"),
    ("shipping_flag", dict(ship_fee=100, ship_est=15101), "Suspicious"),
    ("weight_flag", dict(weight_gr=20001), "Invalid_Per_Item_Too_Heavy"),
    ("weight_flag", dict(weight_gr=20000), "Suspicious_Per_Item_Heavy"),
    ("weight_flag", dict(weight_gr=100001, qty=10, shipping_category="Instant"),
     "Invalid_Instant_Too_Heavy"),
    ("weight_flag", dict(weight_gr=100001, qty=10, shipping_category="Same Day"),
     "Suspicious_Fast_Shipping_Heavy"),
    ("weight_flag", dict(weight_gr=100001, qty=10, shipping_category=None), "Normal"),
    ("cod_status", dict(pay_method="Cash On Delivery", payment=0), "COD_1"),
    ("cod_status", dict(pay_method="Cash On Delivery", order_status="Batal"), "COD_2"),
    ("cod_status", dict(pay_method="Cash On Delivery"), "COD_3"),
    ("cod_status", dict(pay_method="Cash On Delivery", payment=0, order_status="Telah Dikirim"),
     "COD_4"),
    ("cod_status", dict(pay_method="Cash On Delivery", order_status="Sedang Dikirim"), "COD_5"),
    ("cod_status", dict(pay_method="Cash On Delivery", payment=0, order_status="Batal"), "COD_6"),
    ("cod_status", dict(pay_method="Cash On Delivery", order_status="?"), "COD_Other"),
    ("cod_status", dict(), "Non_COD"),
]


def test_flags(spark):
    df = typed_frame(spark, *[case for _, case, _ in FLAG_CASES])
    got = df.select(
        *[getattr(flags, n)().alias(n) for n in dict.fromkeys(c[0] for c in FLAG_CASES)]
    ).collect()
    for row, (name, case, expected) in zip(got, FLAG_CASES):
        assert row[name] == expected, case


def test_zero_payment_rule(spark):
    df = typed_frame(
        spark,
        dict(order_id="bad", payment=0),
        dict(order_id="cancelled", payment=0, order_status="Batal"),
        dict(order_id="free", payment=0, pay_method="Free (No Payment)"),
        dict(order_id="unknown", payment=0, order_status=None),
        dict(order_id="null", payment=None),
    )
    broken = [r.order_id for r in rules.violations(df, "invalid_zero_payment").collect()]
    assert broken == ["bad", "unknown"]
    kept = [r.order_id for r in rules.drop_violations(df, "invalid_zero_payment").collect()]
    assert kept == ["cancelled", "free", "null"]


def test_estimate_rules_count_unknown_as_broken(spark):
    df = typed_frame(
        spark, dict(order_id="ok"), dict(order_id="over", ship_disc=1), dict(order_id="null", ship_est=None)
    )
    assert [r.order_id for r in rules.violations(df, "invalid_ship_disc").collect()] == ["over", "null"]
    assert [r.order_id for r in rules.drop_violations(df, "invalid_ship_disc").collect()] == ["ok"]


def test_reason_rule_is_case_sensitive_where_it_says_so(spark):
    df = typed_frame(
        spark,
        dict(order_id="1", cancel_reason="Tidak Dibatalkan", order_status="Batal"),
        dict(order_id="2", cancel_reason="Tidak dibatalkan", order_status="Batal"),
        dict(order_id="3", cancel_reason="DIBATALKAN oleh", order_status="Selesai"),
    )
    assert [r.order_id for r in rules.violations(df, "status_reason_mismatch").collect()] == ["1", "3"]


def test_future_dates_as_of(spark):
    as_of = F.lit("2001-07-01 18:00:00").cast("timestamp_ntz")  # local day: 2 July
    df = typed_frame(
        spark,
        dict(order_id="past"),
        dict(order_id="today", order_date_clean=dt.date(2001, 7, 1)),
        dict(order_id="before", order_timestamp=dt.datetime(2001, 7, 1, 23, 59)),
        dict(order_id="midnight", order_timestamp=dt.datetime(2001, 7, 2)),
        dict(order_id="nulls", order_timestamp=None, order_date_clean=None),
    )
    assert [r.order_id for r in df.where(rules.future(as_of)).collect()] == ["today", "midnight"]
    assert df.where(rules.future()).count() == 0


def test_incomplete_rows(spark):
    df = typed_frame(spark, dict(order_id="ok"), dict(order_id="b", city=""), dict(order_id="n", qty=None))
    assert [r.order_id for r in df.where(rules.incomplete(df, df.columns)).collect()] == ["b", "n"]


def test_category_rules_survive_repeated_rows(spark):
    df = typed_frame(spark, dict(order_id="a", payment=200000, category_count=2),
                     dict(order_id="b", payment=200000, category_count=1), dict(order_id="c"))
    child = spark.createDataFrame(
        [("a", "p"), ("a", "p"), ("a", "q"), ("b", "p"), ("c", "q")],
        "order_id string, product_category string",
    )
    assert rows(rules.high_value_by_category(df, child)) == [("p", 3), ("q", 1)]
    assert rows(rules.category_count_mismatch(df, child)) == [("a", 2, 3)]


def test_validate_agrees_with_the_single_rules(spark):
    df = typed_frame(spark, dict(payment=0), dict(returned_qty=5), dict(discount=10**6), dict(city=None))
    report = {r.rule: r.violations for r in rules.validate(df).collect()}
    for name in rules.ROW_RULES:
        assert report[name] == rules.violations(df, name).count()
    assert report["incomplete_rows"] == 1 and report["future_dates"] == 0


# --- typed table and constraints --------------------------------------------


def test_constraints(spark):
    df = typed_frame(
        spark,
        dict(),
        dict(order_id="ORD_0000002", qty=0, payment=-1),
        dict(order_id="ORD_0000003", qty=None, order_timestamp=None, order_date_clean=None),
        dict(order_id="short"),
        dict(order_id="ORD_0000009"), dict(order_id="ORD_0000009"),
    )
    checks = typed.sales_constraints()
    assert rows(typed.constraint_violations(df, "order_id", checks)) == [
        ("ORD_0000002", "payment >= 0", 1), ("ORD_0000002", "qty > 0", 1),
        ("ORD_0000003", "qty not null", 1), ("ORD_0000009", "order_id unique", 2),
        ("short", "length(order_id) = 11", 1),
    ]
    accepted, rejected = typed.quarantine(df, "order_id", checks)
    assert [r.order_id for r in accepted.collect()] == ["ORD_0000001"]
    assert accepted.columns == df.columns
    failed = {r.order_id: r.failed for r in rejected.collect()}
    assert failed["ORD_0000002"] == ["qty > 0", "payment >= 0"]
    assert failed["ORD_0000009"] == ["order_id unique"]
    assert rejected.count() == 5


def test_text_dates_are_checked_for_shape_and_value(spark):
    df = spark.createDataFrame([("a", "2024-13-40"), ("b", "2024-1-5"), ("c", "2024-01-05"), ("d", None)],
                               "order_id string, d string")
    check = [typed.written_as("d", fv.DATE_GLOB, typed.read_date)]
    assert [r[0] for r in rows(typed.constraint_violations(df, "order_id", check))] == ["a", "b"]


def test_enforce_fails_the_job(spark):
    checks = typed.sales_constraints()
    good = typed_frame(spark, dict())
    assert rows(typed.enforce(good, "order_id", checks)) == rows(good)
    with pytest.raises(PySparkException, match="qty > 0"):
        typed.enforce(typed_frame(spark, dict(qty=0)), "order_id", checks).collect()
    bad = typed.enforce(typed_frame(spark, dict(qty=0)), "order_id", checks)
    with pytest.raises(Exception, match="constraint failed"):
        bad.count()
    with pytest.raises(Exception, match="constraint failed"):
        bad.select("city").collect()
    # rows that an earlier filter leaves out do not stop the job
    both = typed_frame(spark, dict(), dict(order_id="ORD_0000002", qty=0))
    accepted, _ = typed.quarantine(both, "order_id", checks)
    assert typed.enforce(accepted, "order_id", checks).count() == 1
    with pytest.raises(ValueError, match="unique"):
        typed.enforce(typed_frame(spark, dict(), dict()), "order_id", checks)


# --- sources and sinks ------------------------------------------------------


def test_landing_text_keeps_blanks_quotes_and_spaces(spark):
    data = [("1", "", " padded "), ("2", 'say "hi"; now', "ünï"), ("3", "a,b", "")]
    df = spark.createDataFrame(data, "a string, b string, c string")
    path = new_stage_path(spark, "csv")
    sinks.export_csv(df, path, sep=";")
    assert rows(landing.read_landing(spark, path, ["a", "b", "c"])) == data
    assert landing.read_landing(spark, path).columns == ["a", "b", "c"]


def test_landing_text_goes_by_header_names(spark):
    path = new_stage_path(spark, "named")
    sinks.export_csv(spark.createDataFrame([("new", "old")], "v_new string, v string"), path)
    assert rows(landing.read_landing(spark, path, ["v", "v_new"], ",")) == [("old", "new")]
    with pytest.raises(ValueError, match="other"):
        landing.read_landing(spark, path, ["v", "other"], ",")
    mixed = spark.createDataFrame([("old2", "new2")], "v string, v_new string").coalesce(1)
    mixed.write.mode("append").option("header", True).csv(path)
    with pytest.raises(Exception, match="header does not conform"):
        landing.read_landing(spark, path, ["v", "v_new"], ",").collect()


def test_bad_lines_stop_the_job_or_are_set_aside(spark):
    path = new_stage_path(spark, "bad-lines")
    # a line break inside quotes makes two bad lines
    lines = ["a;b;c", "1;2;3", "short", "1;2;3;4", '5;"two', 'lines";x', "6;7;8"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    assert rows(landing.read_landing(spark, path, bad_lines="skip")) == [("1", "2", "3"), ("6", "7", "8")]
    assert landing.read_landing(spark, path, bad_lines="skip").count() == 2
    assert landing.rejected_lines(spark, path).count() == 4
    with pytest.raises(PySparkException, match="unreadable line"):
        landing.read_landing(spark, path).collect()
    with pytest.raises(PySparkException, match="unreadable line"):
        landing.read_landing(spark, path, ["b"]).count()
    whole = landing.read_landing(spark, path, multi_line=True, bad_lines="skip")
    assert ("5", "two\nlines", "x") in rows(whole)


def test_unquoted_and_quoted_blanks_are_blank(spark):
    path = new_stage_path(spark, "text")
    spark.createDataFrame([("k,v",), ('x,""',), ("y,",)], "value string").coalesce(1).write.text(path)
    assert rows(landing.read_landing(spark, path, sep=",")) == [("x", ""), ("y", "")]


def test_places_are_two_lists(spark):
    df = spark.createDataFrame(
        [("BALI", "Bali", "KAB. A", "A"), ("", "", "KOTA A", "A"), ("", "", "KAB. B", "B")],
        "province string, province_new string, city string, city_new string",
    )
    cities, provinces = landing.split_places(df)
    assert rows(provinces) == [("BALI", "Bali")]
    assert rows(cities) == [("KAB. A", "A"), ("KAB. B", "B"), ("KOTA A", "A")]


def test_create_append_snapshot(spark):
    df = spark.range(3)
    path = new_stage_path(spark, "table")
    assert sinks.create_table_as(df, path).count() == 3
    assert sinks.create_table_as(spark.range(9), path, if_not_exists=True).count() == 3
    with pytest.raises(PySparkException):
        sinks.create_table_as(df, path)
    copy = new_stage_path(spark, "copy")
    assert sinks.snapshot(spark.range(5), copy).count() == 5
    assert sinks.snapshot(df, copy).count() == sinks.published_rows(spark, copy) == 3


def test_a_killed_publication_leaves_the_last_version(spark):
    path = new_stage_path(spark, "published")
    data = spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "m string, v int, t string")
    first = sinks.publish(data, path, partition_by=["m"])
    assert first.columns == data.columns and rows(first) == rows(data)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("killed"))).otherwise("a").cast("string").alias("m"), F.lit(1).alias("v"), F.lit("z").alias("t"))
    with pytest.raises(Exception, match="killed"):
        sinks.publish(broken, path)
    assert rows(sinks.read_published(spark, path)) == rows(data)
    # the version before stays readable, older ones go
    second = sinks.publish(data.limit(1), path)
    assert first.count() == 2 and second.count() == 1
    sinks.publish(data.limit(0), path)
    assert sinks.read_published(spark, path).count() == 0 == sinks.published_rows(spark, path)
    with pytest.raises(Exception):
        spark.read.schema(first.schema).parquet(first.inputFiles()[0]).count()
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, new_stage_path(spark, "nothing"))


def test_a_ledger_number_is_given_once(spark):
    path = new_stage_path(spark, "ledger")
    assert ledger.entries(spark, path) == []
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: ledger.commit(spark, path, 1, {"writer": i}), range(8)))
    assert won.count(True) == 1
    assert ledger.entries(spark, path) == [{"writer": won.index(True), "number": 1}]


# --- audit log --------------------------------------------------------------


def entries(spark, *ids, reason="r"):
    data = [(i, "a", reason, "s", "t", 10, 1) for i in ids]
    return spark.createDataFrame(
        data, "order_id string, attribute string, reason string, solution string, "
        "source_table string, total_rows long, problematic_rows long"
    )


def test_append_skips_known_entries_and_counts_on(spark):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(entries(spark, "b", "a", "a"), log, mirror)
    audit.append_audit(entries(spark, "c", "a"), log, mirror)
    got = rows(audit.read_log(spark, log).select("log_id", "order_id"))
    assert got == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(audit.read_log(spark, mirror)) == rows(audit.read_log(spark, log))


def test_strict_append_raises_and_writes_nothing(spark):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(entries(spark, "a"), log, mirror)
    with pytest.raises(ValueError, match="repeat a key"):
        audit.append_audit(entries(spark, "a", "b"), log, mirror, strict=True)
    assert audit.read_log(spark, log).count() == audit.read_log(spark, mirror).count() == 1


def test_a_mirror_that_was_left_behind_catches_up(spark, monkeypatch):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(entries(spark, "a"), log, mirror)
    with monkeypatch.context() as crash:
        crash.setattr(audit, "catch_up", lambda *paths: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            audit.append_audit(entries(spark, "b", "c"), log, mirror)
        with pytest.raises(ZeroDivisionError):
            audit.append_audit(entries(spark, "x"), log, mirror, batch_id="named")
    assert audit.read_log(spark, mirror).count() == 1
    # the same again without a name adds nothing to the log, but fills the mirror
    audit.append_audit(entries(spark, "b", "c"), log, mirror)
    assert rows(audit.read_log(spark, mirror)) == rows(audit.read_log(spark, log))
    assert audit.read_log(spark, log).count() == 4
    audit.append_audit(entries(spark, "y"), log, mirror, batch_id="named")
    assert rows(audit.read_log(spark, mirror)) == rows(audit.read_log(spark, log))
    assert audit.catch_up(spark, log, mirror) == 0
    # a batch that was replaced before it was mirrored comes once
    other = new_stage_path(spark, "mirror")
    assert audit.catch_up(spark, log, other) == 5
    assert rows(audit.read_log(spark, other)) == rows(audit.read_log(spark, log))


def test_two_appends_at_once(spark, monkeypatch):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(entries(spark, "a"), log, mirror)
    # both have read the log before either is entered
    both, commit = threading.Barrier(2), ledger.commit
    first = set()

    def together(session, path, *entry):
        if path == log and threading.get_ident() not in first:
            first.add(threading.get_ident())
            both.wait(60)
        return commit(session, path, *entry)

    monkeypatch.setattr(audit.ledger, "commit", together)
    with ThreadPoolExecutor(2) as pool:
        done = [pool.submit(audit.append_audit, entries(spark, *ids), log, mirror) for ids in ("bcd", "dea")]
        added = [f.result() for f in done]
    got = rows(audit.read_log(spark, log).select("log_id", "order_id"))
    assert [r[0] for r in got] == [1, 2, 3, 4, 5]
    assert sorted(r[1] for r in got) == list("abcde")
    assert sum(df.count() for df in added) == 4
    assert rows(audit.read_log(spark, mirror)) == rows(audit.read_log(spark, log))


def test_counts_in_the_ledger_are_those_of_the_rows(spark):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    other = entries(spark, "a", "z", reason="q").withColumn("source_table", F.lit("t2"))
    for name, batch in [("1", entries(spark, "a", "b", None)), ("2", other), ("3", entries(spark, "c", "a")), ("1", entries(spark, "b")), ("4", entries(spark, "d").limit(0))]:
        audit.append_audit(batch, log, mirror, batch_id=name)
        told = audit.log_summary(spark, log)
        assert rows(told) == rows(audit.audit_summary(audit.read_log(spark, log)))
        assert "Scan parquet" not in told._jdf.queryExecution().executedPlan().toString()
    assert rows(audit.log_summary(spark, mirror)) == rows(told)


def test_null_keys_are_never_repeats(spark):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    audit.append_audit(entries(spark, None, None), log, mirror)
    audit.append_audit(entries(spark, None), log, mirror)
    assert audit.read_log(spark, log).count() == 3


def test_ids_are_consecutive_over_many_partitions(spark):
    df = spark.range(5000).select(F.format_string("k%05d", "id").alias("order_id")).repartition(7)
    numbered = audit.number_rows(audit.place_rows(df, ["order_id"]), F.lit(100), "n")
    ordered = numbered.orderBy("order_id").collect()
    assert [r.n for r in ordered] == list(range(101, 5101))


def test_entries_count_rows_of_a_repeated_order(spark):
    df = spark.createDataFrame([("a", ""), ("a", ""), ("b", "x"), (None, "")], "order_id string, qty string")
    got = rows(audit.audit_entries(df, "blank_qty", F.col("qty") == "").select(
        "order_id", "total_rows", "problematic_rows"))
    assert got == [("a", 3, 2), (None, 3, 0)]


def test_entries_of_any_table_and_change(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1)], "id string, stock int")
    text = audit.LogText("stock", "Negative stock", "Delete", "warehouse")
    got = audit.audit_entries(df, text, F.col("stock") < 0, key="id")
    assert rows(got) == [("b", "stock", "Negative stock", "Delete", "warehouse", 2, 1)]


def test_an_append_reads_only_its_kinds_of_entries(spark):
    log, mirror = new_stage_path(spark, "log"), new_stage_path(spark, "mirror")
    one = entries(spark, "a", "b")
    other = one.withColumn("attribute", F.lit("another"))
    audit.append_audit(one, log, mirror)
    audit.append_audit(other, log, mirror)
    kinds = one.select(audit.kind_of_entry().alias("k")).agg(F.collect_set("k")).scalar()
    known = spark.read.parquet(log).where(F.array_contains(kinds, F.col(audit.KIND)))
    assert known.count() == 2
    plan = known._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line and "kind" in line)
    assert "array_contains" in scan[scan.index("PartitionFilters"):]
    audit.append_audit(one.unionByName(other), log, mirror)
    assert rows(audit.read_log(spark, log).select("log_id")) == [(1,), (2,), (3,), (4,)]


def test_close_values_are_ranked_in_many_tasks(spark, no_broadcast):
    # microseconds since 1970, close together: the ranges follow the data
    micros = F.lit(1_700_000_000_000_000) + F.col("id")
    df = spark.range(0, 20000, 1, 8).select(micros.alias("v"))
    before = set(stage_paths(spark))
    out = distribution.ntile_profile(df, F.col("v"), "v")
    assert [r.total for r in out.collect()] == [2000] * 10
    (made,) = set(stage_paths(spark)) - before
    sizes = spark.read.parquet(made).groupBy("part").count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 15000


def test_summary(spark):
    log = entries(spark, "a", "b").unionByName(entries(spark, "a", reason="q"))
    assert rows(audit.audit_summary(log)) == [("s", "a", 2, 3)]


# --- star schema ------------------------------------------------------------

# fixed values: raw name, canonical name and category of the payment methods
PAYMENTS = [
    ("BCA OneKlik", "BCA OneKlik", "Bank"),
    ("SeaBank Bayar Instan", "SeaBank Bayar Instan", "Bank"),
    ("Cicilan Kartu Kredit", "CC Installment", "Card"),
    ("Kartu Kredit/Debit", "Credit/Debit Card", "Card"),
    ("Cash On Delivery", "Cash On Delivery", "Cash On Delivery"),
    ("COD", "Cash On Delivery", "Cash On Delivery"),
    ("COD (Bayar di Tempat)", "Cash On Delivery", "Cash On Delivery"),
    ("Saldo ShopeePay", "ShopeePay", "E-Wallet"),
    ("saldo shopeepay", "ShopeePay", "E-Wallet"),
    ("ShopeePay", "ShopeePay", "E-Wallet"),
    ("Pembayaran dibebaskan", "Free (No Payment)", "Free"),
    ("Online Payment", "Online Payment", "Other"),
    ("online payment", "Online Payment", "Other"),
    ("OnlinePayment", "Online Payment", "Other"),
    ("SPay Later", "SPayLater", "PayLater"),
    ("SPayLater", "SPayLater", "PayLater"),
    ("Alfamart/Alfamidi/Dan+Dan", "Alfamart/Alfamidi/Dan+Dan", "Retail (Offline)"),
    ("Indomaret/i.Saku", "Indomaret/i.Saku", "Retail (Offline)"),
    ("Mitra Shopee", "Mitra Shopee", "Retail (Offline)"),
]


def test_payment_dimension_is_a_bag(spark):
    mapping = spark.createDataFrame(PAYMENTS, "pay_method string, pay_method_new string, payment_category string")
    got = [tuple(r) for r in star.dim_payments(mapping).collect()]
    assert got == [(new, category) for _, new, category in PAYMENTS]
    assert len(got) == 19
    unique = star.dim_payments_unique(mapping)
    assert unique.count() == unique.select("pay_method").distinct().count() == 12
    path = new_stage_path(spark, "payments")
    sinks.export_csv(star.dim_payments(mapping), path, one_file=True)
    assert [tuple(r) for r in landing.read_landing(spark, path, sep=",").collect()] == got


def test_fact_has_the_declared_columns(spark):
    df = flags.add_flags(typed_frame(spark, dict(ship_fee=1, ship_disc=5)))
    fact = star.fact_sales(df)
    assert len(fact.columns) == 29
    row = fact.first()
    assert (row.net_shipping, row.year_order_date, row.month_order_date, row.time_order_date) == (
        -4, "2001", "2001-06", "10:00:00",
    )


def test_blank_profile_of_any_column_name(spark):
    df = spark.createDataFrame([("", "x"), (None, "")], "`Kota/Kabupaten` string, b string")
    got = profile.null_blank_profile(df, ["Kota/Kabupaten", "b"])
    assert sorted(map(tuple, got.collect())) == [
        ("Kota/Kabupaten", "blank", 1, 1), ("Kota/Kabupaten", "null", 0, 1), ("b", "blank", 1, 1),
    ]
