"""Literal rows for the reading rules of text-first tables."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderloom import functions as fn


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    return [r.v for r in df.orderBy("i").select(column("c").alias("v")).collect()]


NUMBERS = {
    "3.0": 3, "12ab": 12, "": 0, "ab": 0, None: None, " 7": 7, "-5": -5, "+4x": 4,
    "12.5": 12, ".5": 0, "-.5": 0, "1 2.5": 1, "--3": 0, "1e3": 1,
    "9223372036854775807": 2**63 - 1, "99999999999999999999": 2**63 - 1,
    "-99999999999999999999999999999999999999999": -(2**63), "0" * 50 + "12z": 12,
}


def test_whole_number(spark):
    assert values(spark, fn.whole_number, list(NUMBERS)) == list(NUMBERS.values())


def test_whole_number_or_null_differs_on_blank_only(spark):
    expected = [None if t == "" else v for t, v in NUMBERS.items()]
    assert values(spark, fn.whole_number_or_null, list(NUMBERS)) == expected


def leading_number(text):
    body = text.lstrip(" \t\n\v\f\r")
    sign = body[:1] if body[:1] in ("+", "-") else ""
    digits = ""
    for ch in body[len(sign):]:
        if ch not in "0123456789":
            break
        digits += ch
    if not digits:
        return 0
    return max(-(2**63), min(2**63 - 1, int(sign + digits)))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789+-. ax", max_size=24), min_size=50, max_size=200))
def test_whole_number_against_brute_force(spark, texts):
    assert values(spark, fn.whole_number, texts) == [leading_number(t) for t in texts]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-05", dt.date(2024, 1, 5)), ("2024-01-05 10:30", dt.date(2024, 1, 5)),
        ("", None), ("05/06/2024", None), ("2024-13-40", None), ("2024-02-31", None),
        ("2024-1-5", None), ("2024", None), ("2024-01-05 25:00", None), (None, None),
        ("2024-01-05x", None), (" 2024-01-05", None), ("2024-01-05\n", None),
    ],
)
def test_read_date(spark, text, day):
    assert values(spark, fn.read_date, [text]) == [day]


@pytest.mark.parametrize(
    "text, moment",
    [
        ("2024-01-05 10:30", dt.datetime(2024, 1, 5, 10, 30)),
        ("2024-01-05 10:30:59", dt.datetime(2024, 1, 5, 10, 30, 59)),
        ("2024-01-05T10:30:59.987", dt.datetime(2024, 1, 5, 10, 30, 59)),
        ("2024-01-05", dt.datetime(2024, 1, 5)), ("2024-02-30 10:30", None), ("10:30", None),
        ("", None), (None, None),
    ],
)
def test_read_timestamp(spark, text, moment):
    assert values(spark, fn.read_timestamp, [text]) == [moment]


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("America/New_York", "Asia/Jakarta"):
            spark.conf.set("spark.sql.session.timeZone", other)
            assert values(spark, fn.read_timestamp, ["2024-03-10 02:30"]) == [
                dt.datetime(2024, 3, 10, 2, 30)
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_like_ignores_ascii_case_only(spark):
    def like(pattern):
        return lambda c: fn.like_ignoring_case(c, pattern)

    assert values(spark, like("%SeAl / b_ut%"), ["x seal / BAUT y", "seal", None]) == [
        True, False, None,
    ]
    # no escape character, and letters beyond A-Z keep their case
    assert values(spark, like("a\\%"), ["a\\b", "ab"]) == [True, False]
    assert values(spark, like("É"), ["é", "É"]) == [False, True]


def test_glob(spark):
    date = lambda c: fn.matches_glob(c, "[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]")
    assert values(spark, date, ["2024-13-40", "2024-1-5", "x2024-01-05", None]) == [
        True, False, False, None,
    ]
    stars = lambda c: fn.matches_glob(c, "A*?.c")
    assert values(spark, stars, ["Ab.c", "ab.c", "A.c", "Abb\n.c"]) == [True, False, False, True]


def test_ratio_and_rounding(spark):
    row = spark.range(1).select(
        fn.ratio(F.lit(1), F.lit(0)).alias("none"),
        fn.ratio(F.lit(1), F.lit(2)).alias("half"),
        fn.rounded(F.lit(2.5)).alias("up"),
        fn.rounded(F.lit(-2.5)).alias("down"),
        fn.rounded(F.lit(1.0005), 3).alias("digits"),
    ).first()
    assert (row.none, row.half, row.up, row.down, row.digits) == (None, 0.5, 3.0, -3.0, 1.001)


def test_day_first(spark):
    assert values(spark, fn.day_first_to_iso, ["05/06/2024", "2024-06-05", "", None]) == [
        "2024-06-05", "2024-06-05", "", None,
    ]
