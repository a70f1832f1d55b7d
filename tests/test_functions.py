"""P1-P9 cleaners and D-1..D-9 derived columns on literal rows: nulls, both closed ends, malformed text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import cleaners as C
from tidemark.functions import derived as D


def _one(spark, data, schema, expr):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_trim_keeps_null_and_empty(spark):
    assert _one(spark, [("  a b ",), ("",), (None,)], "s string", C.trimmed("s")) == ["a b", "", None]


def test_email_and_phone(spark):
    assert _one(spark, [(" User1@Example.COM ",), (None,)], "s string", C.standard_email("s")) == \
        ["user1@example.com", None]
    assert _one(spark, [("+91 98-100 (22)",), ("12-34",), (None,)], "s string", C.phone_digits("s")) == \
        ["+919810022", "1234", None]


def test_range_or_null_numeric_bounds_closed(spark):
    vals = _one(spark, [(-60.0,), (-60.01,), (300.0,), (300.01,), (None,)], "x double",
                C.in_range_or_null("x", -60, 300))
    assert vals == [-60.0, None, 300.0, None, None]
    assert _one(spark, [(-1.0,), (0.0,)], "x double", C.in_range_or_null("x", 0)) == [None, 0.0]


def test_range_or_null_on_strings_uses_try_cast(spark):
    vals = _one(spark, [("0",), ("1",), ("S-X",), ("7.5",), (None,)], "s string",
                C.in_range_or_null("s", 1, None, dtype=StringType()))
    assert vals == [None, "1", None, None, None]
    pins = _one(spark, [("99",), ("100000",), ("999999",), ("1000000",), ("N/A",)], "s string",
                C.in_range_or_null("s", 100000, 999999, dtype=StringType()))
    assert pins == [None, "100000", "999999", None, None]


def test_title_or_default(spark):
    vals = _one(spark, [("slightly delayed",), ("UPI",), (None,), (" on time",)], "s string",
                C.title_or_default("s"))
    assert vals == ["Slightly Delayed", "Upi", "Unknown", " On Time"]


def test_defaults_and_round(spark):
    assert _one(spark, [(None,), (5,)], "x int", C.default_if_null("x", 0)) == [0, 5]
    assert _one(spark, [(None,), (" Traffic ",)], "s string", C.trimmed_or_default("s")) == ["None", "Traffic"]
    assert _one(spark, [(1.005,), (2.345,), (-2.345,), (None,)], "x double", C.round2("x")) == \
        [1.01, 2.35, -2.35, None]


def test_minutes_between_truncates_seconds_per_side(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0, 900000)
    t1 = dt.datetime(2024, 1, 1, 10, 1, 30, 100000)
    out = _one(spark, [(t0, t1), (t1, t0), (None, t1)], "a timestamp_ntz, b timestamp_ntz",
               D.minutes_between("a", "b"))
    assert out == [1.5, -1.5, None]


def test_flags_three_valued(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,)], "m double")
    got = df.select(D.is_delayed("m").alias("d"), D.delay_category("m").alias("c")).collect()
    assert [(r.d, r.c) for r in got] == [(True, "Slight Delay"), (False, "On Time"), (False, "Significant Delay")]
    assert _one(spark, [("On Time",), ("Delayed",), (None,)], "s string", D.flag_equals("s", "On Time")) == \
        [True, False, False]


def test_delay_category_boundaries(spark):
    vals = _one(spark, [(0.0,), (5.0,), (5.01,), (15.0,), (15.01,)], "m double", D.delay_category("m"))
    assert vals == ["On Time", "Slight Delay", "Moderate Delay", "Moderate Delay", "Significant Delay"]


def test_efficiency_guard_and_age(spark):
    vals = _one(spark, [(30.0, 2.0), (30.0, 0.0), (None, 2.0), (30.0, None)], "m double, k double",
                D.efficiency("m", "k"))
    assert vals == [15.0, None, None, None]
    ages = _one(spark, [(dt.date(2024, 12, 31),), (None,)], "d date", D.age_days("d", "2025-01-01"))
    assert ages == [1, None]


def test_year_month(spark):
    out = spark.createDataFrame([(dt.datetime(1997, 5, 28, 0, 1),)], "t timestamp_ntz") \
        .select(D.year_month("t"), D.year_of("t")).first()
    assert tuple(out) == ("1997-05", 1997)
    assert F is not None
