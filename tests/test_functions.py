"""Scalar expressions: known answers and ANSI-safety."""
import math

import pytest
from pyspark.sql import functions as F

from tabulae.functions import (band_label, canonical_code, compound_duration, correlation_strength, is_finite,
                               label_of, level_word, profile_name, skew_verdict, to_double, to_int, validate_code)


def test_canonical_code(spark):
    df = spark.createDataFrame([("1",), ("1.0",), (" 1 ",), ("",), (None,), ("abc",), ("1e30",), ("inf",),
                                ("-2",), ("007",), ("2.5",)], "x string")
    got = [r[0] for r in df.select(canonical_code("x")).collect()]
    assert got == ["1", "1", "1", None, None, "abc", "1e30", "inf", "-2", "7", "2.5"]


def test_text_to_numbers_is_ansi_safe(spark):
    df = spark.createDataFrame([("abc",), (" 12 ",), ("2.9",), ("-2.9",), (None,)], "x string")
    rows = df.select(to_double("x").alias("d"), to_int("x").alias("i")).collect()
    assert [r.d for r in rows] == [None, 12.0, 2.9, -2.9, None]
    assert [r.i for r in rows] == [None, 12, 2, -2, None]  # truncation toward zero


def test_is_finite(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (1.5,)], "x double")
    assert [r[0] for r in df.select(is_finite("x")).collect()] == [False, False, False, False, True]


def test_compound_duration(spark):
    df = spark.createDataFrame([(2.0, 6.0), (None, 3.0)], "y double, m double")
    assert [r[0] for r in df.select(compound_duration("y", "m")).collect()] == [2.5, None]


def test_validate_code(spark):
    df = spark.createDataFrame([(None,), ("77",), ("8",), ("0",), ("7",)], "x string")
    ok = [str(i) for i in range(8)]
    got = [r[0] for r in df.select(validate_code("x", ok, "UNKNOWN")).collect()]
    assert got == ["UNKNOWN", "UNKNOWN", "UNKNOWN", "0", "7"]


def test_band_label(spark):
    df = spark.createDataFrame([(None, 250.0), (250.0, 450.0), (450.0, None), (1234567.4, 2500.5)], "a double, b double")
    got = [r[0] for r in df.select(band_label("a", "b")).collect()]
    assert got == ["<= Q250", "Q250 - Q450", "> Q450", "Q1,234,567 - Q2,500"]


def test_label_fallback(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "c string")
    assert [r[0] for r in df.select(label_of("c", {"1": "one"})).collect()] == ["one", "9", None]


def test_profile_name(spark):
    df = spark.createDataFrame([(0.1, -0.2, 0.3), (0.6, -0.7, 0.0), (-0.5, 0.5, 0.49)], "a double, b double, c double")
    words = [level_word("a", "young", "older"), level_word("b", "short tenure", "long tenure"),
             level_word("c", "short hours", "long hours")]
    got = [r[0] for r in df.select(profile_name(words)).collect()]
    assert got == ["Average profile", "Older, short tenure", "Young, long tenure"]


def test_classes(spark):
    df = spark.createDataFrame([(0.05,), (-0.2,), (0.45,), (-0.9,)], "r double")
    assert [r[0] for r in df.select(correlation_strength("r")).collect()] == ["negligible", "weak", "moderate", "strong"]
    assert [r[0] for r in df.select(skew_verdict(F.col("r") * 2)).collect()] == [
        "roughly symmetric", "roughly symmetric", "right-skewed", "left-skewed"]


def test_long_codes_keep_every_digit(spark):
    cases = {"9007199254740993": "9007199254740993", " 1234567890123456789.00 ": "1234567890123456789", "-007": "-7", "+5.": "5",
             "000": "0", "-0.0": "0", "1e3": "1000", "1.5e1": "15", "1.25": "1.25", "12a": "12a", "1e400": "1e400", "": None}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    assert {r.c: r.v for r in df.select("c", canonical_code("c").alias("v")).collect()} == cases


def test_rules_are_false_on_absent_values(spark):
    from tabulae.functions.rules import member, valid_duration, within
    rows = [(1, 2.0, 6.0, "a"), (2, 2.0, 12.0, "z"), (3, None, 1.0, None), (4, float("nan"), 1.0, "a"), (5, 1.0, 0.5, "b"), (6, 40.0, 0.0, "a")]
    df = spark.createDataFrame(rows, "i int, y double, m double, c string")
    got = df.select("i", valid_duration("y", "m", F.lit(30)).alias("d"), member("c", ["a", "b"]).alias("k"),
                    within("y", above=1, high=10).alias("w")).collect()
    assert [(r.i, r.d, r.k, r.w) for r in got] == [(1, True, True, True), (2, False, False, True), (3, False, False, False),
                                                   (4, False, True, False), (5, False, True, False), (6, False, True, False)]


def test_profile_names_of_any_length(spark):
    from tabulae.functions import profile_name
    long = "x" * 1_100_000
    assert spark.range(1).select(F.length(profile_name([F.lit(long)]))).first()[0] == len(long)
