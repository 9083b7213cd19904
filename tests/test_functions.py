"""Scalar expressions: null-safe casts (N1, N2), lenient parse, buckets,
fraud flags (N5, N6) and the risk rule."""

import math

from pyspark.sql import functions as F

from fraudlens.functions import (
    age_group, cost_group, fraud_probability, income_group, is_fraud_int,
    is_fraud_str, parse_float_lenient, try_double, try_int_legacy, encode_cell,
)


def _one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_legacy_int_cast(spark):
    got = _one(spark, ["abc", "1.0", "-1.9", "9999999999", "12d", "", " 7 ", "1e400", None],
               try_int_legacy)
    assert got == [None, 1, -1, None, 12, None, 7, None, None]


def test_try_double(spark):
    got = _one(spark, ["2.5", "abc", "", "1e3", None], try_double)
    assert got == [2.5, None, None, 1000.0, None]


def test_parse_float_lenient(spark):
    got = _one(spark, ["12kg", "abc", " -3.5e2x", ".5", "1.", "0x1F", "", None, "NaN"],
               parse_float_lenient)
    assert got == [12.0, None, -350.0, 0.5, 1.0, 0.0, None, None, None]   # never NaN


def test_age_buckets(spark):
    got = _one(spark, [19, 20, 29, 30, 39, 40, 49, 50, -1, None], age_group, "int")
    assert got == ["Under 20", "20-29", "20-29", "30-39", "30-39", "40-49", "40-49",
                   "50+", "Under 20", None]


def test_income_buckets(spark):
    got = _one(spark, [19999, 20000, 59999, 60000, 99999, 100000, 139999, 140000, None],
               income_group, "int")
    assert got == ["Under 20k", "20k-59k", "20k-59k", "60k-99k", "60k-99k",
                   "100k-139k", "100k-139k", "140k+", None]


def test_cost_buckets(spark):
    got = _one(spark, [499.99, 500.0, 1499.99, 1500.0, None], cost_group, "double")
    assert got == ["Low Cost", "Medium Cost", "Medium Cost", "High Cost", None]


def test_fraud_flags(spark):
    assert _one(spark, ["1", "1.0", "0", None], is_fraud_str) == [True, False, False, None]
    assert _one(spark, [1, 0, None], is_fraud_int, "int") == [True, False, None]


def test_encode_cell(spark):
    assert _one(spark, ["a", None], encode_cell) == ["a", ""]


def test_fraud_probability(spark):
    df = spark.createDataFrame(
        [(1600.0, "Air", "Asia"), (100.0, "Sea", "Europe"), (None, None, None),
         (1500.0, "Air", "South America")],
        "f double, m string, r string")
    got = [r[0] for r in df.select(fraud_probability("f", "m", "r")).collect()]
    expect = [0.05 + 0.1 + 0.05 + 0.05, 0.05, 0.05, 0.05 + 0.05 + 0.05]
    assert all(math.isclose(a, b) for a, b in zip(got, expect))
