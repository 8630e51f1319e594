import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridstats.functions.numeric import (
    clip, finite_or_null, ratio, round_half_even, rounded_ratio)

NAN, INF = math.nan, math.inf


def one(rows, column, **values):
    ddl = ", ".join(f"{name} double" for name in values)
    return rows(ddl, values).select(column.alias("out")).first()["out"]


def same(a, b):
    return (a is None and b is None) or a == b or (
        a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("n, d, expected", [
    (1.0, 4.0, 0.25), (0.0, 0.0, NAN), (3.0, 0.0, INF), (-3.0, 0.0, -INF),
    (NAN, 0.0, NAN), (NAN, 2.0, NAN), (None, 0.0, None), (None, 2.0, None),
    (1.0, None, None), (0.0, None, None), (0.0, 5.0, 0.0),
])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ratio_is_ieee_division(spark, rows, n, d, expected, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert same(one(rows, ratio("n", "d"), n=n, d=d), expected)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("value, expected", [
    (0.125, 0.12), (0.375, 0.38), (1.015, 1.01), (-0.625, -0.62), (2.0, 2.0),
    (NAN, NAN), (INF, INF), (-INF, -INF), (None, None),
])
def test_rounding_is_half_even_on_the_scaled_value(rows, value, expected):
    assert same(one(rows, round_half_even("x", 2), x=value), expected)


@pytest.mark.parametrize("value, expected", [
    (-1.0, 0.0), (1.0, 1.0), (9.0, 2.375), (NAN, NAN), (None, None),
    (INF, 2.375), (-INF, 0.0),
])
def test_clip_keeps_nan_and_null(rows, value, expected):
    assert same(one(rows, clip("x", 0.0, 2.375), x=value), expected)


def test_rates_fill_nan_but_keep_infinity(rows):
    assert one(rows, rounded_ratio("n", "d"), n=0.0, d=0.0) == 0.0
    assert one(rows, rounded_ratio("n", "d", scale=100), n=2.0, d=0.0) == INF
    assert one(rows, rounded_ratio("n", "d", scale=100), n=2.0, d=3.0) == 66.67
    assert one(rows, rounded_ratio("n", "d"), n=None, d=3.0) is None


def test_finite_or_null(rows):
    frame = rows("a double, b int, c string",
                 dict(a=NAN, b=1, c="x"), dict(a=INF, b=None), dict(a=-INF), dict(a=2.5))
    assert [r["a"] for r in finite_or_null(frame).collect()] == [None, None, None, 2.5]
    assert finite_or_null(frame).columns == ["a", "b", "c"]
    assert finite_or_null(rows("b int", dict(b=1))).count() == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(
    st.one_of(st.none(), st.floats(allow_subnormal=False, width=32)),
    st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60))
def test_ratio_matches_python_floats(spark, pairs):
    frame = spark.createDataFrame(
        [(i, n, None if d is None else float(d)) for i, (n, d) in enumerate(pairs)],
        "i int, n double, d double")
    got = {r["i"]: r["q"] for r in frame.select("i", ratio("n", "d").alias("q")).collect()}
    for i, (n, d) in enumerate(pairs):
        if n is None or d is None:
            expected = None
        elif d:
            expected = n / d
        else:
            expected = NAN if n == 0 or math.isnan(n) else math.copysign(INF, n)
        assert same(got[i], expected), (n, d)


def test_rounding_needs_no_python(rows):
    from conftest import plan_of
    frame = rows("x double", dict(x=1.0)).select(round_half_even("x", 2), clip(F.col("x"), 0, 1))
    assert "Python" not in plan_of(frame)
