"""Range assignment against exact rational arithmetic."""

import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fragloom.functions.ranges import (
    FRAGMENT_ID,
    RangeSpec,
    assign_range,
    fragment_of_value,
    fragment_span,
)

HALF_STARS = [i / 2 for i in range(11)]


def exact(value, n, lo=0, hi=5):
    position = (Fraction(value) - lo) * n / (Fraction(hi) - lo)
    return max(0, math.ceil(position) - 1)


def assigned(spark, values, spec):
    df = spark.createDataFrame([(v,) for v in values], "rating double")
    return [(r["rating"], r[FRAGMENT_ID]) for r in assign_range(df, spec).collect()]


def test_half_stars_exact_for_1_to_100_fragments(spark):
    grid = spark.range(1, 101).select(F.col("id").cast("int").alias("n")).select(
        "n", F.explode(F.array(*map(F.lit, HALF_STARS))).alias("v")
    )
    rows = grid.select("n", "v", fragment_of_value(F.col("v"), F.col("n"), 0.0, 5.0).alias("f")).collect()
    assert len(rows) == 1100
    assert all(r["f"] == exact(r["v"], r["n"]) for r in rows)


def test_boundaries_go_down(spark):
    got = assigned(spark, [0.0, 1.0, 1.0000001, 2.0, 5.0], RangeSpec(5))
    assert got == [(0.0, 0), (1.0, 0), (1.0000001, 1), (2.0, 1), (5.0, 4)]


OUTSIDE = [None, math.nan, -0.5, -1.0, 5.5, math.inf]


def test_drop_leaves_out_values_outside(spark):
    assert assigned(spark, [*OUTSIDE, 3.0], RangeSpec(5)) == [(3.0, 2)]


def test_clamp_moves_values_to_the_ends(spark):
    got = assigned(spark, OUTSIDE, RangeSpec(5, out_of_range="clamp"))
    assert got == [(-0.5, 0), (-1.0, 0), (5.5, 4), (math.inf, 4)]


@pytest.mark.parametrize("value", OUTSIDE)
def test_error_fails_on_values_outside(spark, value):
    with pytest.raises(PySparkException, match="outside"):
        assigned(spark, [value], RangeSpec(5, out_of_range="error"))


def test_rounding_at_the_upper_end_stays_in_the_last_fragment(spark):
    """(7.3 + 3) * 29 / 10.3 rounds to more than 29."""
    assert assigned_in(spark, 7.3, RangeSpec(29, lo=-3.0, hi=7.3)) == 28


def assigned_in(spark, value, spec):
    return assigned(spark, [value], spec)[0][1]


def test_integer_column(spark):
    df = spark.range(11).select(F.col("id").cast("int").alias("v"))
    got = {r["v"]: r[FRAGMENT_ID] for r in assign_range(df, RangeSpec(3, "v", 0.0, 10.0)).collect()}
    assert got == {v: exact(v, 3, 0, 10) for v in range(11)}


@pytest.mark.parametrize("n, error", [(0, ValueError), (-1, ValueError), (2.5, TypeError), ("5", TypeError), (True, TypeError)])
def test_bad_fragment_count(n, error):
    with pytest.raises(error):
        RangeSpec(n)


@pytest.mark.parametrize("lo, hi", [(5.0, 5.0), (5.0, 0.0), (0.0, math.inf), (math.nan, 1.0)])
def test_bad_domain(lo, hi):
    with pytest.raises(ValueError):
        RangeSpec(5, lo=lo, hi=hi)


def test_unknown_policy():
    with pytest.raises(ValueError):
        RangeSpec(5, out_of_range="ignore")


NUMBERS = st.floats(-20, 20, allow_nan=False)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 60), NUMBERS, NUMBERS, NUMBERS, st.sampled_from(["drop", "clamp"]))
def test_span_covers_every_matching_value(n, low, high, value, policy):
    """Any stored value of the interval lies in a fragment of the span."""
    spec = RangeSpec(n, lo=-3.0, hi=7.3, out_of_range=policy)
    stored = fragment_span(spec, value, value)
    if stored is None or not low <= value <= high:
        return
    first, last = fragment_span(spec, low, high)
    assert 0 <= first <= stored[0] <= last < n


def test_span_uses_the_column_formula(spark):
    values = [i * 10.3 / 997 - 3.0 for i in range(998)]
    for n in (1, 3, 7, 11, 49):
        spec = RangeSpec(n, lo=-3.0, hi=7.3)
        for value, fragment in assigned(spark, [min(v, 7.3) for v in values], spec):
            assert fragment_span(spec, value, value) == (fragment, fragment)


@pytest.mark.parametrize("low, high", [(6, 9), (-3, -1), (3, 2), (math.nan, 2)])
def test_empty_span(low, high):
    assert fragment_span(RangeSpec(5), low, high) is None


def test_drop_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, 2.0)], "id int, rating double").write.parquet(path)
    plan = assign_range(spark.read.parquet(path), RangeSpec(5))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(rating,0.0), LessThanOrEqual(rating,5.0)" in plan
