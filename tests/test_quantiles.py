import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabloom.operators import profile, scale
from tabloom.operators.quantiles import exact_quantiles

PROBABILITIES = (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0)


def check(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], ["x"]).repartition(4)
    assert exact_quantiles(df, ["x"], PROBABILITIES)["x"] == pytest.approx(np.quantile(values, PROBABILITIES))


def test_small_table(spark):
    assert exact_quantiles(spark.createDataFrame([(v,) for v in (1, 2, 4, 9)], ["x"]), ["x"], (0.25, 0.5, 0.75)) == {
        "x": [1.75, 3.0, 5.25]
    }


@pytest.mark.parametrize("kind", ["spread", "hot", "two", "heavy_tail"])
def test_narrowing(spark, small_limits, kind):
    rng = random.Random(7)
    values = {
        "spread": [rng.random() for _ in range(3000)],
        "hot": [5.0] * 1200 + [rng.random() * 10 for _ in range(1800)],
        "two": [0.0] * 500 + [1.0] * 1500,
        "heavy_tail": [math.exp(8 * rng.random()) for _ in range(2500)] + [-1.0] * 40,
    }[kind]
    check(spark, values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-30, 30), min_size=25, max_size=120))
def test_narrowing_any_values(spark, small_limits, values):
    check(spark, values)


def test_missing_values_and_other_plotting_position(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 4.0, 9.0, None, float("nan")]], "x double")
    # position n * p + 0.4 + 0.2 * p: 4 * 0.5 + 0.5 = 2.5, half way from the 2nd to the 3rd value
    assert exact_quantiles(df, ["x"], (0.5,), plotting=0.4)["x"] == [3.0]
    empty = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(empty, ["x"], (0.5,))["x"] == [None]


def test_describe_and_box(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(v, 1.0) for v in values], ["x", "c"])
    row = profile.describe(df, ["x", "c"]).collect()[0]
    assert (row["n"], row["mean"], row["median"], row["max"]) == (5, 22.0, 3.0, 100.0)
    assert row["std"] == pytest.approx(np.std(values, ddof=1))
    box = {r["feature"]: r for r in profile.box_stats(df, ["x", "c"]).collect()}
    assert (box["x"]["whisker_low"], box["x"]["whisker_high"], box["x"]["outliers"]) == (1.0, 4.0, 1)
    assert (box["c"]["whisker_low"], box["c"]["whisker_high"], box["c"]["outliers"]) == (1.0, 1.0, 0)


def test_scaling(spark):
    df = spark.createDataFrame([(v, 3.0) for v in (1.0, 2.0, 4.0, 9.0)], ["x", "c"])
    standard = [r["x"] for r in scale.fit_standard(df, ["x", "c"]).apply(df).collect()]
    assert standard == pytest.approx(list((np.array([1, 2, 4, 9]) - 4) / np.std([1, 2, 4, 9])))
    robust = scale.fit_robust(df, ["x", "c"]).apply(df).collect()
    assert [r["x"] for r in robust] == pytest.approx([(v - 3.0) / 3.5 for v in (1, 2, 4, 9)])
    assert {r["c"] for r in robust} == {0.0}


def test_top_spread_keeps_order_on_ties(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0, 5.0), (2.0, 2.0, 0.0, 5.0)], ["b", "a", "z", "y"])
    assert profile.top_spread_columns(df, ["z", "b", "a"], 2) == ["b", "a"]
