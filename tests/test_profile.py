import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.operators import profile, quantiles

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]


def table(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def expect(spark, values):
    found = quantiles.exact_quantiles(table(spark, v=values), ["v"], PROBABILITIES)["v"]
    np.testing.assert_allclose(found, np.quantile(values, PROBABILITIES), rtol=1e-12, atol=1e-322)


RANDOM = np.random.default_rng(5)


@pytest.mark.parametrize(
    "values",
    [
        RANDOM.normal(size=5001),
        RANDOM.integers(0, 3, 1000).astype(float),
        np.concatenate([np.zeros(700), RANDOM.uniform(0, 500, 300)]),
        10.0 ** RANDOM.uniform(-200, 200, 500),
        np.array([-1e308, 1e308, 0.0, 1.0]),
        np.array([7.0]),
        1.7e15 + np.arange(20_000) * 977.0,
        np.concatenate([RANDOM.normal(size=999), [1e300]]),
    ],
    ids=["normal", "few", "hot", "wide", "extreme", "one", "times", "outlier"],
)
def test_quantiles_are_those_of_a_full_sort(spark, values):
    expect(spark, values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e12, 1e12), min_size=1, max_size=40))
def test_quantiles_of_any_numbers(spark, values):
    expect(spark, np.array(values))


def test_whole_numbers_a_double_cannot_tell_apart(spark):
    big = 2**60
    data = spark.range(5).selectExpr(f"{big} + id AS v")
    assert quantiles.exact_quantiles(data, ["v"], [0.5]) == {"v": [float(big + 2)]}


def test_a_whole_number_that_most_rows_hold(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "FEW", 100)
    for value in (3, 2**60 + 1):
        data = spark.range(1000).selectExpr(f"if(id < 900, {value}, id) AS v")
        found = quantiles.exact_quantiles(data, ["v"], [0.2, 0.3])["v"]
        assert found == list(np.quantile(data.toPandas()["v"], [0.2, 0.3]))


@pytest.mark.parametrize("shape", ["wide", "lognormal", "outlier", "same", "subnormal"])
def test_passes_do_not_depend_on_the_values(spark, monkeypatch, shape):
    random = np.random.default_rng(1)
    values = {
        "wide": 10.0 ** random.uniform(-200, 200, 3000),
        "lognormal": random.lognormal(0, 4, 3000),
        "outlier": np.concatenate([random.normal(size=2999), [1e300]]),
        "same": np.concatenate([np.full(2500, 7.0), random.normal(size=500)]),
        "subnormal": np.concatenate([np.zeros(1500), random.integers(1, 99, 1500) * 5e-324]),
    }[shape]
    passes = []
    for name in ("_counted", "_narrowed"):
        step = getattr(quantiles, name)
        monkeypatch.setattr(quantiles, name, lambda *a, step=step: passes.append(1) or step(*a))
    monkeypatch.setattr(quantiles, "FEW", 100)
    expect(spark, values)
    assert len(passes) <= 5


def test_infinities_missing_values_and_empty_columns(spark):
    data = table(spark, v=[-math.inf, 1.0, 2.0, math.inf, math.inf]).withColumn("none", F.lit(None).cast("double"))
    found = quantiles.exact_quantiles(data, ["v", "none"], [0.0, 0.25, 0.5, 1.0])
    assert found == {"v": [-math.inf, 1.0, 2.0, math.inf], "none": [None] * 4}


def test_summary_is_that_of_pandas(spark):
    frame = pd.DataFrame({"a": [1, 2, 3, 10], "b": [0.5, math.nan, 2.5, 4.0], "c": ["x", "y", "z", "z"]})
    found = profile.summary_stats(spark.createDataFrame(frame)).toPandas().set_index("column")
    expected = frame.describe().T
    expected.columns = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    np.testing.assert_allclose(found[expected.columns].astype(float), expected)
    assert list(found.index) == ["a", "b"]


def test_time_summary_is_that_of_pandas(spark):
    frame = pd.DataFrame({"at": pd.date_range("2024-01-01", periods=10, freq="7h")})
    found = profile.time_summary(spark.createDataFrame(frame)).first()
    expected = frame["at"].describe()
    assert found["count"] == 10
    for ours, theirs in zip(("mean", "min", "p25", "p50", "p75", "max"), expected.iloc[1:7]):
        assert found[ours] == theirs.to_pydatetime()


def test_nothing_to_summarise(spark):
    assert profile.summary_stats(spark.createDataFrame([("x",)], "c string")).isEmpty()
    assert profile.time_summary(spark.createDataFrame([("x",)], "c string")).isEmpty()


def test_profiles_count_missing_cells_as_pandas_does(edge_bronze):
    missing = edge_bronze.toPandas().isnull().sum()
    row = profile.table_profile(edge_bronze).first()
    assert tuple(row) == (17, 10, round(missing.sum() / 170 * 100, 1))
    assert profile.table_profile(edge_bronze.filter("false")).first().null_percent == 0.0


@pytest.mark.parametrize("approx", [False, True])
def test_column_profile(edge_bronze, approx):
    found = profile.column_profile(edge_bronze, approx=approx)
    frame = edge_bronze.toPandas()
    assert [r.column for r in found.collect()] == edge_bronze.columns
    for row in found.collect():
        column = frame[row.column]
        expected = (column.isnull().sum(), column.notnull().sum(), column.nunique())
        assert (row.null_count, row.non_null_count, row.distinct_count) == expected
        assert row.type == dict(edge_bronze.dtypes)[row.column]


def test_column_profile_of_every_kind(spark):
    data = spark.sql(
        "SELECT x, x % 2 = 0 AS flag, date_add(date'2024-01-01', x) AS day,"
        " make_timestamp_ntz(2024, 1, 1, x, 0, 0) AS at, cast(x AS decimal(5, 2)) AS money,"
        " encode(string(x % 3), 'UTF-8') AS bytes, array(x % 4) AS list"
        " FROM (SELECT explode(array(1, 2, 3, 4, 5, null)) AS x)"
    )
    counts = {r.column: (r.null_count, r.distinct_count) for r in profile.column_profile(data).collect()}
    assert counts == {
        "x": (1, 5),
        "flag": (1, 2),
        "day": (1, 5),
        "at": (1, 5),
        "money": (1, 5),
        "bytes": (1, 3),
        "list": (0, 5),
    }


def test_both_zeros_are_one_value(spark):
    data = table(spark, v=[0.0, -0.0, math.nan, math.nan])
    row = profile.column_profile(data).first()
    assert (row.null_count, row.distinct_count) == (2, 1)


def test_context_is_bounded(spark):
    for rows in (2, 51):
        found = profile.table_context(spark.range(rows).toDF("n"), sample=20)
        assert found["profile"].first()["rows"] == rows
        assert found["sample"].count() == min(rows, 20)
        assert found["summary"].first().p50 == (rows - 1) / 2
        assert found["column_profile"].first().distinct_count == rows
