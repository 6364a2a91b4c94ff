import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventlake.functions import exact

def price():
    return F.col("price")



def table(spark, prices):
    return spark.createDataFrame([(p,) for p in prices], "price double")


def total(spark, prices, places=2):
    return table(spark, prices).agg(exact.total(price(), places).alias("t")).first().t


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cents=st.lists(st.integers(-(10**11), 10**11), min_size=1, max_size=30))
def test_totals_and_means_are_exact(spark, cents):
    prices = [c / 100 for c in cents]
    row = (
        table(spark, prices)
        .agg(exact.total(price(), 2).alias("t"), exact.mean(price(), F.count("*"), 2).alias("m"))
        .first()
    )
    mean = Decimal(sum(cents)) / 100 / len(cents)
    assert row.t == sum(cents) / 100
    assert row.m == float(mean.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_half_cents_round_up_whatever_the_order(spark):
    prices = [0.005, 1.0] * 100
    for partitions in (1, 3, 7):
        scattered = table(spark, prices).repartition(partitions)
        row = scattered.agg(exact.mean(price(), F.count("*"), 2).alias("m")).first()
        assert row.m == 0.5
    assert total(spark, [1.005]) == 1.01


def test_missing_and_no_values(spark):
    assert total(spark, [None, 2.5]) == 2.5
    assert total(spark, [None]) is None
    assert total(spark, []) is None
    row = table(spark, [None, 3.0]).agg(
        exact.mean(price(), F.count("*"), 2).alias("all"),
        exact.mean(price(), F.count("price"), 2).alias("priced"),
    )
    assert row.first().asDict() == {"all": 1.5, "priced": 3.0}


def test_prices_that_are_no_ordinary_numbers(spark):
    assert math.isnan(total(spark, [1.0, math.nan]))
    assert total(spark, [1.0, math.inf]) == math.inf
    assert math.isnan(total(spark, [math.inf, -math.inf]))
    assert total(spark, [1e15, 1.25]) == 1e15 + 1.25


def test_parts_of_a_millionth_count(spark):
    assert total(spark, [4e-7] * 1000, 6) == 0.0004
    row = table(spark, [4e-7] * 10).agg(exact.mean(price(), F.count("*"), 8).alias("m")).first()
    assert row.m == 4e-7


def test_a_total_beyond_the_range_of_millionths(spark):
    assert total(spark, [8.9e12] * 50) == 8.9e12 * 50


@pytest.mark.parametrize(
    ("part", "whole", "expected"), [(1, 3, 33.33), (2, 3, 66.67), (5, 0, 0.0), (0, 4, 0.0), (1, 800, 0.13)]
)
def test_ratio(spark, part, whole, expected):
    row = spark.range(1).select(exact.ratio(F.lit(part), F.lit(whole), 2, 100).alias("r")).first()
    assert row.r == expected
