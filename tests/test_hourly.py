from datetime import datetime

import pytest
from conftest import rows

from eventlake.operators import hourly

EVENTS = [
    (1, 10, "view", 0.0, "2024-01-01 10:00:00"),
    (1, 10, "cart", 0.0, "2024-01-01 10:10:00"),
    (1, 10, "purchase", 10.0, "2024-01-01 10:20:00"),
    (2, 11, "view", 0.0, "2024-01-01 10:30:00"),
    (2, 11, "view", 0.0, "2024-01-01 10:59:59.999999"),
    (2, 11, "purchase", None, "2024-01-01 10:40:00"),
    (3, None, "cart", 0.0, "2024-01-01 11:00:00"),
]
TEN, ELEVEN = datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 11)


def test_revenue_divides_by_all_purchases(make_silver):
    assert rows(hourly.revenue_per_hour(make_silver(EVENTS))) == [(TEN, 10.0, 2, 5.0)]


def test_active_users_ignore_null_products(make_silver):
    table = hourly.latest_first(hourly.active_users_per_hour(make_silver(EVENTS)))
    assert [tuple(r) for r in table.collect()] == [(ELEVEN, 1, 1, 0), (TEN, 2, 6, 2)]


def test_conversion_guards_its_divisions(make_silver):
    assert rows(hourly.conversion_rate(make_silver(EVENTS))) == [
        (TEN, 3, 1, 2, 2, 33.33, 200.0, 66.67),
        (ELEVEN, 0, 1, 0, 1, 0.0, 0.0, 0.0),
    ]


@pytest.mark.parametrize("name", ["revenue_per_hour", "active_users_per_hour", "conversion_rate"])
def test_the_rollup_gives_the_same_tables(silver, name):
    single = getattr(hourly, name)(silver)
    projected = hourly.gold_tables(hourly.hourly_rollup(silver))[name]
    assert projected.columns == single.columns
    assert rows(projected) == rows(single)


def test_counts_add_up(silver):
    rollup = hourly.hourly_rollup(silver)
    assert rollup.filter("view_count + cart_count + purchase_count <> total_events").isEmpty()
    assert rollup.groupBy().sum("total_events").first()[0] == silver.count()


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_result_does_not_depend_on_partitioning(silver, partitions):
    expected = rows(hourly.hourly_rollup(silver))
    assert rows(hourly.hourly_rollup(silver.repartition(partitions))) == expected


def test_sketches_are_close(silver):
    exact = hourly.active_users_per_hour(silver).groupBy().sum("active_users").first()[0]
    approx = hourly.active_users_per_hour(silver, approx=True).groupBy().sum("active_users").first()[0]
    assert abs(approx - exact) <= 0.05 * exact


def test_orders(silver):
    table = hourly.revenue_per_hour(silver)
    newest = [r.hour for r in hourly.latest_first(table).collect()]
    assert newest == sorted(newest, reverse=True)
    assert [r.hour for r in hourly.trend(table).collect()] == newest[::-1]
