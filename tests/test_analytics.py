import math

from pyspark.sql import functions as F

from eventlake.operators import analytics, hourly

EVENTS = [
    (1, 10, "purchase", 10.0, "2024-01-01 10:00:00"),
    (1, 11, "purchase", 30.0, "2024-01-01 10:30:00"),
    (2, 10, "purchase", 20.0, "2024-01-01 11:00:00"),
    (2, None, "purchase", 99.0, "2024-01-01 11:00:00"),
    (3, 12, "purchase", math.nan, "2024-01-01 11:00:00"),
    (3, 12, "view", 0.0, "2024-01-01 11:00:00"),
    (3, 12, None, 0.0, "2024-01-01 23:00:00"),
]


def test_ties_go_to_the_smaller_key_and_missing_prices_count_nothing(make_silver):
    found = analytics.top_products(make_silver(EVENTS)).collect()
    assert [tuple(r) for r in found] == [("10", 30.0), ("11", 30.0), ("12", 0.0)]
    spenders = analytics.top_spenders(make_silver(EVENTS), n=2).collect()
    assert [tuple(r) for r in spenders] == [("2", 119.0), ("1", 40.0)]


def test_null_types_are_left_out(make_silver):
    found = analytics.event_distribution(make_silver(EVENTS)).collect()
    assert [tuple(r) for r in found] == [("purchase", 5), ("view", 1)]


def test_hour_of_day(make_silver):
    found = analytics.hourly_activity(make_silver(EVENTS)).collect()
    assert [tuple(r) for r in found] == [(10, 2), (11, 4), (23, 1)]


def test_bronze_measures_survive_bad_times(edge_bronze):
    minutes = analytics.events_per_minute(edge_bronze).collect()
    assert [r.event_count for r in minutes] == [12, 1, 1]
    latest = analytics.latest_events(edge_bronze, n=3).collect()
    assert [r.offset for r in latest] == [5, 4, 13]
    everything = analytics.latest_events(edge_bronze, n=100).collect()
    assert [r.offset for r in everything[-3:]] == [16, 15, 14]
    row = analytics.stream_kpis(edge_bronze).first()
    assert tuple(row) == (17, 5, 5)


def test_kpis(make_silver):
    silver = make_silver(EVENTS[:4] + EVENTS[5:6])
    gold = hourly.gold_tables(hourly.hourly_rollup(silver))
    row = analytics.kpis(*gold.values(), silver).first().asDict()
    assert row == {
        "total_revenue": 159.0,
        "active_user_hours": 3,
        "conversion_rate": 100.0,
        "avg_order_value": 39.75,
        "weighted_conversion_rate": 400.0,
        "weighted_avg_order_value": 39.75,
        "distinct_users": 3,
    }


def test_kpis_of_empty_tables(make_silver):
    silver = make_silver(EVENTS).filter(F.lit(False))
    gold = hourly.gold_tables(hourly.hourly_rollup(silver))
    assert set(analytics.kpis(*gold.values(), silver).first()) == {0}


def test_class_distribution(spark):
    table = spark.createDataFrame([(0,)] * 2 + [(1,)], "is_purchaser int")
    found = sorted(tuple(r) for r in analytics.class_distribution(table).collect())
    assert found == [(0, 2, 66.7), (1, 1, 33.3)]
