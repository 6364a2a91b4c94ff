from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.operators import features

AS_OF = datetime(2024, 1, 2, 12)
EVENTS = [
    (1, 10, "view", 0.0, "2024-01-01 11:00:00"),
    (1, 10, "purchase", 10.0, "2024-01-01 11:59:59"),
    (1, 11, "purchase", 20.5, "2024-01-01 12:00:00"),
    (1, 11, "purchase", 30.0, "2024-02-01 00:00:00"),
    (2, 12, "cart", 0.0, "2024-01-01 10:00:00"),
    (2, 12, "cart", 0.0, "2024-01-01 10:00:17"),
]


def test_the_day_before_has_a_lower_bound_only(make_silver):
    row = features.purchase_features(make_silver(EVENTS), AS_OF).first()
    assert tuple(row) == (1, 2, 3, 60.5, 20.17, 30.0, 10.0)


def test_a_short_span_rounds_to_zero(make_silver):
    table = features.event_frequency_features(make_silver(EVENTS))
    row = table.filter("user_id = 2").first()
    assert (row.activity_span_hours, row.events_per_hour, row.cart_count) == (0.0, 2.0, 2)
    busy = table.filter("user_id = 1").first()
    assert busy.unique_products == 2 and busy.activity_span_hours == 733.0


def test_users_without_purchases_are_filled(make_silver):
    row = features.user_features(make_silver(EVENTS), AS_OF).filter("user_id = 2").first()
    assert [row[c] for c in features.FILLED] == [0, 0, 0.0, 0.0, 0.0, 0.0]
    assert row.is_purchaser == 0 and row.feature_timestamp == AS_OF


def test_table_schema(make_silver):
    table = features.user_features(make_silver(EVENTS))
    assert table.columns == schemas.USER_FEATURE_TABLE_COLUMNS
    types = dict(table.dtypes)
    assert types["is_purchaser"] == "int" and types["feature_timestamp"] == "timestamp"
    assert types["total_purchases"] == "bigint" and types["events_per_hour"] == "double"


@pytest.mark.parametrize("partitions", [1, 16])
def test_one_pass_equals_the_joined_form(silver, partitions):
    spread = silver.repartition(partitions)
    joined = features.join_features(
        features.purchase_features(spread, AS_OF),
        features.event_frequency_features(spread),
        features.conversion_features(spread),
        AS_OF,
    )
    single = features.user_features(silver, AS_OF)
    assert joined.schema.simpleString() == single.schema.simpleString()
    assert rows(joined) == rows(single)


def test_totals_are_the_rows_of_silver(silver):
    total = features.user_features(silver, AS_OF).agg(F.sum("total_events")).first()[0]
    assert total == silver.count()


def test_the_clock_is_the_default(make_silver):
    row = features.user_features(make_silver(EVENTS)).filter("user_id = 1").first()
    assert row.purchases_last_24h == 0
    assert row.feature_timestamp > datetime(2025, 1, 1)


def test_features_as_of_are_those_of_the_events_before(spark, silver):
    times = [datetime(2024, 1, day, hour) for day, hour in ((1, 0), (1, 12), (9, 23), (30, 12), (31, 0))]
    found = features.features_as_of(silver, times)
    assert found.columns == features.user_features(silver, times[0]).columns
    for at in times:
        before = silver.filter(F.col("event_timestamp") < F.lit(at).cast("timestamp_ntz"))
        own = found.filter(F.col("feature_timestamp") == F.lit(at).cast("timestamp_ntz"))
        assert rows(own) == rows(features.user_features(before, at))
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_days_merge_into_the_features(spark, silver):
    by_day = silver.withColumn("event_date", F.to_date("event_timestamp"))
    days = features.user_days(by_day)
    assert days.count() < silver.count() + 1
    at = datetime(2024, 1, 20, 12)
    newest = by_day.filter(F.col("event_date") >= features.since(at))
    assert rows(features.features_of_days(days, newest, at)) == rows(features.user_features(silver, at))
