"""What the physical plans must and must not contain."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from eventlake import adapters
from eventlake.operators import analytics, cleaning, features, hourly, profile, quality
from eventlake.sources import tables

SF_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 30, 12)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver and Bronze as files, so that scans and push-down can be seen."""
    folder = tmp_path_factory.mktemp("stored")
    found = {}
    for name, table in {
        "silver": adapters.silver(spark, SF_DIR),
        "bronze": adapters.bronze(spark, SF_DIR),
    }.items():
        tables.write_table(table, f"{folder}/{name}")
        found[name] = tables.read_table(spark, f"{folder}/{name}")
    return found


def scanned(text: str) -> set[str]:
    schema = text.split("ReadSchema: struct<")[1].split(">")[0]
    return {field.split(":")[0] for field in schema.split(",")}


def test_purchase_filters_reach_the_scan(stored):
    for table in (
        hourly.revenue_per_hour(stored["silver"]),
        analytics.top_products(stored["silver"]),
        features.purchase_features(stored["silver"], AS_OF),
    ):
        assert "EqualTo(event_type,purchase)" in plan(table)


def test_scans_read_only_what_is_used(stored):
    revenue = plan(hourly.revenue_per_hour(stored["silver"]))
    assert scanned(revenue) == {"event_type", "price", "event_timestamp"}
    report = plan(quality.quality_report(stored["bronze"]))
    assert scanned(report) == {"user_id", "product_id", "event_type", "price"}
    assert scanned(plan(analytics.stream_kpis(stored["bronze"]))) == {"event_type", "user_id"}


def test_one_scan_serves_all_hourly_tables_and_all_features(stored):
    assert plan(hourly.hourly_rollup(stored["silver"])).count("FileScan") == 1
    single = plan(features.user_features(stored["silver"], AS_OF))
    assert single.count("FileScan") == 1 and "Join" not in single


def test_quality_is_one_aggregate(stored):
    text = plan(quality.quality_report(stored["bronze"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_cleaning_filters_before_its_only_shuffle(stored):
    text = plan(cleaning.clean(stored["bronze"]))
    assert text.count("Exchange") == 1
    assert text.rindex("Filter") > text.index("Exchange")
    assert "partial_min" in text and "IsNotNull(user_id)" in text


def test_times_are_parsed_once(stored):
    for table in (
        cleaning.clean(stored["bronze"]),
        analytics.events_per_minute(stored["bronze"]),
        analytics.hourly_activity(stored["bronze"]),
        analytics.latest_events(stored["bronze"]),
    ):
        assert plan(table).count("cast(event_timestamp") == 1


def test_money_is_summed_in_hash_aggregates(stored):
    for table in (
        hourly.hourly_rollup(stored["silver"]),
        features.user_features(stored["silver"], AS_OF),
        analytics.revenue_by_product(stored["silver"]),
    ):
        assert "SortAggregate" not in plan(table)


def test_top_lists_keep_the_best_per_task(stored):
    for table in (
        analytics.top_products(stored["silver"]),
        analytics.top_spenders(stored["silver"]),
        analytics.latest_events(stored["bronze"]),
    ):
        assert "TakeOrderedAndProject" in plan(table)


def test_distinct_values_are_spread_by_value(stored):
    text = plan(hourly.active_users_per_hour(stored["silver"]))
    assert "Expand" in text
    first = text.split("Exchange hashpartitioning(")[-1].split(")")[0]
    assert "user_id" in first and "product_id" in first
    profiled = plan(profile.column_profile(stored["silver"]))
    assert "Expand" not in profiled and "hashpartitioning(number" in profiled


def test_writing_by_date_rebalances(spark, stored):
    by_date = stored["silver"].withColumn("event_date", F.to_date("event_timestamp"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(by_date.hint("rebalance", "event_date"))


# Queries of the corpus operators have plan tests of their own.
OWN_QUERIES = [n for n in contract.queries() if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", sorted(OWN_QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
