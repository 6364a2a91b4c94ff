"""Dashboard measures: KPIs, top lists and distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import exact, times


def kpis(
    revenue: DataFrame,
    active_users: DataFrame,
    conversion: DataFrame,
    silver: DataFrame | None = None,
) -> DataFrame:
    """One row of headline figures over the three hourly tables.

    ``active_user_hours`` counts a user once per active hour; ``conversion_rate`` and
    ``avg_order_value`` weigh every hour alike. The ``weighted_`` forms weigh by
    events and orders. With ``silver``, ``distinct_users`` counts each user once.
    The tables are stacked, not joined, and reduced by a single aggregate.
    """
    parts = [
        revenue.select("total_revenue", "purchase_count", "avg_order_value"),
        active_users.select("active_users"),
        conversion.select(
            "view_count",
            F.col("purchase_count").alias("bought"),
            "overall_conversion_rate",
        ),
    ]
    measures = [
        _or_zero(exact.total(F.col("total_revenue"), 2)).alias("total_revenue"),
        F.coalesce(F.sum("active_users"), F.lit(0)).alias("active_user_hours"),
        _or_zero(_mean("overall_conversion_rate")).alias("conversion_rate"),
        _or_zero(_mean("avg_order_value")).alias("avg_order_value"),
        exact.ratio(F.sum("bought"), F.sum("view_count"), 2, scale=100).alias(
            "weighted_conversion_rate"
        ),
        _or_zero(exact.mean(F.col("total_revenue"), F.sum("purchase_count"), 2)).alias(
            "weighted_avg_order_value"
        ),
    ]
    if silver is not None:
        users = silver.groupBy(F.col("user_id").alias("user")).agg(F.lit(1).alias("once"))
        parts.append(users.filter(F.col("user").isNotNull()).select("once"))
        measures.append(F.count("once").alias("distinct_users"))
    return reduce(_stack, parts).agg(*measures)


def _stack(upper: DataFrame, lower: DataFrame) -> DataFrame:
    return upper.unionByName(lower, allowMissingColumns=True)


def _mean(column: str) -> Column:
    return exact.mean(F.col(column), F.count(column), 2)


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _spend_by(silver: DataFrame, key: str, name: str) -> DataFrame:
    """Purchase revenue per key; NULL keys form no group and NaN prices count as 0."""
    price = F.when(~F.isnan("price"), F.col("price"))
    return (
        silver.filter((F.col("event_type") == "purchase") & F.col(key).isNotNull())
        .groupBy(key)
        .agg(_or_zero(exact.total(price)).alias(name))
    )


def revenue_by_product(silver: DataFrame) -> DataFrame:
    return _spend_by(silver, "product_id", "revenue")


def spend_by_user(silver: DataFrame) -> DataFrame:
    return _spend_by(silver, "user_id", "total_spent")


def top(table: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows of highest value, ties by key, with the key as text. Spark keeps
    the best ``n`` per task, so no task holds the sorted table."""
    return (
        table.orderBy(F.col(value).desc(), F.col(key))
        .limit(n)
        .withColumn(key, F.col(key).cast("string"))
    )


def top_products(silver: DataFrame, n: int = 15) -> DataFrame:
    return top(revenue_by_product(silver), "revenue", "product_id", n)


def top_spenders(silver: DataFrame, n: int = 10) -> DataFrame:
    return top(spend_by_user(silver), "total_spent", "user_id", n)


def event_distribution(events: DataFrame) -> DataFrame:
    """Rows per event type, NULL types left out, most frequent first."""
    return (
        events.filter(F.col("event_type").isNotNull())
        .groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), "event_type")
    )


def hourly_activity(events: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """Rows per hour of day; rows without a valid time are left out."""
    hours = events.select(F.hour(times.parsed(events, column)).alias("hour_of_day"))
    return _counted(hours, F.col("hour_of_day")).orderBy("hour_of_day")


def events_per_minute(bronze: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """Rows per minute in time order; rows without a valid time are left out."""
    timed = bronze.select(times.parsed(bronze, column).alias("at"))
    return _counted(timed, times.bucket(timed, "at", "minute").alias("minute")).orderBy("minute")


def _counted(rows: DataFrame, key: Column) -> DataFrame:
    """Rows per non-NULL key. The NULL group is dropped by its count, after the
    aggregate: a filter on the key would be pushed down and parse every time twice."""
    counts = rows.groupBy(key).agg(F.count(key).alias("event_count"))
    return counts.filter("event_count > 0")


def stream_kpis(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """Events, event types and users seen so far."""
    users = F.approx_count_distinct("user_id") if approx else F.countDistinct("user_id")
    return bronze.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.countDistinct("event_type").alias("event_types"),
        users.alias("unique_users"),
    )


def latest_events(bronze: DataFrame, n: int = 20, column: str = "event_timestamp") -> DataFrame:
    """The newest ``n`` rows by event time, rows without a valid time last; later
    arrivals first among equals. ``column`` is returned as a time."""
    return (
        bronze.withColumn(column, times.parsed(bronze, column))
        .orderBy(
            F.col(column).desc_nulls_last(),
            F.col("offset").desc(),
            F.col("partition").desc(),
            F.col("topic").desc(),
        )
        .limit(n)
    )


def class_distribution(features: DataFrame, label: str = "is_purchaser") -> DataFrame:
    """Rows and percent share per label, of which there may be any number. The total is
    a subquery of one figure, so no task gathers the classes."""
    counts = features.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    rows = features.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "count", exact.ratio(F.col("count"), rows, 1, 100).alias("percent"))
