"""Hourly business tables over Silver.

The three tables share their key, so ``hourly_rollup`` computes everything in one
scan and the tables are projections of it, one row per hour. The single-table forms
serve a caller who wants just one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions import exact, times


def _by_hour(silver: DataFrame):
    return silver.groupBy(times.bucket(silver, "event_timestamp", "hour").alias("hour"))


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _count_of(event_type: str) -> Column:
    return F.count_if(_is(event_type))


def _distinct(column: str, approx: bool) -> Column:
    return F.approx_count_distinct(column) if approx else F.countDistinct(column)


def _revenue(price: Column, purchases: Column) -> list[Column]:
    return [
        exact.total(price, 2).alias("total_revenue"),
        purchases.alias("purchase_count"),
        exact.mean(price, purchases, 2).alias("avg_order_value"),
    ]


def _funnel_rates() -> dict[str, Column]:
    views, carts, purchases = map(F.col, ("view_count", "cart_count", "purchase_count"))
    return {
        "view_to_cart_rate": exact.ratio(carts, views, 2, scale=100),
        "cart_to_purchase_rate": exact.ratio(purchases, carts, 2, scale=100),
        "overall_conversion_rate": exact.ratio(purchases, views, 2, scale=100),
    }


def revenue_per_hour(silver: DataFrame) -> DataFrame:
    """Revenue, purchases and average order value per hour with a purchase."""
    purchases = silver.filter(_is("purchase"))
    return _by_hour(purchases).agg(*_revenue(F.col("price"), F.count(F.lit(1))))


def active_users_per_hour(silver: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct users, events and distinct products (of all event types) per hour.

    Exact distincts shuffle by hour and value, so a busy hour is spread over all
    tasks. ``approx`` keeps a fixed-size sketch per hour and shuffles only that.
    """
    return _by_hour(silver).agg(
        _distinct("user_id", approx).alias("active_users"),
        F.count(F.lit(1)).alias("total_events"),
        _distinct("product_id", approx).alias("unique_products_viewed"),
    )


def conversion_rate(silver: DataFrame, approx: bool = False) -> DataFrame:
    """Funnel counts, distinct users and percent rates per hour."""
    return (
        _by_hour(silver)
        .agg(
            _count_of("view").alias("view_count"),
            _count_of("cart").alias("cart_count"),
            _count_of("purchase").alias("purchase_count"),
            _distinct("user_id", approx).alias("unique_users"),
        )
        .withColumns(_funnel_rates())
    )


def hourly_rollup(silver: DataFrame, approx: bool = False) -> DataFrame:
    """All measures of the three tables in one aggregate."""
    price = F.when(_is("purchase"), F.col("price"))
    return _by_hour(silver).agg(
        *_revenue(price, _count_of("purchase")),
        _distinct("user_id", approx).alias("active_users"),
        _distinct("product_id", approx).alias("unique_products_viewed"),
        F.count(F.lit(1)).alias("total_events"),
        _count_of("view").alias("view_count"),
        _count_of("cart").alias("cart_count"),
    )


def cell_measures() -> list[Column]:
    """What the tables need of an hour, a user and a product, in a form that can be merged."""
    price = F.when(_is("purchase"), F.col("price"))
    return [
        F.count(F.lit(1)).alias("events"),
        _count_of("view").alias("views"),
        _count_of("cart").alias("carts"),
        _count_of("purchase").alias("purchases"),
        *exact.parts(price, "price"),
    ]


def rollup_of_cells(cells: DataFrame) -> DataFrame:
    """The rollup from rows of (hour, user_id, product_id) and :func:`cell_measures`."""
    return cells.groupBy("hour").agg(
        exact.merged_total("price", 2).alias("total_revenue"),
        F.sum("purchases").alias("purchase_count"),
        exact.merged_mean("price", F.sum("purchases"), 2).alias("avg_order_value"),
        F.countDistinct("user_id").alias("active_users"),
        F.countDistinct("product_id").alias("unique_products_viewed"),
        F.sum("events").alias("total_events"),
        F.sum("views").alias("view_count"),
        F.sum("carts").alias("cart_count"),
    )


#: Size of a distinct sketch, as a power of two; its relative error is 1.04 / sqrt(2 ** SKETCH).
SKETCH = 12


def distinct_sketches(silver: DataFrame) -> DataFrame:
    """Per hour a sketch of its users and one of its products. They are stored with Gold,
    and merge into any longer period without reading Silver again."""
    return _by_hour(silver).agg(
        F.hll_sketch_agg("user_id", F.lit(SKETCH)).alias("users"),
        F.hll_sketch_agg("product_id", F.lit(SKETCH)).alias("products"),
    )


def distinct_by(sketches: DataFrame, unit: str) -> DataFrame:
    """Distinct users and products per ``unit`` ("day", "week", "month"), merged from
    :func:`distinct_sketches`: within two standard errors, 3.3 percent, in 95 of 100 periods."""
    period = times.bucket(sketches, "hour", unit).alias("period")
    return sketches.groupBy(period).agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"),
        F.hll_sketch_estimate(F.hll_union_agg("products")).alias("distinct_products"),
    )


def exact_distinct_by(silver: DataFrame, unit: str) -> DataFrame:
    """The same counts exactly, from Silver."""
    period = times.bucket(silver, "event_timestamp", unit).alias("period")
    return silver.groupBy(period).agg(
        F.countDistinct("user_id").alias("distinct_users"),
        F.countDistinct("product_id").alias("distinct_products"),
    )


def gold_tables(rollup: DataFrame) -> dict[str, DataFrame]:
    """The three hourly tables of a rollup, by table name."""
    return {
        "revenue_per_hour": rollup.filter("purchase_count > 0").select(
            "hour", "total_revenue", "purchase_count", "avg_order_value"
        ),
        "active_users_per_hour": rollup.select(
            "hour", "active_users", "total_events", "unique_products_viewed"
        ),
        "conversion_rate": rollup.select(
            "hour",
            "view_count",
            "cart_count",
            "purchase_count",
            F.col("active_users").alias("unique_users"),
        ).withColumns(_funnel_rates()),
    }


def latest_first(table: DataFrame) -> DataFrame:
    """Newest hour first. Order belongs to the reader: files keep none."""
    return table.orderBy(F.col("hour").desc())


def trend(table: DataFrame, column: str = "hour") -> DataFrame:
    """Oldest first, as trend charts read it."""
    return table.orderBy(column)
