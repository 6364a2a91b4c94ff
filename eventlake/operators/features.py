"""Per-user features over Silver.

``user_features`` is one grouped aggregate. The three partial feature sets and their
join give the same table; they serve callers who want one set, and cross-check it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions import exact

AsOf = datetime | Column | None

# Names of features, which are 0 for a user without a purchase.
FILLED = [
    "purchases_last_24h",
    "total_purchases",
    "total_revenue",
    "avg_order_value",
    "max_purchase_value",
    "min_purchase_value",
]


def _as_of(as_of: AsOf) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def _time_of(silver: DataFrame, as_of: AsOf) -> Column:
    """``as_of`` in the type of the event time, so the comparison needs no cast."""
    return _as_of(as_of).cast(silver.schema["event_timestamp"].dataType)


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def _purchase_measures(price: Column, bought: Column, now: Column) -> list[Column]:
    """``price`` is NULL on rows that are no purchase; ``bought`` tells them apart.
    The 24-hour count has a lower bound only: later events count as recent."""
    recent = F.col("event_timestamp") >= now - F.expr("INTERVAL 24 HOURS")
    return [
        F.count_if(bought & recent).alias("purchases_last_24h"),
        F.count_if(bought).alias("total_purchases"),
        exact.total(price, 2).alias("total_revenue"),
        exact.mean(price, F.count(price), 2).alias("avg_order_value"),
        F.round(F.max(price), 2).alias("max_purchase_value"),
        F.round(F.min(price), 2).alias("min_purchase_value"),
    ]


def _frequency_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(_is("view")).alias("view_count"),
        F.count_if(_is("cart")).alias("cart_count"),
        F.countDistinct("product_id").alias("unique_products"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    ]


def _with_frequency(counts: DataFrame) -> DataFrame:
    """Span and rate. The rate divides by the rounded span, and is the event count
    where that span is zero."""
    first, last = (
        F.unix_timestamp(F.col(c).cast("timestamp"))
        for c in ("first_activity", "last_activity")
    )
    span, events = F.col("activity_span_hours"), F.col("total_events")
    hundredths = F.round(span * 100, 0)
    return counts.withColumn("activity_span_hours", F.round((last - first) / 3600, 2)).withColumn(
        "events_per_hour",
        F.when(span > 0, F.round(events * 100 / hundredths, 2)).otherwise(events.cast("double")),
    )


def _conversion_ratios(views: str, carts: str, purchases: str) -> dict[str, Column]:
    return {
        "view_to_cart_ratio": exact.ratio(F.col(carts), F.col(views), 4),
        "cart_to_purchase_ratio": exact.ratio(F.col(purchases), F.col(carts), 4),
        "overall_conversion": exact.ratio(F.col(purchases), F.col(views), 4),
    }


def purchase_features(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Counts, revenue and order values of each user with a purchase."""
    purchases = silver.filter(_is("purchase"))
    return purchases.groupBy("user_id").agg(
        *_purchase_measures(F.col("price"), F.lit(True), _time_of(silver, as_of))
    )


def event_frequency_features(silver: DataFrame) -> DataFrame:
    """Event counts, distinct products, activity span and rate of each user."""
    counts = silver.groupBy("user_id").agg(
        *_frequency_measures(), F.count_if(_is("purchase")).alias("event_purchase_count")
    )
    return _with_frequency(counts)


def conversion_features(silver: DataFrame) -> DataFrame:
    """Funnel ratios of each user."""
    counts = silver.groupBy("user_id").agg(
        F.count_if(_is("view")).alias("views"),
        F.count_if(_is("cart")).alias("carts"),
        F.count_if(_is("purchase")).alias("purchases"),
    )
    return counts.withColumns(_conversion_ratios("views", "carts", "purchases")).select(
        "user_id", "view_to_cart_ratio", "cart_to_purchase_ratio", "overall_conversion"
    )


def _finished(features: DataFrame, now: Column) -> DataFrame:
    return (
        features.fillna(0, subset=FILLED)
        .withColumn("feature_timestamp", now)
        .withColumn(schemas.LABEL_COLUMN, F.when(F.col("total_purchases") > 0, 1).otherwise(0))
        .select(*schemas.USER_FEATURE_TABLE_COLUMNS)
    )


def join_features(
    purchases: DataFrame, frequency: DataFrame, conversion: DataFrame, as_of: AsOf = None
) -> DataFrame:
    """The feature table from its three parts, all of them unique on ``user_id``."""
    joined = frequency.join(purchases, "user_id", "left").join(conversion, "user_id", "left")
    now = _as_of(as_of).cast(frequency.schema["first_activity"].dataType)
    return _finished(joined, now)


def user_features(silver: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The feature table in one aggregate: one scan, no join.

    The distinct product count makes Spark aggregate by user and product first, so a
    user with a large share of all events is spread over their products.
    """
    now = _time_of(silver, as_of)
    bought = _is("purchase")
    counts = silver.groupBy("user_id").agg(
        *_purchase_measures(F.when(bought, F.col("price")), bought, now),
        *_frequency_measures(),
    )
    ratios = _conversion_ratios("view_count", "cart_count", "total_purchases")
    return _finished(_with_frequency(counts).withColumns(ratios), now)


def user_days(silver: DataFrame, day: str = "event_date") -> DataFrame:
    """What the feature table needs of each day, user and product, in a form that can
    be merged: a late event changes its own day only."""
    bought = _is("purchase")
    price = F.when(bought, F.col("price"))
    return silver.groupBy(day, "user_id", "product_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(_is("view")).alias("views"),
        F.count_if(_is("cart")).alias("carts"),
        F.count_if(bought).alias("purchases"),
        F.count(price).alias("priced"),
        *exact.parts(price, "price"),
        F.max(price).alias("most"),
        F.min(price).alias("least"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    )


def since(as_of: AsOf) -> Column:
    """The day from which on events may count as recent."""
    return F.to_date(_as_of(as_of) - F.expr("INTERVAL 24 HOURS"))


def features_of_days(days: DataFrame, newest: DataFrame, as_of: AsOf = None) -> DataFrame:
    """The feature table from :func:`user_days`, and from Silver rows of the ``newest``
    days, of which the last 24 hours are counted: older events are not read again."""
    now = _time_of(newest, as_of)
    recent = newest.filter(_is("purchase")).filter(
        F.col("event_timestamp") >= now - F.expr("INTERVAL 24 HOURS")
    )
    recent = recent.groupBy("user_id").agg(F.count(F.lit(1)).alias("purchases_last_24h"))
    counts = days.groupBy("user_id").agg(
        F.sum("purchases").alias("total_purchases"),
        exact.merged_total("price", 2).alias("total_revenue"),
        exact.merged_mean("price", F.sum("priced"), 2).alias("avg_order_value"),
        F.round(F.max("most"), 2).alias("max_purchase_value"),
        F.round(F.min("least"), 2).alias("min_purchase_value"),
        F.sum("events").alias("total_events"),
        F.sum("views").alias("view_count"),
        F.sum("carts").alias("cart_count"),
        F.countDistinct("product_id").alias("unique_products"),
        F.min("first_activity").alias("first_activity"),
        F.max("last_activity").alias("last_activity"),
    )
    joined = _with_frequency(counts).join(recent, "user_id", "left")
    ratios = _conversion_ratios("view_count", "cart_count", "total_purchases")
    return _finished(joined.withColumns(ratios), now)


def features_as_of(silver: DataFrame, times: list[datetime]) -> DataFrame:
    """The features of each user at each of ``times``, whole hours, from the events before it: what
    a model may be trained on without looking ahead. A user has a row from their first event on.

    One pass sums events up by user and hour. A window along the hours of each user then gives all
    times at once: a running total, and a range of 24 hours. A window holds hours, not events, so
    a user with very many events takes no more room than another; distinct products are
    counted where each is first seen.
    """
    kind = silver.schema["event_timestamp"].dataType
    bought = _is("purchase")
    price = F.when(bought, F.col("price"))
    hour = F.date_trunc("hour", "event_timestamp").cast(kind).alias("hour")
    by_product = silver.groupBy("user_id", hour, "product_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(_is("view")).alias("view_count"),
        F.count_if(_is("cart")).alias("cart_count"),
        F.count_if(bought).alias("total_purchases"),
        F.count(price).alias("priced"),
        *exact.parts(price, "price"),
        F.max(price).alias("most"),
        F.min(price).alias("least"),
        F.min("event_timestamp").alias("first_activity"),
        F.max("event_timestamp").alias("last_activity"),
    )
    sums = ["total_events", "view_count", "cart_count", "total_purchases", "priced"]
    sums += [f"price_{part}" for part in ("units", "millionths", "dust", "loose")]
    extremes = {"most": F.max, "least": F.min, "first_activity": F.min, "last_activity": F.max}
    by_hour = by_product.groupBy("user_id", "hour").agg(
        *[F.sum(c).alias(c) for c in sums], *[f(c).alias(c) for c, f in extremes.items()]
    )
    seen = by_product.filter(F.col("product_id").isNotNull()).groupBy("user_id", "product_id")
    new = seen.agg(F.min("hour").alias("hour")).groupBy("user_id", "hour")
    hours = by_hour.join(
        new.agg(F.count(F.lit(1)).alias("new_products")), ["user_id", "hour"], "left"
    ).withColumn("as_of", F.lit(None).cast(kind))
    asked = F.array(*[F.lit(t).cast(kind) for t in sorted(set(times))])
    firsts = by_hour.groupBy("user_id").agg(F.min("first_activity").alias("since"))
    spine = firsts.select("user_id", "since", F.explode(asked).alias("as_of"))
    spine = spine.filter(F.col("since") < F.col("as_of")).select("user_id", "as_of")
    rows = hours.unionByName(
        spine.withColumn("hour", F.col("as_of")), allowMissingColumns=True
    ).withColumn("second", F.unix_timestamp(F.col("hour").cast("timestamp")))
    along = Window.partitionBy("user_id").orderBy("second")
    before = along.rangeBetween(Window.unboundedPreceding, -1)
    day = along.rangeBetween(-24 * 3600, -1)
    sums.append("new_products")
    running = rows.select(
        "user_id",
        "as_of",
        F.sum("total_purchases").over(day).alias("purchases_last_24h"),
        *[F.sum(c).over(before).alias(c) for c in sums],
        *[f(c).over(before).alias(c) for c, f in extremes.items()],
    ).filter(F.col("as_of").isNotNull())
    counts = running.select(
        "user_id",
        "as_of",
        "purchases_last_24h",
        "total_purchases",
        exact.stored_total("price", 2).alias("total_revenue"),
        exact.stored_mean("price", F.col("priced"), 2).alias("avg_order_value"),
        F.round("most", 2).alias("max_purchase_value"),
        F.round("least", 2).alias("min_purchase_value"),
        "total_events",
        "view_count",
        "cart_count",
        F.coalesce("new_products", F.lit(0)).alias("unique_products"),
        "first_activity",
        "last_activity",
    )
    ratios = _conversion_ratios("view_count", "cart_count", "total_purchases")
    return _finished(_with_frequency(counts).withColumns(ratios), F.col("as_of"))
