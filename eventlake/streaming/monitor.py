"""Throughput of the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators import analytics

from eventlake.functions import times


def events_per_minute(bronze: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Events per minute of a Bronze stream. A minute is emitted once, when no event
    ``lateness`` behind the newest can still change it; state is one count per open
    minute. Rows without a valid time fall into no window. On a batch table this is
    the full count."""
    timed = bronze.select(times.parsed(bronze, "event_timestamp").alias("at"))
    return (
        timed.withWatermark("at", lateness)
        .groupBy(F.window("at", "1 minute"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(F.col("window.start").alias("minute"), "event_count")
    )


def complete_minutes(emitted: DataFrame, bronze: DataFrame) -> DataFrame:
    """Every minute with events, once a run has drained its stream: the ``emitted`` ones,
    and those still open then, counted from Bronze. No event is counted twice: a minute
    after the last emitted one is open, or has no events."""
    last = F.coalesce(emitted.agg(F.max("minute")).scalar(), F.lit("0001-01-01").cast("timestamp"))
    counted = analytics.events_per_minute(bronze)
    newer = counted.filter(F.col("minute") > last)
    return emitted.select("minute", "event_count").unionByName(newer)


def late_events(emitted: DataFrame, bronze: DataFrame) -> DataFrame:
    """One row: events that came too late for their minute and are in Bronze only."""
    counted = analytics.events_per_minute(bronze).withColumnRenamed("event_count", "stored")
    missed = F.col("stored") - F.col("event_count")
    return counted.join(emitted, "minute").agg(
        F.coalesce(F.sum(missed), F.lit(0)).alias("late_events")
    )
