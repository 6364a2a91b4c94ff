"""Silver as a stream: duplicates are known by keyed state, not by reading Silver again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators import cleaning


def stream_silver(
    bronze: DataFrame, lateness: str = "1 hour", normalize_first: bool = False
) -> DataFrame:
    """Silver rows of a Bronze stream, each as soon as it arrives.

    The state holds the keys of events less than ``lateness`` older than the newest. A copy
    that comes within that time meets its key there, one that comes later is older than the
    watermark: both are left out, over restarts too. The first copy wins as long as
    copies of an event come in order, as they do within a Kafka partition, whose key is the user.

    An event that comes first but later than ``lateness`` is left out as well;
    :func:`missed` finds it, and a rebuild of its day takes it in.
    """
    timed = cleaning.arrivals(bronze, normalize_first).filter(F.col("event_time").isNotNull())
    unique = timed.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(
        cleaning.DUPLICATE_KEY
    )
    return cleaning.silver_rows(unique)


def missed(silver: DataFrame, bronze: DataFrame, normalize_first: bool = False) -> DataFrame:
    """Events of Bronze that are not in the Silver of a stream, in the columns of Silver."""
    batch = cleaning.clean(bronze, normalize_first)
    key = ["user_id", "product_id", "event_type", "event_timestamp"]
    same = [batch[c].eqNullSafe(silver[c]) for c in key]
    return batch.join(silver, same, "left_anti")
