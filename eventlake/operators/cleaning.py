"""Bronze to Silver: filter, deduplicate, normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions import times
from eventlake.operators.quality import normalised_type

DUPLICATE_KEY = ["user_id", "product_id", "event_type", "event_timestamp"]
ARRIVAL = ["kafka_timestamp", "topic", "partition", "offset"]


def drop_duplicates(bronze: DataFrame) -> DataFrame:
    """One row per duplicate key, the first to arrive; NULLs in the key are equal.

    A grouped aggregate rather than a ranking window: copies are merged before the
    shuffle, so a key that holds a large share of all rows moves as one row per task.
    The other columns follow the arrival in the compared struct, so that the result
    is the same even where two rows arrived together.
    """
    rest = [c for c in bronze.columns if c not in DUPLICATE_KEY + ARRIVAL]
    return (
        bronze.groupBy(*DUPLICATE_KEY)
        .agg(F.min(F.struct(*ARRIVAL, *rest)).alias("first"))
        .select(*[F.col(c if c in DUPLICATE_KEY else f"first.{c}") for c in bronze.columns])
    )


class DropCounts:
    """Row counts taken while :func:`clean` runs: rows read, rows without user or with
    an unknown type, and, once duplicates are gone, rows without a valid time."""

    def __init__(self) -> None:
        self.reading = Observation()
        self.timing = Observation()

    def of_read(self, bronze: DataFrame) -> DataFrame:
        no_user = F.col("user_id").isNull()
        known = F.coalesce(_known_type(), F.lit(False))
        return bronze.observe(
            self.reading,
            F.count(F.lit(1)).alias("rows_read"),
            F.count_if(no_user).alias("no_user"),
            F.count_if(~no_user & ~known).alias("unknown_type"),
        )

    def of_timed(self, rows: DataFrame) -> DataFrame:
        bad = F.count_if(F.col("event_time").isNull())
        return rows.observe(self.timing, bad.alias("bad_time"))

    def get(self) -> dict[str, int]:
        """The counts, once an action has run."""
        return {**self.reading.get, **self.timing.get}


def _known_type() -> Column:
    return normalised_type().isin(schemas.EVENT_TYPES)


def clean(
    bronze: DataFrame, normalize_first: bool = False, counts: DropCounts | None = None
) -> DataFrame:
    """Silver rows of ``bronze``.

    Duplicates are found on the raw type and time: ``View`` and ``view`` at one
    instant both survive. ``normalize_first`` compares the normalised values instead.

    User and type are tested before deduplication, which gives the same rows as
    testing after it, since they belong to the key, and keeps dropped rows out of the
    shuffle. Times are parsed once per row and travel with it; parsing is the dearest
    step, and a test on the parsed time ahead of the shuffle would repeat it.
    """
    if counts:
        bronze = counts.of_read(bronze)
    kept = drop_duplicates(arrivals(bronze, normalize_first))
    if counts:
        kept = counts.of_timed(kept)
    return silver_rows(kept.filter(F.col("event_time").isNotNull()))


def arrivals(bronze: DataFrame, normalize_first: bool = False) -> DataFrame:
    """Rows with a user and a known type, duplicates included: their key, price and
    arrival, and the parsed time, NULL where it is none."""
    usable = bronze.filter(F.col("user_id").isNotNull()).filter(_known_type())
    timed = usable.select(
        *DUPLICATE_KEY,
        "price",
        *ARRIVAL,
        times.parsed(bronze, "event_timestamp").alias("event_time"),
    )
    if normalize_first:
        timed = timed.withColumns(
            {"event_type": normalised_type(), "event_timestamp": F.col("event_time")}
        )
    return timed


def silver_rows(kept: DataFrame) -> DataFrame:
    """Arrivals, of which one of each key is left, in the columns of Silver."""
    return kept.select(
        "user_id",
        "product_id",
        normalised_type().alias("event_type"),
        "price",
        F.col("event_time").alias("event_timestamp"),
        F.col("kafka_timestamp").alias("ingestion_timestamp"),
    )
