"""Hourly tables as a stream: open hours are kept up, not only closed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.errors import TableNotFoundError
from eventlake.operators import hourly
from eventlake.sources.tables import read_table, write_table

DAY = "event_date"
CELL = ["hour", "user_id", "product_id"]


def stream_cells(silver: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Counts and sums of each hour, user and product of a Silver stream, as windowed state: a
    cell is given out anew, whole, whenever events add to it, until the watermark closes its hour.

    Distinct users and products of an hour follow from its cells exactly, and a busy hour is
    spread over its cells.
    """
    timed = silver.withWatermark("event_timestamp", lateness)
    window = F.window("event_timestamp", "1 hour").alias("window")
    cells = timed.groupBy(window, "user_id", "product_id").agg(*hourly.cell_measures())
    hour = F.col("window.start").alias("hour")
    return cells.select(hour, F.to_date("window.start").alias(DAY), "*").drop("window")


def keep_hours(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    lateness: str = "1 hour",
    interval: str | None = None,
) -> StreamingQuery:
    """Start keeping the cells of a Silver stream in a table at ``path``, keyed by hour, user and product
    and laid out by day. Drains what is there and ends, or with ``interval`` goes on."""
    writer = (
        stream_cells(silver, lateness)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: upsert(batch, path, fmt))
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def upsert(batch: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Put the cells of a batch in the place of those with the same key. Only days the batch
    touches are written, beside the old ones until they are complete; as a cell holds its
    whole count, doing it twice changes nothing.
    """
    batch = batch.persist()
    try:
        days = [row[0] for row in batch.select(DAY).distinct().collect()]
        if not days:
            return
        try:
            old = read_table(batch.sparkSession, path, fmt).filter(F.col(DAY).isin(days))
        except TableNotFoundError:
            merged = batch
        else:
            same = [old[c].eqNullSafe(batch[c]) for c in CELL]
            kept = old.join(batch, same, "left_anti")
            merged = kept.unionByName(batch)
        write_table(merged, path, fmt, partition_by=DAY, only_touched=True)
    finally:
        batch.unpersist()


def gold_of_cells(cells: DataFrame) -> dict[str, DataFrame]:
    """The three hourly tables from the cells, open hours included."""
    return hourly.gold_tables(hourly.rollup_of_cells(cells))
