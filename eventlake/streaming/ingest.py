"""The Bronze stream: decode records and append them, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.functions.records import decode_records


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table. A restart on the same checkpoint goes on
    where the last run stopped and writes nothing twice.

    Without ``interval`` the query drains what is there and ends; with one, for
    instance ``"30 seconds"``, it runs until stopped. New columns are kept: Delta
    merges them on write, Parquet tables where they are read (``merge_schema``).
    """
    writer = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if fmt == "delta":
        writer = writer.option("mergeSchema", "true")
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start(path)


def ingest(
    records: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = None,
    keep_raw: bool = False,
) -> StreamingQuery:
    """Records to Bronze: a map-only job, so batches need no shuffle."""
    return append_stream(decode_records(records, keep_raw), path, checkpoint, fmt, interval)


def run_until_stopped(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for a query; an interrupt or the timeout (in seconds) stops it. Returns
    whether it ended on its own; an error of the query is raised."""
    try:
        ended = bool(query.awaitTermination(timeout)) if timeout else query.awaitTermination() is None
    except KeyboardInterrupt:
        ended = False
    finally:
        if query.isActive:
            query.stop()
    return ended
