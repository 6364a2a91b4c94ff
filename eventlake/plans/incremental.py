"""Silver, Gold and features kept up with Bronze, batch by batch.

A batch of new Bronze rows is checked, its sound rows are added to the arrivals, which keep
duplicates and lie by day, and the days it touches are built anew: Silver from their arrivals, and
Gold and the users' days from their Silver. No other day is read or written. A late event, or one
delivered again, thus has the effect it would have had in time.

Every step replaces what an earlier try of it may have left, by batch or by day, so a batch
that broke off is simply run again; one that is committed is passed over. The counts of a batch
are its commit, and are written last.
"""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.errors import TableNotFoundError
from eventlake.operators import cleaning, features, hourly, quality
from eventlake.plans.jobs import LakePaths
from eventlake.session import checkpointed, side_by_side
from eventlake.sources.tables import exists, read_table, write_table
from eventlake.streaming.ingest import run_until_stopped

DAY = "event_date"

COMMIT = """batch_id bigint, rows_read bigint, rows_quarantined bigint, rows_untimed bigint,
rows_arrived bigint, days array<date>"""


def run_incremental(
    spark: SparkSession,
    paths: LakePaths,
    interval: str | None = None,
    timeout: float | None = None,
    files_per_batch: int | None = None,
    normalize_first: bool = False,
) -> bool:
    """Bring Silver, Gold and the users' days up to Bronze. Without ``interval`` all of
    Bronze that is new is worked off, in batches of ``files_per_batch`` files at most, and the job
    ends; with one it goes on until stopped. Returns whether it ended on its own."""
    reader = spark.readStream.format(paths.fmt)
    if paths.fmt != "delta":
        reader = reader.schema(schemas.BRONZE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    query = (
        reader.load(paths.bronze)
        .writeStream.foreachBatch(
            lambda batch, batch_id: apply_batch(batch, batch_id, paths, normalize_first)
        )
        .option("checkpointLocation", paths.batches_checkpoint)
        .trigger(**trigger)
        .start()
    )
    return run_until_stopped(query, timeout)


def apply_batch(
    batch: DataFrame, batch_id: int, paths: LakePaths, normalize_first: bool = False
) -> None:
    """Take one batch of Bronze rows in, unless it is in already."""
    spark = batch.sparkSession
    if exists(spark, f"{_commit(paths, batch_id)}/_SUCCESS"):
        return
    counts = _sort_out(batch, batch_id, paths, normalize_first)
    days = _days(spark, batch_id, paths)
    if days:
        rebuild_days(spark, paths, days)
    row = (batch_id, *counts, days)
    commit = spark.createDataFrame([row], COMMIT).drop("batch_id")
    commit.coalesce(1).write.mode("overwrite").json(_commit(paths, batch_id))


def _commit(paths: LakePaths, batch_id: int) -> str:
    return f"{paths.commits}/batch_id={batch_id}"


def _sort_out(
    batch: DataFrame, batch_id: int, paths: LakePaths, normalize_first: bool
) -> tuple[int, ...]:
    """Rows that break a rule to the quarantine, the others to the arrivals, each under the
    batch's own folder, which a second try replaces. Returns rows read, set
    aside, without a valid time, and arrived: the last three make up the first."""
    own = F.lit(batch_id).cast("long").alias("batch_id")
    tagged = quality.tag_violations(batch)
    broken = tagged.filter(F.size("violated_rules") > 0).select("*", own)
    sound = tagged.filter(F.size("violated_rules") == 0)
    # A NULL type breaks no rule, and is no event.
    arrived = cleaning.arrivals(sound, normalize_first)
    timed = arrived.filter(F.col("event_time").isNotNull())
    timed = timed.select("*", F.to_date("event_time").alias(DAY), own)
    set_aside, written, rows = side_by_side(
        batch.sparkSession,
        lambda: write_table(
            broken, paths.quarantine, paths.fmt, partition_by="batch_id", only_touched=True
        ),
        lambda: write_table(
            timed,
            paths.arrivals,
            paths.fmt,
            partition_by=[DAY, "batch_id"],
            only_touched=True,
        ),
        batch.count,
    )
    bad, good = set_aside["rows_written"], written["rows_written"]
    return rows, bad, rows - bad - good, good


def _days(spark: SparkSession, batch_id: int, paths: LakePaths) -> list[date]:
    """Days the batch has arrivals for, from the names of its folders."""
    try:
        arrivals = read_table(spark, paths.arrivals, paths.fmt)
    except TableNotFoundError:
        return []
    own = arrivals.filter(F.col("batch_id") == batch_id).select(DAY).distinct()
    return sorted(row[0] for row in own.collect())


def rebuild_days(spark: SparkSession, paths: LakePaths, days: list[date]) -> None:
    """Silver, Gold and the users' days of ``days``, all from the arrivals. What is built from
    Silver is built side by side."""
    touched = F.col(DAY).isin(days)
    arrivals = read_table(spark, paths.arrivals, paths.fmt).filter(touched)
    kept = cleaning.silver_rows(cleaning.drop_duplicates(arrivals.drop(DAY, "batch_id")))
    _replace_days(kept.withColumn(DAY, F.to_date("event_timestamp")), paths.silver, paths)
    silver = read_table(spark, paths.silver, paths.fmt).filter(touched)

    def replace_gold() -> None:
        rollup = checkpointed(hourly.hourly_rollup(silver))
        side_by_side(
            spark,
            *[
                partial(_replace_days, table.withColumn(DAY, F.to_date("hour")), paths.gold(n), paths)
                for n, table in hourly.gold_tables(rollup).items()
            ]
        )

    sketches = hourly.distinct_sketches(silver).withColumn(DAY, F.to_date("hour"))
    side_by_side(
        spark,
        replace_gold,
        lambda: _replace_days(sketches, paths.gold("distinct_sketches"), paths),
        lambda: _replace_days(features.user_days(silver, DAY), paths.user_days, paths),
    )


def _replace_days(table: DataFrame, path: str, paths: LakePaths) -> None:
    write_table(table, path, paths.fmt, partition_by=DAY, only_touched=True)


def refresh_features(
    spark: SparkSession, paths: LakePaths, as_of: features.AsOf = None
) -> dict[str, int]:
    """Replace the feature table from the users' days and the Silver rows of the last
    24 hours; returns its row count."""
    newest = read_table(spark, paths.silver, paths.fmt).filter(F.col(DAY) >= features.since(as_of))
    days = read_table(spark, paths.user_days, paths.fmt)
    table = features.features_of_days(days, newest, as_of)
    return write_table(table, paths.features, paths.fmt)


def batches(spark: SparkSession, paths: LakePaths) -> DataFrame:
    """The commits, one row per batch."""
    return spark.read.schema(COMMIT).json(paths.commits)
