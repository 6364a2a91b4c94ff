"""The jobs of the lake. Each reads a table, checks it, and replaces its output; all
are plain functions, to be called by whatever schedules them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.operators import cleaning, features, hourly, model, quality
from eventlake.session import checkpointed
from eventlake.sources import artifacts
from eventlake.sources.tables import read_table, write_table
from eventlake.streaming.ingest import ingest, run_until_stopped


@dataclass(frozen=True)
class LakePaths:
    """Where the tables live, below one root."""

    root: str
    fmt: str = "parquet"

    def at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self.at("bronze", "ecommerce_events")

    @property
    def bronze_checkpoint(self) -> str:
        return self.at("checkpoints", "bronze")

    @property
    def silver(self) -> str:
        return self.at("silver", "ecommerce_events")

    @property
    def quarantine(self) -> str:
        return self.at("quarantine", "ecommerce_events")

    @property
    def batches_checkpoint(self) -> str:
        return self.at("checkpoints", "batches")

    @property
    def arrivals(self) -> str:
        return self.at("silver", "arrivals")

    @property
    def user_days(self) -> str:
        return self.at("features", "user_days")

    @property
    def commits(self) -> str:
        return self.at("commits")

    @property
    def features(self) -> str:
        return self.at("features", "user_features")

    @property
    def model(self) -> str:
        return self.at("models", "purchase_predictor")

    @property
    def metrics(self) -> str:
        return self.at("models", "metrics")

    def gold(self, table: str) -> str:
        return self.at("gold", table)

    def queryable(self) -> dict[str, str]:
        names = ("revenue_per_hour", "active_users_per_hour", "conversion_rate")
        return {**{name: self.gold(name) for name in names}, "user_features": self.features}

    def layers(self) -> dict[str, str]:
        return {"bronze": self.bronze, "silver": self.silver, **self.queryable()}


def run_bronze(
    spark: SparkSession,
    records: DataFrame,
    paths: LakePaths,
    interval: str | None = None,
    timeout: float | None = None,
) -> bool:
    """Append a record stream to Bronze. See :mod:`eventlake.streaming.ingest`."""
    query = ingest(records, paths.bronze, paths.bronze_checkpoint, paths.fmt, interval)
    return run_until_stopped(query, timeout)


def run_silver(
    spark: SparkSession,
    paths: LakePaths,
    on_violation: str = "fail",
    normalize_first: bool = False,
    by_date: bool = False,
) -> dict[str, int]:
    """Check Bronze, clean it, replace Silver; returns row counts: read, dropped by
    each check of the cleaning, and written (duplicates are the rest).

    A violated rule fails the job before anything is written. ``"quarantine"`` writes
    the offending rows, with the rules they break, to a side table and goes on with
    the rest. ``by_date`` lays Silver out in daily partitions, which lets readers of
    a period skip the other days.
    """
    bronze = read_table(spark, paths.bronze, paths.fmt, schemas.BRONZE)
    counts = {}
    if on_violation == "quarantine":
        tagged = quality.tag_violations(bronze)
        broken = F.size("violated_rules") > 0
        written = write_table(tagged.filter(broken), paths.quarantine, paths.fmt)
        counts["rows_quarantined"] = written["rows_written"]
        bronze = tagged.filter(~broken).drop("violated_rules")
    elif on_violation == "fail":
        quality.check_quality(bronze)
    else:
        raise ValueError(f"on_violation: {on_violation}")
    dropped = cleaning.DropCounts()
    silver = cleaning.clean(bronze, normalize_first, dropped)
    if by_date:
        silver = silver.withColumn("event_date", F.to_date("event_timestamp"))
    written = write_table(
        silver, paths.silver, paths.fmt, partition_by="event_date" if by_date else None
    )
    return {**counts, **dropped.get(), **written}


def run_gold(spark: SparkSession, paths: LakePaths, approx: bool = False) -> dict[str, int]:
    """Replace the three hourly tables from one scan of Silver; returns row counts."""
    silver = read_table(spark, paths.silver, paths.fmt)
    rollup = checkpointed(hourly.hourly_rollup(silver, approx))
    return {
        name: write_table(table, paths.gold(name), paths.fmt)["rows_written"]
        for name, table in hourly.gold_tables(rollup).items()
    }


def run_features(
    spark: SparkSession,
    paths: LakePaths,
    as_of: features.AsOf = None,
    label: Column | None = None,
) -> dict[str, int]:
    """Replace the feature table; returns its row count. ``label`` is a rule of its own on the
    features, true for class 1; by default a user with a purchase is."""
    table = features.user_features(read_table(spark, paths.silver, paths.fmt), as_of)
    if label is not None:
        table = table.withColumn(schemas.LABEL_COLUMN, label.cast("int"))
    return write_table(table, paths.features, paths.fmt)


def run_training(
    spark: SparkSession, paths: LakePaths, exclude_leaky: bool = False
) -> Row | None:
    """Train and gate the model, and save it if it passes: a model that does not leaves
    the old one in place, and its metrics in the history. Returns the metrics, None when
    skipped for want of rows."""
    table = read_table(spark, paths.features, paths.fmt)
    if not quality.enough_to_train(table):
        return None
    trained = model.train(table, exclude_leaky=exclude_leaky)
    artifacts.write_metrics(spark, trained.metrics, paths.metrics)
    passed = artifacts.check_model(spark, paths.metrics)
    artifacts.save_model(trained.pipeline, paths.model)
    return passed


def run_all(
    spark: SparkSession,
    paths: LakePaths,
    as_of: features.AsOf = None,
    on_violation: str = "fail",
    label: Column | None = None,
    exclude_leaky: bool = False,
) -> Row | None:
    """Silver, Gold, features and training, with the gate after each."""
    run_silver(spark, paths, on_violation)
    written = run_gold(spark, paths)
    quality.require_rows(
        **{name: read_table(spark, paths.gold(name), paths.fmt) for name in written}
    )
    run_features(spark, paths, as_of, label)
    quality.require_rows(user_features=read_table(spark, paths.features, paths.fmt))
    return run_training(spark, paths, exclude_leaky)
