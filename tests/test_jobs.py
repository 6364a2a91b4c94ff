from datetime import datetime

import pytest
from conftest import as_json, record, rows
from pyspark.sql import functions as F

from eventlake import adapters, schemas
from eventlake.errors import DataQualityError, EmptyTableError, TableNotFoundError
from eventlake.operators import cleaning
from eventlake.plans import jobs
from eventlake.session import scratch_dir
from eventlake.sources.records import file_records
from eventlake.sources.registry import TableRegistry
from eventlake.sources.tables import layer_status, read_table

AS_OF = datetime(2024, 1, 30, 12)
SF_DIR = "/root/testdata/sf0.01"


def ingest(spark, records, root):
    paths = jobs.LakePaths(str(root))
    records.write.mode("append").parquet(paths.at("records"))
    assert jobs.run_bronze(spark, file_records(spark, paths.at("records")), paths)
    return paths


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """A lake over the valid events; a third of the users buys nothing."""
    events = adapters.source_events(spark, SF_DIR).filter("event_type IN ('view', 'click', 'purchase')")
    events = events.filter("event_type <> 'purchase' OR user_id % 3 > 0")
    paths = ingest(spark, adapters.records(events), tmp_path_factory.mktemp("lake"))
    metrics = jobs.run_all(spark, paths, AS_OF)
    return paths, metrics


def test_the_whole_chain(spark, lake):
    paths, metrics = lake
    assert metrics.accuracy >= 0.5 and metrics.n_train + metrics.n_test == 150
    bronze, silver = (read_table(spark, p) for p in (paths.bronze, paths.silver))
    assert silver.schema.simpleString() == schemas.SILVER.simpleString()
    assert rows(silver) == rows(cleaning.clean(bronze))
    registry = TableRegistry.load(spark, paths.queryable())
    total = registry.run_query("SELECT sum(total_events) AS n FROM user_features").first().n
    hourly = registry.run_query("SELECT sum(total_events) AS n FROM active_users_per_hour").first().n
    assert total == hourly == silver.count()
    status = {r.layer: r for r in layer_status(spark, paths.layers()).collect()}
    assert all(row.exists for row in status.values()) and len(status) == 6


def test_a_rerun_gives_the_same_tables(spark, lake):
    paths, _ = lake
    names = {n: p for n, p in paths.layers().items() if n != "bronze"}
    before = {n: rows(read_table(spark, p)) for n, p in names.items()}
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths)
    jobs.run_features(spark, paths, AS_OF)
    assert {n: rows(read_table(spark, p)) for n, p in names.items()} == before


def test_dirty_input_fails_before_anything_is_written(spark, edge_records, tmp_path):
    paths = ingest(spark, edge_records, tmp_path)
    with pytest.raises(DataQualityError) as caught:
        jobs.run_silver(spark, paths)
    assert caught.value.violations["null_user_id"] == 3
    with pytest.raises(TableNotFoundError):
        read_table(spark, paths.silver)
    counts = jobs.run_silver(spark, paths, on_violation="quarantine")
    assert counts["rows_quarantined"] == 9
    assert counts["rows_read"] == 8 and counts["rows_written"] == 5
    assert (counts["unknown_type"], counts["bad_time"]) == (1, 1)
    assert read_table(spark, paths.quarantine).filter("size(violated_rules) = 0").isEmpty()


def test_silver_by_date(spark, edge_records, tmp_path):
    paths = ingest(spark, edge_records.filter("offset <= 5"), tmp_path)
    jobs.run_silver(spark, paths, by_date=True)
    silver = read_table(spark, paths.silver)
    assert [str(r.event_date) for r in silver.select("event_date").distinct().collect()] == ["2024-01-01"]
    assert jobs.run_gold(spark, paths)["revenue_per_hour"] == 2


def test_too_few_rows_skip_training(spark, edge_records, tmp_path):
    paths = ingest(spark, edge_records.filter("offset <= 5"), tmp_path)
    jobs.run_silver(spark, paths)
    jobs.run_features(spark, paths, AS_OF)
    with pytest.warns(UserWarning):
        assert jobs.run_training(spark, paths) is None


def test_an_empty_gold_table_stops_the_chain(spark, tmp_path):
    views = [record(i, as_json(1, 1, "view", 0.0, "2024-01-01T00:00:00")) for i in range(3)]
    paths = ingest(spark, spark.createDataFrame(views, schemas.RECORD), tmp_path)
    with pytest.raises(EmptyTableError, match="revenue_per_hour"):
        jobs.run_all(spark, paths, AS_OF)


def test_duplicates_are_the_rows_neither_dropped_nor_written(spark, tmp_path):
    bronze = adapters.records(adapters.source_events(spark, "/root/testdata/sf0.001"))
    valid = bronze.filter(F.col("value").cast("string").rlike("view|cart|purchase"))
    paths = ingest(spark, valid.unionByName(valid), tmp_path)
    counts = jobs.run_silver(spark, paths)
    assert counts["rows_read"] == 1200 and counts["rows_written"] == 600


def test_scratch_paths_are_new(spark):
    one, other = (scratch_dir(spark, "trial") for _ in range(2))
    assert one != other
    spark.range(3).write.parquet(one)
    assert spark.read.parquet(one).count() == 3
