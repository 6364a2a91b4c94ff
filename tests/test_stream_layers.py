"""Silver and the hourly tables as streams."""

from datetime import datetime, timedelta

from conftest import as_json, record, rows
from pyspark.sql import functions as F

from eventlake import adapters, schemas
from eventlake.functions.records import decode_records
from eventlake.operators import cleaning, hourly
from eventlake.sources.records import file_records
from eventlake.sources.tables import read_table
from eventlake.streaming import hours, ingest
from eventlake.streaming.silver import missed, stream_silver

START = datetime(2024, 1, 1)


def events(spark, offset, *minutes, user=1, kind="view", price=0.0):
    values = [
        as_json(user, 1, kind, price, (START + timedelta(minutes=m)).isoformat()) for m in minutes
    ]
    return spark.createDataFrame([record(offset + i, v) for i, v in enumerate(values)], schemas.RECORD)


def step(spark, folder, records, lateness="1 hour"):
    """Deliver, and bring both layers up to date in new queries."""
    records.coalesce(1).write.mode("append").parquet(f"{folder}/records")
    bronze = decode_records(file_records(spark, f"{folder}/records"))
    silver = stream_silver(bronze, lateness)
    ingest.run_until_stopped(ingest.append_stream(silver, f"{folder}/silver", f"{folder}/c1"))
    added = spark.readStream.schema(schemas.SILVER).parquet(f"{folder}/silver")
    ingest.run_until_stopped(hours.keep_hours(added, f"{folder}/cells", f"{folder}/c2", lateness=lateness))


def tables(spark, folder):
    bronze = decode_records(spark.read.schema(schemas.RECORD).parquet(f"{folder}/records"))
    return bronze, read_table(spark, f"{folder}/silver"), read_table(spark, f"{folder}/cells")


def test_copies_over_restarts_are_left_out(spark, tmp_path):
    folder = str(tmp_path)
    first = events(spark, 0, 0, 1, 1, 30, 90)
    step(spark, folder, first)
    # Minute 90 is in the state still; minute 0 is behind the watermark.
    step(spark, folder, events(spark, 100, 90, 0, 95))
    step(spark, folder, events(spark, 200, 95, 300, kind="purchase", price=2.5))
    bronze, silver, cells = tables(spark, folder)
    assert rows(silver) == rows(cleaning.clean(bronze))
    assert missed(silver, bronze).isEmpty()
    batch = hourly.gold_tables(hourly.hourly_rollup(silver))
    for name, table in hours.gold_of_cells(cells).items():
        assert rows(table) == rows(batch[name])


def test_open_hours_are_kept_up(spark, tmp_path):
    folder = str(tmp_path)
    for i, minutes in enumerate([(0, 10), (20,), (50, 61)]):
        step(spark, folder, events(spark, 100 * i, *minutes, user=i + 1))
    _, silver, cells = tables(spark, folder)
    active = hours.gold_of_cells(cells)["active_users_per_hour"].orderBy("hour").collect()
    assert [(r.active_users, r.total_events) for r in active] == [(3, 4), (1, 1)]
    # Doing the last batch again changes nothing.
    before = rows(cells)
    hours.upsert(cells.filter("user_id = 3"), f"{folder}/cells")
    assert rows(read_table(spark, f"{folder}/cells")) == before


def test_what_comes_too_late_is_found(spark, tmp_path):
    folder = str(tmp_path)
    step(spark, folder, events(spark, 0, 0, 300))
    step(spark, folder, events(spark, 100, 20, 310))
    step(spark, folder, events(spark, 200, 320))
    bronze, silver, _ = tables(spark, folder)
    late = missed(silver, bronze).collect()
    assert [r.event_timestamp for r in late] == [START + timedelta(minutes=20)]


def test_sketches_merge_within_their_error(spark):
    n = 20_000
    times = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, id % 1000)")
    silver = spark.range(3 * n).select(
        (F.col("id") % n).cast("int").alias("user_id"),
        F.lit(1).alias("product_id"),
        times.alias("event_timestamp"),
    )
    sketches = hourly.distinct_sketches(silver)
    for unit in ("day", "week", "month"):
        exact = {r.period: r for r in hourly.exact_distinct_by(silver, unit).collect()}
        near = {r.period: r for r in hourly.distinct_by(sketches, unit).collect()}
        assert exact.keys() == near.keys()
        for period, row in exact.items():
            assert abs(near[period].distinct_users - row.distinct_users) <= 0.05 * row.distinct_users
            assert near[period].distinct_products == 1


def test_streamed_cells_of_the_table(spark, tmp_path):
    folder = str(tmp_path)
    records = adapters.records(adapters.source_events(spark, "/root/testdata/sf0.001"))
    step(spark, folder, records)
    bronze, silver, cells = tables(spark, folder)
    assert rows(silver) == rows(cleaning.clean(bronze))
    batch = hourly.gold_tables(hourly.hourly_rollup(silver))
    for name, table in hours.gold_of_cells(cells).items():
        assert rows(table) == rows(batch[name])
