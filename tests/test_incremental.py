"""Incremental jobs: equal to a rebuild, and unhurt by crashes, replays and late events."""

import os
import threading
from datetime import date, datetime

import pytest
from conftest import as_json, record, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import __spark_entry__ as contract
from eventlake import adapters, schemas
from eventlake.functions.records import decode_records
from eventlake.operators import cleaning, features, hourly, quality
from eventlake.plans import incremental, jobs
from eventlake.session import side_by_side
from eventlake.sources.records import file_records
from eventlake.sources.tables import read_table

AS_OF = datetime(2024, 1, 30, 12)
SF_DIR = "/root/testdata/sf0.001"
GOLD = ("revenue_per_hour", "active_users_per_hour", "conversion_rate")


def deliver(spark, paths, records):
    records.coalesce(1).write.mode("append").parquet(paths.at("records"))
    jobs.run_bronze(spark, file_records(spark, paths.at("records")), paths)


def state(spark, paths):
    names = {n: paths.gold(n) for n in (*GOLD, "distinct_sketches")}
    names |= {"silver": paths.silver, "days": paths.user_days, "quarantine": paths.quarantine}
    return {name: rows(read_table(spark, path)) for name, path in names.items()}


def assert_equals_rebuild(spark, paths):
    bronze = read_table(spark, paths.bronze, schema=schemas.BRONZE)
    tagged = quality.tag_violations(bronze)
    sound = tagged.filter(F.size("violated_rules") == 0).drop("violated_rules")
    silver = cleaning.clean(sound)
    stored = read_table(spark, paths.silver)
    assert rows(stored.drop("event_date")) == rows(silver)
    for name, table in hourly.gold_tables(hourly.hourly_rollup(silver)).items():
        # A table without a row yet has no file.
        if table.isEmpty():
            continue
        assert rows(read_table(spark, paths.gold(name)).drop("event_date")) == rows(table)
    incremental.refresh_features(spark, paths, AS_OF)
    table = read_table(spark, paths.features)
    assert rows(table) == rows(features.user_features(silver, AS_OF))
    bad = tagged.filter(F.size("violated_rules") > 0)
    if not bad.isEmpty():
        aside = read_table(spark, paths.quarantine).drop("batch_id")
        assert rows(aside.select("offset")) == rows(bad.select("offset"))


def files_of(path):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def visits(offset, *hours, user=1, kind="view", price=0.0):
    values = [as_json(user, 1, kind, price, f"2024-01-{h // 24 + 1:02}T{h % 24:02}:30:00") for h in hours]
    return [record(offset + i, v) for i, v in enumerate(values)]


def test_batches_add_up_to_a_rebuild(spark, tmp_path):
    paths = jobs.LakePaths(str(tmp_path))
    events = adapters.source_events(spark, SF_DIR)
    late = F.col("event_type") == "purchase"
    deliver(spark, paths, adapters.records(events.filter(~late)))
    assert incremental.run_incremental(spark, paths)
    assert_equals_rebuild(spark, paths)
    deliver(spark, paths, adapters.records(events.filter(late)))
    deliver(spark, paths, adapters.redelivered_records(events))
    assert incremental.run_incremental(spark, paths, files_per_batch=1)
    assert_equals_rebuild(spark, paths)
    taken = incremental.batches(spark, paths).collect()
    assert len(taken) == 3 and sum(b.rows_read for b in taken) == 2 * events.count()
    for b in taken:
        assert b.rows_read == b.rows_quarantined + b.rows_untimed + b.rows_arrived
    before = state(spark, paths)
    assert incremental.run_incremental(spark, paths)
    assert state(spark, paths) == before


def test_a_late_event_rewrites_its_day_only(spark, tmp_path):
    paths = jobs.LakePaths(str(tmp_path))
    first = [*visits(0, 1, 30, 55), *visits(10, 2, 31, 56, kind="purchase", price=2.0)]
    deliver(spark, paths, spark.createDataFrame(first, schemas.RECORD))
    incremental.run_incremental(spark, paths)
    tables = [paths.silver, paths.user_days, *(paths.gold(n) for n in GOLD)]
    before = {t: files_of(t) for t in tables}
    late = spark.createDataFrame(visits(100, 33, kind="purchase", price=5.0), schemas.RECORD)
    deliver(spark, paths, late)
    incremental.run_incremental(spark, paths)
    for t in tables:
        now = files_of(t)
        kept = {f for f in before[t] if "event_date=2024-01-02" not in f and "arrivals" not in f}
        assert kept and all(now.get(f) == before[t][f] for f in kept)
        new = {f for f in set(now) - set(before[t]) if "arrivals" not in f}
        assert new and all("event_date=2024-01-02" in f for f in new)
    assert_equals_rebuild(spark, paths)


@pytest.mark.parametrize("step", ["arrivals", "silver/ecommerce_events", "revenue_per_hour", "user_days", "commit"])
def test_a_batch_that_broke_off_is_taken_in_once(spark, tmp_path, monkeypatch, step):
    """It stops behind the write of ``step``, and goes on at the next start."""
    paths = jobs.LakePaths(str(tmp_path))
    first = [*visits(0, 1, 30), *visits(10, 2, kind="purchase", price=2.0), *visits(20, 3, kind="refund")]
    deliver(spark, paths, spark.createDataFrame(first, schemas.RECORD))
    write = incremental.write_table
    commit = incremental._commit

    def breaking(table, path, *rest, **options):
        done = write(table, path, *rest, **options)
        if path.endswith(step):
            raise RuntimeError("broke off")
        return done

    def no_commit(*_):
        raise RuntimeError("broke off")

    if step == "commit":
        calls = []
        monkeypatch.setattr(
            incremental, "_commit", lambda *a: calls.append(1) or (commit(*a) if len(calls) == 1 else no_commit())
        )
    else:
        monkeypatch.setattr(incremental, "write_table", breaking)
    with pytest.raises(StreamingQueryException, match="broke off"):
        incremental.run_incremental(spark, paths)
    monkeypatch.setattr(incremental, "write_table", write)
    monkeypatch.setattr(incremental, "_commit", commit)
    incremental.run_incremental(spark, paths)
    assert_equals_rebuild(spark, paths)
    assert [b.rows_read for b in incremental.batches(spark, paths).collect()] == [4]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    paths = jobs.LakePaths(str(tmp_path))
    bought = visits(20, 5, kind="purchase", price=2.5)
    rest = [*visits(0, 1, 30), *visits(9, 4, kind="refund")]
    records = spark.createDataFrame([*bought, *rest], schemas.RECORD)
    batch = decode_records(records)
    incremental.apply_batch(batch, 0, paths)
    before, files = state(spark, paths), files_of(paths.root)
    incremental.apply_batch(batch, 0, paths)
    assert files_of(paths.root) == files
    # Without its commit the batch is done again, with the same result.
    os.remove(f"{paths.commits}/batch_id=0/_SUCCESS")
    incremental.apply_batch(batch, 0, paths)
    assert state(spark, paths) == before


def test_odd_batches(spark, edge_records, tmp_path):
    paths = jobs.LakePaths(str(tmp_path))
    incremental.apply_batch(decode_records(edge_records), 0, paths)
    incremental.apply_batch(decode_records(edge_records.limit(0)), 1, paths)
    first, second = incremental.batches(spark, paths).orderBy("batch_id").collect()
    n = edge_records.count()
    assert (first.rows_read, second.rows_read, second.days) == (n, 0, [])
    assert first.rows_quarantined + first.rows_untimed + first.rows_arrived == n
    assert first.days == [date(2024, 1, 1)]
    bronze = decode_records(edge_records)
    sound = quality.tag_violations(bronze).filter(F.size("violated_rules") == 0)
    stored = read_table(spark, paths.silver).drop("event_date")
    assert rows(stored) == rows(cleaning.clean(sound.drop("violated_rules")))


def test_nothing_sound_leaves_no_layer(spark, tmp_path):
    paths = jobs.LakePaths(str(tmp_path))
    bad = spark.createDataFrame(visits(0, 1, kind="refund"), schemas.RECORD)
    incremental.apply_batch(decode_records(bad), 0, paths)
    assert read_table(spark, paths.quarantine).count() == 1
    assert incremental.batches(spark, paths).first().days == []


@pytest.mark.parametrize(
    "tables",
    [
        ("quarantine/ecommerce_events", "silver/arrivals"),
        ("distinct_sketches", "user_days", "revenue_per_hour"),
        ("revenue_per_hour", "active_users_per_hour", "conversion_rate"),
    ],
)
def test_tables_that_do_not_need_each_other_are_written_at_once(spark, tmp_path, monkeypatch, tables):
    """Each of ``tables`` waits until the writes of all have begun."""
    paths = jobs.LakePaths(str(tmp_path))
    write, begun = incremental.write_table, threading.Barrier(len(tables))

    def meeting(table, path, *rest, **options):
        if path.endswith(tables):
            begun.wait(60)
        return write(table, path, *rest, **options)

    monkeypatch.setattr(incremental, "write_table", meeting)
    bought = visits(0, 1, 30, kind="purchase", price=2.0)
    records = spark.createDataFrame([*bought, *visits(9, 4, kind="refund")], schemas.RECORD)
    batch = decode_records(records)
    batch.write.parquet(paths.bronze)
    incremental.apply_batch(batch, 0, paths)
    assert_equals_rebuild(spark, paths)


def test_steps_side_by_side_all_end_before_an_error_is_raised(spark):
    ended, failed = [], threading.Event()

    def fails():
        failed.set()
        raise RuntimeError("broke off")

    def goes_on():
        failed.wait(60)
        ended.append(spark.range(10).count())

    with pytest.raises(RuntimeError, match="broke off"):
        side_by_side(spark, fails, goes_on)
    assert ended == [10]
    assert side_by_side(spark, lambda: 1, lambda: 2) == [1, 2]


def test_deliveries_of_one_row_group_are_encoded_by_many_tasks(spark, tmp_path, monkeypatch):
    """They also hold every row of the table, however often it comes."""
    event = "{}L AS event_id, timestamp_ntz'2024-01-01 10:00:00' AS ts, {}L AS user_id, '{}' AS event_type"
    rest = "2.5D AS value, '{\"k\": 7}' AS props"
    texts = [event.format(i, i % 5, ("view", "purchase")[i % 2]) for i in range(200)]
    texts += [event.format("null", "null", "view")] * 2
    texts = [t.replace("nullL", "CAST(NULL AS BIGINT)") for t in texts]
    table = spark.sql(" UNION ALL ".join(f"SELECT {t}, {rest}" for t in texts))
    table.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    for module, name in ((jobs, "run_bronze"), (incremental, "run_incremental")):
        monkeypatch.setattr(module, name, lambda *_: True)
    records = read_table(spark, contract._incremental(spark, str(tmp_path)).at("records"))
    per_file = records.groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(per_file) > 3 * 4 and max(r["count"] for r in per_file) < 100
    events = adapters.source_events(spark, str(tmp_path))
    whole = adapters.records(events).unionAll(adapters.redelivered_records(events))
    assert rows(records) == rows(whole)
