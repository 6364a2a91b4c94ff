from datetime import datetime, timedelta

from conftest import EDGE_EVENTS, as_json, record, rows
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions.records import decode_records
from eventlake.operators import analytics
from eventlake.sources.records import file_records
from eventlake.sources.tables import read_table
from eventlake.streaming import ingest, monitor


def add_file(records, folder):
    records.coalesce(1).write.mode("append").parquet(folder)


def drain(spark, folder, keep_raw=False):
    query = ingest.ingest(
        file_records(spark, f"{folder}/records"), f"{folder}/bronze", f"{folder}/checkpoint", keep_raw=keep_raw
    )
    assert ingest.run_until_stopped(query)


def test_nothing_is_lost_or_repeated_over_restarts(spark, edge_records, tmp_path):
    folder = str(tmp_path)
    add_file(edge_records.filter("offset < 9"), f"{folder}/records")
    drain(spark, folder)
    first = read_table(spark, f"{folder}/bronze")
    assert rows(first) == rows(decode_records(edge_records.filter("offset < 9")))
    drain(spark, folder)
    add_file(edge_records.filter("offset >= 9"), f"{folder}/records")
    drain(spark, folder)
    bronze = read_table(spark, f"{folder}/bronze")
    assert bronze.columns == schemas.BRONZE.fieldNames()
    assert rows(bronze) == rows(decode_records(edge_records))


def test_a_new_column_joins_the_table(spark, edge_records, tmp_path):
    folder = str(tmp_path)
    add_file(edge_records.filter("offset < 9"), f"{folder}/records")
    drain(spark, folder)
    add_file(edge_records.filter("offset >= 9"), f"{folder}/records")
    drain(spark, folder, keep_raw=True)
    bronze = read_table(spark, f"{folder}/bronze", merge_schema=True)
    assert bronze.filter("offset < 9 AND raw_value IS NULL").count() == 9
    assert bronze.filter("offset = 15").first().raw_value == "not json"


def test_a_continuous_query_stops_at_its_timeout(spark, edge_records, tmp_path):
    folder = str(tmp_path)
    add_file(edge_records, f"{folder}/records")
    query = ingest.ingest(
        file_records(spark, f"{folder}/records"), f"{folder}/bronze", f"{folder}/checkpoint", interval="1 second"
    )
    query.processAllAvailable()
    assert not ingest.run_until_stopped(query, timeout=1)
    assert not query.isActive
    assert read_table(spark, f"{folder}/bronze").count() == len(EDGE_EVENTS) + 2


def test_minutes_are_emitted_once_and_complete(spark, tmp_path):
    folder = str(tmp_path)
    start = datetime(2024, 1, 1)

    def events(offset, *minutes):
        values = [
            as_json(1, 1, "view", 0.0, (start + timedelta(minutes=m)).isoformat()) for m in minutes
        ]
        values.append("not json")
        return spark.createDataFrame(
            [record(offset + i, v) for i, v in enumerate(values)], schemas.RECORD
        )

    def run():
        bronze = decode_records(file_records(spark, f"{folder}/records"))
        minutes = monitor.events_per_minute(bronze, "5 minutes")
        query = ingest.append_stream(minutes, f"{folder}/minutes", f"{folder}/checkpoint")
        ingest.run_until_stopped(query)
        return read_table(spark, f"{folder}/minutes")

    add_file(events(0, 0, 0.5, 1, 8), f"{folder}/records")
    assert rows(run()) == [(start, 2), (start + timedelta(minutes=1), 1)]
    # Minute 1 is closed and stays as it is; minute 6 is late but still open.
    add_file(events(100, 1, 6, 20), f"{folder}/records")
    counts = {(r.minute - start).seconds // 60: r.event_count for r in run().collect()}
    assert counts == {0: 2, 1: 1, 6: 1, 8: 1}


def test_batch_and_stream_count_alike(edge_bronze):
    batch = analytics.events_per_minute(edge_bronze)
    assert rows(monitor.events_per_minute(edge_bronze)) == rows(batch)


def test_the_kafka_source_is_asked_for_by_name(spark):
    """The connector is not installed here; its absence is reported, not hidden."""
    import pytest
    from pyspark.errors import AnalysisException

    from eventlake.sources.records import kafka_records

    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_records(spark, "localhost:9092")


def test_stream_and_batch_decode_alike(spark, edge_records, tmp_path):
    add_file(edge_records, f"{tmp_path}/records")
    stream = decode_records(file_records(spark, f"{tmp_path}/records"))
    assert stream.isStreaming
    assert stream.schema == decode_records(edge_records).schema
    assert "offset" in stream.select(F.col("offset")).columns
