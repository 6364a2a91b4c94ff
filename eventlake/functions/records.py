"""Kafka record encoding and decoding; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake import schemas


def encode_records(events: DataFrame) -> DataFrame:
    """Events to Kafka ``key`` and ``value``: the user id as text, the event as JSON.

    Columns beyond the five event fields (topic, partition, ...) are kept.
    """
    fields = schemas.EVENT.fieldNames()
    others = [c for c in events.columns if c not in fields]
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
        .cast("binary")
        .alias("value"),
        *others,
    )


def decode_records(records: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Kafka records to Bronze rows. No row is dropped: a value that is not an event
    gives NULL fields. ``keep_raw`` adds the text, so such rows can be repaired."""
    event = F.from_json(F.col("json"), schemas.EVENT)
    raw = [F.col("json").alias("raw_value")] if keep_raw else []
    return (
        records.select(
            F.col("key").cast("string").alias("kafka_key"),
            F.col("value").cast("string").alias("json"),
            "topic",
            "partition",
            "offset",
            F.col("timestamp").alias("kafka_timestamp"),
        )
        .withColumn("event", event)
        .select(
            "kafka_key",
            "event.user_id",
            "event.product_id",
            "event.event_type",
            "event.price",
            F.col("event.timestamp").alias("event_timestamp"),
            "topic",
            "partition",
            "offset",
            "kafka_timestamp",
            *raw,
        )
    )


def decode_evolving(records: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Like :func:`decode_records`, and ``other_fields``: what an event holds beyond its known
    fields, as a map from name to VARIANT. It is NULL for a value that is no JSON object, and empty
    where nothing is new: a producer may add fields before the schema here knows them."""
    decoded = decode_records(records, keep_raw=True)
    known = schemas.EVENT.fieldNames()
    fields = F.try_variant_get(F.try_parse_json("raw_value"), "$", "map<string,variant>")
    other = F.map_filter(fields, lambda name, _: ~name.isin(known))
    found = decoded.withColumn("other_fields", other)
    return found if keep_raw else found.drop("raw_value")


def new_fields(decoded: DataFrame) -> DataFrame:
    """(field, rows, type) of the fields that :func:`decode_evolving` does not know: in how many
    events each stands, and the type that holds all its values."""
    cells = decoded.select(F.explode("other_fields").alias("field", "value"))
    return cells.groupBy("field").agg(
        F.count(F.lit(1)).alias("rows"), F.schema_of_variant_agg("value").alias("type")
    )
