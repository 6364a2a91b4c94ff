import json

from conftest import as_json, record, rows
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions.records import (
    decode_evolving,
    decode_records,
    encode_records,
    new_fields,
)


def decode(spark, *values, **options):
    table = spark.createDataFrame([record(i, v) for i, v in enumerate(values)], schemas.RECORD)
    return decode_records(table, **options).orderBy("offset").collect()


def test_bronze_schema_and_row_count(edge_bronze):
    assert edge_bronze.columns == schemas.BRONZE.fieldNames()
    assert [f.dataType for f in edge_bronze.schema] == [f.dataType for f in schemas.BRONZE]
    assert edge_bronze.count() == 17


def test_malformed_values_keep_their_row_with_null_fields(spark):
    good = as_json(1, 2, "view", 0.0, "2024-01-01T00:00:00")
    found = decode(spark, "not json", '{"user_id": 1', "[1]", "", None, good)
    for row in found[:5]:
        assert (row.user_id, row.product_id, row.event_type, row.price) == (None,) * 4
    assert found[5].user_id == 1


def test_a_wrong_field_is_null_alone(spark):
    rows = decode(
        spark,
        '{"user_id": "42", "product_id": 7, "price": 0}',
        '{"user_id": 1.5, "product_id": 7, "extra": true}',
        '{"user_id": 99999999999, "product_id": 7, "USER_ID": 3}',
    )
    assert [row.user_id for row in rows] == [None, None, None]
    assert [row.product_id for row in rows] == [7, 7, 7]
    assert rows[0].price == 0.0


def test_raw_text_is_kept_on_request(spark):
    assert decode(spark, "not json", keep_raw=True)[0].raw_value == "not json"


def test_encoding_round_trip(spark):
    events = spark.createDataFrame(
        [(1, 2, "purchase", 12.5, "2024-01-01T00:00:00"), (None, None, "view", None, None)],
        schemas.EVENT,
    )
    encoded = encode_records(events).collect()
    assert bytes(encoded[0].key) == b"1" and encoded[1].key is None
    assert json.loads(bytes(encoded[1].value)) == {
        "user_id": None,
        "product_id": None,
        "event_type": "view",
        "price": None,
        "timestamp": None,
    }
    again = decode(spark, *[bytes(r.value).decode() for r in encoded])
    assert [(r.user_id, r.price, r.event_type) for r in again] == [
        (1, 12.5, "purchase"),
        (None, None, "view"),
    ]


def test_fields_the_schema_does_not_know_are_kept_and_reported(spark):
    values = [
        '{"user_id": 1, "event_type": "view", "price": 1.5, "coupon": "A", "geo": {"lat": 1.5}}',
        '{"user_id": 2, "coupon": null, "tags": [1, 2]}',
        '{"user_id": 3, "coupon": 7}',
        '{"user_id": 4}',
        "[1, 2]",
        "not json",
        None,
    ]
    records = spark.createDataFrame([record(i, v) for i, v in enumerate(values)], schemas.RECORD)
    decoded = decode_evolving(records)
    assert rows(decoded.drop("other_fields")) == rows(decode_records(records))
    found = decoded.orderBy("offset").select(
        F.map_keys("other_fields").alias("names"),
        F.try_variant_get(F.col("other_fields")["coupon"], "$", "string").alias("coupon"),
    )
    assert [(r.names and sorted(r.names), r.coupon) for r in found.collect()] == [
        (["coupon", "geo"], "A"),
        (["coupon", "tags"], None),
        (["coupon"], "7"),
        ([], None),
        (None, None),
        (None, None),
        (None, None),
    ]
    reported = {r.field: (r.rows, r.type) for r in new_fields(decoded).collect()}
    assert reported["coupon"][0] == 3 and reported["tags"] == (1, "ARRAY<BIGINT>")
    assert reported["geo"] == (1, "OBJECT<lat: DECIMAL(2,1)>")
    assert decode_evolving(records, keep_raw=True).columns[-2:] == ["raw_value", "other_fields"]
