"""The ``events`` test table as click events, in the shape of each layer.

Its types are read as view, click (our cart) and purchase; others are invalid. The
``k`` of ``props`` is the product, ``value`` the price of a purchase.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.functions.records import decode_records, encode_records
from eventlake.session import configure

EVENT_COLUMNS = {
    "product_id": "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)",
    "event_type": "CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END",
    "price": "CASE WHEN event_type = 'purchase' THEN value ELSE 0.0D END",
}


def source_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """The same rows, evenly over all cores: a file of few row groups is otherwise encoded by as
    many tasks, and the files they write are as few for those who read them."""
    parts = 3 * events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(parts, *events.columns)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver straight from the table: its valid rows, ids and times in their type."""
    events = source_events(spark, sf_dir)
    valid = events.filter("event_type IN ('view', 'click', 'purchase')").filter(
        "NOT (event_type = 'purchase' AND value <= 0)"
    )
    return valid.select(
        "user_id",
        *[F.expr(sql).alias(name) for name, sql in EVENT_COLUMNS.items()],
        F.col("ts").alias("event_timestamp"),
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Every row, invalid ones included, with its place in the topic."""
    return events.select(
        F.col("user_id").cast("int").alias("user_id"),
        *[F.expr(sql).alias(name) for name, sql in EVENT_COLUMNS.items()],
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp"),
        F.lit(schemas.TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("arrival"),
    )


def records(events: DataFrame) -> DataFrame:
    """The table as Kafka records."""
    return _as_records(raw_events(events))


def redelivered_records(events: DataFrame) -> DataFrame:
    """The same records once more, an hour later and at another price."""
    again = raw_events(events).withColumns(
        {
            "offset": F.col("offset") + 1_000_000_000,
            "arrival": F.col("arrival") + F.expr("INTERVAL 1 HOUR"),
            "price": F.col("price") * 2,
        }
    )
    return _as_records(again)


def evolving_records(events: DataFrame) -> DataFrame:
    """Records of a producer ahead of the schema: every second one nests its product, and a
    purchase names its currency."""
    raw = raw_events(events)
    nested = F.when(F.col("offset") % 2 == 0, F.struct(F.col("product_id").alias("k")))
    currency = F.when(F.col("event_type") == "purchase", "EUR")
    event = F.struct(*schemas.EVENT.fieldNames(), nested.alias("props"), currency.alias("currency"))
    return raw.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(event).cast("binary").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("arrival").alias("timestamp"),
    )


def _as_records(raw: DataFrame) -> DataFrame:
    return (
        encode_records(raw)
        .withColumnRenamed("arrival", "timestamp")
        .withColumn("timestampType", F.lit(0))
        .select(*schemas.RECORD.fieldNames())
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Bronze table the records decode to, as its readers find it in storage:
    plain columns, no JSON left to parse."""
    events = raw_events(source_events(spark, sf_dir))
    return events.select(
        F.col("user_id").cast("string").alias("kafka_key"),
        "user_id",
        "product_id",
        "event_type",
        "price",
        F.col("timestamp").alias("event_timestamp"),
        "topic",
        "partition",
        "offset",
        F.col("arrival").alias("kafka_timestamp"),
    )


def decoded_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by way of Kafka records: encoded, then decoded."""
    return decode_records(records(source_events(spark, sf_dir)))


def redelivered_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record delivered twice, the second time an hour later and, for a purchase,
    at another price: the first delivery must win."""
    return redelivered(bronze(spark, sf_dir))


def redelivered(first: DataFrame) -> DataFrame:
    again = first.withColumns(
        {
            "offset": F.col("offset") + 1_000_000_000,
            "kafka_timestamp": F.col("kafka_timestamp") + F.expr("INTERVAL 1 HOUR"),
            "price": F.col("price") * 2,
        }
    )
    return first.unionByName(again)


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with every fault the rules and the cleaning look for, by place in the topic."""
    place, nan = F.col("offset"), F.lit(float("nan"))
    price = F.when(place % 83 == 0, -1.0).when(place % 79 == 0, nan).when(place % 73 == 0, 0.0)
    price = price.when(place % 67 == 0, F.lit(None)).otherwise(F.col("price"))
    return bronze(spark, sf_dir).withColumns(
        {
            "user_id": F.when(place % 97 != 0, F.col("user_id")),
            "product_id": F.when(place % 89 != 0, F.col("product_id")),
            "price": price,
            "event_timestamp": F.when(place % 71 == 0, "yesterday").otherwise(
                F.col("event_timestamp")
            ),
        }
    )


def unsold_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver in which what every fifth user buys only reaches the cart."""
    unsold = (F.col("user_id") % 5 == 0) & (F.col("event_type") == "purchase")
    event_type = F.when(unsold, "cart").otherwise(F.col("event_type"))
    return silver(spark, sf_dir).withColumn("event_type", event_type)


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream of Kafka records."""
    stream = (
        configure(spark)
        .readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return records(stream)
