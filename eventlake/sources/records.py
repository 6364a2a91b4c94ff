"""Sources of Kafka-shaped records: a Kafka topic, or files of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake import schemas


def kafka_records(
    spark: SparkSession, servers: str, topic: str = schemas.TOPIC, **options: str
) -> DataFrame:
    """The topic as a stream, from its first record on and tolerating records the
    broker has already dropped. ``options`` go to the source, for instance
    ``maxOffsetsPerTrigger`` or ``minPartitions`` to size the micro-batches."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .options(**options)
        .load()
    )


def file_records(
    spark: SparkSession, directory: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of records as a stream: each file in the directory is read once."""
    reader = spark.readStream.format(fmt).schema(schemas.RECORD)
    return reader.options(**options).load(directory)
