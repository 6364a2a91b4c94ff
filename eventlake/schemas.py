"""Declared schemas of the wire format and of every table."""

from __future__ import annotations

from pyspark.sql import types as T

# The topic, the event types and the names of the event fields.
TOPIC = "ecommerce_events"
EVENT_TYPES = ["view", "cart", "purchase"]

EVENT = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# The columns every Kafka reader returns; file streams of records use the same.
RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# The column names of Bronze.
BRONZE = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("event_timestamp", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
    ]
)

# The column names of Silver.
SILVER = T.StructType(
    [
        T.StructField("user_id", T.IntegerType()),
        T.StructField("product_id", T.IntegerType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
    ]
)

# The model inputs, in the order of the coefficient vector.
FEATURE_COLUMNS = [
    "purchases_last_24h",
    "total_purchases",
    "total_revenue",
    "avg_order_value",
    "max_purchase_value",
    "min_purchase_value",
    "total_events",
    "view_count",
    "cart_count",
    "unique_products",
    "activity_span_hours",
    "events_per_hour",
    "view_to_cart_ratio",
    "cart_to_purchase_ratio",
    "overall_conversion",
]
# Fixed value: the label.
LABEL_COLUMN = "is_purchaser"

# Features that restate the label: a user with any purchase value is a purchaser.
LEAKY_FEATURES = [
    "purchases_last_24h",
    "total_purchases",
    "total_revenue",
    "avg_order_value",
    "max_purchase_value",
    "min_purchase_value",
    "cart_to_purchase_ratio",
    "overall_conversion",
]

# The columns of the feature table.
USER_FEATURE_TABLE_COLUMNS = [
    "user_id",
    *FEATURE_COLUMNS,
    "first_activity",
    "last_activity",
    "feature_timestamp",
    LABEL_COLUMN,
]

# The names of the metrics.
METRICS = T.StructType(
    [
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("training_date", T.StringType()),
        T.StructField("n_train", T.LongType()),
        T.StructField("n_test", T.LongType()),
        T.StructField("n_features", T.IntegerType()),
        T.StructField("confusion_matrix", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("feature_importance", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("feature_names", T.ArrayType(T.StringType())),
    ]
)
