"""Time the usual many-pass shape of each job against the shape used here.

The events of $BENCH_SF_DIR are multiplied by $BENCH_COPIES (default 100), each copy
with users of its own but for user 0, who is in all of them and holds a third of the
rows, and stored once below a new temporary folder. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import adapters
from eventlake.operators import features, hourly, quality

AS_OF = datetime(2024, 1, 30, 12)


def multiplied(table: DataFrame, copies: int) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    user = F.when(F.pmod(F.xxhash64("user_id", "copy"), F.lit(3)) == 0, 0).otherwise(
        F.col("user_id") * copies + F.col("copy")
    )
    rows = table.select("*", copy)
    return rows.withColumn("user_id", user.cast("int")).drop("copy")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def rules_one_by_one(bronze: DataFrame) -> None:
    for rule in quality.rules().values():
        bronze.filter(rule).count()


def tables_one_by_one(silver: DataFrame) -> None:
    cached = silver.persist()
    for build in (hourly.revenue_per_hour, hourly.active_users_per_hour, hourly.conversion_rate):
        run(hourly.latest_first(build(cached)))
    cached.unpersist()


def features_joined(silver: DataFrame) -> None:
    run(
        features.join_features(
            features.purchase_features(silver, AS_OF),
            features.event_frequency_features(silver),
            features.conversion_features(silver),
            AS_OF,
        )
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    copies = int(os.environ.get("BENCH_COPIES", "100"))
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="bench-shapes-")
    for name in ("silver", "bronze"):
        table = getattr(adapters, name)(spark, sf_dir)
        multiplied(table, copies).repartition(int(cpus)).write.parquet(f"{folder}/{name}")
    silver, bronze = (spark.read.parquet(f"{folder}/{n}") for n in ("silver", "bronze"))
    shapes = {
        "quality_many_passes": lambda: rules_one_by_one(bronze),
        "quality_one_pass": lambda: run(quality.quality_report(bronze)),
        "hourly_three_tables": lambda: tables_one_by_one(silver),
        "hourly_rollup": lambda: run(hourly.hourly_rollup(silver)),
        "features_joined": lambda: features_joined(silver),
        "features_one_pass": lambda: run(features.user_features(silver, AS_OF)),
    }
    seconds = {}
    for name, shape in shapes.items():
        best = float("inf")
        for _ in range(3):
            started = time.perf_counter()
            shape()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)
    print(json.dumps({"events": bronze.count(), "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
