
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

import oracle_queries
from eventlake import adapters, schemas
from eventlake.errors import DataQualityError, EventLakeError
from eventlake.functions.records import decode_evolving, decode_records, new_fields
from eventlake.operators import (
    analytics,
    cleaning,
    features,
    hourly,
    model,
    profile,
    quality,
)
from eventlake.plans import incremental, jobs
from eventlake.session import checkpointed, scratch_dir
from eventlake.sources import artifacts, tables
from eventlake.sources.records import file_records
from eventlake.sources.registry import TableRegistry
from eventlake.streaming import hours, ingest, monitor
from eventlake.streaming.silver import stream_silver

try:
    import corpus_pipeline
    import eventlake.llm.queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "eventlake.llm", "eventlake.llm.queries"):
        raise
    corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 30, 12)
SPENDER = oracle_queries.SPENDER
GIVEN_WEIGHTS = oracle_queries.GIVEN_WEIGHTS
GIVEN_INTERCEPT = oracle_queries.GIVEN_INTERCEPT

Query = Callable[[SparkSession, str], DataFrame]


def _without_zone(df: DataFrame) -> DataFrame:
    """Times as the oracle keeps them."""
    for name, kind in df.dtypes:
        if kind == "timestamp":
            df = df.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return df


def _on_silver(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(adapters.silver(spark, sf_dir))


def _on_bronze(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _without_zone(operator(adapters.bronze(spark, sf_dir)))


def _user_features(silver: DataFrame) -> DataFrame:
    return features.user_features(silver, AS_OF)


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lazy: the tables share the shuffles of their rollup where a query reads several."""
    return hourly.gold_tables(hourly.hourly_rollup(adapters.silver(spark, sf_dir)))


def _joined_features(silver: DataFrame) -> DataFrame:
    return features.join_features(
        features.purchase_features(silver, AS_OF),
        features.event_frequency_features(silver),
        features.conversion_features(silver),
        AS_OF,
    )


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold = _gold(spark, sf_dir)
    return analytics.kpis(
        gold["revenue_per_hour"],
        gold["active_users_per_hour"],
        gold["conversion_rate"],
        adapters.silver(spark, sf_dir),
    )


def _tagged(bronze: DataFrame) -> DataFrame:
    tagged = quality.tag_violations(bronze).filter(F.size("violated_rules") > 0)
    return tagged.select(
        "offset", "event_type", "price", F.array_join("violated_rules", ",").alias("rules")
    )


def _silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _without_zone(cleaning.clean(adapters.redelivered_bronze(spark, sf_dir)))


def _silver_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second delivery spells the type differently; normalising first sees through it."""
    bronze = adapters.bronze(spark, sf_dir)
    again = bronze.withColumns(
        {
            "event_type": F.concat(F.lit(" "), F.upper("event_type")),
            "offset": F.col("offset") + 1_000_000_000,
            "kafka_timestamp": F.col("kafka_timestamp") + F.expr("INTERVAL 1 HOUR"),
        }
    )
    return _without_zone(cleaning.clean(bronze.unionByName(again), normalize_first=True))


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = adapters.records(adapters.source_events(spark, sf_dir))
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
    )


def _bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest the table as a stream, restart it on its checkpoint, read the result."""
    folder = scratch_dir(spark, "bronze-stream")
    for _ in range(2):
        stream = adapters.record_stream(spark, sf_dir)
        query = ingest.ingest(stream, f"{folder}/table", f"{folder}/checkpoint")
        ingest.run_until_stopped(query)
    return _without_zone(tables.read_table(spark, f"{folder}/table", "parquet"))


def _minutes_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "minutes-stream")
    bronze = decode_records(adapters.record_stream(spark, sf_dir))
    minutes = monitor.events_per_minute(bronze)
    query = ingest.append_stream(minutes, f"{folder}/table", f"{folder}/checkpoint")
    ingest.run_until_stopped(query)
    emitted = tables.read_table(spark, f"{folder}/table", "parquet")
    bronze = adapters.bronze(spark, sf_dir)
    return _without_zone(monitor.complete_minutes(emitted, bronze))


def _decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which every second one is spelt backwards, and so is no JSON."""
    records = adapters.records(adapters.source_events(spark, sf_dir))
    backwards = F.reverse(F.col("value").cast("string")).cast("binary")
    value = F.when(F.col("offset") % 2 == 0, backwards).otherwise(F.col("value"))
    decoded = decode_records(records.withColumn("value", value), keep_raw=True)
    return decoded.select("offset", "user_id", "product_id", "event_type", "raw_value")


def _evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_evolving(adapters.evolving_records(adapters.source_events(spark, sf_dir)))


def _decode_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.col("other_fields")
    return _evolved(spark, sf_dir).select(
        "offset",
        "user_id",
        "product_id",
        "event_type",
        "price",
        F.try_variant_get(other["currency"], "$", "string").alias("currency"),
        F.try_variant_get(other["props"], "$.k", "int").alias("k"),
        F.size(F.map_keys(other)).alias("others"),
    )


def _registry(spark: SparkSession, sf_dir: str) -> TableRegistry:
    user_features = _user_features(adapters.silver(spark, sf_dir))
    return TableRegistry(spark, {**_gold(spark, sf_dir), "user_features": user_features})


def _run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT hour, total_revenue, purchase_count, avg_order_value FROM {t}
        WHERE avg_order_value > 5 AND purchase_count >= 2
        ORDER BY total_revenue DESC, hour
    """
    return _registry(spark, sf_dir).run_query(text, t="revenue")


def _grouped_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        SELECT is_purchaser, count(*) AS users, sum(total_events) AS events,
               max(last_activity) AS newest
        FROM user_features GROUP BY is_purchaser ORDER BY is_purchaser
    """
    return _registry(spark, sf_dir).run_query(text)


def _grouped_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        WITH days AS (SELECT hour(hour) AS hour_of_day, * FROM Active_Users_Per_Hour)
        SELECT hour_of_day, sum(total_events) AS events, max(active_users) AS most_users
        FROM days GROUP BY hour_of_day -- limit 5
    """
    return _registry(spark, sf_dir).execute(text)


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir).execute("what does user_features look like", n=10)


def _clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = adapters.redelivered(adapters.dirty_bronze(spark, sf_dir))
    return _without_zone(cleaning.clean(dirty))


def _on_dirty(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(adapters.dirty_bronze(spark, sf_dir))


def _features_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_features(adapters.unsold_silver(spark, sf_dir))


def _prepared_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of which some are missing, no number or infinite."""
    user = F.col("user_id")
    odd = F.when(user % 7 == 0, F.lit(float("nan"))).when(user % 11 == 0, F.lit(float("inf")))
    odd = odd.when(user % 13 == 0, F.lit(None)).otherwise(F.col("total_revenue"))
    table = _features_dirty(spark, sf_dir).withColumn("total_revenue", odd)
    return model.prepare(table, schemas.FEATURE_COLUMNS)


def _schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _registry(spark, sf_dir).schemas()


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases, and all other rows, which lack the price column."""
    silver = adapters.silver(spark, sf_dir)
    others = silver.filter("event_type <> 'purchase'").drop("price")
    return tables.union_tables([silver.filter("event_type = 'purchase'"), others])


def _rounded_summary(summary: DataFrame) -> DataFrame:
    figures = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return summary.withColumns({f: F.round(f, 4) for f in figures if f in summary.columns})


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = checkpointed(_user_features(adapters.silver(spark, sf_dir)))
    return _rounded_summary(profile.summary_stats(table.drop("user_id")))


def _of_table(name: str, operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _time_summary(silver: DataFrame) -> DataFrame:
    return _without_zone(profile.time_summary(silver))


def _scaling(silver: DataFrame) -> DataFrame:
    names = schemas.FEATURE_COLUMNS
    train, _ = model.split(_user_features(silver))
    stats = train.agg(*model.scaling_measures(names))
    parts = [
        F.struct(
            F.lit(c).alias("feature"),
            F.round(f"{c}_mean", 4).alias("mean"),
            F.round(f"{c}_std", 4).alias("std"),
        )
        for c in names
    ]
    return stats.select(F.inline(F.array(*parts)))


def _split(silver: DataFrame) -> DataFrame:
    parts = model.split(_user_features(silver))
    train, test = (
        part.select("user_id", F.lit(name).alias("part"))
        for part, name in zip(parts, ("train", "test"))
    )
    return train.unionByName(test)


def _label_by_spend(silver: DataFrame) -> DataFrame:
    """The features labelled by a large average order: at test size every user has bought
    something at some time, a model needs both classes, and no model input may restate
    the label."""
    table = _user_features(silver)
    return table.withColumn("is_purchaser", _spends().cast("int"))


def _spends() -> Column:
    return F.col("avg_order_value") > SPENDER


def _trained(spark: SparkSession, sf_dir: str):
    table = checkpointed(_label_by_spend(adapters.silver(spark, sf_dir)))
    return table, model.train(table, exclude_leaky=True)


def _features_as_of(silver: DataFrame) -> DataFrame:
    """The features at noon of each of thirty days."""
    return features.features_as_of(silver, [datetime(2024, 1, day, 12) for day in range(1, 31)])


def _point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of the users who spent most, from an indexed table."""
    silver = adapters.silver(spark, sf_dir)
    folder = scratch_dir(spark, "indexed")
    tables.write_indexed(_user_features(silver), folder, "user_id")
    wanted = analytics.top_spenders(silver).select("user_id")
    return tables.look_up(tables.read_table(spark, folder), "user_id", wanted)


def _saved_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Those users' scores by the given model, saved and loaded again."""
    silver = adapters.silver(spark, sf_dir)
    table, fitted = scratch_dir(spark, "indexed"), scratch_dir(spark, "model")
    tables.write_indexed(_label_by_spend(silver), table, "user_id")
    artifacts.save_model(model.linear_pipeline(GIVEN_WEIGHTS, GIVEN_INTERCEPT), fitted)
    wanted = analytics.top_spenders(silver).select("user_id")
    scored = model.score_users(
        artifacts.load_model(fitted), tables.read_table(spark, table), wanted
    )
    return scored.withColumn("confidence", F.round("confidence", 6))


def _given_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _label_by_spend(adapters.silver(spark, sf_dir))
    return model.linear_scores(table, GIVEN_WEIGHTS, GIVEN_INTERCEPT)


def _given_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = model.with_messages(_given_scores(spark, sf_dir))
    return scored.withColumn("confidence", F.round("confidence", 6))


def _given_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = model.confusion(_given_scores(spark, sf_dir))
    shares = model.classification_metrics(cells)
    return shares.select(*[F.round(c, 9).alias(c) for c in shares.columns])


def _given_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = checkpointed(_given_scores(spark, sf_dir))
    area = model.roc_auc(scored.withColumn("rawPrediction", F.col("purchase_probability")))
    return scored.agg(
        F.count(F.lit(1)).alias("users"), F.round(F.lit(area), 9).alias("roc_auc")
    )


def _train_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures of a training run; its date is left out."""
    _, trained = _trained(spark, sf_dir)
    shares = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    values = trained.metrics.asDict()
    row = tuple(values[name] for name in (*shares, "n_train", "n_test", "n_features"))
    columns = ", ".join(f"{name} double" for name in shares)
    found = spark.createDataFrame([row], f"{columns}, n_train bigint, n_test bigint, n_features int")
    return found.withColumns({name: F.round(name, 9) for name in shares})


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trained(spark, sf_dir)[1].confusion


def _coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = model.most_important(_trained(spark, sf_dir)[1].coefficients)
    return top.withColumn("coefficient", F.round("coefficient", 4))


def _score_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, trained = _trained(spark, sf_dir)
    scored = model.score_users(trained.pipeline, table)
    return scored.withColumn("confidence", F.round("confidence", 4))


def _layer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = {name: f"{sf_dir}/{name}.parquet" for name in ("events", "orders", "absent")}
    status = tables.layer_status(spark, layers, "parquet")
    return _without_zone(status.select("layer", "exists", "files", "rows", "newest"))


def _lake(spark: SparkSession, sf_dir: str) -> tuple[jobs.LakePaths, dict[str, int]]:
    """Bronze of the table's stream, and Silver of it with the unsound rows set aside;
    and what Silver counted."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    jobs.run_bronze(spark, adapters.record_stream(spark, sf_dir), paths)
    return paths, jobs.run_silver(spark, paths, on_violation="quarantine")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return _without_zone(tables.read_table(spark, path))


def _pipeline_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, _lake(spark, sf_dir)[0].silver)


def _pipeline_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _stored(spark, _lake(spark, sf_dir)[0].quarantine)
    return rows.select("offset", F.array_join("violated_rules", ",").alias("rules"))


def _pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs say they read, set aside and wrote."""
    paths, counts = _lake(spark, sf_dir)
    wanted = ["rows_read", "rows_quarantined", "rows_written"]
    rows = [(name, counts[name]) for name in wanted]
    rows += jobs.run_gold(spark, paths).items()
    rows.append(("user_features", jobs.run_features(spark, paths, AS_OF)["rows_written"]))
    return spark.createDataFrame(rows, "step string, rows bigint")


def _pipeline_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = _lake(spark, sf_dir)
    names = jobs.run_gold(spark, paths)
    return tables.union_tables(
        [_stored(spark, paths.gold(n)).withColumn("table", F.lit(n)) for n in names]
    )


def _pipeline_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths, _ = _lake(spark, sf_dir)
    jobs.run_features(spark, paths, AS_OF)
    return _stored(spark, paths.features)


def _passes(gate: Callable[[], object]) -> bool:
    try:
        return gate() is not False
    except EventLakeError:
        return False


def _check_given(spark: SparkSession, table: DataFrame, paths: jobs.LakePaths, accuracy: float):
    """The gate on the metrics of the given model, which are added to the history."""
    labelled = table.withColumn("is_purchaser", _spends().cast("int"))
    scored = model.linear_scores(labelled, GIVEN_WEIGHTS, GIVEN_INTERCEPT)
    shares = model.classification_metrics(model.confusion(scored)).first().asDict()
    known = dict.fromkeys(schemas.METRICS.fieldNames()) | shares
    known["training_date"] = datetime.now().isoformat()
    artifacts.write_metrics(spark, Row(**known), paths.metrics)
    return artifacts.check_model(spark, paths.metrics, accuracy)


def _gate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gate of the chain, and those that must not open."""
    paths, _ = _lake(spark, sf_dir)
    gold = {n: tables.read_table(spark, paths.gold(n)) for n in jobs.run_gold(spark, paths)}
    jobs.run_features(spark, paths, AS_OF)
    bronze, table = (tables.read_table(spark, p) for p in (paths.bronze, paths.features))
    gates = {
        "bronze_quality": lambda: quality.check_quality(bronze),
        "gold_rows": lambda: quality.require_rows(**gold),
        "feature_rows": lambda: quality.require_rows(user_features=table),
        "no_rows": lambda: quality.require_rows(user_features=table.filter("user_id < 0")),
        "enough_to_train": lambda: quality.enough_to_train(table),
        "too_few_to_train": lambda: quality.enough_to_train(table.filter("user_id < 5")),
        "model_without_metrics": lambda: artifacts.check_model(spark, paths.metrics),
        "given_model": lambda: _check_given(spark, table, paths, 0.5),
        "given_model_unlike_perfect": lambda: _check_given(spark, table, paths, 1.0),
    }
    rows = [(name, _passes(gate)) for name, gate in gates.items()]
    return spark.createDataFrame(rows, "gate string, passed boolean")


def _metrics_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metrics two training runs left; figures of the fit as whether they pass."""
    paths, _ = _lake(spark, sf_dir)
    jobs.run_features(spark, paths, AS_OF, _spends())
    for _ in range(2):
        jobs.run_training(spark, paths, exclude_leaky=True)
    return artifacts.read_metrics(spark, paths.metrics).select(
        "n_train", "n_test", "n_features", (F.col("accuracy") >= 0.5).alias("passed")
    )


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain with its gates, and what each layer then holds."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    jobs.run_bronze(spark, adapters.record_stream(spark, sf_dir), paths)
    metrics = jobs.run_all(spark, paths, AS_OF, "quarantine", _spends(), exclude_leaky=True)
    status = tables.layer_status(spark, paths.layers(), paths.fmt)
    rows = [(row.layer, row.rows) for row in status.collect()]
    rows.append(("trained_on", metrics.n_train + metrics.n_test if metrics else 0))
    rows.append(("good_models", int(metrics is not None and metrics.accuracy >= 0.5)))
    return spark.createDataFrame(rows, "layer string, rows bigint")


def _run_all_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain as it stops at unsound rows: the rules they break, and that no layer
    behind Bronze is written."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    jobs.run_bronze(spark, adapters.record_stream(spark, sf_dir), paths)
    rows = []
    try:
        jobs.run_all(spark, paths, AS_OF)
    except DataQualityError as error:
        rows = list(error.violations.items())
    status = tables.layer_status(spark, paths.layers(), paths.fmt).filter("exists").collect()
    rows.append(("layers", len(status)))
    return spark.createDataFrame(rows, "rule string, rows bigint")


def _incremental(spark: SparkSession, sf_dir: str) -> jobs.LakePaths:
    """A lake brought up to date after each of three deliveries: all records but the
    purchases, which come late, and then every record a second time."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    events = adapters.source_events(spark, sf_dir)
    bought = F.col("event_type") == "purchase"
    deliveries = [
        adapters.records(adapters.spread(events.filter(~bought))),
        adapters.records(adapters.spread(events.filter(bought))),
        adapters.redelivered_records(adapters.spread(events)),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(paths.at("records"))
        jobs.run_bronze(spark, file_records(spark, paths.at("records")), paths)
        incremental.run_incremental(spark, paths)
    return paths


def _incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, _incremental(spark, sf_dir).silver)


def _incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _incremental(spark, sf_dir)
    return tables.union_tables(
        [
            _stored(spark, paths.gold(n)).withColumn("table", F.lit(n))
            for n in ("revenue_per_hour", "active_users_per_hour", "conversion_rate")
        ]
    )


def _incremental_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = _incremental(spark, sf_dir)
    incremental.refresh_features(spark, paths, AS_OF)
    return _stored(spark, paths.features)


def _incremental_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches say they took in, and what then lies in the quarantine."""
    paths = _incremental(spark, sf_dir)
    taken = incremental.batches(spark, paths).agg(
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_quarantined").alias("rows_quarantined"),
        F.sum("rows_untimed").alias("rows_untimed"),
        F.sum("rows_arrived").alias("rows_arrived"),
        F.size(F.array_distinct(F.flatten(F.collect_list("days")))).alias("days"),
    )
    aside = tables.read_table(spark, paths.quarantine)
    return taken.withColumn("quarantine", aside.agg(F.count(F.lit(1))).scalar())


def _streamed(spark: SparkSession, sf_dir: str) -> jobs.LakePaths:
    """A lake whose Silver and hours are streams, restarted for each delivery: ten days of
    records, and the ten days before once more."""
    paths = jobs.LakePaths(scratch_dir(spark, "lake"))
    events = adapters.source_events(spark, sf_dir)
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    for step in range(4):
        for delivery in (
            adapters.records(events.filter(third == step)),
            adapters.redelivered_records(events.filter(third == step - 1)),
        ):
            delivery.write.mode("append").parquet(paths.at("records"))
        jobs.run_bronze(spark, file_records(spark, paths.at("records")), paths)
        bronze = spark.readStream.schema(schemas.BRONZE).parquet(paths.bronze)
        silver = ingest.append_stream(
            stream_silver(bronze), paths.silver, paths.at("checkpoints", "silver")
        )
        ingest.run_until_stopped(silver)
        added = spark.readStream.schema(schemas.SILVER).parquet(paths.silver)
        cells = hours.keep_hours(added, paths.at("hours"), paths.at("checkpoints", "hours"))
        ingest.run_until_stopped(cells)
    return paths


def _streamed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, _streamed(spark, sf_dir).silver)


def _streamed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = tables.read_table(spark, _streamed(spark, sf_dir).at("hours"))
    gold = hours.gold_of_cells(cells)
    return _without_zone(
        tables.union_tables([table.withColumn("table", F.lit(n)) for n, table in gold.items()])
    )


def _distinct_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users and products of days, weeks and months: exact, and whether the merged
    hourly sketches, which are stored, come within a twentieth."""
    silver = adapters.silver(spark, sf_dir)
    folder = scratch_dir(spark, "sketches")
    tables.write_table(hourly.distinct_sketches(silver), folder)
    sketches = tables.read_table(spark, folder)
    names = ("distinct_users", "distinct_products")
    found = []
    for unit in ("day", "week", "month"):
        near = hourly.distinct_by(sketches, unit).withColumnsRenamed({n: f"{n}_near" for n in names})
        both = hourly.exact_distinct_by(silver, unit).join(near, "period")
        within = [
            (F.abs(F.col(f"{n}_near") - F.col(n)) <= 0.05 * F.col(n)).alias(f"{n}_within")
            for n in names
        ]
        found.append(both.select(F.lit(unit).alias("unit"), "period", *names, *within))
    return tables.union_tables(found)


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is known of the tables but their first rows: sizes, columns, figures, times."""
    registry = _registry(spark, sf_dir)
    registry.tables = {name: checkpointed(table) for name, table in registry.tables.items()}
    parts = []
    for name, known in registry.context().items():
        times = known["time_summary"]
        figures = [c for c in times.columns if c not in ("column", "count")]
        times = times.withColumnsRenamed({c: f"{c}_time" for c in figures})
        found = {
            "profile": known["profile"],
            "columns": known["column_profile"],
            "summary": _rounded_summary(known["summary"]),
            "times": _without_zone(times),
        }
        for part, table in found.items():
            parts.append(table.withColumns({"table": F.lit(name), "part": F.lit(part)}))
    return tables.union_tables(parts)


def _answer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    question = "sql SELECT hour, nullif(purchase_count, 1) AS several FROM revenue_per_hour"
    return _registry(spark, sf_dir).answer(question).summary


def queries() -> dict[str, Query]:
    """One entry per query or operator; each takes (spark, sf_dir)."""
    corpus = {}
    if corpus_queries is not None:
        corpus = {**corpus_queries.QUERIES, "pipeline": corpus_pipeline.run}
    return {
        **corpus,
        "decode_events": lambda spark, sf: _without_zone(adapters.decoded_bronze(spark, sf)),
        "decode_malformed": _decode_malformed,
        "encode_events": _encoded,
        "bronze_stream": _bronze_stream,
        "decode_evolved": _decode_evolved,
        "new_fields": lambda spark, sf: new_fields(_evolved(spark, sf)),
        "quality_report": _on_bronze(quality.quality_report),
        "quality_issues": _on_bronze(lambda b: quality.quality_issues(quality.quality_report(b))),
        "quality_violations": _on_bronze(_tagged),
        "silver_clean": _silver_clean,
        "silver_normalized": _silver_normalized,
        "quality_report_dirty": _on_dirty(quality.quality_report),
        "quality_violations_dirty": _on_dirty(_tagged),
        "silver_clean_dirty": _clean_dirty,
        "user_features_dirty": _features_dirty,
        "prepared_features_dirty": _prepared_dirty,
        "revenue_per_hour": _on_silver(lambda s: hourly.latest_first(hourly.revenue_per_hour(s))),
        "active_users_per_hour": _on_silver(hourly.active_users_per_hour),
        "conversion_rate": _on_silver(hourly.conversion_rate),
        "hourly_rollup": _on_silver(hourly.hourly_rollup),
        "purchase_features": _on_silver(lambda s: features.purchase_features(s, AS_OF)),
        "event_frequency_features": _on_silver(features.event_frequency_features),
        "conversion_features": _on_silver(features.conversion_features),
        "user_features": _on_silver(_user_features),
        "user_features_joined": _on_silver(_joined_features),
        "kpis": _kpis,
        "revenue_by_product": _on_silver(analytics.revenue_by_product),
        "top_products": _on_silver(analytics.top_products),
        "spend_by_user": _on_silver(analytics.spend_by_user),
        "top_spenders": _on_silver(analytics.top_spenders),
        "event_distribution": _on_silver(analytics.event_distribution),
        "bronze_event_distribution": _on_bronze(analytics.event_distribution),
        "hourly_activity": _on_silver(analytics.hourly_activity),
        "events_per_minute": _on_bronze(analytics.events_per_minute),
        "events_per_minute_stream": _minutes_stream,
        "stream_kpis": _on_bronze(analytics.stream_kpis),
        "latest_events": _on_bronze(analytics.latest_events),
        "table_profile": lambda spark, sf: profile.table_profile(_union(spark, sf)),
        "column_profile": lambda spark, sf: profile.column_profile(_union(spark, sf)),
        "lineitem_column_profile": _of_table("lineitem", profile.column_profile),
        "summary_stats": _summary,
        "lineitem_summary_stats": _of_table(
            "lineitem", lambda t: _rounded_summary(profile.summary_stats(t))
        ),
        "time_summary": _on_silver(_time_summary),
        "class_distribution": _on_silver(
            lambda s: analytics.class_distribution(_label_by_spend(s))
        ),
        "run_query": _run_query,
        "grouped_query": _grouped_query,
        "grouped_by_hour": _grouped_by_hour,
        "table_preview": _preview,
        "table_schemas": _schemas,
        "union_tables": _union,
        "layer_status": _layer_status,
        "conversion_trend": _on_silver(lambda s: hourly.trend(hourly.conversion_rate(s))),
        "table_context": _context,
        "answer_summary": _answer_summary,
        "pipeline_silver": _pipeline_silver,
        "pipeline_quarantine": _pipeline_quarantine,
        "pipeline_gold": _pipeline_gold,
        "pipeline_features": _pipeline_features,
        "pipeline_counts": _pipeline_counts,
        "gate_status": _gate_status,
        "metrics_history": _metrics_history,
        "run_all": _run_all,
        "run_all_failing": _run_all_failing,
        "incremental_silver": _incremental_silver,
        "incremental_gold": _incremental_gold,
        "incremental_features": _incremental_features,
        "incremental_batches": _incremental_batches,
        "streamed_silver": _streamed_silver,
        "streamed_gold": _streamed_gold,
        "distinct_by_period": _distinct_by,
        "features_as_of": _on_silver(_features_as_of),
        "point_lookup": _point_lookup,
        "saved_scores": _saved_scores,
        "train_test_split": _on_silver(_split),
        "prepared_features": _on_silver(
            lambda s: model.prepare(_user_features(s), schemas.FEATURE_COLUMNS)
        ),
        "feature_scaling": _on_silver(_scaling),
        "train_metrics": _train_metrics,
        "confusion_matrix": _confusion,
        "top_coefficients": _coefficients,
        "score_users": _score_users,
        "given_scores": _given_messages,
        "given_confusion": lambda spark, sf: model.confusion(_given_scores(spark, sf)),
        "given_metrics": _given_metrics,
        "given_roc_auc": _given_auc,
    }


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL, where SQL can express them."""
    corpus = {}
    if corpus_queries is not None:
        corpus = dict(corpus_queries.ORACLE_SQL)
        if corpus_pipeline.ORACLE_SQL is not None:
            corpus["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**corpus, **oracle_queries.oracle_sql()}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: revenue per hour, newest first."""
    return queries()["revenue_per_hour"](spark, SMOKE_DIR)
