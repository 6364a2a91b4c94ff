"""DuckDB SQL for the registered queries.

Rounded ratios are written in whole numbers, half up, so they do not depend on how a
double is summed or rounded.
"""

from __future__ import annotations

from eventlake.schemas import FEATURE_COLUMNS as FEATURES
from eventlake.schemas import LEAKY_FEATURES as LEAKY

AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"

# Average order from which a user is labelled 1, and a logistic model of given numbers.
SPENDER = 50.0
GIVEN_WEIGHTS = {"total_events": 0.05, "view_count": -0.15, "unique_products": 0.02}
GIVEN_INTERCEPT = -0.6

PRODUCT = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
TYPE = "CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END"
PRICE = "CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END"

SILVER = f"""silver AS (
  SELECT user_id, {PRODUCT} AS product_id, {TYPE} AS event_type, {PRICE} AS price,
         ts AS event_timestamp
  FROM events
  WHERE event_type IN ('view', 'click', 'purchase')
    AND NOT (event_type = 'purchase' AND value <= 0))"""

BRONZE = f"""bronze AS (
  SELECT user_id::VARCHAR AS kafka_key, user_id::INTEGER AS user_id,
         {PRODUCT} AS product_id, {TYPE} AS event_type, {PRICE} AS price,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_timestamp,
         'ecommerce_events' AS topic, (user_id % 4)::INTEGER AS partition,
         event_id AS "offset", ts AS kafka_timestamp, ts
  FROM events)"""


def half_up(part: str, whole: str, places: int) -> str:
    """``round(part / whole, places)`` of whole numbers, as double."""
    unit = 10**places
    return f"((2 * ({part})::HUGEINT * {unit} + ({whole})) // (2 * ({whole})))::DOUBLE / {unit}"


def guarded(part: str, whole: str, places: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {half_up(part, f'greatest({whole}, 1)', places)} ELSE 0.0 END"


def micros(price: str = "price") -> str:
    return f"floor({price} * 1000000 + 0.5)::BIGINT"


BOUGHT = "event_type = 'purchase'"
SILVER_COLUMNS = ["user_id", "product_id", "event_type", "price", "event_timestamp"]
UNITED = f"""united AS (
  SELECT user_id, product_id, event_type, CASE WHEN {BOUGHT} THEN price END AS price,
         event_timestamp
  FROM silver)"""
DIRTY = """dirty AS (
  SELECT kafka_key, CASE WHEN "offset" % 97 <> 0 THEN user_id END AS user_id,
         CASE WHEN "offset" % 89 <> 0 THEN product_id END AS product_id, event_type,
         CASE WHEN "offset" % 83 = 0 THEN -1.0::DOUBLE WHEN "offset" % 79 = 0 THEN 'NaN'::DOUBLE
              WHEN "offset" % 73 = 0 THEN 0.0::DOUBLE WHEN "offset" % 67 = 0 THEN NULL
              ELSE price END AS price,
         CASE WHEN "offset" % 71 <> 0 THEN ts END AS ts, "offset", kafka_timestamp
  FROM bronze)"""
UNSOLD = """unsold AS (
  SELECT * REPLACE (CASE WHEN user_id % 5 = 0 AND event_type = 'purchase' THEN 'cart'
                         ELSE event_type END AS event_type) FROM silver)"""
S6 = f"sum({micros()}) FILTER ({BOUGHT})"
BUYS = f"count(*) FILTER ({BOUGHT})"
VIEWS = "count(*) FILTER (event_type = 'view')"
CARTS = "count(*) FILTER (event_type = 'cart')"

HOURLY = f"""hourly AS (
  SELECT date_trunc('hour', event_timestamp)::TIMESTAMP AS hour, {S6} AS s6, {BUYS} AS buys,
         {VIEWS} AS views, {CARTS} AS carts, count(*) AS total_events,
         count(DISTINCT user_id) AS users, count(DISTINCT product_id) AS products
  FROM silver GROUP BY 1)"""

USERS = f"""users AS (
  SELECT user_id, {S6} AS s6, {BUYS} AS buys, {VIEWS} AS views, {CARTS} AS carts,
         count(*) FILTER ({BOUGHT} AND event_timestamp >= {AS_OF} - INTERVAL 24 HOURS) AS recent,
         max({micros()}) FILTER ({BOUGHT}) AS most, min({micros()}) FILTER ({BOUGHT}) AS least,
         count(*) AS total_events, count(DISTINCT product_id) AS unique_products,
         min(event_timestamp) AS first_activity, max(event_timestamp) AS last_activity,
         floor(epoch(max(event_timestamp)))::BIGINT - floor(epoch(min(event_timestamp)))::BIGINT AS secs
  FROM silver GROUP BY user_id)"""

HUNDREDTHS = "((2 * secs + 36) // 72)"
PER_HOUR = (
    f"CASE WHEN {HUNDREDTHS} > 0 THEN "
    + half_up("total_events * 100", f"greatest({HUNDREDTHS}, 1)", 2)
    + " ELSE total_events::DOUBLE END"
)
PURCHASE_COLUMNS = {
    "purchases_last_24h": "recent",
    "total_purchases": "buys",
    "total_revenue": half_up("s6", "1000000", 2),
    "avg_order_value": half_up("s6", "1000000 * greatest(buys, 1)", 2),
    "max_purchase_value": half_up("most", "1000000", 2),
    "min_purchase_value": half_up("least", "1000000", 2),
}
FREQUENCY_COLUMNS = {
    "total_events": "total_events",
    "view_count": "views",
    "cart_count": "carts",
    "unique_products": "unique_products",
    "activity_span_hours": f"{HUNDREDTHS}::DOUBLE / 100",
    "events_per_hour": PER_HOUR,
}
CONVERSION_COLUMNS = {
    "view_to_cart_ratio": guarded("carts", "views", 4),
    "cart_to_purchase_ratio": guarded("buys", "carts", 4),
    "overall_conversion": guarded("buys", "views", 4),
}


def listed(columns: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


USER_FEATURES = f"""user_features AS (
  SELECT user_id, {listed({n: f"coalesce({sql}, 0)" for n, sql in PURCHASE_COLUMNS.items()})},
         {listed(FREQUENCY_COLUMNS)}, {listed(CONVERSION_COLUMNS)},
         first_activity, last_activity, {AS_OF} AS feature_timestamp,
         CASE WHEN buys > 0 THEN 1 ELSE 0 END AS is_purchaser
  FROM users)"""

REVENUE_COLUMNS = {
    "total_revenue": half_up("s6", "1000000", 2),
    "purchase_count": "buys",
    "avg_order_value": half_up("s6", "1000000 * greatest(buys, 1)", 2),
}
RATES = {
    "view_to_cart_rate": guarded("100 * carts", "views", 2),
    "cart_to_purchase_rate": guarded("100 * buys", "carts", 2),
    "overall_conversion_rate": guarded("100 * buys", "views", 2),
}
FUNNEL_COLUMNS = {
    "view_count": "views",
    "cart_count": "carts",
    "purchase_count": "buys",
    "unique_users": "users",
    **RATES,
}


def cents(sql: str) -> str:
    return f"round({sql} * 100)::BIGINT"


def spend(key: str, name: str) -> str:
    return f"""SELECT {key}, sum({micros()})::DOUBLE / 1000000 AS {name}
        FROM silver WHERE {BOUGHT} GROUP BY {key}"""


RULES = {
    "null_user_id": "user_id IS NULL",
    "invalid_event_type": "lower(trim(event_type)) NOT IN ('view', 'cart', 'purchase')",
    "null_product_id": "product_id IS NULL",
    "negative_price": "price < 0",
    "unpriced_purchase": "lower(trim(event_type)) = 'purchase' AND (price IS NULL OR price <= 0)",
    "nonfinite_price": "isnan(price) OR isinf(price)",
}
REPORT = "SELECT " + ", ".join(
    f"count(*) FILTER ({rule}) AS {name}" for name, rule in RULES.items()
) + " FROM bronze"


def column_profile(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{kind}' AS type,
            count(*) FILTER ({c} IS NULL) AS null_count,
            count({c}) AS non_null_count, count(DISTINCT {c}) AS distinct_count FROM {table}"""
        for c, kind in columns.items()
    )


def summary(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count,
            round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std,
            round(min({c})::DOUBLE, 4) AS min,
            round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25,
            round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75,
            round(max({c})::DOUBLE, 4) AS max FROM {table}"""
        for c in columns
    )


def time_summary(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(us) AS count,
            make_timestamp(round(avg(us))::BIGINT) AS mean, make_timestamp(min(us)) AS min,
            make_timestamp(round(quantile_cont(us::DOUBLE, 0.25))::BIGINT) AS p25,
            make_timestamp(round(quantile_cont(us::DOUBLE, 0.5))::BIGINT) AS p50,
            make_timestamp(round(quantile_cont(us::DOUBLE, 0.75))::BIGINT) AS p75,
            make_timestamp(max(us)) AS max FROM (SELECT epoch_us({c}) AS us FROM {table})"""
        for c in columns
    )


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


TIMES = """times AS (
  SELECT unnest(range(TIMESTAMP '2024-01-01 12:00:00', TIMESTAMP '2024-01-31 00:00:00',
                      INTERVAL 1 DAY)) AS as_of)"""
USERS_AT = (
    USERS.replace("SELECT user_id,", "SELECT user_id, as_of,")
    .replace(AS_OF, "as_of")
    .replace(
        "FROM silver GROUP BY user_id",
        "FROM silver JOIN times ON event_timestamp < as_of GROUP BY user_id, as_of",
    )
)
TOP_SPENDERS = f"""spenders AS (
  SELECT user_id FROM ({spend('user_id', 'total_spent')}) t
  ORDER BY total_spent DESC, t.user_id LIMIT 10)"""
LABELLED = f"""labelled AS (
  SELECT * REPLACE (CASE WHEN avg_order_value > {SPENDER} THEN 1 ELSE 0 END AS is_purchaser)
  FROM user_features)"""
GIVEN = f"""given AS (
  SELECT *, 1 / (1 + exp(-z)) AS p, CASE WHEN z > 0 THEN 1 ELSE 0 END AS predicted
  FROM (SELECT *, {GIVEN_INTERCEPT}::DOUBLE
          + {' + '.join(f'{n}::DOUBLE * {w}::DOUBLE' for n, w in GIVEN_WEIGHTS.items())} AS z
        FROM labelled))"""
GIVEN_CELLS = """cells AS (
  SELECT count(*) FILTER (is_purchaser = 1 AND predicted = 1) AS tp,
         count(*) FILTER (is_purchaser = 0 AND predicted = 1) AS fp,
         count(*) FILTER (is_purchaser = 1 AND predicted = 0) AS fn,
         count(*) FILTER (is_purchaser = 0 AND predicted = 0) AS tn, count(*) AS n FROM given)"""
PLACE = "('0x' || substr(md5('42:' || user_id::VARCHAR), 1, 8))::BIGINT"
# A fifth of each label, by rank of the hash.
PARTS = f"""parts AS (
  SELECT *, row_number() OVER (PARTITION BY is_purchaser ORDER BY {PLACE})
              <= ceil(0.2 * count(*) OVER (PARTITION BY is_purchaser)) AS in_test
  FROM user_features)"""
LINEITEM = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
JSON = """'{"user_id":' || user_id || ',"product_id":' || product_id || ',"event_type":"'
    || event_type || '","price":' || price || ',"timestamp":"' || event_timestamp || '"}'"""
GOLD_TYPES = {
    "revenue_per_hour": {
        "hour": "timestamp_ntz",
        "total_revenue": "double",
        "purchase_count": "bigint",
        "avg_order_value": "double",
    },
    "active_users_per_hour": {
        "hour": "timestamp_ntz",
        "active_users": "bigint",
        "total_events": "bigint",
        "unique_products_viewed": "bigint",
    },
    "conversion_rate": {
        "hour": "timestamp_ntz",
        "view_count": "bigint",
        "cart_count": "bigint",
        "purchase_count": "bigint",
        "unique_users": "bigint",
        "view_to_cart_rate": "double",
        "cart_to_purchase_rate": "double",
        "overall_conversion_rate": "double",
    },
}
WHOLE_FEATURES = [
    "purchases_last_24h",
    "total_purchases",
    "total_events",
    "view_count",
    "cart_count",
    "unique_products",
]
FEATURE_TYPES = {
    "user_id": "bigint",
    **{c: "bigint" if c in WHOLE_FEATURES else "double" for c in FEATURES},
    "first_activity": "timestamp_ntz",
    "last_activity": "timestamp_ntz",
    "feature_timestamp": "timestamp_ntz",
    "is_purchaser": "int",
}


def described(name: str, types: dict[str, str], rows: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "table", {i} AS "position", '{c}' AS "column", '{kind}' AS type,
            ({rows}) AS rows"""
        for i, (c, kind) in enumerate(types.items())
    )


# The tables of the lake, in which no unsound row stays.
LAKE = f"""lake AS (
  SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {r} THEN '{n}' END" for n, r in RULES.items())})
    AS rules
  FROM bronze)"""
CLEANED = """silver AS (
  SELECT user_id, product_id, event_type, price, ts AS event_timestamp,
         kafka_timestamp AS ingestion_timestamp
  FROM bronze WHERE event_type IN ('view', 'cart', 'purchase'))"""
LAKE_SILVER = """silver AS (
  SELECT user_id, product_id, event_type, price, ts AS event_timestamp,
         kafka_timestamp AS ingestion_timestamp FROM lake WHERE rules = '')"""


FITTED = [c for c in FEATURES if c not in LEAKY]
STEPS = 9


def newton(names: list[str]) -> str:
    """Logistic regression in SQL: common tables up to ``fit``, whose columns b0, b1, ... are the
    coefficients of the scaled ``names`` and, last, the intercept. Each of the steps of
    Newton's method is an aggregate over ``z`` and an elimination, a table for each pivot."""
    n = len(names)
    every = range(n + 1)
    upper = [(i, j) for i in every for j in range(i, n + 1)]
    scaling = ", ".join(
        f"avg({c}::DOUBLE) AS m{i}, coalesce(nullif(stddev_pop({c}::DOUBLE), 0), 1) AS s{i}"
        for i, c in enumerate(names)
    )
    scaled = ", ".join(f"({c}::DOUBLE - m{i}) / s{i} AS z{i}" for i, c in enumerate(names))
    tables = [
        f"""stats AS MATERIALIZED (SELECT {scaling}, count(*) AS n,
              count(*) FILTER (is_purchaser = 1) AS n1 FROM parts WHERE NOT in_test)""",
        f"""z AS MATERIALIZED (SELECT user_id, in_test, is_purchaser AS y, {scaled}, 1.0::DOUBLE AS z{n},
              n / (2 * CASE WHEN is_purchaser = 1 THEN n1 ELSE n - n1 END) AS w FROM parts, stats)""",
        f"b_0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b{i}' for i in every)})",
    ]
    score = " + ".join(f"b{i} * z{i}" for i in every)
    for step in range(STEPS):
        slopes = ", ".join(
            f"sum(w * (p - y) * z{i}){f' + any_value(b{i})' if i < n else ''} AS g{i}" for i in every
        )
        bends = ", ".join(
            f"sum(w * p * (1 - p) * z{i} * z{j}){' + 1' if i == j < n else ''} AS h{i}_{j}"
            for i, j in upper
        )
        before = ", ".join(f"any_value(b{i}) AS b{i}" for i in every)
        tables.append(
            f"""e_{step}_0 AS MATERIALIZED (SELECT {slopes}, {bends}, {before}
              FROM (SELECT *, 1 / (1 + exp(-({score}))) AS p FROM z, b_{step} WHERE NOT in_test))"""
        )
        for t in range(n):
            columns = [
                f"h{i}_{j} - h{t}_{i} * h{t}_{j} / h{t}_{t} AS h{i}_{j}" if i > t else f"h{i}_{j}"
                for i, j in upper
            ]
            columns += [f"g{i} - h{t}_{i} * g{t} / h{t}_{t} AS g{i}" if i > t else f"g{i}" for i in every]
            columns += [f"b{i}" for i in every]
            tables.append(f"e_{step}_{t + 1} AS MATERIALIZED (SELECT {', '.join(columns)} FROM e_{step}_{t})")
        solved = f"e_{step}_{n}"
        for i in reversed(every):
            known = "".join(f" - h{i}_{j} * x{j}" for j in range(i + 1, n + 1))
            solved = f"(SELECT *, (g{i}{known}) / h{i}_{i} AS x{i} FROM {solved})"
        tables.append(
            f"b_{step + 1} AS MATERIALIZED (SELECT {', '.join(f'b{i} - x{i} AS b{i}' for i in every)} FROM {solved})"
        )
    tables.append(f"fit AS (SELECT * FROM b_{STEPS})")
    tables.append(
        f"""scored AS (SELECT *, 1 / (1 + exp(-s)) AS p, (s > 0)::INTEGER AS predicted
              FROM (SELECT user_id, in_test, y, {score} AS s FROM z, fit))"""
    )
    return ", ".join(tables)


def described_table(name: str, types: dict[str, str]) -> str:
    """Every part of what is known of a table without missing cells."""
    numbers = [c for c, kind in types.items() if kind in ("bigint", "int", "double")]
    moments = [c for c, kind in types.items() if kind == "timestamp_ntz"]
    figures = ("mean", "min", "p25", "p50", "p75", "max")
    renamed = ", ".join(f"{f} AS {f}_time" for f in figures)
    parts = {
        "profile": f"SELECT count(*) AS rows, {len(types)} AS columns, 0.0::DOUBLE AS null_percent FROM {name}",
        "columns": column_profile(name, types),
        "summary": summary(name, numbers),
        "times": f"SELECT * EXCLUDE ({', '.join(figures)}), {renamed} FROM ({time_summary(name, moments)})",
    }
    return " UNION ALL BY NAME ".join(
        f"""SELECT *, '{name}' AS "table", '{part}' AS part FROM ({sql})""" for part, sql in parts.items()
    )


def oracle_sql() -> dict[str, str]:
    lake = with_(BRONZE, LAKE, LAKE_SILVER, HOURLY, USERS, USER_FEATURES)
    labelled_parts = PARTS.replace("FROM user_features", "FROM labelled")
    revenue = f"SELECT hour, {listed(REVENUE_COLUMNS)} FROM hourly WHERE buys > 0"
    active = """SELECT hour, users AS active_users, total_events,
        products AS unique_products_viewed FROM hourly"""
    funnel = f"SELECT hour, {listed(FUNNEL_COLUMNS)} FROM hourly"
    context = {**GOLD_TYPES, "user_features": FEATURE_TYPES}
    gold_rows = {"revenue_per_hour": revenue, "active_users_per_hour": active, "conversion_rate": funnel}
    gold_ctes = [f"{name} AS ({sql})" for name, sql in gold_rows.items()]
    silver, bronze = with_(SILVER), with_(BRONZE)
    gold, users = with_(SILVER, HOURLY), with_(SILVER, USERS)
    features = with_(SILVER, USERS, USER_FEATURES)
    trained = f"{features}, {LABELLED}, {labelled_parts}, {newton(FITTED)}"
    tested = """cells AS (
      SELECT count(*) FILTER (y = 1 AND predicted = 1) AS tp,
             count(*) FILTER (y = 0 AND predicted = 1) AS fp,
             count(*) FILTER (y = 1 AND predicted = 0) AS fn,
             count(*) FILTER (y = 0 AND predicted = 0) AS tn, count(*) AS n
      FROM scored WHERE in_test), ranked AS (
      SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r
      FROM scored WHERE in_test), area AS (
      SELECT (sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y)))
        AS roc_auc FROM ranked)"""
    united = with_(SILVER, UNITED)
    unsold = with_(SILVER, UNSOLD, USERS.replace("FROM silver", "FROM unsold"), USER_FEATURES)
    bronze_rows = f"{bronze} SELECT * EXCLUDE (ts) FROM bronze"
    cleaned = f"{with_(BRONZE, CLEANED)} SELECT * FROM silver"
    feature_rows = f"{features} SELECT * FROM user_features"
    return {
        "decode_events": bronze_rows,
        "bronze_stream": bronze_rows,
        "encode_events": f"""{bronze} SELECT kafka_key AS key, {JSON} AS value, topic, partition,
            "offset" FROM bronze""",
        "decode_malformed": f"""{bronze} SELECT "offset",
            CASE WHEN odd THEN user_id END AS user_id,
            CASE WHEN odd THEN product_id END AS product_id,
            CASE WHEN odd THEN event_type END AS event_type,
            CASE WHEN odd THEN {JSON} ELSE reverse({JSON}) END AS raw_value
            FROM (SELECT *, "offset" % 2 = 1 AS odd FROM bronze)""",
        "decode_evolved": f"""{bronze} SELECT "offset", user_id, product_id, event_type, price,
            CASE WHEN event_type = 'purchase' THEN 'EUR' END AS currency,
            CASE WHEN "offset" % 2 = 0 THEN product_id END AS k,
            (event_type = 'purchase')::INTEGER + ("offset" % 2 = 0)::INTEGER AS others FROM bronze""",
        "new_fields": f"""{bronze} SELECT 'currency' AS field, count(*) AS rows, 'STRING' AS type
            FROM bronze WHERE event_type = 'purchase'
            UNION ALL SELECT 'props', count(*), 'OBJECT<k: BIGINT>' FROM bronze
            WHERE "offset" % 2 = 0""",
        "quality_report": f"""{bronze} SELECT *, greatest({', '.join(RULES)}) = 0 AS passed
            FROM ({REPORT})""",
        "quality_issues": bronze
        + " UNION ALL ".join(
            f"SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS violations FROM bronze"
            for name, rule in RULES.items()
        ),
        "quality_violations": f"""{bronze} SELECT "offset", event_type, price, rules FROM (
            SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {r} THEN '{n}' END" for n, r in RULES.items())})
            AS rules FROM bronze) WHERE rules <> ''""",
        "silver_clean": cleaned,
        "silver_normalized": cleaned,
        "revenue_per_hour": f"{gold} SELECT hour, {listed(REVENUE_COLUMNS)} FROM hourly WHERE buys > 0",
        "active_users_per_hour": f"""{gold} SELECT hour, users AS active_users, total_events,
            products AS unique_products_viewed FROM hourly""",
        "conversion_rate": f"{gold} {funnel}",
        "conversion_trend": f"{gold} {funnel}",
        "table_context": with_(SILVER, HOURLY, USERS, USER_FEATURES, *gold_ctes)
        + " UNION ALL BY NAME ".join(described_table(n, types) for n, types in context.items()),
        "answer_summary": f"""{gold} SELECT count(*) AS rows, 2 AS columns,
            {half_up("100 * count(*) FILTER (buys = 1)", "2 * count(*)", 1)} AS null_percent
            FROM hourly WHERE buys > 0""",
        "pipeline_silver": f"{lake} SELECT * FROM silver",
        "pipeline_quarantine": f"""{lake} SELECT "offset", rules FROM lake WHERE rules <> ''""",
        "pipeline_gold": f"""{lake} SELECT *, 'revenue_per_hour' AS "table" FROM ({revenue})
            UNION ALL BY NAME SELECT *, 'active_users_per_hour' AS "table" FROM ({active})
            UNION ALL BY NAME SELECT *, 'conversion_rate' AS "table" FROM ({funnel})""",
        "pipeline_features": f"{lake} SELECT * FROM user_features",
        "incremental_silver": f"{lake} SELECT *, event_timestamp::DATE AS event_date FROM silver",
        "incremental_gold": f"""{lake} SELECT *, hour::DATE AS event_date FROM (
            SELECT *, 'revenue_per_hour' AS "table" FROM ({revenue})
            UNION ALL BY NAME SELECT *, 'active_users_per_hour' AS "table" FROM ({active})
            UNION ALL BY NAME SELECT *, 'conversion_rate' AS "table" FROM ({funnel}))""",
        "incremental_features": f"{lake} SELECT * FROM user_features",
        "incremental_batches": f"""{lake} SELECT 2 * count(*) AS rows_read,
            2 * count(*) FILTER (rules <> '') AS rows_quarantined, 0::BIGINT AS rows_untimed,
            2 * count(*) FILTER (rules = '') AS rows_arrived,
            count(DISTINCT ts::DATE) FILTER (rules = '')::INTEGER AS days,
            2 * count(*) FILTER (rules <> '') AS quarantine FROM lake""",
        "streamed_silver": f"{with_(BRONZE, CLEANED)} SELECT * FROM silver",
        "streamed_gold": f"""{with_(BRONZE, CLEANED, HOURLY)}
            SELECT *, 'revenue_per_hour' AS "table" FROM ({revenue})
            UNION ALL BY NAME SELECT *, 'active_users_per_hour' AS "table" FROM ({active})
            UNION ALL BY NAME SELECT *, 'conversion_rate' AS "table" FROM ({funnel})""",
        "distinct_by_period": silver
        + " UNION ALL ".join(
            f"""SELECT '{unit}' AS unit, date_trunc('{unit}', event_timestamp)::TIMESTAMP AS period,
                count(DISTINCT user_id) AS distinct_users,
                count(DISTINCT product_id) AS distinct_products,
                true AS distinct_users_within, true AS distinct_products_within
                FROM silver GROUP BY 2"""
            for unit in ("day", "week", "month")
        ),
        "features_as_of": f"""{with_(SILVER, TIMES, USERS_AT, USER_FEATURES.replace(AS_OF, "as_of"))}
            SELECT * FROM user_features""",
        "point_lookup": f"""{features}, {TOP_SPENDERS} SELECT user_features.*
            FROM user_features JOIN spenders USING (user_id)""",
        "saved_scores": f"""{features}, {LABELLED}, {GIVEN}, {TOP_SPENDERS}
            SELECT user_id, predicted, round(greatest(p, 1 - p) * 100, 6) AS confidence,
            CASE WHEN predicted = 1 THEN 'Likely Purchaser' ELSE 'Unlikely Purchaser' END AS message
            FROM given JOIN spenders USING (user_id)""",
        "run_all": f"""{lake} SELECT 'bronze' AS layer, count(*) AS rows FROM bronze
            UNION ALL SELECT 'silver', count(*) FROM silver
            UNION ALL SELECT 'revenue_per_hour', count(*) FROM hourly WHERE buys > 0
            UNION ALL SELECT 'active_users_per_hour', count(*) FROM hourly
            UNION ALL SELECT 'conversion_rate', count(*) FROM hourly
            UNION ALL SELECT 'user_features', count(*) FROM users
            UNION ALL SELECT 'trained_on', CASE WHEN count(*) >= 100 THEN count(*) ELSE 0 END
              FROM users
            UNION ALL SELECT 'good_models', CASE WHEN count(*) >= 100 THEN 1 ELSE 0 END FROM users""",
        "run_all_failing": f"""{bronze} SELECT * FROM (UNPIVOT ({REPORT})
              ON {', '.join(RULES)} INTO NAME rule VALUE rows) WHERE rows > 0
            UNION ALL SELECT 'layers', 1""",
        "pipeline_counts": f"""{lake} SELECT 'rows_read' AS step, count(*) AS rows FROM silver
            UNION ALL SELECT 'rows_written', count(*) FROM silver
            UNION ALL SELECT 'rows_quarantined', count(*) FROM lake WHERE rules <> ''
            UNION ALL SELECT 'revenue_per_hour', count(*) FROM hourly WHERE buys > 0
            UNION ALL SELECT 'active_users_per_hour', count(*) FROM hourly
            UNION ALL SELECT 'conversion_rate', count(*) FROM hourly
            UNION ALL SELECT 'user_features', count(*) FROM users""",
        "gate_status": f"""{lake}, {LABELLED}, {GIVEN}, {GIVEN_CELLS} SELECT 'bronze_quality' AS gate, count(*) = 0 AS passed
              FROM lake WHERE rules <> ''
            UNION ALL SELECT 'gold_rows', count(*) FILTER (buys > 0) > 0 FROM hourly
            UNION ALL SELECT 'feature_rows', count(*) > 0 FROM users
            UNION ALL SELECT 'no_rows', count(*) > 0 FROM users WHERE user_id < 0
            UNION ALL SELECT 'enough_to_train', count(*) >= 100 FROM users
            UNION ALL SELECT 'too_few_to_train', count(*) >= 100 FROM users WHERE user_id < 5
            UNION ALL SELECT 'model_without_metrics', false
            UNION ALL SELECT 'given_model', (tp + tn) / n >= 0.5 FROM cells
            UNION ALL SELECT 'given_model_unlike_perfect', (tp + tn) / n >= 1 FROM cells""",
        "metrics_history": f"""{lake}, {LABELLED}, {labelled_parts} SELECT count(*) FILTER (NOT in_test) AS n_train,
            count(*) FILTER (in_test) AS n_test, {len(FEATURES) - len(LEAKY)} AS n_features,
            true AS passed FROM parts, range(2) AS run(n) GROUP BY n HAVING count(*) >= 100""",
        "hourly_rollup": f"""{gold} SELECT hour, {listed(REVENUE_COLUMNS)}, users AS active_users,
            products AS unique_products_viewed, total_events, views AS view_count,
            carts AS cart_count FROM hourly""",
        "purchase_features": f"""{users} SELECT user_id, {listed(PURCHASE_COLUMNS)}
            FROM users WHERE buys > 0""",
        "event_frequency_features": f"""{users} SELECT user_id, {listed(FREQUENCY_COLUMNS)},
            buys AS event_purchase_count, first_activity, last_activity FROM users""",
        "conversion_features": f"{users} SELECT user_id, {listed(CONVERSION_COLUMNS)} FROM users",
        "user_features": feature_rows,
        "user_features_joined": feature_rows,
        "kpis": f"""{gold}, rounded AS (SELECT *, {cents(REVENUE_COLUMNS['total_revenue'])} AS cents,
              {cents(REVENUE_COLUMNS['avg_order_value'])} AS order_cents,
              {cents(RATES['overall_conversion_rate'])} AS rate FROM hourly)
            SELECT sum(cents)::DOUBLE / 100 AS total_revenue,
              sum(users)::BIGINT AS active_user_hours,
              {half_up('sum(rate)', '100 * count(*)', 2)} AS conversion_rate,
              {half_up('sum(order_cents) FILTER (buys > 0)', '100 * count(*) FILTER (buys > 0)', 2)}
                AS avg_order_value,
              {half_up('100 * sum(buys)', 'sum(views)', 2)} AS weighted_conversion_rate,
              {half_up('sum(cents)', '100 * sum(buys)', 2)} AS weighted_avg_order_value,
              (SELECT count(DISTINCT user_id) FROM silver) AS distinct_users
            FROM rounded""",
        "revenue_by_product": f"{silver} {spend('product_id', 'revenue')}",
        "spend_by_user": f"{silver} {spend('user_id', 'total_spent')}",
        "top_products": f"""{silver} SELECT product_id::VARCHAR AS product_id, revenue
            FROM ({spend('product_id', 'revenue')}) t ORDER BY revenue DESC, t.product_id LIMIT 15""",
        "top_spenders": f"""{silver} SELECT user_id::VARCHAR AS user_id, total_spent
            FROM ({spend('user_id', 'total_spent')}) t ORDER BY total_spent DESC, t.user_id LIMIT 10""",
        "event_distribution": f"{silver} SELECT event_type, count(*) AS count FROM silver GROUP BY 1",
        "bronze_event_distribution": f"""{bronze} SELECT event_type, count(*) AS count
            FROM bronze GROUP BY 1""",
        "hourly_activity": f"""{silver} SELECT hour(event_timestamp)::INTEGER AS hour_of_day,
            count(*) AS event_count FROM silver GROUP BY 1""",
        "events_per_minute": f"""{bronze} SELECT date_trunc('minute', ts)::TIMESTAMP AS minute,
            count(*) AS event_count FROM bronze GROUP BY 1""",
        "events_per_minute_stream": f"""{bronze}
            SELECT date_trunc('minute', ts)::TIMESTAMP AS minute, count(*) AS event_count
            FROM bronze GROUP BY 1""",
        "stream_kpis": f"""{bronze} SELECT count(*) AS total_events,
            count(DISTINCT event_type) AS event_types, count(DISTINCT user_id) AS unique_users
            FROM bronze""",
        "latest_events": f"""{bronze} SELECT * EXCLUDE (ts) REPLACE (ts AS event_timestamp)
            FROM bronze ORDER BY ts DESC, "offset" DESC LIMIT 20""",
        "table_profile": f"""{united} SELECT count(*) AS rows, 5 AS columns,
            {half_up(f"100 * ({' + '.join(f'count(*) - count({c})' for c in SILVER_COLUMNS)})", "count(*) * 5", 1)}
              AS null_percent FROM united""",
        "column_profile": united
        + column_profile(
            "united",
            {
                "user_id": "bigint",
                "product_id": "int",
                "event_type": "string",
                "price": "double",
                "event_timestamp": "timestamp_ntz",
            },
        ),
        "lineitem_column_profile": column_profile("lineitem", LINEITEM),
        "lineitem_summary_stats": summary(
            "lineitem", [c for c, kind in LINEITEM.items() if kind in ("bigint", "int", "double")]
        ),
        "summary_stats": features
        + summary("user_features", FEATURES + ["is_purchaser"]),
        "time_summary": silver + time_summary("silver", ["event_timestamp"]),
        "class_distribution": f"""{features}, {LABELLED}
            SELECT is_purchaser, count(*) AS count,
              {half_up('100 * count(*)', '(SELECT count(*) FROM labelled)', 1)} AS percent
            FROM labelled GROUP BY 1""",
        "run_query": f"""{gold}, revenue AS (
              SELECT hour, {listed(REVENUE_COLUMNS)} FROM hourly WHERE buys > 0)
            SELECT * FROM revenue WHERE avg_order_value > 5 AND purchase_count >= 2
            ORDER BY total_revenue DESC, hour""",
        "grouped_by_hour": f"""{gold} SELECT hour(hour)::INTEGER AS hour_of_day,
            sum(total_events)::BIGINT AS events, max(users) AS most_users
            FROM hourly GROUP BY 1""",
        "table_preview": f"{features} SELECT * FROM user_features ORDER BY user_id LIMIT 10",
        "quality_report_dirty": f"""{with_(BRONZE, DIRTY)} SELECT *,
            greatest({', '.join(RULES)}) = 0 AS passed FROM ({REPORT.replace("bronze", "dirty")})""",
        "quality_violations_dirty": f"""{with_(BRONZE, DIRTY)}
            SELECT "offset", event_type, price, rules FROM (
            SELECT *, concat_ws(',', {', '.join(f"CASE WHEN {r} THEN '{n}' END" for n, r in RULES.items())})
            AS rules FROM dirty) WHERE rules <> ''""",
        "silver_clean_dirty": f"""{with_(BRONZE, DIRTY)} SELECT user_id, product_id, event_type,
            price, ts AS event_timestamp, kafka_timestamp AS ingestion_timestamp FROM dirty
            WHERE user_id IS NOT NULL AND ts IS NOT NULL
              AND event_type IN ('view', 'cart', 'purchase')""",
        "user_features_dirty": f"{unsold} SELECT * FROM user_features",
        "prepared_features_dirty": f"""{unsold} SELECT user_id,
            {', '.join(f"{c}::DOUBLE AS {c}" for c in FEATURES if c != 'total_revenue')},
            CASE WHEN user_id % 7 = 0 OR user_id % 11 = 0 OR user_id % 13 = 0 THEN 0.0::DOUBLE
                 ELSE total_revenue END AS total_revenue, is_purchaser FROM user_features""",
        "given_scores": f"""{features}, {LABELLED}, {GIVEN} SELECT user_id, predicted,
            round(greatest(p, 1 - p) * 100, 6) AS confidence,
            CASE WHEN predicted = 1 THEN 'Likely Purchaser' ELSE 'Unlikely Purchaser' END AS message
            FROM given""",
        "given_confusion": f"""{features}, {LABELLED}, {GIVEN}, {GIVEN_CELLS}
            SELECT 1 AS label, 1 AS predicted, tp AS n FROM cells
            UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells
            UNION ALL SELECT 0, 0, tn FROM cells""",
        "given_metrics": f"""{features}, {LABELLED}, {GIVEN}, {GIVEN_CELLS}
            SELECT round((tp + tn) / n, 9) AS accuracy,
              CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 9) ELSE 0 END AS precision,
              CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall,
              round(2 * tp / (2 * tp + fp + fn), 9) AS f1_score FROM cells""",
        "given_roc_auc": f"""{features}, {LABELLED}, {GIVEN}, ranked AS (
              SELECT is_purchaser, (rank() OVER (ORDER BY p)
                + (count(*) OVER (PARTITION BY p) - 1) / 2) AS r FROM given)
            SELECT count(*) AS users, round((sum(r) FILTER (is_purchaser = 1)
                - count(*) FILTER (is_purchaser = 1) * (count(*) FILTER (is_purchaser = 1) + 1) / 2)
              / (count(*) FILTER (is_purchaser = 1) * count(*) FILTER (is_purchaser = 0)), 9) AS roc_auc
            FROM ranked""",
        "train_metrics": f"""{trained}, {tested}
            SELECT round((tp + tn) / n, 9) AS accuracy,
              CASE WHEN tp + fp > 0 THEN round(tp / (tp + fp), 9) ELSE 0 END AS precision,
              CASE WHEN tp + fn > 0 THEN round(tp / (tp + fn), 9) ELSE 0 END AS recall,
              round(2 * tp / (2 * tp + fp + fn), 9) AS f1_score, round(roc_auc, 9) AS roc_auc,
              (SELECT count(*) FROM z WHERE NOT in_test) AS n_train, n AS n_test,
              {len(FITTED)} AS n_features FROM cells, area""",
        "confusion_matrix": f"""{trained}, {tested}
            SELECT 1 AS label, 1 AS predicted, tp AS n FROM cells
            UNION ALL SELECT 0, 1, fp FROM cells UNION ALL SELECT 1, 0, fn FROM cells
            UNION ALL SELECT 0, 0, tn FROM cells""",
        "top_coefficients": f"{trained} SELECT feature, round(b, 4) AS coefficient FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS feature, b{i} AS b FROM fit" for i, c in enumerate(FITTED))
        + ") ORDER BY abs(b) DESC LIMIT 5",
        "score_users": f"""{trained} SELECT user_id, predicted,
            round(greatest(p, 1 - p) * 100, 4) AS confidence,
            CASE WHEN predicted = 1 THEN 'Likely Purchaser' ELSE 'Unlikely Purchaser' END AS message
            FROM scored""",
        "grouped_query": f"""{features} SELECT is_purchaser, count(*) AS users,
            sum(total_events)::BIGINT AS events, max(last_activity) AS newest
            FROM user_features GROUP BY 1""",
        "union_tables": f"{united} SELECT * FROM united",
        "layer_status": """SELECT 'events' AS layer, true AS exists, 1::BIGINT AS files,
              (SELECT count(*) FROM events) AS rows, (SELECT max(ts) FROM events) AS newest
            UNION ALL SELECT 'orders', true, 1, (SELECT count(*) FROM orders), NULL
            UNION ALL SELECT 'absent', false, NULL, NULL, NULL""",
        "table_schemas": gold
        + " UNION ALL ".join(
            described(
                name,
                types,
                "SELECT count(*) FROM hourly" + (" WHERE buys > 0" if "revenue" in name else ""),
            )
            for name, types in GOLD_TYPES.items()
        )
        + " UNION ALL "
        + described("user_features", FEATURE_TYPES, "SELECT count(DISTINCT user_id) FROM silver"),
        "prepared_features": f"""{features} SELECT user_id,
            {', '.join(f"{c}::DOUBLE AS {c}" for c in FEATURES)}, is_purchaser FROM user_features""",
        "train_test_split": f"""{features}, {PARTS} SELECT user_id,
            CASE WHEN in_test THEN 'test' ELSE 'train' END AS part FROM parts""",
        "feature_scaling": f"{features}, {PARTS} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg({c}::DOUBLE), 4) AS mean,
                round(stddev_pop({c}::DOUBLE), 4) AS std
                FROM parts WHERE NOT in_test"""
            for c in FEATURES
        ),
    }
