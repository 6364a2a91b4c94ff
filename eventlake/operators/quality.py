"""Data-quality rules over Bronze, counted in one pass, and the gates built on them."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.errors import DataQualityError, EmptyTableError


def normalised_type() -> Column:
    return F.lower(F.trim(F.col("event_type")))


def rules() -> dict[str, Column]:
    """Rule name to violation predicate. A NULL predicate is no violation: a NULL event
    type breaks no rule. NaN passes the sign rules, hence the rule on finite prices."""
    price = F.col("price")
    infinity = float("inf")
    return {
        "null_user_id": F.col("user_id").isNull(),
        "invalid_event_type": ~normalised_type().isin(schemas.EVENT_TYPES),
        "null_product_id": F.col("product_id").isNull(),
        "negative_price": price < 0,
        "unpriced_purchase": (normalised_type() == "purchase")
        & (price.isNull() | (price <= 0)),
        "nonfinite_price": F.isnan(price) | (F.abs(price) == infinity),
    }


def quality_report(bronze: DataFrame) -> DataFrame:
    """One row: a violation count per rule, and ``passed``."""
    counts = bronze.agg(*[F.count_if(rule).alias(name) for name, rule in rules().items()])
    return counts.withColumn("passed", F.greatest(*[F.col(name) for name in rules()]) == 0)


def quality_issues(report: DataFrame) -> DataFrame:
    """The report in long form: one row per rule."""
    return report.unpivot([], [F.col(name) for name in rules()], "rule", "violations")


def check_quality(bronze: DataFrame) -> dict[str, int]:
    """Raise :class:`DataQualityError` naming every violated rule; else the counts."""
    row = quality_report(bronze).first()
    counts = {name: row[name] for name in rules()}
    violated = {name: n for name, n in counts.items() if n > 0}
    if violated:
        raise DataQualityError(violated)
    return counts


def tag_violations(bronze: DataFrame) -> DataFrame:
    """Bronze plus ``violated_rules``, an array that is empty for a sound row."""
    hits = [F.when(rule, F.lit(name)) for name, rule in rules().items()]
    return bronze.withColumn("violated_rules", F.array_compact(F.array(*hits)))


def require_rows(**tables: DataFrame) -> None:
    """Raise :class:`EmptyTableError` unless every table holds a row."""
    empty = [name for name, table in tables.items() if table.isEmpty()]
    if empty:
        raise EmptyTableError(f"no rows in: {', '.join(empty)}")


def has_rows(table: DataFrame, needed: int) -> bool:
    """Whether the table holds ``needed`` rows; reads no further than that."""
    return table.limit(needed).count() >= needed


def enough_to_train(features: DataFrame, needed: int = 100, wanted: int = 10) -> bool:
    """Gate before training: False (skip) under ``needed`` rows, with a warning when
    even ``wanted`` rows are missing."""
    if not has_rows(features, wanted):
        warnings.warn(f"fewer than {wanted} rows: no reliable training", stacklevel=2)
    return has_rows(features, needed)
