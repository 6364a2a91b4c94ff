"""Table and column profiles, summaries and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.operators import quantiles

QUARTILES = [0.25, 0.5, 0.75]


def present_value(df: DataFrame, column: str) -> Column:
    """The column with NaN read as missing, as in every profile here."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def table_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns and the percent of missing cells."""
    missing = [F.count_if(present_value(df, c).isNull()) for c in df.columns]
    nulls = sum(missing, start=F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("null_cells")).select(
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.when(
            F.col("rows") > 0,
            F.round(F.col("null_cells") * 100 / (F.col("rows") * len(df.columns)), 1),
        )
        .otherwise(0.0)
        .alias("null_percent"),
    )


def _cell(df: DataFrame, column: str, number: int) -> Column:
    """A value in the field of its kind. Numbers and times stay numbers, which compare
    and travel faster than their texts; grouping makes one value of both zeros."""
    kind, value = df.schema[column].dataType, present_value(df, column)
    whole = real = text = F.lit(None)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        whole = value
    elif isinstance(kind, T.DateType):
        whole = F.unix_date(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.unix_micros(value.cast("timestamp"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        real = value
    elif isinstance(kind, T.BinaryType):
        text = F.hex(value)
    else:
        text = value
    return F.struct(
        F.lit(number).alias("number"),
        whole.cast("bigint").alias("whole"),
        real.cast("double").alias("real"),
        text.cast("string").alias("text"),
    )


def column_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row per column: type, NULL, non-NULL and distinct counts.

    Exact distincts of many columns would multiply every wide row by the number of
    columns. Here the table is turned into narrow (column, value) rows, counted per
    value before the shuffle, so frequent values cost one row per task and a column's
    values spread over all tasks. ``approx`` needs a sketch per column and no
    shuffle of values.
    """
    counts = _approx_counts(df) if approx else _exact_counts(df)
    described = [
        F.struct(F.lit(c).alias("column"), F.lit(kind).alias("type")) for c, kind in df.dtypes
    ]
    return counts.orderBy("number").select(
        F.array(*described)[F.col("number")].alias("described"), "*"
    ).select("described.*", "null_count", "non_null_count", "distinct_count")


def _exact_counts(df: DataFrame) -> DataFrame:
    cells = F.array(*[_cell(df, c, i) for i, c in enumerate(df.columns)])
    values = (
        df.select(F.inline(cells))
        .groupBy("number", "whole", "real", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    present = F.lit(False)
    for field in ("whole", "real", "text"):
        present = present | F.col(field).isNotNull()
    return values.groupBy("number").agg(
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0)).alias("non_null_count"),
        F.count_if(present).alias("distinct_count"),
    )


def _approx_counts(df: DataFrame) -> DataFrame:
    per_column = [
        F.struct(
            F.lit(i).alias("number"),
            F.count_if(present_value(df, c).isNull()).alias("null_count"),
            F.count(present_value(df, c)).alias("non_null_count"),
            F.approx_count_distinct(present_value(df, c)).alias("distinct_count"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(F.array(*per_column).alias("profile")).select(F.inline("profile"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def time_columns(df: DataFrame) -> list[str]:
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds)]


SUMMARY = (
    "column string, count bigint, mean double, std double, "
    "min double, p25 double, p50 double, p75 double, max double"
)


def summary_stats(df: DataFrame) -> DataFrame:
    """Per numeric column: count, mean, sample deviation, extremes and exact quartiles,
    NaN read as missing."""
    return _summary(df, numeric_columns(df))


def _summary(df: DataFrame, columns: list[str], whole: bool = False) -> DataFrame:
    """``whole`` columns hold large whole numbers, whose mean is taken as decimal."""
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], SUMMARY)
    value = F.col("value")
    measured = quantiles.pairs(df, columns).groupBy("column").agg(
        *quantiles.range_measures(),
        F.avg(value.cast("decimal(20,0)") if whole else value).cast("double").alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    rows = {columns[row["column"]]: row for row in measured.collect()}
    ranges = {c: quantiles.column_range(rows.get(c)) for c in columns}
    quartiles = quantiles.exact_quantiles(df, columns, QUARTILES, ranges)
    no_values = Row(mean=None, std=None, min=None, max=None)
    described = []
    for c in columns:
        row = rows.get(c, no_values)
        described.append(
            (c, ranges[c].count, row.mean, row.std, row.min, *quartiles[c], row.max)
        )
    return spark.createDataFrame(described, SUMMARY)


def time_summary(df: DataFrame) -> DataFrame:
    """Per time column: count, mean, extremes and exact quartiles as timestamps."""
    columns = time_columns(df)
    micros = df.select(
        *[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in columns]
    )
    figures = ["mean", "min", "p25", "p50", "p75", "max"]
    return _summary(micros, columns, whole=True).select(
        "column",
        "count",
        *[F.timestamp_micros(F.round(F.col(f)).cast("bigint")).alias(f) for f in figures],
    )


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows in the order of the columns, the same on every run; each
    task keeps its best ``n``."""
    ordered = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return (df.orderBy(*ordered) if ordered else df).limit(n)


def table_context(df: DataFrame, sample: int = 20) -> dict:
    """What a reader needs to know of a table, whatever its size: columns, row count and
    missing cells, a profile and a summary of each column, and the first rows."""
    return {
        "columns": df.columns,
        "profile": table_profile(df),
        "column_profile": column_profile(df),
        "summary": summary_stats(df),
        "time_summary": time_summary(df),
        "sample": preview(df, sample),
    }
