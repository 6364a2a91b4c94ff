"""Time buckets that keep the type of the column they cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def bucket(df: DataFrame, column: str, unit: str) -> Column:
    """``column`` cut to ``unit``. ``date_trunc`` returns TIMESTAMP even for a column
    without time zone, so the result is cast back."""
    return F.date_trunc(unit, F.col(column)).cast(df.schema[column].dataType)


def parsed(df: DataFrame, column: str) -> Column:
    """``column`` as a time; text that is no time becomes NULL, also in ANSI mode."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column)
