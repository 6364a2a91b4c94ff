"""Sums and means that do not depend on the order in which Spark adds the rows.

A double sum changes with the partitioning, which moves rounded results by a cent.
Summing ``decimal`` columns is exact but several times slower, because a wide
decimal leaves the fixed-width fast path. So a price is split into two bigints,
whole units and millionths, each summed on the fast path, and put together as a
decimal once per group. A group total beyond 9e18 units raises an overflow error.
What a price has beyond its millionths is summed as a double beside them, so that
nothing is dropped; prices in whole millionths have none of it.

Prices outside ``+-EXACT_LIMIT`` (NaN and the infinities included) cannot be split.
They are summed as doubles beside the exact part and reach the result the way
floating point defines it: a NaN or infinite price gives a NaN or infinite total.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_LIMIT = 9.0e12
MILLIONTHS = 1_000_000
# Parts of a double that are rounding, not value.
RESOLUTION = 1e-15


def _is_exact(value: Column) -> Column:
    return (value > -EXACT_LIMIT) & (value < EXACT_LIMIT)


def _split(value: Column) -> tuple[Column, Column]:
    """Whole units and millionths of the splittable values."""
    millionths = F.when(
        _is_exact(value), F.floor(value * float(MILLIONTHS) + F.lit(0.5))
    )
    return F.call_function("div", millionths, F.lit(MILLIONTHS)), millionths % MILLIONTHS


def _joined(whole: Column, rest: Column) -> Column:
    """Sums of units and of millionths as one decimal."""
    return whole.cast("decimal(20,0)") + rest.cast("decimal(20,0)") * F.lit("0.000001").cast(
        "decimal(6,6)"
    )


def exact_sum(value: Column) -> Column:
    """Aggregate: sum of the splittable values as decimal, NULL when there are none."""
    whole, rest = _split(value)
    return _joined(F.sum(whole), F.sum(rest))


def _loose_sum(value: Column) -> Column:
    return F.sum(F.when(~_is_exact(value), value))


def _dust_sum(value: Column) -> Column:
    """Aggregate: sum of what is left of the splittable values beyond their millionths,
    NULL when nothing is. A rest that a double of that size cannot hold is none."""
    millionths = F.floor(value * float(MILLIONTHS) + F.lit(0.5))
    rest = value - millionths / float(MILLIONTHS)
    held = _is_exact(value) & (F.abs(rest) > F.abs(value) * RESOLUTION)
    return F.sum(F.when(held, rest))


def total(value: Column, places: int = 6) -> Column:
    """Aggregate: ``round(sum(value), places)`` as double; NULL over no values."""
    return _total(exact_sum(value), _dust_sum(value), _loose_sum(value), places)


def _total(exact: Column, dust: Column, loose: Column, places: int) -> Column:
    split = F.coalesce(
        F.round(exact.cast("double") + dust, places), F.round(exact, places).cast("double")
    )
    return F.coalesce(loose + F.coalesce(split, F.lit(0.0)), split)


def mean(value: Column, rows: Column, places: int) -> Column:
    """Aggregate: ``round(sum(value) / rows, places)`` as double.

    ``rows`` is the aggregate to divide by: ``count(*)`` counts NULL values too,
    ``count(value)`` does not. NULL over no values.
    """
    return _mean(exact_sum(value), _dust_sum(value), _loose_sum(value), rows, places)


def _mean(exact: Column, dust: Column, loose: Column, rows: Column, places: int) -> Column:
    fine = exact.cast("double") + dust
    loose = loose + F.coalesce(fine, exact.cast("double"), F.lit(0.0))
    return F.when(
        rows > 0,
        F.coalesce(
            F.round(loose / rows, places),
            F.round(fine / rows, places),
            F.round(exact / rows.cast("decimal(20,0)"), places).cast("double"),
        ),
    )


def parts(value: Column, prefix: str) -> list[Column]:
    """Aggregates that can be stored and merged: :func:`merged_total` and
    :func:`merged_mean` over the rows of several groups give what :func:`total` and
    :func:`mean` give over all their values."""
    whole, rest = _split(value)
    return [
        F.sum(whole).alias(f"{prefix}_units"),
        F.sum(rest).alias(f"{prefix}_millionths"),
        _dust_sum(value).alias(f"{prefix}_dust"),
        _loose_sum(value).alias(f"{prefix}_loose"),
    ]


def _stored(prefix: str, merge=lambda part: part) -> tuple[Column, Column, Column]:
    """Exact sum, dust and loose sum of stored parts."""
    units, millionths, dust, loose = (
        merge(F.col(f"{prefix}_{part}")) for part in ("units", "millionths", "dust", "loose")
    )
    return _joined(units, millionths), dust, loose


def merged_total(prefix: str, places: int = 6) -> Column:
    """Aggregate: the total of the :func:`parts` of several groups."""
    return _total(*_stored(prefix, F.sum), places)


def merged_mean(prefix: str, rows: Column, places: int) -> Column:
    """Aggregate: the mean over several groups; ``rows`` is the aggregate to divide by."""
    return _mean(*_stored(prefix, F.sum), rows, places)


def stored_total(prefix: str, places: int = 6) -> Column:
    """The total of the :func:`parts` in a row."""
    return _total(*_stored(prefix), places)


def stored_mean(prefix: str, rows: Column, places: int) -> Column:
    """The mean of the :func:`parts` in a row, over ``rows`` values."""
    return _mean(*_stored(prefix), rows, places)


def ratio(part: Column, whole: Column, places: int, scale: int = 1) -> Column:
    """``round(scale * part / whole, places)``, 0.0 when ``whole`` is 0."""
    return F.when(whole > 0, F.round(part * scale / whole, places)).otherwise(F.lit(0.0))
