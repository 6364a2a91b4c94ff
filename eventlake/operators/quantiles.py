"""Exact quantiles without sorting a column into one task.

``percentile`` gathers every distinct value of a column in one buffer, and no sketch is
exact. Here a KLL sketch only brackets each wanted rank: a pass merges the sketches of the
partitions and asks for the values a little below and a little above the rank, the next
numbers the cell of each value among these cuts and counts rows by cell. What follows looks at
the rows of the rank's cell alone. A cell holds a small share of the rows before it, however the
values are spread, so the passes follow the logarithm of the row count: two or three, never more for
odd values. When few rows are left they are grouped by value, and the driver gets the
groups around the ranks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Size of the sketch, whose ranks are then right within 0.07 percent of the rows, and the part
# of the rows a bracket reaches to either side.
SKETCH = 4096
MARGIN = 0.002
# Rows in a bracket from which its distinct values are counted one by one.
FEW = 20_000
# Whole numbers up to here are doubles of their own.
TOLD_APART = 2**53


@dataclass(frozen=True)
class ColumnRange:
    """Count of a column's values; NULL and NaN are none."""

    count: int


def pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column number, value, exact) of every value that is neither NULL nor NaN. The plan
    of a pass stays small, however many columns there are. ``exact`` keeps whole numbers,
    which a double may not."""
    cells = []
    for i, c in enumerate(columns):
        whole = isinstance(df.schema[c].dataType, T.IntegralType)
        exact = F.col(c) if whole else F.lit(None)
        cells.append(
            F.struct(
                F.lit(i).alias("column"),
                F.col(c).cast("double").alias("value"),
                exact.cast("bigint").alias("whole"),
            )
        )
    return df.select(F.inline(F.array(*cells))).filter(_is_value("value"))


def _is_value(column: Column | str) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return value.isNotNull() & ~F.isnan(value)


def range_measures() -> list[Column]:
    """Aggregates over pairs a :class:`ColumnRange` is read from."""
    return [F.count("value").alias("count")]


def column_range(row: Row | None) -> ColumnRange:
    """The range in an aggregate row; a column without values has no row."""
    return ColumnRange(0 if row is None else row["count"])


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    ranges: dict[str, ColumnRange] | None = None,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of numeric columns, None for a column without
    values. ``ranges`` saves the first pass to a caller who has them."""
    if ranges is None:
        rows = pairs(df, columns).groupBy("column").agg(*range_measures()).collect()
        by_number = {row["column"]: row for row in rows}
        ranges = {c: column_range(by_number.get(i)) for i, c in enumerate(columns)}
    ranks = {
        (c, rank)
        for c, r in ranges.items()
        for p in probabilities
        for rank in _ranks(r.count, p)[:2]
    }
    values = _values_at(df, columns, ranges, ranks)
    result = {}
    for c, r in ranges.items():
        result[c] = []
        for p in probabilities:
            if r.count == 0:
                result[c].append(None)
                continue
            lower, upper, weight = _ranks(r.count, p)
            a, b = values[c, lower], values[c, upper]
            result[c].append(float(a if a == b or weight == 0 else a + (b - a) * weight))
    return result


def value_at_rank(df: DataFrame, column: str, rank: int, count: int) -> float:
    """The value at ``rank``, from 0, of a column of ``count`` values, none of them NULL."""
    ranges = {column: ColumnRange(count)}
    return _values_at(df, [column], ranges, {(column, rank)})[column, rank]


def _ranks(count: int, probability: float) -> tuple:
    if count == 0:
        return ()
    position = probability * (count - 1)
    lower = math.floor(position)
    return lower, min(lower + 1, count - 1), position - lower


@dataclass(frozen=True)
class Bracket:
    """Values of one column from ``low`` to ``high`` (None: open): ``rows`` of them, with
    ``below`` smaller ones. A bracket of one value is closed."""

    column: int
    low: float | None
    high: float | None
    below: int
    rows: int

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.rows

    def closed(self) -> bool:
        return self.low is not None and self.low == self.high

    def condition(self, value: Column) -> Column:
        inside = _is_value(value)
        if self.low is not None:
            inside &= value >= F.lit(self.low)
        if self.high is not None:
            inside &= value <= F.lit(self.high)
        return inside


def _values_at(df, columns, ranges, ranks) -> dict[tuple[str, int], float]:
    """The value at each (column, rank), ranks counted from 0."""
    wanted: dict[Bracket, set[int]] = {}
    for column, rank in ranks:
        number = columns.index(column)
        whole = Bracket(number, None, None, 0, ranges[column].count)
        wanted.setdefault(whole, set()).add(rank)
    found: dict[tuple[str, int], float] = {}
    while wanted:
        small = {b: r for b, r in wanted.items() if b.rows <= FEW or b.closed()}
        large = {b: r for b, r in wanted.items() if b not in small}
        for b, rank, value in _counted(df, columns, small) if small else []:
            found[columns[b.column], rank] = value
        wanted = {}
        for b, of_rank in (_narrowed(df, columns, large) if large else {}).items():
            for rank in of_rank:
                if b.closed() and (abs(b.low) <= TOLD_APART or _is_double(df, columns, b)):
                    found[columns[b.column], rank] = b.low
                else:
                    wanted.setdefault(b, set()).add(rank)
    return found


def _is_double(df: DataFrame, columns: list[str], bracket: Bracket) -> bool:
    return not isinstance(df.schema[columns[bracket.column]].dataType, T.LongType)


def _slotted(df: DataFrame, columns: list[str], brackets: list[Bracket]) -> DataFrame:
    """(slot, value, whole) of the rows of the brackets, slot being the number of theirs.
    Brackets of one column may overlap: a row is given once for each that holds it. All of a
    row's slots are made from it at once."""
    slots = []
    for i, b in enumerate(brackets):
        column = F.col(columns[b.column])
        value = column.cast("double")
        whole = isinstance(df.schema[columns[b.column]].dataType, T.IntegralType)
        exact = (column if whole else F.lit(None)).cast("bigint")
        fields = [F.lit(i).alias("slot"), value.alias("value"), exact.alias("whole")]
        slots.append(F.when(b.condition(value), F.struct(*fields)))
    return df.select(F.inline(F.array(*slots))).filter(F.col("slot").isNotNull())


def _cell(cuts: list[list[float]]) -> Column:
    """Twice the cuts of its slot below the value, and one more if it is a cut. The cuts are
    looked up as data: a comparison for each cut of each slot would outgrow what the JVM compiles."""
    most = max(map(len, cuts))
    # NaN is above every value.
    filled = [F.array(*[F.lit(c) for c in (*of, *[math.nan] * (most - len(of)))]) for of in cuts]
    own, value, cell = F.get(F.array(*filled), F.col("slot")), F.col("value"), F.lit(0)
    for i in range(most):
        cell = cell + (F.get(own, i) < value).cast("int") + (F.get(own, i) <= value).cast("int")
    return cell


def _counted(df, columns, wanted) -> list[tuple[Bracket, int, float]]:
    """The values at the wanted ranks of brackets of few rows, from their value counts."""
    brackets = list(wanted)
    # Doubles that stand for several whole numbers are told apart by these.
    groups = (
        _slotted(df, columns, brackets)
        .groupBy("slot", "value", "whole")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A window over the values of a bracket, FEW rows at most.
    before = Window.partitionBy("slot").orderBy("value", "whole").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = groups.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    inside = F.lit(False)
    for i, b in enumerate(brackets):
        for rank in wanted[b]:
            at = rank - b.below
            inside |= (F.col("slot") == i) & F.lit(at).between(
                F.col("before"), F.col("before") + F.col("n") - 1
            )
    result = []
    for row in placed.filter(inside).collect():
        b = brackets[row.slot]
        for rank in wanted[b]:
            if row.before <= rank - b.below < row.before + row.n:
                value = row.value if row.whole is None else row.whole
                result.append((b, rank, value))
    return result


def _narrowed(df, columns, wanted) -> dict[Bracket, set[int]]:
    """One step: cuts around each wanted rank, from a sketch, and then the rows of each cell."""
    brackets = list(wanted)
    asked = []
    for b in brackets:
        shares = set()
        for rank in wanted[b]:
            share = (rank - b.below + 0.5) / b.rows
            shares |= {max(share - MARGIN, 0.0), min(share + MARGIN, 1.0)}
        asked.append(sorted(shares))
    every = sorted({share for shares in asked for share in shares})
    sketch = _slotted(df, columns, brackets).groupBy("slot").agg(
        F.kll_sketch_agg_double("value", F.lit(SKETCH)).alias("sketch")
    )
    asked_for = F.array(*[F.lit(share) for share in every])
    bounds = sketch.select("slot", F.kll_sketch_get_quantile_double("sketch", asked_for).alias("at"))
    found = {row.slot: dict(zip(every, row["at"])) for row in bounds.collect()}
    cuts = [sorted({found[i][share] for share in shares}) for i, shares in enumerate(asked)]
    cells = _slotted(df, columns, brackets).groupBy("slot", _cell(cuts).alias("cell")).count().collect()
    counted = {(row.slot, row.cell): row["count"] for row in cells}
    result: dict[Bracket, set[int]] = {}
    for i, b in enumerate(brackets):
        parts, below, low = [], b.below, b.low
        for cell in range(2 * len(cuts[i]) + 1):
            rows, cut = counted.get((i, cell), 0), cuts[i][min(cell // 2, len(cuts[i]) - 1)]
            # Neighbouring doubles bound the open stretches between the cuts.
            if cell % 2:
                part = Bracket(b.column, cut, cut, below, rows)
                low = math.nextafter(cut, math.inf)
            elif cell == 2 * len(cuts[i]):
                part = Bracket(b.column, low, b.high, below, rows)
            else:
                part = Bracket(b.column, low, math.nextafter(cut, -math.inf), below, rows)
            parts.append(part)
            below += rows
        for rank in wanted[b]:
            part = next(p for p in parts if p.holds(rank))
            result.setdefault(part, set()).add(rank)
    return result
