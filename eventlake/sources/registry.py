"""Named tables and the SQL surface over them. The language is Spark SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.errors import AmbiguousTableError, EventLakeError, TableNotFoundError
from eventlake.operators import profile
from eventlake.sources.tables import read_table, union_tables

# The first word of a query, and the commands that ask for the schemas.
QUERY_WORDS = ("select", "with")
SCHEMA_WORDS = ("describe", "show")
SCHEMA_QUESTIONS = ("describe", "show tables", "schema")


@dataclass(frozen=True)
class Answer:
    """What was run and what it gave; ``data`` honours the whole query. ``summary`` is
    one row that sizes it up: rows, columns and the percent of missing cells."""

    sql: str
    data: DataFrame
    summary: DataFrame


class TableRegistry:
    """Tables by name, each lazy: nothing is read before a query asks.

    The names are the registry's own. They hide tables and views of the session, and
    no other registry sees them.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark = spark
        self.tables = dict(tables)

    @classmethod
    def load(
        cls, spark: SparkSession, paths: dict[str, str], fmt: str | None = None
    ) -> TableRegistry:
        """Register the tables that exist; absent ones are left out."""
        tables = {}
        for name, path in paths.items():
            try:
                tables[name] = read_table(spark, path, fmt)
            except TableNotFoundError:
                continue
        return cls(spark, tables)

    def resolve(self, name: str) -> str:
        """The registered name meant by ``name``: equal but for case, else the only one
        that contains it."""
        wanted = name.lower()
        same = [t for t in self.tables if t.lower() == wanted]
        if same:
            return same[0]
        close = [t for t in self.tables if wanted in t.lower()]
        if len(close) > 1:
            raise AmbiguousTableError(f"{name}: {', '.join(close)}")
        if not close:
            raise TableNotFoundError(f"{name}; available: {', '.join(self.tables)}")
        return close[0]

    def table(self, name: str) -> DataFrame:
        return self.tables[self.resolve(name)]

    def run_query(self, text: str, n: int | None = None, **names: str) -> DataFrame:
        """Run a SELECT: all its rows, or the first ``n``.

        ``names`` lets the text use partial table names: ``run_query("SELECT * FROM
        {t}", t="revenue")``. The registered tables are put before the text as common
        table expressions, which is what makes their names private.
        """
        query = text.strip().rstrip(";")
        if not names:
            query = query.replace("{", "{{").replace("}", "}}")
        arguments = {key: self.table(name) for key, name in names.items()}
        bound = {f"registered_{i}": name for i, name in enumerate(self.tables)}
        if bound:
            named = ", ".join(f"`{n}` AS (SELECT * FROM {{{key}}})" for key, n in bound.items())
            query = f"WITH {named} SELECT * FROM (\n{query}\n)"
        arguments |= {key: self.tables[name] for key, name in bound.items()}
        result = self.spark.sql(query, **arguments)
        return result if n is None else result.limit(n)

    def schemas(self) -> DataFrame:
        """(table, position, column, type, rows) of every table, counted in one query."""
        return union_tables([self._described(name) for name in self.tables])

    def _described(self, name: str) -> DataFrame:
        columns = [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
            )
            for i, field in enumerate(self.tables[name].schema)
        ]
        rows = self.tables[name].agg(F.count(F.lit(1)).alias("rows"))
        return rows.select(F.lit(name).alias("table"), "rows", F.inline(F.array(*columns)))

    def preview(self, name: str, n: int = 10) -> DataFrame:
        """The first ``n`` rows of a table in the order of its columns."""
        return profile.preview(self.table(name), n)

    def context(self, sample: int = 20) -> dict[str, dict]:
        """What is known of each table, in the same form whatever its size."""
        return {name: profile.table_context(table, sample) for name, table in self.tables.items()}

    def execute(self, text: str, n: int | None = None) -> DataFrame:
        """A SELECT, a DESCRIBE or SHOW (every table's schema), or a text that names a
        table (its rows). ``n`` keeps the first rows only."""
        text = text.strip()
        command = text.split(None, 1)[0].lower() if text else ""
        if command in QUERY_WORDS:
            return self.run_query(text, n)
        if command in SCHEMA_WORDS:
            return self.schemas()
        named = [t for t in self.tables if t.lower() in text.lower()]
        if not named:
            raise TableNotFoundError(
                f"no table named in {text!r}; available: {', '.join(self.tables)}"
            )
        return self.table(named[0]) if n is None else self.preview(named[0], n)

    def answer(self, question: str, n: int | None = None) -> Answer:
        """``sql <query>`` runs the query; a schema command describes the tables."""
        if question.lower().startswith("sql "):
            sql = question[4:].strip()
            data = self.execute(sql, n)
        elif question.strip().lower() in SCHEMA_QUESTIONS:
            sql, data = "", self.schemas()
        else:
            raise EventLakeError("only 'sql <query>' and schema commands are answered")
        return Answer(sql, data, profile.table_profile(data))
