from datetime import datetime

import pytest

from eventlake.errors import AmbiguousTableError, EventLakeError, TableNotFoundError
from eventlake.sources.registry import TableRegistry


@pytest.fixture(scope="module")
def registry(spark):
    hours = [(datetime(2024, 1, 1, h % 24), float(h), h) for h in range(30)]
    revenue = spark.createDataFrame(hours, "hour timestamp, avg_order_value double, n int")
    users = spark.range(3).toDF("user_id")
    return TableRegistry(
        spark, {"revenue_per_hour": revenue, "active_users_per_hour": users, "user_features": users}
    )


def test_names(registry):
    assert registry.resolve("REVENUE_PER_HOUR") == "revenue_per_hour"
    assert registry.resolve("revenue") == "revenue_per_hour"
    with pytest.raises(AmbiguousTableError):
        registry.resolve("per_hour")
    with pytest.raises(TableNotFoundError):
        registry.resolve("nothing")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("SELECT n FROM revenue_per_hour WHERE avg_order_value > 5 ORDER BY n DESC", list(range(29, 5, -1))),
        ("SELECT n FROM Revenue_Per_Hour ORDER BY n LIMIT 20", list(range(20))),
        ("SELECT n FROM revenue_per_hour WHERE n <> 0 ORDER BY n LIMIT 3 OFFSET 1;", [2, 3, 4]),
        ("SELECT n FROM revenue_per_hour ORDER BY n LIMIT ALL", list(range(30))),
        ("SELECT n FROM revenue_per_hour ORDER BY n LIMIT (17)", list(range(17))),
        ("SELECT n FROM revenue_per_hour ORDER BY n -- limit 5", list(range(30))),
        ("WITH x AS (SELECT n FROM revenue_per_hour) SELECT n FROM x ORDER BY n", list(range(30))),
        ("SELECT n FROM revenue_per_hour WHERE '{x}' = concat('{', 'x}') ORDER BY n", list(range(30))),
    ],
)
def test_queries_are_spark_sql(registry, text, expected):
    assert [r.n for r in registry.execute(text).collect()] == expected


def test_limits(registry):
    assert registry.run_query("SELECT * FROM {t}", t="revenue").count() == 30
    assert registry.run_query("SELECT * FROM {t}", n=10, t="revenue").count() == 10
    assert registry.run_query("SELECT * FROM {t} LIMIT 20", n=10, t="revenue").count() == 10
    assert registry.execute("revenue_per_hour").count() == 30
    assert [r.n for r in registry.execute("revenue_per_hour", n=2).collect()] == [0, 24]


def test_names_are_private(spark, registry):
    other = TableRegistry(spark, {"user_features": spark.range(7).toDF("user_id")})
    spark.range(9).createOrReplaceTempView("user_features")
    for lake, rows in ((registry, 3), (other, 7)):
        assert lake.run_query("SELECT * FROM user_features").count() == rows
        assert lake.run_query("SELECT * FROM {x}", x="User_Features").count() == rows
    spark.catalog.dropTempView("user_features")
    assert registry.run_query("SELECT count(*) AS c FROM user_features").first().c == 3


def test_a_bad_condition_is_an_error(registry):
    with pytest.raises(Exception, match="nonsense"):
        registry.execute("SELECT * FROM user_features WHERE nonsense > 1")


def test_commands(registry):
    for command in ("DESCRIBE revenue_per_hour", "show tables"):
        described = registry.execute(command).collect()
        assert ("revenue_per_hour", "n", "int", 30) in [
            (r.table, r.column, r.type, r.rows) for r in described
        ]
    assert registry.execute("please show me user_features").count() == 3
    with pytest.raises(TableNotFoundError):
        registry.execute("hello")
    with pytest.raises(TableNotFoundError):
        registry.execute("")


def test_answers(registry):
    answer = registry.answer("sql SELECT n FROM revenue_per_hour WHERE n > 4 ORDER BY n")
    assert answer.sql.startswith("SELECT") and answer.data.count() == 25
    assert tuple(answer.summary.first()) == (25, 1, 0.0)
    assert registry.answer("schema").data.count() == 5
    with pytest.raises(EventLakeError):
        registry.answer("how is business?")


def test_absent_tables_are_left_out(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    loaded = TableRegistry.load(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert list(loaded.tables) == ["a"]
    context = loaded.context(sample=1)["a"]
    assert context["profile"].first()["rows"] == 2 and context["sample"].count() == 1
