from datetime import datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventlake.errors import TableNotFoundError
from eventlake.sources import tables


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(5), path) == {"rows_written": 5}
    replaced = spark.range(3).withColumn("x", F.lit("a"))
    assert tables.write_table(replaced, path) == {"rows_written": 3}
    assert rows(tables.read_table(spark, path)) == [(0, "a"), (1, "a"), (2, "a")]


def test_a_table_can_be_replaced_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    tables.write_table(tables.read_table(spark, path).filter("id > 2"), path)
    assert rows(tables.read_table(spark, path)) == [(3,), (4,)]
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["t"]


def test_a_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    failing = spark.range(5).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id"))
    with pytest.raises(PySparkException):
        tables.write_table(failing, path)
    assert tables.read_table(spark, path).count() == 5


def test_partitions_can_be_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(6).select("id", (F.col("id") % 3).cast("int").alias("day"))
    tables.write_table(days, path, partition_by="day")
    changed = spark.createDataFrame([(100, 1)], "id bigint, day int")
    tables.write_table(changed, path, partition_by="day", only_touched=True)
    assert rows(tables.read_table(spark, path)) == [(0, 0), (100, 1), (2, 2), (3, 0), (5, 2)]
    tables.write_table(changed, path, partition_by="day")
    assert rows(tables.read_table(spark, path)) == [(100, 1)]


def test_files_of_different_schemas_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    spark.range(1).withColumn("x", F.lit(1)).write.mode("append").parquet(path)
    merged = tables.read_table(spark, path, merge_schema=True)
    assert rows(merged.select("id", "x")) == [(0, 1), (0, None)]
    declared = tables.read_table(spark, path, schema=merged.schema)
    assert rows(declared.select("id", "x")) == [(0, 1), (0, None)]
    narrow = spark.range(1).select("id")
    together = tables.union_tables([narrow, narrow.withColumn("x", F.lit(1))])
    assert rows(together) == [(0, 1), (0, None)]


def test_missing_tables(spark, tmp_path):
    with pytest.raises(TableNotFoundError):
        tables.read_table(spark, str(tmp_path / "nothing"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(TableNotFoundError):
        tables.read_table(spark, str(tmp_path / "empty"))


def test_a_delta_log_is_never_read_as_parquet(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1).write.parquet(path)
    assert not tables.is_delta(spark, path)
    (tmp_path / "t" / "_delta_log").mkdir()
    (tmp_path / "t" / "_delta_log" / "00000000000000000000.json").write_text("{}")
    assert tables.is_delta(spark, path)
    with pytest.raises(Exception, match="(?i)delta"):
        tables.read_table(spark, path)


def test_layer_status(spark, tmp_path):
    events = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 2),)], "hour timestamp")
    events.repartition(2).write.parquet(str(tmp_path / "gold"))
    spark.range(1).write.parquet(str(tmp_path / "other"))
    layers = {n: str(tmp_path / n) for n in ("gold", "other", "missing")}
    gold, missing, other = tables.layer_status(spark, layers).collect()
    assert (gold.exists, gold.files, gold.rows, gold.newest) == (True, 2, 2, datetime(2024, 1, 2))
    assert gold.last_modified > datetime(2025, 1, 1)
    assert (missing.exists, missing.files) == (False, None)
    assert (other.rows, other.newest) == (1, None)
    nothing = tables.layer_status(spark, {"missing": str(tmp_path / "missing")}).first()
    assert nothing.exists is False


def test_a_reader_finds_a_whole_table_between_any_two_steps(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    seen = []
    writing, publishing = tables._file_system, tables._publish

    def publish(*args):
        seen.append(tables.read_table(spark, path).count())
        monkeypatch.setattr(tables, "_file_system", lambda *a: seen.append(_count(spark, path, writing)) or writing(*a))
        publishing(*args)
        monkeypatch.setattr(tables, "_file_system", writing)
        seen.append(tables.read_table(spark, path).count())

    monkeypatch.setattr(tables, "_publish", publish)
    held = tables.read_table(spark, path)
    tables.write_table(spark.range(9), path)
    assert set(seen) == {5, 9} and seen == sorted(seen)
    assert held.count() == 5 and tables.read_table(spark, path).count() == 9


def _count(spark, path, file_system):
    pointer, files = file_system(spark, f"{path}/{tables.LIVE}")
    stream = files.open(pointer)
    version = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return spark.read.parquet(f"{path}/{tables.VERSIONS}/{version}").count()


@pytest.mark.parametrize("step", ["write", "publish"])
def test_a_crash_leaves_the_live_version(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    real = tables._publish

    def broken(*args):
        if step == "publish":
            raise RuntimeError("broke off")
        return real(*args)

    monkeypatch.setattr(tables, "_publish", broken)
    bad = spark.range(9)
    if step == "write":
        bad = bad.select(F.when(F.col("id") == 8, F.raise_error(F.lit("x"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises((RuntimeError, PySparkException)):
        tables.write_table(bad, path)
    assert rows(tables.read_table(spark, path)) == [(i,) for i in range(5)]
    monkeypatch.setattr(tables, "_publish", real)
    tables.write_table(spark.range(7), path)
    assert tables.read_table(spark, path).count() == 7
    versions = [f for f in (tmp_path / "t" / tables.VERSIONS).iterdir() if f.is_dir()]
    assert len(versions) == 2


def test_files_from_before_versions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    assert tables.read_table(spark, path).count() == 3
    tables.write_table(spark.range(4), path)
    assert tables.read_table(spark, path).count() == 4
    assert {f.name for f in (tmp_path / "t").iterdir() if not f.name.endswith(".crc")} == {tables.LIVE, tables.VERSIONS}


def test_status_reads_footers_and_the_newest_times(spark, tmp_path):
    path = str(tmp_path / "t")
    times = spark.range(1000).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts")
    tables.write_table(times.repartitionByRange(4, "ts"), path)
    table = tables.read_table(spark, path)
    row = tables.layer_status(spark, {"t": path, "none": str(tmp_path / "none")}).collect()
    assert [(r.layer, r.exists, r.files, r.rows) for r in row] == [("none", False, None, None), ("t", True, 4, 1000)]
    assert row[1].newest == datetime(2024, 2, 11, 15)
    status = tables._status("t", table, tables.live_folder(spark, path))
    text = status._jdf.queryExecution().executedPlan().toString()
    read = {part.split(">")[0] for part in text.split("ReadSchema: struct<")[1:]}
    assert read <= {"", "ts:timestamp_ntz", "modificationTime:timestamp"}
    empty = tables._status("e", table.filter("false"), tables.live_folder(spark, path))
    assert empty.first().rows == 0


def test_lookups_read_the_buckets_of_their_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    users = spark.range(1000).selectExpr("id AS user_id", "id * 2 AS x").withColumn("key", F.lit("clash"))
    assert tables.write_indexed(users, path, "user_id", buckets=16) == {"rows_written": 1000}
    table = tables.read_table(spark, path)

    def found(ids):
        wanted = spark.createDataFrame([(i,) for i in ids], "user_id bigint")
        return tables.look_up(table, "user_id", wanted, buckets=16)

    one = found([77])
    assert rows(one.select("user_id", "x")) == [(77, 154)] and one.columns == users.columns
    read = table.filter(F.col(tables.BUCKET) == tables._bucket(F.lit(77).cast("bigint"), 16))
    assert len(read.select("_metadata.file_path").distinct().collect()) == 1
    assert rows(found([5, 5, None, 2000, 999]).select("user_id")) == [(5,), (999,)]
    assert found([]).isEmpty() and found([None]).isEmpty()
    assert found(range(1000)).count() == 1000
