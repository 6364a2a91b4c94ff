"""Batch tables: read, overwrite with an observed row count, and their status.

A Parquet table that is replaced whole keeps its versions in folders of their own, and a
small file names the one that counts. That file is put in place in one step, so a reader finds
the old version or the new one, whole, and never neither.
"""

from __future__ import annotations

import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.errors import TableNotFoundError

# Columns a layer's newest event may be read from, the first that fits.
NEWEST_BY = ["event_timestamp", "kafka_timestamp", "hour", "last_activity", "ts"]
TIMES = (T.TimestampType(), T.TimestampNTZType())

# Name of the file that names the live version, and of the folder that holds the versions.
LIVE = "_live"
VERSIONS = "_versions"

# Name of the folders of an indexed table.
BUCKET = "key_bucket"

# What Spark names a path that holds nothing to read.
ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def _file_system(spark: SparkSession, path: str):
    """Hadoop's view of ``path`` and of the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


def is_delta(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` keeps a Delta log. Only the log tells live files from stale
    ones, so such a path must never be read as plain Parquet."""
    log, files = _file_system(spark, f"{path}/_delta_log")
    return files.exists(log)


def _live(spark: SparkSession, path: str) -> str | None:
    """The name of the live version, None for a table that lies in ``path`` itself."""
    pointer, files = _file_system(spark, f"{path}/{LIVE}")
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def live_folder(spark: SparkSession, path: str) -> str:
    """Where the files of the table at ``path`` lie now. A reader that has it keeps its version:
    that stays until two later ones are published."""
    version = _live(spark, path)
    return path if version is None else f"{path}/{VERSIONS}/{version}"


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """The live snapshot of a table: its Delta version, else all its Parquet files
    together. Lazy: nothing is counted.

    The schema of Parquet files is taken from one of them. For a table whose files
    differ, give the ``schema``, or ask to merge theirs, which opens every file.
    """
    fmt = fmt or ("delta" if is_delta(spark, path) else "parquet")
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "delta":
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    try:
        return reader.load(path if fmt == "delta" else live_folder(spark, path))
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            raise TableNotFoundError(path) from error
        raise


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """All rows of several tables; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | list[str] | None = None,
    only_touched: bool = False,
    sort_by: list[str] | None = None,
    **options: str,
) -> dict[str, int]:
    """Replace the table at ``path``, schema included, and return ``rows_written``,
    counted on the way: no second job counts.

    Spark empties the target of a file overwrite before it writes. So files are written as
    a new version beside the live one, which one small file then puts in its place: a failed
    job leaves the table as it was, a table may be rebuilt from itself, and readers see one version
    or the other. The version before the live one stays for those who still read it.
    Delta does this by its log.

    ``partition_by`` lays the files out by columns; rows are rebalanced on them first,
    so a partition gets few files and a large one is still written by many tasks.
    ``only_touched`` then replaces just the partitions ``df`` holds, in the live version:
    each partition at once, but one after another. ``sort_by`` sorts the rows of each file, and
    ``options`` go to the writer.
    """
    if only_touched and not partition_by:
        raise ValueError("only_touched needs partition_by: there is nothing to leave untouched")
    keys = [partition_by] if isinstance(partition_by, str) else partition_by or []
    counting = Observation()
    counted = df.observe(counting, F.count(F.lit(1)).alias("rows_written"))
    if keys:
        counted = counted.hint("rebalance", *keys)
    if sort_by:
        counted = counted.sortWithinPartitions(*keys, *sort_by)
    writer = counted.write.format(fmt).mode("overwrite").options(**options)
    if keys:
        writer = writer.partitionBy(*keys)
    spark = df.sparkSession
    if only_touched:
        target = path if fmt == "delta" else live_folder(spark, path)
        writer.option("partitionOverwriteMode", "dynamic").save(target)
    elif fmt == "delta":
        writer.option("overwriteSchema", "true").save(path)
    else:
        version = uuid.uuid4().hex
        writer.save(f"{path}/{VERSIONS}/{version}")
        _publish(spark, path, version)
    return {"rows_written": observed(counting, "rows_written")}


def observed(observation: Observation, name: str) -> int:
    """A count taken while an action ran. Spark leaves the counting out where it sees, at run
    time, that there are no rows to count."""
    try:
        return observation.get[name]
    except Py4JJavaError:
        return 0


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the live one, and drop all but it and the one before. Files that lay in
    ``path`` itself, from before it had versions, go as well."""
    before = _live(spark, path)
    named = f"{path}/{VERSIONS}/{version}.name"
    source, files = _file_system(spark, named)
    stream = files.create(source, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    rename = getattr(hadoop, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    target = hadoop.Path(f"{path}/{LIVE}")
    context = hadoop.FileContext.getFileContext(
        files.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(files.makeQualified(source), files.makeQualified(target), overwrite)
    kept = {LIVE, VERSIONS, version, before}
    for folder in (path, f"{path}/{VERSIONS}"):
        for found in files.listStatus(hadoop.Path(folder)):
            name = found.getPath().getName()
            if name not in kept and not name.endswith(".crc"):
                files.delete(found.getPath(), True)


def _bucket(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_indexed(
    df: DataFrame, path: str, key: str, fmt: str = "parquet", buckets: int = 64
) -> dict[str, int]:
    """Replace a table laid out for :func:`look_up`: one folder for each hash bucket of ``key``, its
    files sorted by key and with Bloom filters of it."""
    bucketed = df.withColumn(BUCKET, _bucket(key, buckets))
    bloom = {f"parquet.bloom.filter.enabled#{key}": "true"}
    return write_table(bucketed, path, fmt, partition_by=BUCKET, sort_by=[key], **bloom)


def look_up(
    table: DataFrame, key: str, wanted: DataFrame, buckets: int = 64
) -> DataFrame:
    """The rows of an indexed ``table`` whose ``key`` occurs in ``wanted``, a table with that column.

    Only the buckets of wanted keys are listed and read, and of their files only row groups in whose
    range a key can lie; the keys themselves are joined, however many there are. At most ``buckets``
    numbers come to the driver. Without a wanted key there are no rows.
    """
    kind = table.schema[key].dataType
    keys = wanted.select(F.col(key).cast(kind).alias(key)).filter(F.col(key).isNotNull()).distinct()
    by_bucket = keys.groupBy(_bucket(key, buckets).alias(BUCKET)).agg(
        F.min(key).alias("least"), F.max(key).alias("most")
    )
    found = by_bucket.collect()
    if not found:
        return table.limit(0).drop(BUCKET)
    within = F.col(key).between(min(r.least for r in found), max(r.most for r in found))
    touched = table.filter(F.col(BUCKET).isin([r[BUCKET] for r in found]) & within)
    return touched.join(keys, key, "left_semi").drop(BUCKET)


def layer_status(
    spark: SparkSession, layers: dict[str, str], fmt: str | None = None
) -> DataFrame:
    """One row per layer: whether it exists, files, rows, last change and, where the
    layer has a time column, its newest event."""
    empty = spark.createDataFrame([(name,) for name in layers], "layer string")
    present = []
    for name, path in layers.items():
        try:
            table = read_table(spark, path, fmt)
            folder = None if is_delta(spark, path) else live_folder(spark, path)
            present.append(_status(name, table, folder))
        except TableNotFoundError:
            continue
    if not present:
        present = [
            spark.createDataFrame(
                [], "layer string, files bigint, rows bigint, last_modified timestamp, newest timestamp"
            )
        ]
    found = union_tables(present)
    return (
        empty.join(found, "layer", "left")
        .withColumn("exists", F.col("files").isNotNull())
        .orderBy("layer")
    )


def _status(name: str, table: DataFrame, folder: str | None) -> DataFrame:
    """Files come from a listing and rows from the files' footers: no column is read for
    them. Of a Delta table (no ``folder``), whose folder also holds stale files, the live ones
    are asked for. Times kept as text are passed over: parsing them would cost more than the rest."""
    typed = [c for c in NEWEST_BY if c in table.columns and table.schema[c].dataType in TIMES]
    rows = table.agg(F.count(F.lit(1))).scalar()
    if folder is None:
        listed = table.select("_metadata.*").select(
            F.col("file_path").alias("path"), F.col("file_modification_time").alias("at")
        ).distinct()
    else:
        reader = table.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        listed = reader.option("recursiveFileLookup", "true").load(folder)
        listed = listed.select("path", F.col("modificationTime").alias("at"))
    newest = F.lit(None)
    if typed:
        file = listed.agg(F.max_by("path", F.struct("at", "path")).alias("path")).first().path
        newest = _newest(table, typed[0], file)
    files = listed.agg(F.count(F.lit(1)).alias("files"), F.max("at").alias("last_modified"))
    return files.select(
        F.lit(name).alias("layer"),
        "files",
        rows.alias("rows"),
        "last_modified",
        newest.cast(T.TimestampType()).alias("newest"),
    )


def _newest(table: DataFrame, column: str, file: str | None) -> Column:
    """The largest time. That of the file written last is taken first: of the others only
    row groups are read whose statistics reach beyond it."""
    kind = table.schema[column].dataType
    if file is None:
        return F.lit(None)
    least = F.lit("0001-01-01").cast(kind)
    own = table.sparkSession.read.schema(table.select(column).schema).parquet(file)
    known = own.agg(F.coalesce(F.max(column), least)).scalar()
    later = table.filter(F.col(column) > known).agg(F.max(column)).scalar()
    return F.nullif(F.greatest(known, later), least)
