"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventlake.session import scratch_dir


#: Parts that the texts of one id are numbered in: two to the power of this.
PART_BITS = 8


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Later readers neither repeat its work nor depend on the executors that did it. The
    files go when the application ends; asking for a garbage collection lets Spark drop
    the shuffle files of the finished step at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.option("compression", "zstd").parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_units(
    docs: DataFrame, name: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with a number ``name`` for each distinct (id, text), in the order of ids.

    The number is the id itself where every id is set and has one text. Otherwise the
    texts of an id are numbered by their hash, and rows without an id come last. Rows
    that repeat both id and text share a number: they are one document.

    However many rows share an id, or have none: their texts are numbered within parts by
    their hash, and the parts one after another.
    """
    known = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash")
    ).distinct()
    most, nulls, low, high = (
        known.groupBy("id")
        .agg(F.count(F.lit(1)).alias("texts"))
        .agg(F.max("texts"), F.count(F.when(F.isnull("id"), 1)), F.min("id"), F.max("id"))
        .first()
    )
    more = (most or 1) - 1
    if not more and not nulls:
        return docs.withColumn(name, F.col(id_col).cast("long"))
    known = known.withColumn("part", F.shiftright("hash", 64 - PART_BITS))
    parts = known.groupBy("id", "part").agg(F.count(F.lit(1)).alias("texts"))
    earlier = F.sum("texts").over(Window.partitionBy("id").orderBy("part")) - F.col("texts")
    parts = parts.select("id", "part", earlier.alias("before"))
    rank = F.row_number().over(Window.partitionBy("id", "part").orderBy("hash")) - 1
    ranked = known.select(
        F.col("id").alias("own_id"), F.col("part").alias("own_part"), "hash", rank.alias("rank")
    )
    same = F.col("id").eqNullSafe(F.col("own_id")) & (F.col("part") == F.col("own_part"))
    variants = ranked.join(parts, same).select(
        "id", "hash", (F.col("before") + F.col("rank")).alias("variant")
    )
    place = F.coalesce(F.col("id"), F.lit((high or 0) + 1)) - F.lit(low or 0)
    own_id, own_hash = free_name(docs, "unit_id"), free_name(docs, "unit_hash")
    numbered = variants.select(
        F.col("id").alias(own_id),
        F.col("hash").alias(own_hash),
        (place * (more + 1) + F.col("variant")).alias(name),
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own_id)) & (
        F.xxhash64(text_col) == F.col(own_hash)
    )
    return docs.join(numbered, same).drop(own_id, own_hash)


@dataclass(frozen=True)
class Places:
    """Places in a corpus, (unit, offset in the unit's text), as one number in their order."""

    low: int
    width: int
    kind: str

    @classmethod
    def of(cls, docs: DataFrame, unit: str, text_col: str = "text") -> Places:
        """Wide enough for every byte of ``docs``; a decimal where a long is too narrow."""
        low, high, longest = docs.agg(
            F.min(unit), F.max(unit), F.max(F.octet_length(text_col))
        ).first()
        low, high, width = low or 0, high or 0, (longest or 0) + 1
        fits = (high - low + 1) * width < 2**63
        return cls(low, width, "bigint" if fits else "decimal(38,0)")

    def at(self, unit: Column, offset: Column) -> Column:
        before = unit.cast(self.kind) - F.lit(self.low).cast(self.kind)
        return (before * F.lit(self.width).cast(self.kind) + offset).cast(self.kind)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, unless their Python finds it by itself."""
    root = Path(__file__).resolve().parents[2]
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if any(p and Path(p).resolve() == root for p in found):
        return
    context = spark.sparkContext
    if any(name.endswith("/eventlake.zip") for name in context._jsc.sc().listFiles().mkString(" ").split()):
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(), "eventlake"), "zip", root, "eventlake"
    )
    context.addPyFile(archive)
