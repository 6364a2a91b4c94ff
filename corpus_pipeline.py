"""From raw documents to packed sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that the next one reads
back from Parquet; all but the last return the columns of ``documents``. Texts that a
stage shortens get a new n_chars; a document whose text is all removed stays, empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import lines, quality, simhash, suffixes
from eventlake.llm.common import settle, ship_package
from eventlake.llm.packing import pack

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the texts of column ``text``."""
    n_chars = F.length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns({"n_chars": n_chars, "text": F.col(text)}).select(*COLUMNS)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more; empty texts score like any other."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, folds=5, fold=0)
    return docs.select(*COLUMNS).filter(model.column(F.col("text")) >= 0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier, exactly or, from 20 characters,
    within two edits."""
    left = lines.without_repeated_lines(docs.select(*COLUMNS), short_repeats=True)
    return _with_text(left, "text")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id.

    Rows without an id stay only where nothing in their group has one. Ids need be neither
    set nor distinct: rows of different groups never stand for each other.
    """
    ship_package(spark)
    return simhash.one_of_each(docs.select(*COLUMNS))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of passages that stand earlier."""
    ship_package(spark)
    return _with_text(suffixes.without_repeats(docs.select(*COLUMNS)), "kept_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens, dealt to sequences of at most 2048."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("simhash near-dedup", simhash_dedup),
    ("suffix-array dedup", suffix_dedup),
    ("packing", packing),
]

#: SQL has no classifier and no tokenizer; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, on ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
