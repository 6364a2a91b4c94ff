"""Which labelled rows a classifier learns from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document is in the fold that no classifier learns from; without an id
    it is."""
    remainder = F.crc32(doc_id.cast("long").cast("string")) % folds
    return F.coalesce(remainder == fold, F.lit(True))


def labelled_sample(
    labels: DataFrame, label: str, folds: int, fold: int, at_most: int
) -> DataFrame:
    """(sample_id, label 0 or 1) of ``at_most`` labelled documents outside the fold.

    The sample is a fixed one, of the smallest id hashes. A document labelled more than
    once counts once, as 1 if any row says so; null ids and labels are left out. Its
    bound makes it small enough to broadcast.
    """
    usable = labels.select(
        F.col("doc_id").cast("long").alias("sample_id"), F.col(label).cast("int").alias("label")
    ).filter(~held_out(F.col("doc_id"), folds, fold) & F.col("label").isin(0, 1))
    once = usable.groupBy("sample_id").agg(F.max("label").alias("label"))
    return once.orderBy(F.xxhash64("sample_id"), "sample_id").limit(at_most)


def sampled_texts(
    docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(sample_id, text, label) of the sampled documents; the texts are not shuffled."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("sample_id"), F.col(text_col).alias("text")
    )
    return texts.join(F.broadcast(sample), "sample_id").select("sample_id", "text", "label")
