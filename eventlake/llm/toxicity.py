"""Toxicity scores: a linear classifier over character n-grams, scaled by naive Bayes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from eventlake.llm.common import settle
from eventlake.llm.labelled import labelled_sample, sampled_texts

#: n-grams of these many bytes are hashed into 2**BITS buckets.
LENGTHS = (3, 4, 5, 6)
BITS = 20
#: Bytes hashed at once.
BLOCK = 1 << 20
#: Texts whose n-grams a worker holds at once; they take more memory than the texts.
AT_ONCE = 100


def grams_of(text: str | None) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text, repeats included, block by block.

    The text is lower-cased, white space becomes one space, and a space stands before
    and after. An empty or null text has none.
    """
    words = (text or "").lower().split()
    if not words:
        return
    raw = np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "replace"), np.uint8)
    overlap = max(LENGTHS) - 1
    for i in range(0, max(len(raw) - overlap, 1), BLOCK):
        part = raw[i : i + BLOCK + overlap].astype(np.uint32)
        state = part
        for n in range(2, max(LENGTHS) + 1):
            if len(part) < n:
                break
            state = state[:-1] * np.uint32(0x01000193) + part[n - 1 :]
            if n in LENGTHS:
                yield (state * np.uint32(0x9E3779B1) + np.uint32(n)) >> np.uint32(32 - BITS)


def distinct_grams(text: str | None) -> np.ndarray:
    found = list(grams_of(text))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)


@dataclass(frozen=True)
class ToxicityModel:
    """A weight per bucket, counted once for each bucket a text has."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        hits = [part[self.weights[part] != 0] for part in grams_of(text)]
        total = self.weights[np.unique(np.concatenate(hits))].sum() if hits else 0.0
        return float(1.0 / (1.0 + np.exp(-np.clip(self.intercept + total, -500, 500))))

    def column(self, text: Column) -> Column:
        """The score of a text column."""

        def scored(texts: pd.Series) -> pd.Series:
            return pd.Series([self.score(t) for t in texts], dtype="float64")

        return F.pandas_udf(scored, DoubleType())(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 3,
    fold: int = 1,
    at_most: int = 20_000,
    buckets: int = 8192,
    least_evidence: float = 4.0,
    regularization: float = 1e-3,
) -> ToxicityModel:
    """Learn from at most ``at_most`` labelled documents outside the held-out fold.

    A bucket's feature is present or not, times its log-count ratio: the log of how much
    more often toxic documents have it. The ``buckets`` buckets with the clearest
    difference between the classes (in standard errors, ``least_evidence`` at least) go
    into a logistic regression. Labelled ids that have no document are ignored. With no
    labelled document the score is 0.5, with one class only it is that class's label.
    """
    sample = labelled_sample(labels, label, folds, fold, at_most)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), AT_ONCE):
                part = batch.iloc[i : i + AT_ONCE]
                grams = [distinct_grams(t).astype(np.int32) for t in part["text"]]
                yield pd.DataFrame({"label": part["label"].to_numpy(), "grams": grams})

    rows = sampled_texts(docs, sample).select("text", "label")
    rows = settle(rows.mapInPandas(features, "label int, grams array<int>"), "grams")
    toxic, total = rows.agg(F.sum("label"), F.count("label")).first()
    weights = np.zeros(1 << BITS, np.float32)
    if not total or toxic in (0, total):
        prior = (toxic or 0) / total if total else 0.5
        return ToxicityModel(weights, {0.0: -500.0, 1.0: 500.0}.get(prior, 0.0))
    chosen, ratios = _clearest(rows, toxic, total, buckets, least_evidence)
    if not len(chosen):
        return ToxicityModel(weights, float(np.log(toxic / (total - toxic))))
    rank = np.full(1 << BITS, -1, np.int32)
    rank[chosen] = np.arange(len(chosen))

    def present(grams) -> object:
        own = rank[np.array(grams, np.int64)] if len(grams) else np.empty(0, np.int32)
        own = np.sort(own[own >= 0])
        return Vectors.sparse(len(ratios), own.tolist(), ratios[own].tolist())

    vectors = rows.select(
        F.col("label").cast("double").alias("label"),
        F.udf(present, VectorUDT(), useArrow=False)("grams").alias("features"),
    ).cache()
    learner = LogisticRegression(regParam=regularization, standardization=False, maxIter=60)
    model = learner.fit(vectors)
    vectors.unpersist()
    weights[chosen] = (model.coefficients.toArray() * ratios).astype(np.float32)
    return ToxicityModel(weights, float(model.intercept))


def _clearest(
    rows: DataFrame, toxic: int, total: int, buckets: int, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that tell the classes apart best, and their log-count ratios."""
    counts = (
        rows.select("label", F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(F.sum("label").alias("toxic"), F.count("label").alias("docs"))
    )
    clean = total - toxic
    share = F.col("docs") / total
    apart = F.col("toxic") / toxic - (F.col("docs") - F.col("toxic")) / clean
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean) + 1e-12)
    best = (
        counts.withColumn("evidence", F.abs(apart) / error)
        .filter(F.col("evidence") >= least)
        .orderBy(F.desc("evidence"), "gram")
        .limit(buckets)
        .toPandas()
        .sort_values("gram")
    )
    in_toxic = (best["toxic"].to_numpy() + 1.0) / (toxic + 2.0)
    in_clean = (best["docs"].to_numpy() - best["toxic"].to_numpy() + 1.0) / (clean + 2.0)
    return best["gram"].to_numpy(np.int64), np.log(in_toxic / in_clean)
