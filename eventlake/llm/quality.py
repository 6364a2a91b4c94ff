"""Quality scores: kernel ridge regression over document statistics, calibrated."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from eventlake.llm.common import settle
from eventlake.llm.labelled import labelled_sample, sampled_texts

#: Byte classes whose shares of a text are statistics.
CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\n",
    b".,;:",
    b"!?",
    b"#*$%&",
    b"|<>",
    b"@/\\=_~^+{}[]()",
    b"'\"-",
]
STATISTICS = len(CLASSES) + 9
#: Standardised statistics beyond this many deviations count as this many.
WIDEST = 4.0

_CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _i, _members in enumerate(CLASSES):
    _CLASS_OF[list(_members)] = _i


def statistics_of(text: str | None) -> list[float]:
    """What the classifier knows of a text: shares of byte classes, and word and line
    statistics. An empty or null text gives zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    words = (text or "").split()
    if not words:
        return [0.0] * STATISTICS
    histogram = np.bincount(raw, minlength=256)
    shares = np.bincount(_CLASS_OF, histogram, len(CLASSES) + 1)[:-1] / len(raw)
    lines = [line for line in text.split("\n") if line]
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    distinct = len(set(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [
        *shares.tolist(),
        float(np.log1p(n)),
        float(lengths.mean()),
        float(np.log1p(lengths.max())),
        float(lengths.std()),
        distinct / n,
        float(np.log1p(n) - np.log1p(distinct)),
        repeats / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


@dataclass(frozen=True)
class Features:
    """A random map whose inner products approximate a Gaussian kernel."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean, spread, size: int, width: float, seed: int) -> Features:
        random = np.random.default_rng(seed)
        directions = random.normal(0.0, 1.0 / width, (len(mean), size))
        return cls(mean, spread, directions, random.uniform(0.0, 2 * np.pi, size))

    def __call__(self, statistics: np.ndarray) -> np.ndarray:
        """A row of cosines, and a 1, for each row of statistics."""
        scaled = np.clip((statistics - self.mean) / self.spread, -WIDEST, WIDEST)
        cosines = np.cos(scaled @ self.directions + self.phases)
        cosines *= np.sqrt(2.0 / len(self.phases))
        return np.hstack([cosines, np.ones((len(scaled), 1))])


@dataclass(frozen=True)
class QualityModel:
    """Ridge weights over the features, and the steps that turn a fit into a score."""

    features: Features | None
    weights: np.ndarray
    fits: np.ndarray
    scores: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.features is None:
            return np.full(len(texts), self.scores[0])
        rows = np.array([statistics_of(t) for t in texts], float).reshape(-1, STATISTICS)
        return np.interp(self.features(rows) @ self.weights, self.fits, self.scores)

    def column(self, text: Column) -> Column:
        """The score of a text column."""

        def scored(texts: pd.Series) -> pd.Series:
            return pd.Series(self.score(texts.tolist()), dtype="float64")

        return F.pandas_udf(scored, DoubleType())(text)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 5,
    fold: int = 0,
    at_most: int = 50_000,
    size: int = 256,
    width: float = 4.0,
    ridge: float = 1e-3,
    seed: int = 7,
) -> QualityModel:
    """Learn from at most ``at_most`` labelled documents outside the held-out fold.

    Three quarters of them give the ridge weights: each partition sums its own normal
    equations, of ``size`` squared figures whatever its rows, and the sums are added.
    The rest calibrates the fits by isotonic regression. Labelled ids that have no
    document are ignored. With no labelled document the score is 0.5, with one class
    only it is that class's label.
    """
    sample = labelled_sample(labels, label, folds, fold, at_most)
    statistics = F.udf(statistics_of, "array<double>", useArrow=False)
    rows = sampled_texts(docs, sample).select(
        (F.pmod(F.xxhash64("sample_id"), F.lit(4)) == 0).alias("calibrates"),
        F.col("label").cast("double").alias("label"),
        statistics("text").alias("statistics"),
    )
    rows = settle(rows, "statistics")
    classes = rows.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if classes[1] is None or classes[1] == classes[2]:
        constant = 0.5 if classes[1] is None else float(classes[1])
        return QualityModel(None, np.zeros(0), np.zeros(1), np.array([constant]))
    columns = [F.col("statistics")[i] for i in range(STATISTICS)]
    moments = rows.agg(*map(F.avg, columns), *map(F.stddev_pop, columns)).first()
    mean, spread = np.array(moments[:STATISTICS]), np.array(moments[STATISTICS:])
    features = Features.draw(mean, np.where(spread > 1e-9, spread, 1.0), size, width, seed)
    weights = _ridge_weights(rows.filter("NOT calibrates"), features, ridge)
    fits, scores = _calibration(rows, features, weights)
    return QualityModel(features, weights, fits, scores)


def _ridge_weights(rows: DataFrame, features: Features, ridge: float) -> np.ndarray:
    size = len(features.phases) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = features(np.array(batch.column("statistics").to_pylist()).reshape(-1, STATISTICS))
            y = batch.column("label").to_numpy()
            total += x.T @ np.column_stack([x, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
            names=["i", "sums"],
        )

    parts = rows.select("statistics", "label").mapInArrow(partial, "i int, sums array<double>")
    cells = parts.select("i", F.posexplode("sums").alias("j", "value"))
    total = np.zeros((size, size + 1))
    summed = cells.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    total[summed["i"], summed["j"]] = summed["value"]
    left = total[:, :size] + ridge * max(total[-1, size - 1], 1.0) * np.eye(size)
    return np.linalg.solve(left, total[:, size])


def _calibration(
    rows: DataFrame, features: Features, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    def fitted(statistics: pd.Series) -> pd.Series:
        table = np.array(statistics.tolist(), float).reshape(-1, STATISTICS)
        return pd.Series(features(table) @ weights)

    fit_of = F.pandas_udf(fitted, DoubleType())
    held = rows.filter("calibrates").select("label", fit_of("statistics").alias("features"))
    if held.isEmpty():
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    model = IsotonicRegression(labelCol="label", featuresCol="features").fit(held)
    scores = np.clip(model.predictions.toArray(), 0.0, 1.0)
    return model.boundaries.toArray(), scores
