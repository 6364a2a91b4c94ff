"""Purchase-propensity model: split, scale, fit, evaluate, score.

The fit is logistic regression by Newton's method: each step is one aggregate, which gives the
loss, its gradient and its second derivatives. The fitted model is a Spark ML pipeline of SQL
stages, which is saved and loaded like any other.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass
from datetime import datetime, timezone
from fractions import Fraction

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.errors import SingleClassError
from eventlake.operators import quantiles
from eventlake.session import checkpointed
from eventlake.sources import tables

LABEL = schemas.LABEL_COLUMN
HASH_DIGITS = 8  # hexadecimal digits of the hash that places a user in the split


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline, its metrics and the two tables behind them."""

    pipeline: PipelineModel
    metrics: Row
    coefficients: DataFrame
    confusion: DataFrame


def feature_names(features: DataFrame, exclude_leaky: bool = False) -> list[str]:
    """The expected feature columns the table has; missing ones are warned about."""
    expected = [
        c
        for c in schemas.FEATURE_COLUMNS
        if not (exclude_leaky and c in schemas.LEAKY_FEATURES)
    ]
    missing = [c for c in expected if c not in features.columns]
    if missing:
        warnings.warn(f"missing features: {', '.join(missing)}", stacklevel=2)
    return [c for c in expected if c not in missing]


def finite(value: Column) -> Column:
    """``value`` as double; NULL, NaN and the infinities become 0. NaN sorts above every
    number, so one comparison finds them all."""
    number = value.cast("double")
    return F.when(F.abs(number) < math.inf, number).otherwise(F.lit(0.0))


def prepare(features: DataFrame, names: list[str]) -> DataFrame:
    """User id, cleaned features and label."""
    return features.select(
        "user_id", *[finite(F.col(c)).alias(c) for c in names], F.col(LABEL).cast("int")
    )


def hash_place(user: Column, seed: int = 42) -> Column:
    """A number by the hash of seed and id, the same on every run."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), user.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def is_test(features: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> Column:
    """Whether a user belongs to the test set: ``test_fraction`` of each label, rounded
    up, those of the smallest hashes. The cut of each of the two labels is the hash at that
    rank, exact at every size; of users that share it, the smallest ids make up the number."""
    place = hash_place(F.col("user_id"), seed)
    placed = checkpointed(
        features.filter(F.col(LABEL).isin(0, 1)).select(
            F.col(LABEL).alias("label"), "user_id", place.alias("place")
        )
    )
    counts = placed.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()
    test = F.lit(False)
    for label, n in sorted(counts):
        # Fractions are meant as they are written: a fifth of 5 is 1, not a little more.
        wanted = math.ceil(Fraction(str(test_fraction)) * n)
        if wanted == 0:
            continue
        own = placed.filter(F.col("label") == label)
        cut = int(quantiles.value_at_rank(own.select("place"), "place", wanted - 1, n))
        below = own.filter(F.col("place") < cut).count()
        at_cut = own.filter(F.col("place") == cut).orderBy("user_id").limit(wanted - below)
        last = at_cut.agg(F.max("user_id")).first()[0]
        inside = place < cut
        if last is not None:
            inside |= (place == cut) & (F.col("user_id") <= F.lit(last))
        test |= (F.col(LABEL) == label) & inside
    return test


def split(
    features: DataFrame, test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, with the same share of each label."""
    test = is_test(features, test_fraction, seed)
    return features.filter(~test), features.filter(test)


def scaling_measures(names: list[str]) -> list[Column]:
    """Mean and population deviation of each cleaned feature."""
    return [
        measure
        for c in names
        for measure in (
            F.avg(finite(F.col(c))).alias(f"{c}_mean"),
            F.stddev_pop(finite(F.col(c))).alias(f"{c}_std"),
        )
    ]


def _literal(value: float) -> str:
    return f"double('{value!r}')"


def _scaling_stage(names: list[str], stats: Row) -> SQLTransformer:
    """Cleaning and scaling as one SQL projection, so it is saved with the model. A
    feature without variance is only centred."""
    columns = []
    for c in names:
        center, spread = stats[f"{c}_mean"], stats[f"{c}_std"] or 1.0
        value = f"double(`{c}`)"
        clean = f"CASE WHEN abs({value}) < double('Infinity') THEN {value} ELSE 0D END"
        columns.append(f"({clean} - {_literal(center)}) / {_literal(spread)} AS `{c}_scaled`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, the rows it was fitted on, and its numbers for scaled features."""

    pipeline: PipelineModel
    rows: int
    coefficients: dict[str, float]
    intercept: float


def fit(train: DataFrame, names: list[str], c: float = 1.0, max_iter: int = 50) -> Fitted:
    """Fit on feature rows: L2 penalty ``1/c``, classes weighted to equal mass.

    One aggregate gives scaling and weights. The scaled rows are written once, as narrow
    as the model, and read in each of the few steps.
    """
    stats = train.agg(
        *scaling_measures(names),
        F.count_if(F.col(LABEL) == 1).alias("positives"),
        F.count_if(F.col(LABEL) == 0).alias("negatives"),
    ).first()
    positives, negatives = stats.positives, stats.negatives
    rows = positives + negatives
    if positives == 0 or negatives == 0:
        raise SingleClassError(f"labels: {negatives} negative, {positives} positive")
    scaling = _scaling_stage(names, stats)
    weight = F.when(F.col(LABEL) == 1, rows / (2 * positives)).otherwise(rows / (2 * negatives))
    scaled = scaling.transform(train).select(
        *[F.col(f"{name}_scaled").alias(f"z{i}") for i, name in enumerate(names)],
        F.col(LABEL).cast("double").alias("y"),
        weight.alias("w"),
    )
    *slopes, intercept = _newton(checkpointed(scaled), len(names), 1.0 / c, max_iter)
    coefficients = dict(zip(names, slopes))
    stages = _score_stages({f"{name}_scaled": b for name, b in coefficients.items()}, intercept)
    return Fitted(PipelineModel([scaling, *stages]), rows, coefficients, intercept)


def _newton(rows: DataFrame, n: int, penalty: float, max_iter: int, tol: float = 1e-10) -> list:
    """The ``n`` slopes and the intercept that minimise the weighted log loss of (z0 ..., y, w)
    plus half the ``penalty`` times the squared slopes. A step that does not lower
    the loss is halved."""
    z = [F.col(f"z{i}") for i in range(n)] + [F.lit(1.0)]
    pairs = [(i, j) for i in range(n + 1) for j in range(i, n + 1)]
    ridge = np.append(np.full(n, penalty), 0.0)
    beta, step, last = np.zeros(n + 1), np.zeros(n + 1), math.inf
    for _ in range(max_iter):
        score = sum((zi * F.lit(float(b)) for zi, b in zip(z, beta)), F.lit(0.0))
        p = 1 / (1 + F.exp(-F.col("score")))
        terms = rows.withColumn("score", score).select(
            *[f"z{i}" for i in range(n)],
            (F.col("w") * (p - F.col("y"))).alias("slope"),
            (F.col("w") * p * (1 - p)).alias("bend"),
            (F.col("w") * (F.log1p(F.exp(-F.abs("score"))) + F.greatest("score", F.lit(0.0))
                           - F.col("y") * F.col("score"))).alias("loss"),
        )
        found = terms.agg(
            F.sum("loss"),
            *[F.sum(F.col("slope") * zi) for zi in z],
            *[F.sum(F.col("bend") * z[i] * z[j]) for i, j in pairs],
        ).first()
        loss = found[0] + penalty / 2 * float(beta[:-1] @ beta[:-1])
        if loss > last + 1e-12 * abs(last):
            step = step / 2
            beta = beta - step
            continue
        last = loss
        gradient = np.array(found[1 : n + 2]) + ridge * beta
        hessian = np.zeros((n + 1, n + 1))
        for (i, j), value in zip(pairs, found[n + 2 :]):
            hessian[i, j] = hessian[j, i] = value
        step = -np.linalg.solve(hessian + np.diag(ridge), gradient)
        beta = beta + step
        if np.abs(step).max() < tol:
            break
    return beta.tolist()


def _score_stages(weights: dict[str, float], intercept: float) -> list[SQLTransformer]:
    """A linear score of columns, cleaned, and class and probability from it."""
    terms = [_literal(intercept)]
    for name, weight in weights.items():
        value = f"double(`{name}`)"
        clean = f"CASE WHEN abs({value}) < double('Infinity') THEN {value} ELSE 0D END"
        terms.append(f"{clean} * {_literal(weight)}")
    scored = f"SELECT *, {' + '.join(terms)} AS linear_score FROM __THIS__"
    classed = """SELECT *, int(linear_score > 0) AS predicted,
        1 / (1 + exp(-linear_score)) AS purchase_probability FROM __THIS__"""
    return [SQLTransformer(statement=scored), SQLTransformer(statement=classed)]


def predict(pipeline: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` plus ``predicted`` class and ``purchase_probability``."""
    scored = pipeline.transform(features)
    return scored.select(
        *features.columns,
        "predicted",
        "purchase_probability",
        F.col("linear_score").alias("rawPrediction"),
    )


def confusion(predictions: DataFrame) -> DataFrame:
    """All four cells as (label, predicted, n), zero cells kept, from one aggregate."""
    cells = [(label, predicted) for label in (0, 1) for predicted in (0, 1)]
    counted = predictions.agg(
        *[
            F.count_if((F.col(LABEL) == label) & (F.col("predicted") == predicted)).alias(
                f"{label}{predicted}"
            )
            for label, predicted in cells
        ]
    )
    rows = [
        F.struct(
            F.lit(label).alias("label"),
            F.lit(predicted).alias("predicted"),
            F.col(f"{label}{predicted}").alias("n"),
        )
        for label, predicted in cells
    ]
    return counted.select(F.inline(F.array(*rows)))


def classification_metrics(cells: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of a confusion table, 0 where undefined."""

    def cell(label: int, predicted: int) -> Column:
        return F.sum(F.when((F.col("label") == label) & (F.col("predicted") == predicted), F.col("n")))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    tn, fp, fn, tp = cell(0, 0), cell(0, 1), cell(1, 0), cell(1, 1)
    return cells.agg(
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def roc_auc(predictions: DataFrame) -> float:
    """Exact area under the ROC curve. ``numBins=0`` keeps every score; the curve is
    built by a distributed sort."""
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="rawPrediction", labelCol=LABEL, metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(predictions.withColumn(LABEL, F.col(LABEL).cast("double")))


def coefficients(fitted: Fitted, spark: SparkSession) -> DataFrame:
    """(feature, coefficient) of the scaled features, in their order."""
    return spark.createDataFrame(
        list(fitted.coefficients.items()), "feature string, coefficient double"
    )


def most_important(coefficient_table: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` features of largest absolute coefficient."""
    return coefficient_table.orderBy(F.abs("coefficient").desc(), "feature").limit(n)


def train(
    features: DataFrame,
    test_fraction: float = 0.2,
    seed: int = 42,
    exclude_leaky: bool = False,
) -> TrainedModel:
    """Split, fit and evaluate on a feature table (read it from storage: it is scanned
    once for the scaling and again for the fit and each metric)."""
    spark = features.sparkSession
    names = feature_names(features, exclude_leaky)
    used = features.select("user_id", *names, LABEL)
    train_rows, test_rows = split(used, test_fraction, seed)
    fitted = fit(train_rows, names)
    predictions = checkpointed(predict(fitted.pipeline, test_rows))
    cells = confusion(predictions).collect()
    matrix = [[0, 0], [0, 0]]
    for cell in cells:
        matrix[cell.label][cell.predicted] = cell.n
    n_test = sum(map(sum, matrix))
    confusion_table = spark.createDataFrame(cells, "label int, predicted int, n bigint")
    shares = classification_metrics(confusion_table).first().asDict()
    both_classes = all(sum(row) > 0 for row in matrix)
    metrics = Row(
        **shares,
        roc_auc=roc_auc(predictions) if both_classes else 0.0,
        training_date=datetime.now(timezone.utc).isoformat(),
        n_train=fitted.rows,
        n_test=n_test,
        n_features=len(names),
        confusion_matrix=matrix,
        feature_importance=fitted.coefficients,
        feature_names=names,
    )
    return TrainedModel(fitted.pipeline, metrics, coefficients(fitted, spark), confusion_table)


def linear_scores(
    features: DataFrame, weights: dict[str, float], intercept: float = 0.0
) -> DataFrame:
    """``features`` plus ``predicted`` and ``purchase_probability`` of a logistic model of
    given coefficients, as plain expressions: a model from elsewhere needs no file."""
    score = F.lit(intercept)
    for name, weight in weights.items():
        score = score + finite(F.col(name)) * F.lit(weight)
    return features.withColumns(
        {
            "purchase_probability": 1 / (1 + F.exp(-score)),
            "predicted": (score > 0).cast("int"),
        }
    )


def linear_pipeline(weights: dict[str, float], intercept: float = 0.0) -> PipelineModel:
    """The model of :func:`linear_scores` as a pipeline, which can be saved and loaded."""
    return PipelineModel(_score_stages(weights, intercept))


def score_users(
    pipeline: PipelineModel, features: DataFrame, users: DataFrame | list[int] | None = None
) -> DataFrame:
    """Class, confidence in percent and message class for all users, or for some: those of a
    table, which are joined, or a list. ``features`` may be an indexed table, of which only
    the buckets of these users are read."""
    if isinstance(users, list):
        users = features.sparkSession.createDataFrame([(u,) for u in users], "user_id bigint")
    if users is not None and tables.BUCKET in features.columns:
        features = tables.look_up(features, "user_id", users)
    elif users is not None:
        features = features.join(users.select("user_id").distinct(), "user_id", "left_semi")
    return with_messages(predict(pipeline, features))


def with_messages(predictions: DataFrame) -> DataFrame:
    """User, class, confidence in percent and message class of predictions."""
    probability = F.col("purchase_probability")
    # The two message texts.
    return predictions.select(
        "user_id",
        "predicted",
        (F.greatest(probability, 1 - probability) * 100).alias("confidence"),
        F.when(F.col("predicted") == 1, "Likely Purchaser")
        .otherwise("Unlikely Purchaser")
        .alias("message"),
    )
