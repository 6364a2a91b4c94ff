import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventlake import schemas
from eventlake.errors import ModelQualityError, SingleClassError
from eventlake.operators import model
from eventlake.sources import artifacts

NAMES = ["total_events", "view_count", "cart_count"]


@pytest.fixture(scope="module")
def features(spark):
    """Users whose label depends on two of the three features, and on chance."""
    random = np.random.default_rng(3)
    n = 400
    x = random.normal(size=(n, 3)) * [3.0, 20.0, 1.0] + [10.0, -5.0, 0.0]
    score = (x[:, 0] - 10) / 2 - (x[:, 1] + 5) / 10 + random.normal(size=n) - 0.8
    data = [(i, *map(float, x[i]), int(score[i] > 0)) for i in range(n)]
    columns = ", ".join(f"{c} double" for c in NAMES)
    return spark.createDataFrame(data, f"user_id bigint, {columns}, is_purchaser int").cache()


@pytest.fixture(scope="module")
def trained(features):
    with pytest.warns(UserWarning, match="missing features"):
        return model.train(features)


def newton(x, y, weight, penalty=1.0, steps=50):
    """Minimiser of the weighted log loss plus half the squared coefficients."""
    design = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag([penalty] * x.shape[1] + [0.0])
    beta = np.zeros(design.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ beta))
        gradient = design.T @ (weight * (p - y)) + ridge @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        beta -= np.linalg.solve(hessian, gradient)
    return beta


def test_coefficients_are_those_of_a_direct_solution(features, trained):
    train, _ = model.split(features)
    data = train.toPandas()
    x, y = data[NAMES].to_numpy(), data["is_purchaser"].to_numpy()
    x = (x - x.mean(axis=0)) / x.std(axis=0)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    expected = newton(x, y, weight)
    fitted = model.fit(train, NAMES)
    np.testing.assert_allclose(list(fitted.coefficients.values()), expected[:-1], rtol=1e-8)
    np.testing.assert_allclose(fitted.intercept, expected[-1], rtol=1e-7)
    assert [r.coefficient for r in trained.coefficients.collect()] == pytest.approx(expected[:-1])


def test_separable_classes_are_fitted(spark):
    """Without the penalty there would be no minimum; steps that overshoot are halved."""
    data = [(i, float(i), float(i % 3) * 1e6, 0.0, int(i >= 50)) for i in range(100)]
    columns = ", ".join(f"{c} double" for c in NAMES)
    frame = spark.createDataFrame(data, f"user_id bigint, {columns}, is_purchaser int")
    fitted = model.fit(frame, NAMES, c=100.0)
    scored = model.predict(fitted.pipeline, frame)
    assert scored.filter("predicted <> is_purchaser").isEmpty()
    x = np.array([row[1:4] for row in data])
    x = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    expected = newton(x, np.array([row[4] for row in data]), np.ones(100), 0.01)
    np.testing.assert_allclose(list(fitted.coefficients.values()), expected[:-1], rtol=1e-6, atol=1e-9)


def test_metrics_follow_from_the_predictions(features, trained):
    _, test = model.split(features)
    scored = model.predict(trained.pipeline, test).toPandas()
    y, p = scored["is_purchaser"].to_numpy(), scored["predicted"].to_numpy()
    score = scored["purchase_probability"].to_numpy()
    metrics = trained.metrics
    assert metrics.accuracy == (y == p).mean()
    assert metrics.precision == pytest.approx(((y == 1) & (p == 1)).sum() / (p == 1).sum())
    assert metrics.recall == pytest.approx(((y == 1) & (p == 1)).sum() / (y == 1).sum())
    expected_f1 = 2 * metrics.precision * metrics.recall / (metrics.precision + metrics.recall)
    assert metrics.f1_score == pytest.approx(expected_f1)
    ahead = score[y == 1][:, None] - score[y == 0][None, :]
    assert metrics.roc_auc == pytest.approx((ahead > 0).mean() + (ahead == 0).mean() / 2)
    cells = [[int(((y == a) & (p == b)).sum()) for b in (0, 1)] for a in (0, 1)]
    assert metrics.confusion_matrix == cells
    assert metrics.n_train + metrics.n_test == features.count()
    assert metrics.n_test == len(y) and metrics.n_features == 3


def test_split_is_stable_and_near_its_fraction(spark, features):
    train, test = model.split(features)
    assert train.join(test, "user_id").isEmpty()
    again = model.split(features.repartition(7))[1]
    assert sorted(r.user_id for r in again.collect()) == sorted(r.user_id for r in test.collect())
    users = spark.range(50_000).selectExpr("id AS user_id", "int(id % 50 = 0) AS is_purchaser")
    test = model.split(users)[1]
    share = test.count() / 50_000
    assert 0.19 < test.filter("is_purchaser = 1").count() / 1000 < 0.21
    assert abs(share - 0.2) < 0.01


def test_split_is_exact_beyond_the_sketch(spark):
    """So many users that a sketch of 10,000 is not exact, and hashes that several share."""
    users = spark.range(200_000).selectExpr("id AS user_id", "int(id % 4 = 0) AS is_purchaser")
    placed = users.withColumn("place", model.hash_place(F.col("user_id"))).toPandas()
    wanted = set()
    for _, own in placed.groupby("is_purchaser"):
        wanted |= set(own.sort_values(["place", "user_id"]).user_id[: -(-len(own) // 5)])
    for table in (users, users.repartition(13)):
        train, test = model.split(table)
        assert {r.user_id for r in test.collect()} == wanted
        assert train.count() == 200_000 - len(wanted)


def test_users_of_one_hash_are_told_apart(spark, monkeypatch):
    users = spark.range(60).selectExpr("id AS user_id", "int(id % 2) AS is_purchaser")
    monkeypatch.setattr(model, "hash_place", lambda user, seed=42: F.pmod(user, F.lit(4)).cast("bigint"))
    test = {r.user_id for r in model.split(users)[1].collect()}
    assert test == {0, 4, 8, 12, 16, 20} | {1, 5, 9, 13, 17, 21}


def test_cleaning_of_inputs(spark):
    data = spark.createDataFrame(
        [(1, math.nan, math.inf, None, 1), (2, -math.inf, 2.0, 3.0, 0)],
        "user_id int, total_events double, view_count double, cart_count double, is_purchaser int",
    )
    found = model.prepare(data, NAMES).orderBy("user_id").collect()
    assert [tuple(r) for r in found] == [(1, 0.0, 0.0, 0.0, 1), (2, 0.0, 2.0, 3.0, 0)]


def test_scoring_takes_raw_features_and_some_users(features, trained):
    everyone = model.score_users(trained.pipeline, features)
    assert everyone.count() == features.count()
    assert everyone.filter("confidence < 50 OR confidence > 100").isEmpty()
    two = {r.user_id: r for r in model.score_users(trained.pipeline, features, [3, 5]).collect()}
    assert set(two) == {3, 5}
    for row in two.values():
        assert row.message == ("Likely Purchaser" if row.predicted == 1 else "Unlikely Purchaser")
    broken = features.withColumn("view_count", F.lit(math.nan))
    assert model.score_users(trained.pipeline, broken, [3]).count() == 1


def test_a_reloaded_model_scores_the_same(features, trained, tmp_path):
    path = str(tmp_path / "model")
    artifacts.save_model(trained.pipeline, path)
    artifacts.save_model(trained.pipeline, path)
    loaded = artifacts.load_model(path)
    expected = model.score_users(trained.pipeline, features).orderBy("user_id").collect()
    assert model.score_users(loaded, features).orderBy("user_id").collect() == expected


def test_metrics_history_and_gate(spark, trained, tmp_path):
    path = str(tmp_path / "metrics")
    assert artifacts.read_metrics(spark, path).isEmpty()
    with pytest.raises(ModelQualityError, match="no metrics"):
        artifacts.check_model(spark, path)
    artifacts.write_metrics(spark, trained.metrics, path)
    artifacts.write_metrics(spark, trained.metrics, path)
    assert artifacts.read_metrics(spark, path).count() == 2
    newest = artifacts.check_model(spark, path)
    assert newest.confusion_matrix == trained.metrics.confusion_matrix
    assert newest.feature_importance == pytest.approx(trained.metrics.feature_importance)
    with pytest.raises(ModelQualityError, match="under"):
        artifacts.check_model(spark, path, accuracy=1.01)


def test_one_class_cannot_be_fitted(features):
    with pytest.raises(SingleClassError):
        model.fit(features.filter("is_purchaser = 1"), NAMES)


def test_a_feature_without_variance_is_only_centred(features):
    constant = features.withColumn("cart_count", F.lit(7.0))
    assert model.fit(constant, NAMES).coefficients["cart_count"] == 0.0


def test_undefined_shares_are_zero(spark):
    cells = spark.createDataFrame(
        [(0, 0, 5), (0, 1, 0), (1, 0, 0), (1, 1, 0)], "label int, predicted int, n bigint"
    )
    assert tuple(model.classification_metrics(cells).first()) == (1.0, 0.0, 0.0, 0.0)


def test_leaky_features_can_be_left_out(spark):
    table = spark.createDataFrame(
        [(1, *[0.0] * 15, 0)],
        "user_id int, " + ", ".join(f"{c} double" for c in schemas.FEATURE_COLUMNS) + ", is_purchaser int",
    )
    assert model.feature_names(table) == schemas.FEATURE_COLUMNS
    names = model.feature_names(table, exclude_leaky=True)
    assert "total_purchases" not in names and "total_events" in names


def test_most_important(trained):
    top = model.most_important(trained.coefficients, 2).collect()
    sizes = [abs(r.coefficient) for r in top]
    assert len(top) == 2 and sizes == sorted(sizes, reverse=True)
