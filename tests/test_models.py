"""Regressions against closed forms."""

import numpy as np
import pytest

from strataframe.plans import modelling as ml
from strataframe.sources.tables import literal_rows


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3)) * [1.0, 5.0, 0.3] + [2.0, -1.0, 0.5]
    y = 4.0 + x @ [2.0, -0.7, 5.0] + rng.normal(size=300)
    df = literal_rows(spark, [(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double").repartition(4)
    scaled = (x - x.mean(0)) / x.std(0, ddof=1)
    return df, scaled, y


def test_ridge_is_the_closed_form(data):
    df, x, y = data
    fitted = ml.fit(df, ["a", "b", "c"], "y", "ridge", alpha=1.0)
    expected = np.linalg.solve(x.T @ x + np.eye(3), x.T @ (y - y.mean()))
    assert np.allclose(fitted.regression.coefficients.toArray(), expected, atol=1e-5)


def test_lasso_satisfies_its_optimality_conditions(data):
    df, x, y = data
    fitted = ml.fit(df, ["a", "b", "c"], "y", "lasso", alpha=1.0)
    beta = fitted.regression.coefficients.toArray()
    gradient = x.T @ (y - y.mean() - x @ beta) / len(y)
    active = np.abs(beta) > 1e-8
    assert np.allclose(gradient[active], np.sign(beta[active]), atol=1e-3) and np.all(np.abs(gradient[~active]) <= 1 + 1e-3)


def test_metrics_and_ranking(spark, data):
    df, _, _ = data
    fitted = ml.fit(df, ["a", "b", "c"], "y", "ridge")
    scored = fitted.predict(df)
    pred, actual = np.array([tuple(r) for r in scored.select("prediction", "y").collect()]).T
    got = ml.metrics(scored, "y").first()
    assert np.isclose(got.r2, 1 - ((actual - pred) ** 2).sum() / ((actual - actual.mean()) ** 2).sum(), atol=1e-3)
    assert np.isclose(got.rmse, np.sqrt(((actual - pred) ** 2).mean()), atol=1e-3)
    ranked = ml.coefficients(fitted, spark, top=2).collect()
    assert len(ranked) == 2 and abs(ranked[0].coefficient) >= abs(ranked[1].coefficient)


def test_one_hot_names_fit_the_vector(spark):
    df = literal_rows(spark, [(i * 1.0, "abc"[i % 3], float(i % 3 == 1) * 5 + i) for i in range(30)], "n double, k string, y double")
    fitted = ml.fit(df, ["n"], "y", "ridge", categorical=["k"])
    assert fitted.features == ["n", "k_a", "k_b", "k_c"] and fitted.regression.coefficients.size == 4


def test_unknown_kind(data):
    with pytest.raises(ValueError):
        ml.fit(data[0], ["a"], "y", "forest")
