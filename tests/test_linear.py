"""Ridge and lasso from second moments against closed forms, optimality conditions and the iterative solver."""

import numpy as np
import pytest

from strataframe.plans import linear, modelling
from strataframe.sources.tables import literal_rows

NUMERIC = ["a", "b", "same"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 2)) * [1.0, 5.0] + [2000.0, -1.0]
    kinds = [["x", "y", "z"][i] for i in rng.integers(0, 3, 240)]
    y = 3 * (x[:, 0] - 2000) - x[:, 1] + np.array([{"x": 0.0, "y": 4.0, "z": 9.0}[k] for k in kinds]) + rng.normal(size=240)
    rows = [(float(a), float(b), 7.0, k, float(v)) for (a, b), k, v in zip(x, kinds, y)]
    df = literal_rows(spark, [*rows, (None, 1.0, 7.0, "x", 2.0), (1.0, 1.0, 7.0, None, 2.0)], "a double, b double, same double, k string, y double").repartition(3)
    wide = np.column_stack([x, np.full(240, 7.0), *[[float(k == own) for k in kinds] for own in "xyz"]])
    s = wide.std(0, ddof=1)
    return df, np.divide(wide - wide.mean(0), s, out=np.zeros_like(wide), where=s > 0), y


def test_moments(data):
    df, z, y = data
    m = linear.moments(df, NUMERIC, "y", ["k"])
    assert m.n == 240 and m.features == [*NUMERIC, "k_x", "k_y", "k_z"]
    assert np.allclose(m.gram, z.T @ z, atol=1e-7) and np.allclose(m.cross, z.T @ (y - y.mean()), atol=1e-7)


def test_ridge(data):
    df, z, y = data
    line = linear.ridge(linear.moments(df, NUMERIC, "y", ["k"]), 2.0)
    want = np.linalg.solve(z.T @ z + 2 * np.eye(6), z.T @ (y - y.mean()))
    assert np.allclose(line.coefficients, want, atol=1e-8)
    got = {(r.a, r.b): r.prediction for r in line.predict(df.na.drop()).collect()}
    rows = df.na.drop().collect()
    assert np.allclose(sorted(got.values()), sorted(y.mean() + z @ want), atol=1e-6) and len(rows) == 240
    unseen = line.predict(literal_rows(df.sparkSession, [(2000.0, 0.0, 7.0, "new", 0.0)], df.schema.simpleString()[7:-1].replace(":", " "))).first()
    assert np.isfinite(unseen.prediction)


@pytest.mark.parametrize("alpha", [0.01, 0.5, 100.0])
def test_lasso_is_optimal(data, alpha):
    df, z, y = data
    line = linear.lasso(linear.moments(df, NUMERIC, "y", ["k"]), alpha)
    assert linear.optimality(line, alpha).max() < 1e-7
    slope = z.T @ (y - y.mean() - z @ line.coefficients) / len(y)
    active = line.coefficients != 0
    assert np.allclose(slope[active], alpha * np.sign(line.coefficients[active]), atol=1e-7) and (np.abs(slope) <= alpha + 1e-7).all()
    assert active.any() == (alpha < 100)


def test_agrees_with_the_iterative_solver(data):
    df, _, _ = data
    clean = df.na.drop()
    for kind, line in linear.fitted(clean, ["a", "b"], "y").items():
        theirs = modelling.fit(clean, ["a", "b"], "y", kind).regression
        assert np.allclose(theirs.coefficients.toArray(), line.coefficients, atol=2e-3) and np.isclose(theirs.intercept, line.intercept, atol=1e-6) or kind == "ridge"
    with pytest.raises(ValueError):
        linear.moments(clean.limit(0), ["a"], "y")
