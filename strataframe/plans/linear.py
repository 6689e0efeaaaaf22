"""Ridge and lasso from second moments: two aggregates over the rows, whatever the penalty.

The rows are read for means and labels, then for one Gram matrix.  What the driver sees is the
square of the number of features (numbers and labels of descriptors), never rows.  Ridge solves
the normal equations by Cholesky; lasso descends along coordinates of the same matrix and proves
the result by its optimality conditions.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Moments(NamedTuple):
    """Means, deviations and products of scaled features, and of these with the target."""

    numeric: tuple
    labels: dict  # descriptor -> its labels, in order
    target: str
    n: int
    mean: np.ndarray
    scale: np.ndarray  # 0 for a constant feature
    gram: np.ndarray  # sums of products of scaled, centred features
    cross: np.ndarray  # their sums of products with the centred target
    target_mean: float

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *[f"{c}_{x}" for c, own in self.labels.items() for x in own]]


class Line(NamedTuple):
    """Coefficients of scaled features and the intercept."""

    moments: Moments
    coefficients: np.ndarray

    @property
    def intercept(self) -> float:
        return self.moments.target_mean

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction``: one expression, an unseen label counts as none."""
        m, d = self.moments, len(self.moments.numeric)
        weight = np.divide(self.coefficients, m.scale, out=np.zeros(len(m.scale)), where=m.scale > 0)
        terms: list[Column] = [F.lit(float(m.target_mean - weight[d:] @ m.mean[d:]))]
        terms += [(F.col(c).cast("double") - F.lit(float(m.mean[i]))) * F.lit(float(weight[i])) for i, c in enumerate(m.numeric)]
        at = d
        for c, own in m.labels.items():
            if own:
                pairs = [F.lit(x) for pair in zip(own, map(float, weight[at : at + len(own)])) for x in pair]
                terms.append(F.coalesce(F.element_at(F.create_map(*pairs), F.col(c)), F.lit(0.0)))
            at += len(own)
        return df.withColumn("prediction", reduce(add, terms))


def moments(df: DataFrame, numeric, target: str, categorical=()) -> Moments:
    """Eager: one aggregate for means and labels, one for products.

    A row gives the products of its numbers (less their means, so that nothing cancels) and of the
    one label that it has per descriptor, and these are summed map-side; rows with a null take no part.
    """
    y = F.col(target).cast("double")
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical, y.alias("_y")).na.drop()
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("y"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(numeric)], *[F.array_sort(F.collect_set(c)).alias(f"l{i}") for i, c in enumerate(categorical)]).first()
    if not found.n:
        raise ValueError("no row to fit")
    labels = {c: list(found[f"l{i}"]) for i, c in enumerate(categorical)}
    centre, size = [found[f"m{i}"] for i in range(len(numeric))], len(numeric) + sum(map(len, labels.values())) + 1
    entry = lambda i, v: F.struct(i.cast("int").alias("i"), v.cast("double").alias("v"))
    entries = [entry(F.lit(i), F.col(c) - F.lit(centre[i])) for i, c in enumerate(numeric)]
    at = len(numeric)
    for c, own in labels.items():
        entries.append(entry(F.array_position(F.array(*map(F.lit, own)), F.col(c)) + F.lit(at - 1), F.lit(1.0)))
        at += len(own)
    entries.append(entry(F.lit(size - 1), F.col("_y") - F.lit(found.y)))
    entries.append(entry(F.lit(size), F.lit(1.0)))  # products with one are sums
    both = rows.select(F.array(*entries).alias("e")).select(F.explode("e").alias("a"), "e").select("a", F.explode("e").alias("b"))
    sums = both.filter("a.i <= b.i").groupBy(F.col("a.i").alias("i"), F.col("b.i").alias("j")).agg(F.sum(F.col("a.v") * F.col("b.v")).alias("s"))
    products = np.zeros((size + 1, size + 1))
    for r in sums.collect():
        products[r.i, r.j] = products[r.j, r.i] = r.s
    n, mean = found.n, products[size, :size] / found.n
    centred = products[:size, :size] - n * np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(centred)[:-1], 0) / max(n - 1, 1))
    known = np.array([*centre, *[0.0] * (size - 1 - len(centre))]) + mean[:-1]
    spread[spread <= 1e-12 * np.maximum(1, np.abs(known))] = 0
    unit = np.divide(1, spread, out=np.zeros(len(spread)), where=spread > 0)
    return Moments(tuple(numeric), labels, target, n, known, spread, centred[:-1, :-1] * np.outer(unit, unit), centred[:-1, -1] * unit, found.y)


def ridge(m: Moments, alpha: float = 1.0) -> Line:
    """Least squares plus ``alpha`` times the squared coefficients."""
    lower = np.linalg.cholesky(m.gram + alpha * np.eye(len(m.gram)))
    return Line(m, np.linalg.solve(lower.T, np.linalg.solve(lower, m.cross)))


def lasso(m: Moments, alpha: float = 1.0, sweeps: int = 100_000, tolerance: float = 1e-10) -> Line:
    """Half the mean squared error plus ``alpha`` times the absolute coefficients; proven by :func:`optimality`."""
    beta, held = np.zeros(len(m.gram)), np.diag(m.gram)
    for _ in range(sweeps):
        moved = 0.0
        for k in np.flatnonzero(held > 0):
            rest = m.cross[k] - m.gram[k] @ beta + held[k] * beta[k]
            new = np.sign(rest) * max(abs(rest) - alpha * m.n, 0.0) / held[k]
            moved, beta[k] = max(moved, abs(new - beta[k])), new
        if moved <= tolerance * max(1.0, np.abs(beta).max(initial=0)):
            break
    line = Line(m, beta)
    if optimality(line, alpha).max(initial=0) > 1e-6 * max(1.0, np.abs(m.cross).max(initial=0) / m.n):
        raise ArithmeticError("coordinate descent did not reach the optimum")
    return line


def optimality(line: Line, alpha: float) -> np.ndarray:
    """How far each coefficient is from optimal: the slope of the error must be ``alpha`` against an active coefficient's sign, at most ``alpha`` elsewhere."""
    m, beta = line.moments, line.coefficients
    slope = (m.cross - m.gram @ beta) / m.n
    active = beta != 0
    return np.where(active, np.abs(slope - alpha * np.sign(beta)), np.maximum(np.abs(slope) - alpha, 0.0)) * (m.scale > 0)


SOLVERS = {"ridge": ridge, "lasso": lasso}


def fitted(df: DataFrame, numeric, target: str, categorical=(), alpha: float = 1.0) -> dict[str, Line]:
    """Both models from the same moments."""
    own = moments(df, numeric, target, categorical)
    return {kind: solve(own, alpha) for kind, solve in SOLVERS.items()}
