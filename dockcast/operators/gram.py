"""Second moments of feature columns in one pass, and the ridge solutions they give.

All targets share one aggregate: the count, the sums and the sums of products.  Its
size depends on the columns only, so the driver solves a small symmetric system and
the fitted model is a plain column expression.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment_pairs(xs: Sequence[str], ys: Sequence[str]) -> list[tuple[str, str]]:
    """Pairs whose products are summed: ("1", c) for plain sums, features among themselves, features with targets."""
    xs, ys = list(xs), list(ys)
    return ([("1", c) for c in xs + ys] + [(a, b) for i, a in enumerate(xs) for b in xs[i:]] + [(x, y) for y in ys for x in xs])


def moments(df: DataFrame, xs: Sequence[str], ys: Sequence[str]) -> DataFrame:
    """(a, b, n, mean_product) of every pair: one aggregate over ``df``, whose columns hold no nulls."""
    def value(c: str) -> Column:
        return F.lit(1.0) if c == "1" else F.col(c).cast("double")
    pairs = moment_pairs(xs, ys)
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(value(a) * value(b)).alias(f"m{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col("n"), F.col(f"m{i}").alias("mean_product")) for i, (a, b) in enumerate(pairs)]
    return one.select(F.inline(F.array(*rows)))


def ridge_solutions(table: DataFrame, xs: Sequence[str], ys: Sequence[str], alpha: float = 1.0) -> dict[str, tuple[np.ndarray, float]]:
    """{target: (weights, intercept)} that minimise the summed squared error plus ``alpha`` times the squared weights.

    ``table`` comes from ``moments``; its rows are as many as the pairs.
    """
    got = {(r["a"], r["b"]): r["mean_product"] for r in table.collect()}
    n = table.first()["n"]
    if not n:
        return {y: (np.zeros(len(xs)), 0.0) for y in ys}
    mean = np.array([got["1", x] for x in xs])
    gram = np.array([[got[(a, b) if i <= j else (b, a)] for j, b in enumerate(xs)] for i, a in enumerate(xs)])
    system = n * (gram - np.outer(mean, mean)) + alpha * np.eye(len(xs))
    out = {}
    for y in ys:
        cross = n * (np.array([got[x, y] for x in xs]) - mean * got["1", y])
        w = np.linalg.solve(system, cross)
        out[y] = w, float(got["1", y] - mean @ w)
    return out


def linear(xs: Sequence[str], weights: np.ndarray, intercept: float) -> Column:
    """The model's prediction as a column."""
    out = F.lit(float(intercept))
    for x, w in zip(xs, weights):
        out = out + F.lit(float(w)) * F.col(x).cast("double")
    return out
