"""Cross-validation of linear models from fold sums.

One aggregation adds up, for each fold, the products of all features and the
target. Everything that cross-validation asks for follows from these sums on
the driver, whose size is folds x features²: the training sums of a fold are the
total minus the fold's own, a ridge strength is added to their diagonal, and
the held-out r² of the solution is again a form in the fold's sums. So a grid of
any number of strengths, the refit on all rows included, costs one pass over
the data and no fit job.

Columns are centred and scaled by constants first (any constants give the
same result; those of the training rows keep the sums well conditioned).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .split import ScalerParams, fit_standard_scaler


@dataclass
class FoldSums:
    """Counts, sums and product sums by fold; the target is the last column."""

    features: tuple[str, ...]
    target: str
    folds: tuple
    counts: np.ndarray
    sums: np.ndarray
    products: np.ndarray
    centre: np.ndarray
    scale: np.ndarray


@dataclass
class RidgeModel:
    """``intercept + weights · features`` in the units of the data."""

    features: tuple[str, ...]
    weights: np.ndarray
    intercept: float
    alpha: float

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """L19 as one expression; missing, NaN and infinite features count as 0."""
        total = F.lit(float(self.intercept))
        for name, w in zip(self.features, self.weights):
            total = total + _clean(name) * F.lit(float(w))
        return df.withColumn(out, total)


@dataclass
class RidgeSearch:
    """Scores by (alpha, fold), their summary by alpha, and the model of the best one refitted on all rows."""

    scores: DataFrame
    summary: DataFrame
    best: RidgeModel


def _clean(name: str):
    x = F.col(name).cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x)


def fold_sums(df: DataFrame, features: Sequence[str], target: str, fold: str = "fold",
              scaler: ScalerParams | None = None) -> FoldSums:
    """One pass over ``df``; rows without target or fold are left out, missing features count as 0."""
    rows = df.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")) & F.col(fold).isNotNull())
    rows = rows.select(F.col(fold).alias("__fold"), *[_clean(c).alias(c) for c in features],
                       F.col(target).cast("double").alias("__y"))
    params = dict(scaler) if scaler and set(features) <= set(scaler) else None
    known = fit_standard_scaler(rows, ["__y"] if params else [*features, "__y"])
    params = {**(params or {}), **known}
    names = [*features, "__y"]
    centre = np.array([params[c][0] for c in names])
    scale = np.array([params[c][1] for c in names])
    z = rows.select("__fold", *[((F.col(c) - float(m)) / float(s)).alias(f"z{i}")
                                for i, (c, m, s) in enumerate(zip(names, centre, scale))])
    p = len(names)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    got = z.groupBy("__fold").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"z{i}") for i in range(p)]).alias("s"),
        F.array(*[F.sum(F.col(f"z{i}") * F.col(f"z{j}")) for i, j in pairs]).alias("q")).collect()
    got = sorted(got, key=lambda r: r["__fold"])
    products = np.zeros((len(got), p, p))
    for r, out in zip(got, products):
        for (i, j), v in zip(pairs, r["q"]):
            out[i, j] = out[j, i] = v
    return FoldSums(tuple(features), target, tuple(r["__fold"] for r in got), np.array([r["n"] for r in got], float),
                    np.array([r["s"] for r in got], float).reshape(len(got), p), products, centre, scale)


def _solve(n: float, s: np.ndarray, q: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Weights and intercept on scaled columns; the intercept is not penalised, collinear columns share."""
    mean = s / max(n, 1.0)
    cov = q - n * np.outer(mean, mean)
    a, b = cov[:-1, :-1] + alpha * np.eye(len(s) - 1), cov[:-1, -1]
    w = np.linalg.lstsq(a, b, rcond=1e-10)[0]
    return w, float(mean[-1] - mean[:-1] @ w)


def _r2(n: float, s: np.ndarray, q: np.ndarray, w: np.ndarray, b: float) -> float:
    """r² of given rows from their sums; rows of one value have none."""
    v = np.append(-w, 1.0)  # residual = v · (z, y) - b
    left = v @ q @ v - 2 * b * (v @ s) + n * b * b
    all_ = q[-1, -1] - s[-1] ** 2 / n
    return float(1 - left / all_) if all_ > 0 else float("nan")


def ridge_scores(sums: FoldSums, alphas: Sequence[float]) -> list[tuple[float, int, float]]:
    """(alpha, fold, r²): every fold scored by the model of all other folds."""
    n, s, q = sums.counts.sum(), sums.sums.sum(axis=0), sums.products.sum(axis=0)
    out = []
    for alpha in alphas:
        for f, fold in enumerate(sums.folds):
            w, b = _solve(n - sums.counts[f], s - sums.sums[f], q - sums.products[f], alpha)
            out.append((float(alpha), fold, _r2(sums.counts[f], sums.sums[f], sums.products[f], w, b)))
    return out


def refit(sums: FoldSums, alpha: float) -> RidgeModel:
    """The model of all rows."""
    w, b = _solve(sums.counts.sum(), sums.sums.sum(axis=0), sums.products.sum(axis=0), alpha)
    weights = w * sums.scale[-1] / sums.scale[:-1]
    return RidgeModel(sums.features, weights, float(sums.centre[-1] + b * sums.scale[-1] - weights @ sums.centre[:-1]), alpha)


def ridge_search(spark: SparkSession, sums: FoldSums, alphas: Sequence[float] = (0.0, 1.0, 10.0, 100.0)) -> RidgeSearch:
    """Score a grid of ridge strengths; the best has the highest mean r² (ties: the smaller strength)."""
    scores = ridge_scores(sums, alphas)
    by_alpha = {float(a): [r for x, _, r in scores if x == float(a)] for a in alphas}
    summary = [(a, float(np.mean(r)), float(np.std(r))) for a, r in by_alpha.items()]
    best = min(summary, key=lambda x: (np.isnan(x[1]), -x[1], x[0]))[0]
    return RidgeSearch(spark.createDataFrame(scores, "alpha double, fold int, r2 double"),
                       spark.createDataFrame([(*x, x[0] == best) for x in summary],
                                             "alpha double, cv_mean double, cv_std double, is_best boolean"),
                       refit(sums, best))
