"""Gaussian mixtures with full covariances, all starts of all numbers of components in one pass a round."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.operators.clustering import _array, _distances2, _matrix, _spread_starts, _summed, generalisation

#: Numbers that a task holds at a time while it rates rows by components.
CELLS = 4_000_000
#: Added to every variance, as a share of the mean variance of the columns.
FLOOR = 1e-6


@dataclass(frozen=True)
class Mixture:
    """``log_likelihood`` is that of the rows it was fitted on; ``settled`` is false if the rounds ran out."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = math.nan
    rounds: int = 0
    settled: bool = False

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def d(self) -> int:
        return self.means.shape[1]


class _Rater:
    """Log densities of rows under the components of several mixtures, from one matrix product."""

    def __init__(self, models: Sequence[Mixture]) -> None:
        roots = np.linalg.cholesky(np.concatenate([m.covariances for m in models]))
        self.d = roots.shape[1]
        inverse = np.linalg.inv(roots)
        means = np.concatenate([m.means for m in models])
        self.whiten = inverse.reshape(-1, self.d).T
        self.offset = np.einsum("cij,cj->ci", inverse, means).ravel()
        logdet = 2 * np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(1)
        weights = np.concatenate([m.weights for m in models])
        self.base = np.log(np.maximum(weights, 1e-300)) - 0.5 * (self.d * math.log(2 * math.pi) + logdet)
        self.ends = np.cumsum([m.k for m in models])
        self.step = max(1, CELLS // (len(weights) * self.d))

    def slices(self, x: np.ndarray):
        """Rows, their posteriors and the log-likelihoods of a row by model, a slice of rows at a time."""
        for at in range(0, len(x), self.step):
            rows = x[at : at + self.step]
            gap = (rows @ self.whiten - self.offset).reshape(len(rows), -1, self.d)
            logs = self.base - 0.5 * (gap**2).sum(2)
            likelihoods = []
            for end, start in zip(self.ends, [0, *self.ends[:-1]], strict=True):
                own = logs[:, start:end]
                top = own.max(1, keepdims=True)
                whole = top + np.log(np.exp(own - top).sum(1, keepdims=True))
                own -= whole
                likelihoods.append(whole[:, 0])
            yield rows, np.exp(logs), np.stack(likelihoods, axis=1)


def _moments(rows: np.ndarray, share: np.ndarray, upper: tuple) -> np.ndarray:
    """Per component the weight, sums and sums of products of the rows."""
    return share.T @ np.hstack([np.ones((len(rows), 1)), rows, rows[:, upper[0]] * rows[:, upper[1]]])


def _gaussians(found: np.ndarray, n: float, before: Mixture, floor: float, upper: tuple) -> Mixture:
    """Parameters from the moments of the components; a component without rows stays where it was."""
    d = before.d
    mass = found[:, 0]
    some = mass > 1e-8
    safe = np.where(some, mass, 1.0)
    means = found[:, 1 : d + 1] / safe[:, None]
    products = np.zeros((len(mass), d, d))
    products[:, upper[0], upper[1]] = products[:, upper[1], upper[0]] = found[:, d + 1 :] / safe[:, None]
    covariances = products - means[:, :, None] * means[:, None, :] + floor * np.eye(d)
    return Mixture(
        mass / n,
        np.where(some[:, None], means, before.means),
        np.where(some[:, None, None], covariances, before.covariances),
    )


def fit_mixtures(
    df: DataFrame,
    ks: Sequence[int],
    column: str = "features",
    starts: int = 10,
    rounds: int = 300,
    seed: int = 42,
    tol: float = 1e-4,
) -> dict[int, Mixture]:
    """For each K the best of several starts by likelihood, by expectation-maximisation.

    A round is one pass over kept rows that serves every start of every K still moving: a task sends one row with the
    moments of all components, and these rows are added in groups. A fit ends when its mean log-likelihood grows by less
    than ``tol``. Moments are taken around the mean of all rows. Null vectors take no part; no rows at all is an error.
    """
    rows = df.select(_array(column).alias("x"), F.rand(seed).alias("_at")).where("x IS NOT NULL").persist()
    try:
        first = _spread_starts(rows, ks, starts, seed)
        d = next(iter(first.values())).shape[1]
        upper = np.triu_indices(d)
        whole = _summed(rows, lambda x: np.concatenate([[len(x)], x.sum(0)]))
        n, centre = whole[0], whole[1:] / whole[0]
        centred = {c: m - centre for c, m in first.items()}
        names = list(centred)

        def nearest(x: np.ndarray) -> np.ndarray:
            total = 0
            step = max(1, CELLS // (d * (d + 3)))
            for at in range(0, len(x), step):
                part = x[at : at + step] - centre
                share = np.hstack([np.eye(len(m))[_distances2(part, m).argmin(1)] for m in centred.values()])
                total = total + _moments(part, np.hstack([np.ones((len(part), 1)), share]), upper)
            return total.ravel()

        found = _summed(rows, nearest).reshape(-1, 1 + d + len(upper[0]))
        spread = _gaussians(found[:1], n, Mixture(np.ones(1), np.zeros((1, d)), np.eye(d)[None]), 0.0, upper).covariances[0]
        floor = max(FLOOR * float(np.trace(spread)) / d, 1e-12)
        spread = spread + floor * np.eye(d)
        state, at = {}, 1
        for c, m in centred.items():
            before = Mixture(np.full(len(m), 1 / len(m)), m, np.repeat(spread[None], len(m), 0))
            state[c] = _gaussians(found[at : at + len(m)], n, before, floor, upper)
            at += len(m)
        done: dict[tuple[int, int], Mixture] = {}
        likelihood = dict.fromkeys(names, -math.inf)
        for i in range(rounds + 1):
            active = [c for c in names if c not in done]
            if not active:
                break
            rater = _Rater([state[c] for c in active])

            def expect(x: np.ndarray, rater=rater) -> np.ndarray:
                moments, logs = 0, 0
                for part, share, own in rater.slices(x - centre):
                    moments, logs = moments + _moments(part, share, upper), logs + own.sum(0)
                return np.concatenate([moments.ravel(), logs])

            size = sum(len(state[c].weights) for c in active) * (1 + d + len(upper[0]))
            sums = _summed(rows, expect, size)
            logs, table = sums[-len(active) :], sums[: -len(active)].reshape(-1, 1 + d + len(upper[0]))
            for c, log, start, end in zip(active, logs, [0, *rater.ends[:-1]], rater.ends, strict=True):
                settled = (log - likelihood[c]) / n < tol
                likelihood[c] = float(log)
                if settled or i == rounds:
                    m = state[c]
                    done[c] = Mixture(m.weights, m.means + centre, m.covariances, float(log), i, bool(settled))
                else:
                    state[c] = _gaussians(table[start:end], n, state[c], floor, upper)
    finally:
        rows.unpersist()
    return {k: max((done[c] for c in names if c[0] == k), key=lambda m: m.log_likelihood) for k in ks}


def gaussian_mixture(
    df: DataFrame, k: int, column: str = "features", starts: int = 10, rounds: int = 300, seed: int = 42
) -> Mixture:
    """Best of several starts by likelihood."""
    return fit_mixtures(df, [k], column, starts, rounds, seed)[k]


def posteriors(df: DataFrame, model: Mixture, alias: str = "posterior", column: str = "features") -> DataFrame:
    """Adds the array of the components' posteriors; null for a null vector."""
    rater = _Rater([model])

    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        some = values.notna()
        found = iter(np.concatenate([p for _, p, _ in rater.slices(_matrix(values[some]))]) if some.any() else [])
        return pd.Series([next(found) if x else None for x in some], dtype=object)

    return df.withColumn(alias, run(_array(column)))


def mixture_labels(df: DataFrame, model: Mixture, alias: str, column: str = "features") -> DataFrame:
    """Label and uncertainty (one minus the largest posterior); the first label on ties."""
    rated = posteriors(df, model, "_posterior", column)
    top = F.array_max("_posterior")
    label = (F.array_position("_posterior", top) - 1).cast("int")
    return rated.withColumns({alias: label, "uncertainty": 1 - top}).drop("_posterior")


def log_likelihood(df: DataFrame, model: Mixture, column: str = "features") -> float:
    """Log-likelihood of rows, also of such as the mixture was not fitted on; 0 without rows."""
    rater = _Rater([model])
    rows = df.select(_array(column).alias("x")).where("x IS NOT NULL")
    found = _summed(rows, lambda x: np.array([sum(own.sum() for _, _, own in rater.slices(x))]))
    return float(np.sum(found))


def mixture_parameters(k: int, d: int) -> int:
    return k - 1 + k * d + k * d * (d + 1) // 2


def bic(log_likelihood: float, k: int, d: int, n: int) -> float:
    return mixture_parameters(k, d) * math.log(n) - 2 * log_likelihood


def aic(log_likelihood: float, k: int, d: int) -> float:
    return 2 * mixture_parameters(k, d) - 2 * log_likelihood


def mixture_sweep(
    train: DataFrame,
    validation: DataFrame,
    ks: Sequence[int],
    column: str = "features",
    starts: int = 5,
    rounds: int = 100,
    seed: int = 42,
) -> DataFrame:
    """AIC and BIC of the best mixture of each K on the training rows, and BIC on the validation rows."""
    n_train, n_val = train.count(), validation.count()
    rows = []
    for k, model in fit_mixtures(train, ks, column, starts, rounds, seed).items():
        fitted, held_out = model.log_likelihood, log_likelihood(validation, model, column)
        rows.append((k, aic(fitted, k, model.d), bic(fitted, k, model.d, n_train), bic(held_out, k, model.d, n_val)))
    schema = "k int, aic double, bic_train double, bic_validation double"
    return generalisation(train.sparkSession.createDataFrame(rows, schema))
