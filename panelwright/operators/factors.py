"""Factor extraction on a p x p matrix and factor scores for every row."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.operators import correlation, features
from panelwright.operators.cleaning import complete_cases


def velicer_map(matrix: np.ndarray) -> int:
    """Number of components that leaves the least average squared partial correlation."""
    p = len(matrix)
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    loadings = vectors[:, order] * np.sqrt(np.clip(values[order], 0, None))
    scores = []
    for m in range(1, p - 1):
        rest = matrix - loadings[:, :m] @ loadings[:, :m].T
        d = np.sqrt(np.clip(np.diag(rest), 1e-12, None))
        partial = rest / np.outer(d, d)
        scores.append(((partial**2).sum() - p) / (p * (p - 1)))
    return int(np.argmin(scores)) + 1 if scores else 1


def scree(spark: SparkSession, matrix: np.ndarray) -> DataFrame:
    values = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    rows = [(i + 1, float(v), float(v / len(matrix))) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "component int, eigenvalue double, share double")


def usable_factors(p: int, wanted: int) -> int:
    """One factor where the model would have no degrees of freedom."""
    free = p * (p - 1) / 2 - p * wanted + wanted * (wanted - 1) / 2
    return 1 if free <= 0 else wanted


def maximum_likelihood(matrix: np.ndarray, k: int, rounds: int = 2000, tol: float = 1e-8) -> np.ndarray:
    """Unrotated loadings by expectation-maximisation on the correlation matrix."""
    p = len(matrix)
    values, vectors = np.linalg.eigh(matrix)
    top = np.argsort(values)[::-1][:k]
    load = vectors[:, top] * np.sqrt(np.clip(values[top], 1e-6, None)) * 0.8
    unique = np.clip(1 - (load**2).sum(1), 0.05, None)
    for _ in range(rounds):
        beta = load.T @ np.linalg.inv(load @ load.T + np.diag(unique))
        second = np.eye(k) - beta @ load + beta @ matrix @ beta.T
        new = matrix @ beta.T @ np.linalg.inv(second)
        unique = np.clip(np.diag(matrix - new @ beta @ matrix), 0.005, None)
        moved = np.abs(new - load).max()
        load = new
        if moved < tol:
            break
    sign = np.where(load.sum(0) < 0, -1.0, 1.0)
    order = np.argsort((load**2).sum(0))[::-1]
    return (load * sign)[:, order].reshape(p, k)


def oblimin(load: np.ndarray, starts: int = 6, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Oblique quartimin rotation; pattern and factor correlations.

    The identity can be a saddle point of the criterion, so some random orthogonal
    starts are tried as well and the smallest criterion wins.
    """
    k = load.shape[1]
    if k == 1:
        return load, np.eye(1)
    rng = np.random.default_rng(seed)
    begin = [np.eye(k)] + [np.linalg.qr(rng.normal(size=(k, k)))[0] for _ in range(starts)]
    _, pattern, turn = min((_rotate(load, t) for t in begin), key=lambda found: found[0])
    sign = np.where(pattern.sum(0) < 0, -1.0, 1.0)
    return pattern * sign, (turn.T @ turn) * np.outer(sign, sign)


def _quartimin(pattern: np.ndarray) -> tuple[float, np.ndarray]:
    square = pattern**2
    others = square.sum(1, keepdims=True) - square
    return float((square * others).sum() / 4), pattern * others


def to_target(load: np.ndarray, free: np.ndarray, starts: int = 40, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Oblique rotation towards a partly specified target; pattern and factor correlations.

    ``free`` marks the loadings that may take any value; the squares of all others are made as small as possible. A
    factor thus keeps its place on every run. Its sign makes the sum of its free loadings positive. Several fixed
    starts are tried, of which the one with the least criterion is taken.
    """
    k = load.shape[1]
    fixed = ~np.asarray(free, bool)

    def value(pattern: np.ndarray) -> tuple[float, np.ndarray]:
        rest = pattern * fixed
        return float((rest**2).sum() / 2), rest

    rng = np.random.default_rng(seed)
    left, _, right = np.linalg.svd(load.T @ np.asarray(free, float))
    begin = [left @ right] + [np.linalg.qr(rng.normal(size=(k, k)))[0] for _ in range(starts)]
    _, pattern, turn = min((_rotate(load, t, value) for t in begin), key=lambda found: found[0])
    sign = np.where((pattern * ~fixed).sum(0) < 0, -1.0, 1.0)
    return pattern * sign, (turn.T @ turn) * np.outer(sign, sign)


def _rotate(
    load: np.ndarray,
    turn: np.ndarray,
    value: Callable[[np.ndarray], tuple[float, np.ndarray]] = _quartimin,
    rounds: int = 500,
    tol: float = 1e-6,
) -> tuple[float, np.ndarray, np.ndarray]:
    """Gradient projection from one start."""
    step = 1.0
    pattern = load @ np.linalg.inv(turn).T
    f, gradient = value(pattern)
    for _ in range(rounds):
        slope = -(pattern.T @ gradient @ np.linalg.inv(turn)).T
        tangent = slope - turn * (turn * slope).sum(0)
        size = np.sqrt((tangent**2).sum())
        if size < tol:
            break
        step *= 2
        for _ in range(20):
            trial = turn - step * tangent
            trial = trial / np.sqrt((trial**2).sum(0))
            trial_pattern = load @ np.linalg.inv(trial).T
            trial_f, trial_gradient = value(trial_pattern)
            if trial_f < f - 0.5 * size**2 * step:
                break
            step /= 2
        else:
            # no step lowers the criterion any more
            break
        turn, pattern, f, gradient = trial, trial_pattern, trial_f, trial_gradient
    return f, pattern, turn


@dataclass(frozen=True)
class FactorModel:
    columns: tuple[str, ...]
    loadings: np.ndarray
    factor_correlations: np.ndarray
    weights: np.ndarray
    correlations: np.ndarray
    names: tuple[str, ...] = ()

    @property
    def communalities(self) -> np.ndarray:
        return ((self.loadings @ self.factor_correlations) * self.loadings).sum(1)


def fit(matrix: np.ndarray, columns: Sequence[str], k: int | None = None) -> FactorModel:
    """ML extraction, oblimin rotation and regression weights for the scores.

    A matrix estimated pair by pair is made positive definite first."""
    matrix = correlation.positive_definite(matrix).matrix
    k = usable_factors(len(columns), k or velicer_map(matrix))
    loadings, phi = oblimin(maximum_likelihood(matrix, k))
    return _model(matrix, columns, loadings, phi, [f"F{i + 1}" for i in range(k)])


def fit_blocks(matrix: np.ndarray, columns: Sequence[str], blocks: Mapping[str, Sequence[str]]) -> FactorModel:
    """As many factors as there are blocks of columns, each rotated towards its own block and named after it."""
    outside = set(columns) ^ {n for block in blocks.values() for n in block}
    if outside:
        raise ValueError(f"columns and blocks differ in {sorted(outside)}")
    if usable_factors(len(columns), len(blocks)) < len(blocks):
        raise ValueError(f"{len(columns)} columns are too few for {len(blocks)} factors")
    matrix = correlation.positive_definite(matrix).matrix
    free = np.array([[n in block for block in blocks.values()] for n in columns])
    loadings, phi = to_target(maximum_likelihood(matrix, len(blocks)), free)
    return _model(matrix, columns, loadings, phi, list(blocks))


def _model(
    matrix: np.ndarray, columns: Sequence[str], loadings: np.ndarray, phi: np.ndarray, names: Sequence[str]
) -> FactorModel:
    weights = np.linalg.solve(matrix, loadings @ phi)
    return FactorModel(tuple(columns), loadings, phi, weights, matrix, tuple(names))


def loadings_table(spark: SparkSession, model: FactorModel, cut: float = 0.30) -> DataFrame:
    rows = []
    for i, name in enumerate(model.columns):
        row, h2 = model.loadings[i], float(model.communalities[i])
        cross = int((np.abs(row) > cut).sum() > 1)
        rows += [
            (name, j + 1, float(v), h2, int(h2 < cut), cross) for j, v in enumerate(row)
        ]
    return spark.createDataFrame(
        rows,
        "column string, factor int, loading double, communality double, low_communality int, cross_loading int",
    )


def scores(df: DataFrame, model: FactorModel, names: Sequence[str], key: str) -> DataFrame:
    """Factor scores of every complete row as a projection of its z-scores."""
    rows = complete_cases(df, model.columns)
    spread = features.moments(rows, model.columns)
    z = {n: features.scaled(n, *spread[n]) for n in model.columns}

    def score(j: int):
        return reduce(
            lambda a, b: a + b,
            [z[n] * F.lit(float(model.weights[i, j])) for i, n in enumerate(model.columns)],
        )

    return rows.select(key, *[score(j).alias(n) for j, n in enumerate(names)])


def composite_index(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Mean of the z-scores of complete rows, and the same rescaled to 0..1."""
    rows = complete_cases(df, columns)
    stats = [F.struct(F.avg(n).alias("m"), F.stddev_samp(n).alias("s")).alias(n) for n in columns]
    row = rows.agg(*stats).first()
    z = [(F.col(n) - row[n]["m"]) / F.lit(row[n]["s"] or 1.0) for n in columns]
    indexed = rows.select(key, (reduce(lambda a, b: a + b, z) / len(columns)).alias("indice"))
    ends = indexed.agg(F.struct(F.min("indice").alias("lo"), F.max("indice").alias("hi"))).scalar()
    return indexed.withColumn("indice_01", (F.col("indice") - ends["lo"]) / (ends["hi"] - ends["lo"]))


def context_columns(df: DataFrame, vintages: Sequence[str]) -> DataFrame:
    """Standardised origination year, quarter number, ordered vintage and state number."""
    from panelwright.functions import columns as c

    year = df.agg(
        F.struct(F.avg("origination_year").alias("m"), F.stddev_samp("origination_year").alias("s"))
    ).scalar()
    # the number of states is a fixed, small list
    states = df.select("property_state").where("property_state IS NOT NULL").distinct()
    numbered = states.select(
        F.col("property_state").alias("_state"),
        F.row_number().over(W.orderBy("property_state")).alias("state_ord"),
    )
    return (
        df.withColumns(
            {
                "orig_year_std": (F.col("origination_year") - year["m"]) / year["s"],
                "acq_q_num": F.substring("acquisition_quarter", 6, 1).cast("int"),
                "vintage_ord": c.ordinal("vintage_bin", list(vintages)),
            }
        )
        .join(numbered, F.col("property_state") == F.col("_state"), "left")
        .drop("_state")
    )


def latent_space(blocks: Sequence[DataFrame], covariates: DataFrame, key: str) -> DataFrame:
    """Loans complete in every block, with all factor columns and the covariates."""
    joined = reduce(lambda a, b: a.join(b, key), blocks)
    return joined.join(covariates, key, "left")
