"""Low-dimensional representations: PCA, independent components, dense encoders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_vector(df: DataFrame, array: str, alias: str = "features") -> DataFrame:
    return df.withColumn(alias, array_to_vector(F.col(array).cast("array<double>")))


def centred(df: DataFrame, column: str = "features", alias: str = "centred") -> DataFrame:
    scaler = StandardScaler(inputCol=column, outputCol=alias, withMean=True, withStd=False)
    return scaler.fit(df).transform(df)


@dataclass(frozen=True)
class PcaFit:
    components: np.ndarray
    mean: np.ndarray
    explained: np.ndarray


def fit_pca(df: DataFrame, k: int, column: str = "features") -> PcaFit:
    """Components of the centred vectors; the sign of each makes its largest entry positive."""
    mean = df.select(Summarizer.mean(F.col(column))).first()[0].toArray()
    model = PCA(k=k, inputCol=column, outputCol="_z").fit(df)
    pc = model.pc.toArray()
    sign = np.sign(pc[np.abs(pc).argmax(0), range(k)])
    return PcaFit(pc * sign, mean, model.explainedVariance.toArray())


def _per_batch(df: DataFrame, schema: str, compute, columns: Sequence[str]) -> DataFrame:
    """Run a numpy function on (key columns, matrix) batches of the narrowed frame."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield compute(pdf)

    return df.select(*columns).mapInPandas(run, schema)


def project(df: DataFrame, key: str, fit: PcaFit, column: str = "features") -> DataFrame:
    """(key, z0..zk-1): centred vectors on the components, in Arrow batches."""
    k = fit.components.shape[1]
    names = [f"z{i}" for i in range(k)]
    key_type = df.schema[key].dataType.simpleString()
    pc, mean = fit.components, fit.mean

    def compute(pdf: pd.DataFrame) -> pd.DataFrame:
        z = (np.stack(pdf["x"].to_numpy()) - mean) @ pc
        return pd.concat([pdf[[key]].reset_index(drop=True), pd.DataFrame(z, columns=names)], axis=1)

    rows = df.select(key, vector_to_array(column).alias("x"))
    schema = f"{key} {key_type}, " + ", ".join(f"{n} double" for n in names)
    return _per_batch(rows, schema, compute, [key, "x"])


def reconstruct(df: DataFrame, key: str, fit: PcaFit, column: str = "features") -> DataFrame:
    """(key, x, y): the vector and its reconstruction from the components."""
    pc, mean = fit.components, fit.mean
    key_type = df.schema[key].dataType.simpleString()

    def compute(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy())
        y = (x - mean) @ pc @ pc.T + mean
        return pd.DataFrame({key: pdf[key], "x": list(x), "y": list(y)})

    rows = df.select(key, vector_to_array(column).alias("x"))
    return _per_batch(rows, f"{key} {key_type}, x array<double>, y array<double>", compute, [key, "x"])


def reconstruction_quality(pairs: DataFrame) -> DataFrame:
    """Squared correlation per dimension between the columns ``x`` and ``y``."""
    cells = pairs.select(F.posexplode(F.arrays_zip("x", "y")).alias("dim", "cell"))
    r = F.corr("cell.x", "cell.y")
    return cells.groupBy("dim").agg(F.coalesce(r * r, F.lit(0.0)).alias("r2")).orderBy("dim")


def column_quality(df: DataFrame, numeric: dict[str, str], discrete: dict[str, str]) -> DataFrame:
    """r2 of (true, predicted) numeric pairs and accuracy of discrete pairs, one aggregate."""
    cells = [
        F.struct(F.lit(a).alias("column"), F.lit("r2").alias("measure"), (F.corr(a, b) * F.corr(a, b)).alias("value"))
        for a, b in numeric.items()
    ] + [
        F.struct(
            F.lit(a).alias("column"),
            F.lit("accuracy").alias("measure"),
            F.avg(F.col(a).eqNullSafe(F.col(b)).cast("double")).alias("value"),
        )
        for a, b in discrete.items()
    ]
    return df.agg(F.array(*cells).alias("cells")).selectExpr("inline(cells)")


def active_units(df: DataFrame, columns: Sequence[str], above: float = 0.01) -> DataFrame:
    cells = [F.struct(F.lit(n).alias("column"), F.var_pop(n).alias("variance")) for n in columns]
    rows = df.agg(F.array(*cells).alias("cells")).selectExpr("inline(cells)")
    return rows.withColumn("active", (F.col("variance") > above).cast("int"))


# --- dense encoder ----------------------------------------------------------------------


@dataclass(frozen=True)
class Dense:
    """weights (in x out), bias, optional batch-norm scale and shift, optional ReLU."""

    weights: np.ndarray
    bias: np.ndarray
    scale: np.ndarray | None = None
    shift: np.ndarray | None = None
    relu: bool = False

    def __call__(self, x: np.ndarray) -> np.ndarray:
        y = x @ self.weights + self.bias
        if self.scale is not None:
            y = y * self.scale + self.shift
        return np.maximum(y, 0) if self.relu else y


def encode(df: DataFrame, key: str, array: str, layers: Sequence[Dense]) -> DataFrame:
    """Forward pass of given weights, Arrow batch by Arrow batch. The weights travel
    once per executor as a broadcast variable."""
    width = layers[-1].weights.shape[1]
    names = [f"z{i}" for i in range(width)]
    key_type = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(list(layers))

    def compute(pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        z = reduce(lambda acc, layer: layer(acc), shared.value, x)
        return pd.concat([pdf[[key]].reset_index(drop=True), pd.DataFrame(z, columns=names)], axis=1)

    rows = df.select(key, F.col(array).cast("array<double>").alias("x"))
    schema = f"{key} {key_type}, " + ", ".join(f"{n} double" for n in names)
    return _per_batch(rows, schema, compute, [key, "x"])


# --- independent components ---------------------------------------------------------------


@dataclass(frozen=True)
class IcaFit:
    unmixing: np.ndarray
    mean: np.ndarray
    mixing: np.ndarray
    rounds: int


def _symmetric(w: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(w @ w.T)
    return vectors @ np.diag(1 / np.sqrt(values)) @ vectors.T @ w


def fit_icas(
    df: DataFrame,
    numbers: Sequence[int],
    column: str = "features",
    seed: int = 42,
    rounds: int = 200,
    tol: float = 1e-4,
) -> dict[int, IcaFit]:
    """FastICA (log-cosh, all components together) on PCA-whitened vectors, for several numbers of components.

    The vectors are whitened with the largest number; a smaller one takes the leading dimensions. Every round is one
    pass for all numbers that have not converged, and sends n x n + n sums per number and task; whitening and the
    update work on n x n matrices.
    """
    most = max(numbers)
    fit = fit_pca(df, most, column)
    rows = df.select(vector_to_array(column).alias("x")).persist()
    try:
        variance = (
            project(df.withColumn("_k", F.lit(1)), "_k", fit, column)
            .agg(*[F.var_pop(f"z{i}").alias(f"v{i}") for i in range(most)])
            .first()
        )
        whiten = fit.components / np.sqrt(np.maximum(np.array(list(variance), float), 1e-12))
        turns = {n: _symmetric(np.random.default_rng(seed).normal(size=(n, n))) for n in numbers}
        used = dict.fromkeys(numbers, rounds)
        active = list(turns)
        for done in range(1, rounds + 1):
            sums = _ica_sums(rows, fit.mean, whiten, {n: turns[n] for n in active})
            for n in list(active):
                total, slope, count = sums[n]
                new = _symmetric(total / count - np.diag(slope / count) @ turns[n])
                moved = np.abs(np.abs((new * turns[n]).sum(1)) - 1).max()
                turns[n] = new
                if moved < tol:
                    used[n] = done
                    active.remove(n)
            if not active:
                break
    finally:
        rows.unpersist()
    found = {}
    for n, w in turns.items():
        unmixing = whiten[:, :n] @ w.T
        found[n] = IcaFit(unmixing, fit.mean, np.linalg.pinv(unmixing).T, used[n])
    return found


def _ica_sums(
    rows: DataFrame, mean: np.ndarray, whiten: np.ndarray, turns: dict[int, np.ndarray]
) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per number of components the sums of g(wz) z' and g'(wz), and the count, in one pass over the rows."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {n: np.zeros((n, n)) for n in turns}
        slope = {n: np.zeros(n) for n in turns}
        count = 0
        for pdf in batches:
            if not len(pdf):
                continue
            z = (np.stack(pdf["x"].to_numpy()) - mean) @ whiten
            count += len(z)
            for n, w in turns.items():
                g = np.tanh(z[:, :n] @ w.T)
                total[n] += g.T @ z[:, :n]
                slope[n] += (1 - g * g).sum(0)
        flat = np.concatenate([*[np.append(total[n].ravel(), slope[n]) for n in turns], [count]])
        yield pd.DataFrame({"i": np.arange(len(flat)), "v": flat})

    summed = rows.mapInPandas(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    values, at, out = summed.toPandas().sort_values("i")["v"].to_numpy(), 0, {}
    for n in turns:
        square = values[at : at + n * n].reshape(n, n)
        out[n] = (square, values[at + n * n : at + n * n + n], values[-1])
        at += n * n + n
    return out


def fit_ica(
    df: DataFrame, n: int, column: str = "features", seed: int = 42, rounds: int = 200, tol: float = 1e-4
) -> IcaFit:
    return fit_icas(df, [n], column, seed, rounds, tol)[n]


def ica_scores(df: DataFrame, key: str, fit: IcaFit, column: str = "features") -> DataFrame:
    as_pca = PcaFit(fit.unmixing, fit.mean, np.zeros(fit.unmixing.shape[1]))
    out = project(df, key, as_pca, column)
    return out.toDF(key, *[f"ic_{i + 1}" for i in range(fit.unmixing.shape[1])])


def kurtosis_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Excess kurtosis per column."""
    cells = [F.struct(F.lit(n).alias("column"), F.kurtosis(n).alias("kurtosis")) for n in columns]
    return df.agg(F.array(*cells).alias("cells")).selectExpr("inline(cells)")


def score_components(df: DataFrame, key: str, fits: dict[int, IcaFit], column: str = "features") -> dict[int, float]:
    """Mean absolute kurtosis of the components of each fit."""
    scored = {}
    for n, fit in fits.items():
        scores = ica_scores(df, key, fit, column)
        table = kurtosis_table(scores, scores.columns[1:])
        scored[n] = float(table.agg(F.avg(F.abs("kurtosis"))).first()[0])
    return scored


def component_table(spark: SparkSession, scored: dict[int, float]) -> DataFrame:
    """The scores per number of components; the best is marked."""
    best = max(scored, key=scored.get)
    return spark.createDataFrame(
        [(n, v, int(n == best)) for n, v in scored.items()], "n int, mean_abs_kurtosis double, best int"
    )
