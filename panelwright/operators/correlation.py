"""Correlation matrices and factorability. Rows are read by Spark; only the p x p
matrix of a declared list of columns is worked on by the driver."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import stats
from panelwright.operators import ranking
from panelwright.operators.cleaning import complete_cases
from panelwright.session import stored


def coefficient(a: str, b: str) -> Column:
    """Correlation over the rows that have both columns; null where one of them is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    spread = F.stddev_samp(F.when(both, F.col(a))) * F.stddev_samp(F.when(both, F.col(b)))
    return F.try_divide(F.covar_samp(a, b), spread)


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long (row, col, value) matrix over complete rows, by one aggregate; null where a column is constant."""
    rows = complete_cases(df.select(*[F.col(n).cast("double").alias(n) for n in columns]), columns)
    pairs = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), F.corr(a, b).alias("value"))
        for a in columns
        for b in columns
        if a < b
    ]
    half = rows.agg(F.array(*pairs).alias("cells")).selectExpr("inline(cells)")
    mirrored = half.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")
    ones = df.sparkSession.createDataFrame([(n, n, 1.0) for n in columns], half.schema)
    return half.unionByName(mirrored).unionByName(ones)


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, int]:
    rows = complete_cases(df.select(*[F.col(n).cast("double").alias(n) for n in columns]), columns)
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(rows).select("v")
    matrix = Correlation.corr(vectors, "v", "pearson").first()[0].toArray()
    return np.asarray(matrix, float), vectors.count()


def to_long(spark: SparkSession, matrix: np.ndarray, columns: Sequence[str]) -> DataFrame:
    cells = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return spark.createDataFrame(cells, "row string, col string, value double")


def ranked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Complete rows with every column replaced by its average rank."""
    rows = complete_cases(df.select(*[F.col(n).cast("double").alias(n) for n in columns]), columns)
    # written with a number per row, which keeps its value when a task is repeated and spreads equal rows
    rows = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "complete_rows")
    counts = ranking.value_counts(ranking.melt(rows, columns), ["column"])
    places = ranking.with_positions(counts, ["column"]).withColumn("rank", ranking.mid_rank())
    places = stored(places, "ranks")
    out = rows
    for n in columns:
        table = places.where(F.col("column") == n).select("value", "n", "rank")
        out = ranking.lookup_by_value(out, n, table, "rank", f"rank_{n}")
    return out.select(*[F.col(f"rank_{n}").alias(n) for n in columns])


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return pearson(ranked(df, columns), columns)


# --- binary and ordinal columns --------------------------------------------------


def column_kinds(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """binary up to 2 distinct values, ordinal up to 7, else continuous."""
    # an estimate decides what is clearly continuous; the few others are counted exactly
    guess = df.agg(*[F.approx_count_distinct(n, 0.02).alias(n) for n in columns]).first()
    few = [n for n in columns if guess[n] <= 20]
    exact = df.agg(*[F.countDistinct(n).alias(n) for n in few]).first() if few else {}

    def kind(n: str) -> str:
        if n not in few or exact[n] > 7:
            return "continuous"
        return "binary" if exact[n] <= 2 else "ordinal"

    return {n: kind(n) for n in columns}


def _thresholds(counts: np.ndarray) -> np.ndarray:
    share = np.cumsum(counts) / counts.sum()
    return stats.normal_ppf(share[:-1])


def polychoric(table: np.ndarray) -> float:
    """Two-step estimate from a contingency table: thresholds from the margins, then
    the correlation that makes the table most likely."""
    table = table[table.sum(1) > 0][:, table.sum(0) > 0]
    if min(table.shape) < 2:
        return 0.0
    edge = lambda t: np.concatenate(([-np.inf], _thresholds(t), [np.inf]))
    a, b = edge(table.sum(1)), edge(table.sum(0))

    def fit(rho: float) -> float:
        cdf = stats.bivariate_normal_cdf(a[:, None], b[None, :], rho)
        cdf[0, :] = 0.0
        cdf[:, 0] = 0.0
        cell = cdf[1:, 1:] - cdf[:-1, 1:] - cdf[1:, :-1] + cdf[:-1, :-1]
        return float((table * np.log(np.clip(cell, 1e-12, None))).sum())

    return stats.golden_max(fit, -0.999, 0.999)


def polyserial(r: float, deviation: float, counts: np.ndarray, n: int) -> float:
    """Two-step estimate from the plain correlation with the ordinal codes."""
    density = stats.normal_pdf(_thresholds(counts)).sum()
    value = math.sqrt((n - 1) / n) * deviation * r / density
    return float(np.clip(value, -1, 1))


def mixed(
    df: DataFrame, columns: Sequence[str], kinds: Mapping[str, str] | None = None
) -> tuple[np.ndarray, int]:
    """Pearson, polyserial or polychoric correlation by the kinds of each pair; a constant column correlates with none."""
    rows = complete_cases(df.select(*[F.col(n).cast("double").alias(n) for n in columns]), columns)
    kinds = kinds or column_kinds(rows, columns)
    matrix, n = pearson_matrix(rows, columns)
    matrix = np.nan_to_num(matrix)
    np.fill_diagonal(matrix, 1.0)
    at = {name: i for i, name in enumerate(columns)}
    discrete = [x for x in columns if kinds[x] != "continuous"]
    if not discrete:
        return matrix, n
    # counts per combination first: the pairs are unfolded from the combinations only
    combos = rows.groupBy(*discrete).agg(F.count("*").alias("n"))
    unfold = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        for a, b in [*combinations(discrete, 2), *((d, d) for d in discrete)]
    ]
    cells = (
        combos.select("n", F.explode(F.array(*unfold)).alias("p"))
        .groupBy("p.a", "p.b", "p.x", "p.y")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    margins = {d: cells[(cells.a == d) & (cells.b == d)].sort_values("x") for d in discrete}
    for a, b in combinations(discrete, 2):
        table = cells[(cells.a == a) & (cells.b == b)].pivot(index="x", columns="y", values="n").fillna(0)
        matrix[at[a], at[b]] = matrix[at[b], at[a]] = polychoric(table.to_numpy(float))
    for d in discrete:
        weight, value = margins[d].n.to_numpy(float), margins[d].x.to_numpy(float)
        mean = (weight * value).sum() / weight.sum()
        deviation = math.sqrt((weight * (value - mean) ** 2).sum() / (weight.sum() - 1))
        for x in columns:
            if kinds[x] == "continuous" and len(weight) > 1:
                r = polyserial(matrix[at[d], at[x]], deviation, weight, n)
                matrix[at[d], at[x]] = matrix[at[x], at[d]] = r
    return matrix, n


@dataclass(frozen=True)
class Repaired:
    """A correlation matrix with its least eigenvalue before and after the repair."""

    matrix: np.ndarray
    least_before: float
    least_after: float


def positive_definite(matrix: np.ndarray, floor: float = 0.01) -> Repaired:
    """Eigenvalues below the floor are raised to it and the diagonal is scaled back to one. Correlations estimated
    pair by pair need not fit together; a matrix that does is returned as it is."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    least = float(values[0])
    if least >= floor:
        return Repaired(matrix, least, least)
    raised = (vectors * np.clip(values, floor, None)) @ vectors.T
    deviation = np.sqrt(np.diag(raised))
    fixed = raised / np.outer(deviation, deviation)
    return Repaired(fixed, least, float(np.linalg.eigvalsh(fixed)[0]))


# --- factorability -------------------------------------------------------------------


def kmo(matrix: np.ndarray) -> tuple[float, np.ndarray]:
    """Sampling adequacy, overall and per column."""
    inverse = np.linalg.pinv(matrix)
    scale = np.sqrt(np.outer(np.diag(inverse), np.diag(inverse)))
    partial = inverse / scale
    off = ~np.eye(len(matrix), dtype=bool)
    r2, p2 = np.where(off, matrix**2, 0), np.where(off, partial**2, 0)
    return float(r2.sum() / (r2.sum() + p2.sum())), r2.sum(0) / (r2.sum(0) + p2.sum(0))


def bartlett(matrix: np.ndarray, n: int) -> tuple[float, int, float]:
    """Chi-square, degrees of freedom and p-value of the test for an identity matrix."""
    p = len(matrix)
    _, logdet = np.linalg.slogdet(matrix)
    chi2 = -(n - 1 - (2 * p + 5) / 6) * logdet
    df = p * (p - 1) // 2
    return float(chi2), df, float(stats.chi2_sf(float(chi2), df))


def factorability(spark: SparkSession, matrix: np.ndarray, n: int, columns: Sequence[str]) -> DataFrame:
    overall, each = kmo(matrix)
    chi2, df, p = bartlett(matrix, n)
    rows = [("kmo", "all", overall), ("bartlett_chi2", "all", chi2), ("bartlett_df", "all", float(df))]
    rows += [("bartlett_p", "all", p)] + [("kmo", name, float(v)) for name, v in zip(columns, each, strict=True)]
    return spark.createDataFrame(rows, "measure string, column string, value double")


def cronbach_alpha(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Alpha of the z-scored columns. The variance of a sum of z-scores is the sum of
    the correlations, so one aggregate of correlations is enough."""
    k = len(columns)
    rows = complete_cases(df, columns)
    pairs = [F.corr(a, b) for a, b in combinations(columns, 2)]
    total = F.lit(float(k)) + F.lit(2.0) * sum(pairs[1:], pairs[0])
    return rows.agg(F.count("*").alias("n"), (F.lit(k / (k - 1)) * (1 - k / total)).alias("alpha"))


def outcome_correlation(df: DataFrame, factors: Sequence[str], outcomes: Sequence[str]) -> DataFrame:
    """Long (row, col, value) table of factors by outcomes, by one aggregate; null where either is constant."""
    cells = [
        F.struct(F.lit(a).alias("row"), F.lit(b).alias("col"), coefficient(a, b).alias("value"))
        for a in factors
        for b in outcomes
    ]
    return df.agg(F.array(*cells).alias("cells")).selectExpr("inline(cells)")
