"""Clusterings, their internal quality, and the choice of K.

Bisections are Spark ML; K-Means runs all starts in one pass a round, as mixtures do (``mixtures.py``). Quality needs only sums per cluster and, for the
Davies-Bouldin index, one pass with k centroids of d numbers at hand.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions import columns as c


#: Rounds in which rows are drawn as candidates for starting centroids, and how many, per centroid, a start draws in each.
START_ROUNDS = 2
OVERSAMPLING = 4
#: Numbers that a task holds at a time while it measures rows against candidates.
CELLS = 4_000_000
#: Tasks whose sums the driver adds by itself, and how many numbers they may have in all.
FEW_TASKS = 64
FEW_NUMBERS = 20_000


def _array(column: str) -> Column:
    """The numbers of a vector; null for a null vector, which ``vector_to_array`` refuses."""
    return F.when(F.col(column).isNotNull(), vector_to_array(column))


@dataclass(frozen=True)
class Centroids:
    centres: np.ndarray
    cost: float


def _spread_start(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each drawn with a chance that grows with its weight and squared distance from those before."""
    chosen = [x[rng.choice(len(x), p=weight / weight.sum())]]
    gap = weight * ((x - chosen[0]) ** 2).sum(1)
    for _ in range(1, k):
        share = gap / gap.sum() if gap.sum() > 0 else None
        chosen.append(x[rng.choice(len(x), p=share)])
        gap = np.minimum(gap, weight * ((x - chosen[-1]) ** 2).sum(1))
    return np.stack(chosen)


def _uniform(at: np.ndarray, turn: int) -> np.ndarray:
    """Numbers in 0..1 that follow from a row's own random number and the turn."""
    z = at.view(np.uint64) + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0**-53


def _gaps(x: np.ndarray, candidates: Sequence[np.ndarray]):
    """Slices of the rows with, for each start, the squared distance to its nearest candidate and the candidate's place."""
    ends = np.cumsum([len(c) for c in candidates])
    every = np.concatenate(candidates)
    norm = (every**2).sum(1)
    step = max(1, CELLS // len(every))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        gap = np.maximum((part**2).sum(1)[:, None] - 2 * part @ every.T + norm, 0)
        own = [gap[:, a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        yield slice(at, at + step), [g.min(1) for g in own], [g.argmin(1) for g in own]


def _spread_starts(rows: DataFrame, ks: Sequence[int], starts: int, seed: int) -> dict[tuple[int, int], np.ndarray]:
    """Starting centroids for every start of every K, chosen among all ``rows`` (``x, _at``; the second a random number).

    Each start takes one random row and draws more in a few rounds, each row with a chance that grows with its squared distance
    from those taken; every row then counts for its nearest candidate, and the centroids are chosen among these few by weight.
    A round is two passes for all starts; the driver sees some OVERSAMPLING x K rows a start and round.
    """
    schema = "start int, at double, x array<double>"

    def least(batches):
        best = {}
        for pdf in batches:
            if len(pdf):
                at = pdf["_at"].to_numpy()
                for i in range(starts):
                    u = _uniform(at, i)
                    j = int(u.argmin())
                    if i not in best or u[j] < best[i][0]:
                        best[i] = (u[j], pdf["x"].iloc[j])
        if best:
            yield pd.DataFrame({"start": list(best), "at": [b[0] for b in best.values()], "x": [b[1] for b in best.values()]})

    one = rows.mapInPandas(least, schema).groupBy("start").agg(F.min_by("x", "at").alias("x")).collect()
    if not one:
        raise ValueError("there are no vectors to cluster")
    taken = [np.array([r["x"]], float) for r in sorted(one, key=lambda r: r["start"])]
    for turn in range(START_ROUNDS):
        cost = _summed(rows, lambda x, t=tuple(taken): sum(np.array([g.sum() for g in gaps]) for _, gaps, _ in _gaps(x, t)))

        def draw(batches, turn=turn, cost=cost, taken=tuple(taken)):
            for pdf in batches:
                if not len(pdf):
                    continue
                x, at = _matrix(pdf["x"]), pdf["_at"].to_numpy()
                for part, gaps, _ in _gaps(x, taken):
                    for i in range(starts):
                        chance = OVERSAMPLING * max(ks) * gaps[i] / max(cost[i], 1e-300)
                        u = _uniform(at[part], starts * (turn + 1) + i)
                        hit = np.flatnonzero(u < chance)
                        if len(hit):
                            yield pd.DataFrame({"start": i, "at": u[hit], "x": list(x[part][hit])})

        # sorted here, as an ordering by Spark would draw twice
        for r in sorted(rows.mapInPandas(draw, schema).collect(), key=lambda r: (r["start"], r["at"])):
            taken[r["start"]] = np.vstack([taken[r["start"]], r["x"]])
    sizes = [len(t) for t in taken]

    def weigh(x: np.ndarray) -> np.ndarray:
        return sum(
            np.concatenate([np.bincount(near, minlength=m) for near, m in zip(nears, sizes, strict=True)])
            for _, _, nears in _gaps(x, taken)
        )

    weights = np.split(_summed(rows, weigh), np.cumsum(sizes)[:-1])
    return {
        (k, i): _spread_start(taken[i], weights[i], k, np.random.default_rng([seed, k, i])) for k in ks for i in range(starts)
    }


def kmeans_fits(
    df: DataFrame,
    ks: Sequence[int],
    column: str = "features",
    starts: int = 20,
    rounds: int = 500,
    seed: int = 42,
    tol: float = 1e-4,
) -> dict[int, Centroids]:
    """For each K the best of several starts by within-cluster cost.

    A round is one pass over kept rows that serves every start of every K still moving, instead of a pass for each;
    a task sends k x d sums per start. A centroid without rows stays where it is.
    """
    rows = df.select(_array(column).alias("x"), F.rand(seed).alias("_at")).where("x IS NOT NULL").persist()
    try:
        centres = _spread_starts(rows, ks, starts, seed)
        cost: dict[tuple[int, int], float] = {}
        active = list(centres)
        for _ in range(rounds):
            size = sum(centres[c].size + len(centres[c]) + 1 for c in active)
            found, at = _summed(rows, _cluster_sums({c: centres[c] for c in active}), size), 0
            for c in list(active):
                k, d = centres[c].shape
                total, n = found[at : at + k * d].reshape(k, d), found[at + k * d : at + k * d + k]
                cost[c] = float(found[at + k * d + k])
                at += k * d + k + 1
                new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres[c])
                if np.sqrt(((new - centres[c]) ** 2).sum(1)).max() < tol:
                    active.remove(c)
                centres[c] = new
            if not active:
                break
    finally:
        rows.unpersist()
    best = {k: min(((k, i) for i in range(starts)), key=cost.get) for k in ks}
    return {k: Centroids(centres[c], cost[c]) for k, c in best.items()}


def _cluster_sums(centres: dict):
    """Per set of centroids the sums and numbers of the rows nearest to each, and the cost, of a batch."""

    def compute(x: np.ndarray) -> np.ndarray:
        norm, out = (x**2).sum(1), []
        for m in centres.values():
            gap = norm[:, None] - 2 * x @ m.T + (m**2).sum(1)
            near = gap.argmin(1)
            own = np.eye(len(m))[near]
            least = np.maximum(gap[np.arange(len(x)), near], 0).sum()
            out += [(own.T @ x).ravel(), own.sum(0), [least]]
        return np.concatenate(out)

    return compute


def kmeans(
    df: DataFrame, k: int, column: str = "features", starts: int = 20, rounds: int = 500, seed: int = 42
) -> Centroids:
    return kmeans_fits(df, [k], column, starts, rounds, seed)[k]


def label(df: DataFrame, model, alias: str, column: str = "features") -> DataFrame:
    """Adds the cluster of each row, from centroids (null for a null vector) or a fitted Spark model."""
    if isinstance(model, Centroids):
        centres = model.centres

        @F.pandas_udf("int")
        def nearest(vector: pd.Series) -> pd.Series:
            some, out = vector.notna(), pd.Series(pd.NA, vector.index, dtype="Int32")
            if some.any():
                out[some] = _distances2(_matrix(vector[some]), centres).argmin(1).astype("int32")
            return out

        return df.withColumn(alias, nearest(_array(column)))
    drop = [x for x in ("prediction", "probability") if x in df.columns]
    return model.transform(df.drop(*drop)).withColumnRenamed("prediction", alias)


def bisecting(df: DataFrame, k: int, column: str = "features", seed: int = 42):
    return BisectingKMeans(k=k, featuresCol=column, seed=seed).fit(df)


def ward_groups(centroids: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Group weighted centroids by repeatedly joining the pair that adds least variance."""
    m = len(centroids)
    centre, weight = centroids.astype(float).copy(), sizes.astype(float).copy()
    member, alive = np.arange(m), np.ones(m, dtype=bool)
    gap = ((centre[:, None, :] - centre[None, :, :]) ** 2).sum(-1)
    cost = gap * np.outer(weight, weight) / (weight[:, None] + weight[None, :])
    np.fill_diagonal(cost, np.inf)
    for _ in range(m - k):
        i, j = np.unravel_index(np.argmin(cost), cost.shape)
        i, j = min(i, j), max(i, j)
        whole = weight[i] + weight[j]
        centre[i] = (centre[i] * weight[i] + centre[j] * weight[j]) / whole
        weight[i], alive[j] = whole, False
        member[member == j] = i
        cost[j, :] = cost[:, j] = np.inf
        gap = ((centre - centre[i]) ** 2).sum(1)
        row = np.where(alive, gap * weight * whole / (weight + whole), np.inf)
        row[i] = np.inf
        cost[i, :] = cost[:, i] = row
    _, labels = np.unique(member, return_inverse=True)
    return labels


class FeatureTree:
    """Clustering features (number, sum, sum of squared lengths) of at most ``most`` leaves, each within a radius of its first mean.

    The radius starts at that of the features put in and grows by half whenever there are too many leaves, so that their number is
    bounded for any number of rows and every row counts. Leaves lie flat: they are few enough to be searched by one matrix product.
    """

    def __init__(self, most: int, radius: float = 0.0) -> None:
        self.most, self.radius = most, radius
        self.leaves: np.ndarray | None = None

    @staticmethod
    def of(x: np.ndarray) -> np.ndarray:
        """A feature for each row."""
        return np.hstack([np.ones((len(x), 1)), x, (x**2).sum(1, keepdims=True)])

    def add(self, features: np.ndarray) -> None:
        pending = features
        if self.leaves is not None:
            centres = self.leaves[:, 1:-1] / self.leaves[:, :1]
            means = pending[:, 1:-1] / pending[:, :1]
            gap = (means**2).sum(1)[:, None] - 2 * means @ centres.T + (centres**2).sum(1)
            near = gap.argmin(1)
            close = ((means - centres[near]) ** 2).sum(1) <= self.radius**2
            np.add.at(self.leaves, near[close], pending[close])
            pending = pending[~close]
        grown = [] if self.leaves is None else list(self.leaves)
        while len(pending):
            means = pending[:, 1:-1] / pending[:, :1]
            close = ((means - means[0]) ** 2).sum(1) <= self.radius**2
            grown.append(pending[close].sum(0))
            pending = pending[~close]
            if len(grown) > self.most:
                self._widen(grown)
                self.leaves = None
                self.add(np.vstack([*grown, pending]))
                return
        self.leaves = np.array(grown) if grown else None

    def _widen(self, grown: list[np.ndarray]) -> None:
        """A radius that joins at least the nearer half of a few leaves with their neighbours."""
        means = np.array([g[1:-1] / g[0] for g in grown])
        few = means[:: max(1, len(means) // 64)]
        gap = _distances2(means, few)
        nearest = np.sqrt(np.where(gap > 0, gap, np.inf).min(0))
        found = np.median(nearest[np.isfinite(nearest)]) if np.isfinite(nearest).any() else 0.0
        self.radius = max(1.5 * self.radius, float(found), 1e-12)


def feature_tree(df: DataFrame, most: int = 1024, column: str = "features") -> np.ndarray:
    """Clustering features of all rows, at most ``most``: built by each task, then merged thirty-two trees at a time.

    Null vectors take no part. Which rows share a leaf depends on their order; numbers and sums add up to those of all rows.
    """
    rows = df.select(_array(column).alias("x")).where("x IS NOT NULL")
    schema = "part int, radius double, v binary, width int"

    def packed(tree: FeatureTree, part: int) -> pd.DataFrame:
        row = {"part": [part], "radius": [tree.radius], "v": [tree.leaves.tobytes()], "width": [tree.leaves.shape[1]]}
        return pd.DataFrame(row)

    def build(batches):
        tree = FeatureTree(most)
        for pdf in batches:
            # no more rows at a time than leaves, so that a radius that is too small costs little
            for at in range(0, len(pdf), most):
                tree.add(FeatureTree.of(_matrix(pdf["x"].iloc[at : at + most])))
        if tree.leaves is not None:
            yield packed(tree, TaskContext.get().partitionId())

    def together(pdf: pd.DataFrame) -> FeatureTree:
        tree = FeatureTree(most, float(pdf["radius"].max()))
        for v, width in zip(pdf["v"], pdf["width"], strict=True):
            tree.add(np.frombuffer(v, float).reshape(-1, width))
        return tree

    trees, tasks = rows.mapInPandas(build, schema), rows.rdd.getNumPartitions()
    while tasks > 32:
        tasks = math.ceil(tasks / 32)
        trees = trees.groupBy((F.col("part") % tasks).alias("part")).applyInPandas(
            lambda key, pdf: packed(together(pdf), int(key[0])), schema
        )
    found = trees.toPandas().sort_values("part")
    return together(found).leaves if len(found) else np.zeros((0, 2))


def hierarchical(
    df: DataFrame, k: int, micro: int = 1024, column: str = "features", alias: str = "cluster"
) -> DataFrame:
    """Ward grouping of the leaves of a clustering-feature tree over all rows; a row belongs to the group of its nearest leaf.

    Only the leaves, at most ``micro``, are grouped by the driver. With as many leaves as distinct rows the groups are Ward's own.
    A null vector gets no group.
    """
    leaves = feature_tree(df, micro, column)
    if not len(leaves):
        return df.withColumn(alias, F.lit(None).cast("int"))
    centres = leaves[:, 1:-1] / leaves[:, :1]
    groups = ward_groups(centres, leaves[:, 0], k)
    out = label(df, Centroids(centres, math.nan), "_micro", column)
    return out.withColumn(alias, F.get(F.lit([int(g) for g in groups]), F.col("_micro"))).drop("_micro")


# --- internal quality ----------------------------------------------------------------------


def silhouette(df: DataFrame, labels: str, column: str = "features") -> float | None:
    """Silhouette with squared Euclidean distance, which needs no pairs of rows; None for fewer than two clusters."""
    if df.select(labels).distinct().limit(2).count() < 2:
        return None
    evaluator = ClusteringEvaluator(featuresCol=column, predictionCol=labels)
    return evaluator.evaluate(df.withColumn(labels, F.col(labels).cast("int")))


def cluster_sums(df: DataFrame, labels: str, column: str = "features") -> DataFrame:
    """Size, centroid and sum of squared lengths per cluster."""
    norms = F.aggregate(F.transform(vector_to_array(column), lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
    return (
        df.select(labels, column, norms.alias("norm2"))
        .groupBy(labels)
        .agg(
            F.count("*").alias("n"),
            Summarizer.mean(F.col(column)).alias("centroid"),
            F.sum("norm2").alias("norm2"),
        )
    )


def _matrix(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(float)


def _distances2(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every centre."""
    return np.stack([((x - m) ** 2).sum(1) for m in centres], axis=1)


def internal_indices(df: DataFrame, labels: str, column: str = "features") -> dict[str, float | None]:
    """Calinski-Harabasz and Davies-Bouldin; None for fewer than two clusters."""
    rows = cluster_sums(df, labels, column).orderBy(labels).collect()
    if len(rows) < 2:
        return {"calinski_harabasz": None, "davies_bouldin": None}
    names = [r[labels] for r in rows]
    n = np.array([r["n"] for r in rows], float)
    centre = np.stack([r["centroid"].toArray() for r in rows])
    within = sum(r["norm2"] for r in rows) - (n * (centre**2).sum(1)).sum()
    grand = (n[:, None] * centre).sum(0) / n.sum()
    between = (n * ((centre - grand) ** 2).sum(1)).sum()
    k = len(names)
    place = {name: i for i, name in enumerate(names)}

    @F.pandas_udf("double")
    def to_centre(own: pd.Series, vector: pd.Series) -> pd.Series:
        if not len(own):
            return pd.Series([], dtype=float)
        gap = _matrix(vector) - centre[[place[x] for x in own]]
        return pd.Series(np.sqrt((gap**2).sum(1)))

    spread = (
        df.select(labels, to_centre(labels, vector_to_array(column)).alias("d"))
        .groupBy(labels)
        .agg(F.avg("d").alias("d"))
        .orderBy(labels)
        .collect()
    )
    s = np.array([r["d"] for r in spread])
    apart = np.sqrt(((centre[:, None, :] - centre[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(apart, np.inf)
    worst = ((s[:, None] + s[None, :]) / apart).max(1)
    return {
        "calinski_harabasz": float((between / (k - 1)) / (within / (n.sum() - k))),
        "davies_bouldin": float(worst.mean()),
    }


def quality(df: DataFrame, labels: str, method: str, column: str = "features") -> tuple:
    found = internal_indices(df, labels, column)
    return (
        method,
        silhouette(df, labels, column),
        found["calinski_harabasz"],
        found["davies_bouldin"],
    )


QUALITY_SCHEMA = "method string, silhouette double, calinski_harabasz double, davies_bouldin double"


def compare(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """One row per method, the best silhouette marked."""
    table = spark.createDataFrame(list(rows), QUALITY_SCHEMA)
    best = table.agg(F.max_by("method", "silhouette")).scalar()
    return table.withColumn("best", (F.col("method") == best).cast("int"))


def min_max(column: str, invert: bool = False, tiny: float = 1e-9) -> Column:
    """Rescaled to 0..1 over a small table."""
    whole = W.partitionBy()
    low, high = F.min(column).over(whole), F.max(column).over(whole)
    value = (F.col(column) - low) / (high - low + tiny)
    return 1 - value if invert else value


def composite_score(sweep: DataFrame) -> DataFrame:
    """Mean of the rescaled indices of a K sweep; the best K is marked."""
    scored = sweep.withColumn(
        "score",
        (min_max("silhouette") + min_max("calinski_harabasz") + min_max("davies_bouldin", True)) / 3,
    )
    best = scored.agg(F.max_by("k", "score")).scalar()
    return scored.withColumn("best", (F.col("k") == best).cast("int")).orderBy("k")


def kmeans_sweep(
    df: DataFrame,
    ks: Sequence[int],
    column: str = "features",
    starts: int = 20,
    rounds: int = 500,
    seed: int = 42,
) -> DataFrame:
    """Quality of the best of several starts for each K."""
    rows = []
    for k, best in kmeans_fits(df, ks, column, starts, rounds, seed).items():
        _, sil, ch, db = quality(label(df, best, "_label", column), "_label", str(k), column)
        rows.append((k, sil, ch, db))
    schema = "k int, silhouette double, calinski_harabasz double, davies_bouldin double"
    return composite_score(df.sparkSession.createDataFrame(rows, schema))


def generalisation(table: DataFrame) -> DataFrame:
    """Ratio of BIC on training and validation rows per K, and the K before its sharpest drop."""
    after = F.lead("ratio").over(W.partitionBy().orderBy("k")) - F.col("ratio")
    with_ratio = table.withColumn("ratio", F.col("bic_train") / (F.col("bic_validation") + 1e-9))
    with_drop = with_ratio.withColumn("drop_after", after)
    best = with_drop.where("drop_after IS NOT NULL").agg(F.min_by("k", "drop_after")).scalar()
    return with_drop.withColumn("best", (F.col("k") == best).cast("int")).orderBy("k")


# --- soft assignment and its refinement ------------------------------------------------------


def _soft(x: np.ndarray, centroids: np.ndarray, alpha: float) -> np.ndarray:
    """Student-t similarity of every row to each centroid, normalised per row."""
    kernel = (1 + _distances2(x, centroids) / alpha) ** (-(alpha + 1) / 2)
    return kernel / kernel.sum(1, keepdims=True)


def _sharp(q: np.ndarray, sums: np.ndarray) -> np.ndarray:
    p = q * q / sums
    return p / p.sum(1, keepdims=True)


def _row_function(compute):
    """A column function over arrays, computed on Arrow batches; null stays null."""

    @F.pandas_udf("array<double>")
    def run(values: pd.Series) -> pd.Series:
        some = values.notna()
        rows = iter(compute(_matrix(values[some])) if some.any() else [])
        return pd.Series([next(rows) if x else None for x in some], dtype=object)

    return run


def soft_assignment(df: DataFrame, array: str, centroids: np.ndarray, alpha: float = 1.0) -> DataFrame:
    """Adds ``q``: Student-t similarity to each centroid, normalised per row."""
    return df.withColumn("q", _row_function(lambda x: _soft(x, centroids, alpha))(F.col(array)))


def target_distribution(df: DataFrame, k: int) -> DataFrame:
    """Adds ``p``: squared assignments over their column sums, normalised per row."""
    sums = df.agg(F.array(*[F.sum(F.get("q", F.lit(j))) for j in range(k)]).alias("f")).first()["f"]
    f = np.array(sums, float)
    return df.withColumn("p", _row_function(lambda q: _sharp(q, f))(F.col("q")))


def hard_label(column: str) -> Column:
    """Index of the largest entry; the first one on ties."""
    return (F.array_position(column, F.array_max(column)) - 1).cast("int")


def divergence(df: DataFrame) -> DataFrame:
    """Mean Kullback-Leibler divergence of the target from the assignment."""
    terms = F.zip_with("p", "q", lambda p, q: F.when(p > 0, p * F.ln(p / q)).otherwise(0.0))
    row = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)
    return df.agg(F.count("*").alias("n"), (F.sum(row) / F.count("*")).alias("kl"))


def label_change(df: DataFrame, before: str, after: str) -> DataFrame:
    return df.agg(F.avg((F.col(before) != F.col(after)).cast("double")).alias("changed"))


def _summed(rows: DataFrame, compute, size: int = 0) -> np.ndarray:
    """Sum over all rows of a fixed-length vector that ``compute`` gives for a batch of them; one pass. Each task makes one
    row. Those of many tasks, or of vectors whose ``size`` is known to be large, are added by tasks, first in groups of about the
    square root of their number, so that the driver gets one vector whatever the number of tasks."""
    tasks = rows.rdd.getNumPartitions()
    groups = max(1, math.isqrt(tasks)) if tasks > FEW_TASKS else 1

    def partial(batches):
        total = None
        for pdf in batches:
            if len(pdf):
                part = compute(_matrix(pdf["x"]))
                total = part if total is None else total + part
        if total is not None:
            at = TaskContext.get().partitionId()
            yield pd.DataFrame({"part": [at % groups], "at": [at], "v": [np.asarray(total, float).tobytes()]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, float) for v in pdf.sort_values("at")["v"])
        return pd.DataFrame({"part": [0], "at": [pdf["part"].iloc[0]], "v": [total.tobytes()]})

    schema = "part int, at int, v binary"
    sums = rows.mapInPandas(partial, schema)
    if groups > 1 or tasks * size > FEW_NUMBERS:
        sums = sums.groupBy("part").applyInPandas(added, schema)
    if groups > 1:
        sums = sums.groupBy("part").applyInPandas(added, schema)
    return sum(np.frombuffer(r["v"], float) for r in sums.collect())


def refine(
    df: DataFrame,
    array: str,
    centroids: np.ndarray,
    rounds: int = 500,
    tol: float = 0.001,
    alpha: float = 1.0,
    hold: int = 5,
) -> tuple[np.ndarray, list[tuple[int, float, float]]]:
    """Moves the centroids down the divergence of the assignments from their target until few labels change.

    The target is taken from the centroids every ``hold`` rounds and held in between: k column sums in one pass. A round's
    one pass gives the divergence, the changed labels and its gradient by the centroids, which weights every row by the
    Student-t kernel: sums of (p - q) / (1 + d2 / alpha) * (x - m). A step that raises the divergence of the held target is
    taken back and halved. The refinement ends when, at a new target, fewer than ``tol`` of the labels have changed since the
    last one. The target sharpens the assignments, but the kernel's weight fades with the distance, so centroids stay in
    their clusters; if two meet all the same, an error is raised.

    Returns the centroids and the log ``(round, divergence, share of labels changed since the last target)``, a row for each
    target. Null arrays take no part; without any rows the centroids stay and the log is empty.
    """
    k, d = centroids.shape
    log: list[tuple[int, float, float]] = []
    rows = df.select(F.col(array).alias("x")).where("x IS NOT NULL").persist()
    try:
        n = rows.count()
        step, previous = 1.0, None
        i = 0
        while n and i < rounds:
            target = centroids
            sums = _summed(rows, lambda x, m=target: _soft(x, m, alpha).sum(0))

            def moments(x: np.ndarray, now: np.ndarray, target=target, sums=sums, old=previous) -> np.ndarray:
                q = _soft(x, now, alpha)
                p = _sharp(_soft(x, target, alpha), sums)
                kl = (p * np.log(np.where(p > 0, p / q, 1.0))).sum()
                moved = 0 if old is None else (q.argmax(1) != _soft(x, old, alpha).argmax(1)).sum()
                pull = (p - q) / (1 + _distances2(x, now) / alpha)
                # the kernel's mass scales a step to the size of its cluster
                mass = (q / (1 + _distances2(x, now) / alpha)).sum(0)
                return np.concatenate([(pull.T @ x - pull.sum(0)[:, None] * now).ravel(), mass, [kl, moved]])

            found = _summed(rows, lambda x: moments(x, target))
            kl, moved = found[-2] / n, found[-1] / n
            log.append((i, float(kl), float(moved)))
            if previous is not None and moved < tol:
                break
            previous = target
            for _ in range(hold):
                move = found[: k * d].reshape(k, d) / np.maximum(found[k * d : -2, None], 1e-12)
                tried = centroids + step * move
                after = _summed(rows, lambda x, m=tried: moments(x, m))
                i += 1
                if after[-2] <= found[-2]:
                    centroids, found, step = tried, after, min(1.0, 2 * step)
                else:
                    step /= 2
            apart = _distances2(centroids, centroids)[~np.eye(k, dtype=bool)]
            if k > 1 and apart.min() <= 1e-12 * max(1.0, float((centroids**2).sum(1).max())):
                raise ValueError("two centroids have met")
    finally:
        rows.unpersist()
    return centroids, log
