"""Mixtures, starting centroids and Ward groups that cover all rows."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.operators import agreement, clustering, mixtures


def _frame(spark, x, parts=5):
    rows = [(i, None if r is None else [float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, x array<double>").repartition(parts, "id")
    return df.withColumn("features", F.when(F.col("x").isNotNull(), array_to_vector("x")))


@pytest.fixture(scope="module")
def overlapping():
    rng = np.random.default_rng(3)
    shapes = [([0, 0], [[1, 0.8], [0.8, 1]]), ([3, 0], [[1, -0.7], [-0.7, 1]]), ([100, 5], [[0.2, 0], [0, 4]])]
    return np.vstack([rng.multivariate_normal(m, s, 400) for m, s in shapes])


def _by_hand(x, weights, means, covariances):
    """Log densities by the formula, a row and component at a time."""
    out = np.zeros((len(x), len(weights)))
    for i, r in enumerate(x):
        for j in range(len(weights)):
            gap = r - means[j]
            quad = gap @ np.linalg.solve(covariances[j], gap)
            out[i, j] = math.log(weights[j]) - 0.5 * (quad + math.log(np.linalg.det(2 * math.pi * covariances[j])))
    return out


def test_likelihood_and_posteriors_follow_the_formula(spark, overlapping):
    df = _frame(spark, overlapping)
    model = mixtures.fit_mixtures(df, [3], starts=3, rounds=200)[3]
    logs = _by_hand(overlapping, model.weights, model.means, model.covariances)
    whole = np.log(np.exp(logs).sum(1))
    assert model.settled and model.weights.sum() == pytest.approx(1)
    assert model.log_likelihood == pytest.approx(whole.sum())
    assert mixtures.log_likelihood(df, model) == pytest.approx(whole.sum())
    got = np.array([r["p"] for r in mixtures.posteriors(df, model, "p").orderBy("id").collect()])
    assert np.allclose(got, np.exp(logs - whole[:, None]), atol=1e-9)
    labelled = mixtures.mixture_labels(df, model, "c").orderBy("id").collect()
    assert [r["c"] for r in labelled] == list(got.argmax(1))
    assert np.allclose([r["uncertainty"] for r in labelled], 1 - got.max(1))


def test_one_round_is_the_textbook_step(spark, overlapping):
    df = _frame(spark, overlapping)
    before, after = (mixtures.fit_mixtures(df, [3], starts=1, rounds=r, tol=-1)[3] for r in (0, 1))
    logs = _by_hand(overlapping, before.weights, before.means, before.covariances)
    share = np.exp(logs) / np.exp(logs).sum(1, keepdims=True)
    mass = share.sum(0)
    means = (share.T @ overlapping) / mass[:, None]
    assert np.allclose(after.weights, mass / len(overlapping))
    assert np.allclose(after.means, means)
    for j in range(3):
        gap = overlapping - means[j]
        assert np.allclose(after.covariances[j], (share[:, j, None] * gap).T @ gap / mass[j], atol=1e-2)
    assert after.log_likelihood > before.log_likelihood and not after.settled


def test_mixtures_of_several_sizes_in_one_fit(spark, overlapping):
    df = _frame(spark, overlapping)
    n, found = len(overlapping), mixtures.fit_mixtures(df, [1, 2, 3, 4], starts=4, rounds=200)
    scores = {k: mixtures.bic(m.log_likelihood, k, 2, n) for k, m in found.items()}
    assert min(scores, key=scores.get) == 3
    assert np.allclose(found[1].means[0], overlapping.mean(0))
    assert np.allclose(found[1].covariances[0], np.cov(overlapping.T, bias=True), rtol=1e-3, atol=1e-2)
    order = np.argsort(found[3].means[:, 0])
    assert np.allclose(found[3].means[order], [[0, 0], [3, 0], [100, 5]], atol=0.4)


def test_mixture_edges(spark):
    same = _frame(spark, [[1.0, 2.0]] * 30 + [None])
    model = mixtures.gaussian_mixture(same, 2, starts=2, rounds=5)
    assert np.isfinite(model.log_likelihood)
    labelled = mixtures.mixture_labels(same, model, "c")
    assert labelled.where("c is null and uncertainty is null").count() == 1
    with pytest.raises(ValueError):
        mixtures.gaussian_mixture(same.limit(0), 2)
    assert mixtures.log_likelihood(same.limit(0), model) == 0


def test_starts_reach_a_far_cluster_among_copies(spark):
    """A vector that holds most rows doesn't keep rare far ones from being candidates."""
    x = [[0.0, 0.0]] * 3000 + [[50.0, 0.0], [50.5, 0.0], [0.0, 80.0]]
    found = clustering.kmeans(_frame(spark, x), 3, starts=3)
    assert sorted(np.round(found.centres, 3).tolist()) == [[0, 0], [0, 80], [50.25, 0]]
    assert found.cost == pytest.approx(2 * 0.25**2)
    with pytest.raises(ValueError):
        clustering.kmeans(_frame(spark, x).limit(0), 3)


def _ward_by_hand(x, k):
    """Ward over all rows from the increase of the sum of squares of each pair, computed anew in each step."""
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        means, n = np.array([x[g].mean(0) for g in groups]), np.array([len(g) for g in groups], float)
        cost = ((means[:, None] - means[None]) ** 2).sum(-1) * np.outer(n, n) / (n[:, None] + n[None])
        np.fill_diagonal(cost, np.inf)
        i, j = sorted(np.unravel_index(cost.argmin(), cost.shape))
        groups[i] += groups.pop(j)
    out = np.zeros(len(x), int)
    for g, members in enumerate(groups):
        out[members] = g
    return out


def _same(spark, a, b):
    df = spark.createDataFrame(list(zip(map(int, a), map(int, b), strict=True)), "a int, b int")
    return agreement.agreement_matrix(df, {"a": "a", "b": "b"}).where("row = 'a' and col = 'b'").first()["ari"]


def test_ward_with_a_leaf_for_each_row_is_ward(spark):
    x = np.random.default_rng(11).normal(size=(120, 3))
    got = [r["cluster"] for r in clustering.hierarchical(_frame(spark, x), 5).orderBy("id").collect()]
    assert _same(spark, got, _ward_by_hand(x, 5)) == 1.0


def test_ward_on_leaves_gives_the_groups_of_all_rows(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(scale=8, size=(6, 4))
    x = np.vstack([c + rng.normal(size=(n, 4)) for c, n in zip(centres, (700, 500, 400, 200, 150, 50), strict=True)])
    df = _frame(spark, x, parts=40)
    got = [r["cluster"] for r in clustering.hierarchical(df, 6, micro=200).orderBy("id").collect()]
    groups = clustering.ward_groups(x, np.ones(len(x)), 6)
    assert _same(spark, got, groups) > 0.99


def test_feature_tree_counts_every_row(spark):
    rng = np.random.default_rng(8)
    x = [[0.0, 1.0]] * 900 + rng.normal(size=(1100, 2)).tolist() + [None]
    leaves = clustering.feature_tree(_frame(spark, x, parts=40), 64)
    kept = np.array(x[:-1])
    assert len(leaves) <= 64
    assert leaves[:, 0].sum() == 2000
    assert np.allclose(leaves[:, 1:-1].sum(0), kept.sum(0))
    assert leaves[:, -1].sum() == pytest.approx((kept**2).sum())
    out = clustering.hierarchical(_frame(spark, x), 3)
    assert out.where("cluster is null").count() == 1 and out.select("cluster").distinct().count() == 4
    assert clustering.hierarchical(_frame(spark, x).limit(0), 3).count() == 0
