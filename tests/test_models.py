import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from panelwright.functions import stats
from panelwright.operators import agreement, clustering, correlation, embedding, factors, features, mixtures


def test_distribution_functions():
    assert stats.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert stats.chi2_sf(18.307038, 10) == pytest.approx(0.05, abs=1e-6)
    assert stats.chi2_sf(0, 3) == 1.0
    assert stats.normal_ppf(0.975) == pytest.approx(1.959964, abs=1e-5)
    assert np.allclose(stats.normal_cdf(stats.normal_ppf([0.01, 0.3, 0.999])), [0.01, 0.3, 0.999])
    # orthant probability has a closed form
    for rho in (-0.8, 0.0, 0.5):
        want = 0.25 + math.asin(rho) / (2 * math.pi)
        assert float(stats.bivariate_normal_cdf(0.0, 0.0, rho)) == pytest.approx(want, abs=1e-8)


def test_polychoric_and_polyserial_recover_the_latent_correlation():
    rng = np.random.default_rng(1)
    z = rng.multivariate_normal([0, 0], [[1, 0.6], [0.6, 1]], 40_000)
    a, b = np.digitize(z[:, 0], [-0.5, 0.4]), np.digitize(z[:, 1], [0.0])
    table = pd.crosstab(a, b).to_numpy(float)
    assert correlation.polychoric(table) == pytest.approx(0.6, abs=0.02)
    r = np.corrcoef(z[:, 1], a)[0, 1]
    counts = np.bincount(a).astype(float)
    assert correlation.polyserial(r, a.std(ddof=1), counts, len(a)) == pytest.approx(0.6, abs=0.02)


def test_mixed_matrix_on_rows(spark):
    rng = np.random.default_rng(2)
    z = rng.multivariate_normal([0, 0, 0], [[1, 0.5, 0.4], [0.5, 1, 0.3], [0.4, 0.3, 1]], 8000)
    pdf = pd.DataFrame({"x": z[:, 0], "o": np.digitize(z[:, 1], [-1, 0, 1]), "b": (z[:, 2] > 0).astype(int)})
    matrix, n = correlation.mixed(spark.createDataFrame(pdf), ["x", "o", "b"])
    assert n == 8000
    assert np.allclose(matrix, [[1, 0.5, 0.4], [0.5, 1, 0.3], [0.4, 0.3, 1]], atol=0.06)
    kinds = correlation.column_kinds(spark.createDataFrame(pdf), ["x", "o", "b"])
    assert kinds == {"x": "continuous", "o": "ordinal", "b": "binary"}


def test_factorability_of_simple_matrices():
    eye = np.eye(4)
    assert correlation.bartlett(eye, 100)[0] == pytest.approx(0, abs=1e-9)
    one_factor = np.full((4, 4), 0.5) + 0.5 * eye
    overall, each = correlation.kmo(one_factor)
    assert overall == pytest.approx(each[0])
    # partial correlations are 0.5 / (1 + 2 * 0.5) = 0.25
    assert overall == pytest.approx(0.25 / (0.25 + 0.0625))
    chi2, df, p = correlation.bartlett(one_factor, 200)
    assert (df, p < 1e-10, chi2 > 100) == (6, True, True)


def test_factor_loadings_and_rotation_recover_the_structure():
    load = np.array([[0.8, 0], [0.7, 0], [0.6, 0], [0, 0.8], [0, 0.7], [0, 0.6]])
    phi = np.array([[1, 0.3], [0.3, 1]])
    common = load @ phi @ load.T
    matrix = common + np.diag(1 - np.diag(common))
    model = factors.fit(matrix, list("abcdef"), 2)
    found = np.abs(model.loadings)
    order = [0, 1] if found[0, 0] > found[0, 1] else [1, 0]
    assert np.allclose(found[:, order], np.abs(load), atol=0.03)
    assert abs(abs(model.factor_correlations[0, 1]) - 0.3) < 0.05
    assert np.allclose(model.communalities, np.diag(common), atol=0.02)
    assert factors.velicer_map(matrix) in (1, 2)
    assert factors.usable_factors(4, 3) == 1


def test_factor_scores_follow_the_factor(spark):
    rng = np.random.default_rng(5)
    f = rng.normal(size=2000)
    pdf = pd.DataFrame({n: w * f + math.sqrt(1 - w * w) * rng.normal(size=2000) for n, w in zip("abcd", (0.9, 0.8, 0.7, 0.8), strict=True)})
    pdf["id"], pdf["f"] = range(2000), f
    df = spark.createDataFrame(pdf)
    matrix, _ = correlation.pearson_matrix(df, list("abcd"))
    out = factors.scores(df, factors.fit(matrix, list("abcd"), 1), ["s"], "id").join(df.select("id", "f"), "id")
    assert abs(out.agg(F.corr("s", "f")).first()[0]) > 0.93


def test_alpha_of_identical_columns_is_one(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 3.0 * i) for i in range(10)], "a double, b double, c double")
    assert correlation.cronbach_alpha(df, ["a", "b", "c"]).first()["alpha"] == pytest.approx(1.0)


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0, 0], [6, 0, 0], [0, 6, 0], [0, 0, 6]])
    rows = [(i, i % 4, (centres[i % 4] + rng.normal(scale=0.5, size=3)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, truth int, x array<double>")
    return df.withColumn("features", array_to_vector("x")).persist()


def test_clusterings_find_the_blobs(spark, blobs):
    km = clustering.label(blobs, clustering.kmeans(blobs, 4, starts=2), "a")
    ward = clustering.hierarchical(km, 4, micro=30, alias="b")
    both = agreement.agreement_matrix(ward, {"truth": "truth", "a": "a", "b": "b"})
    assert all(r["ari"] == 1.0 and r["nmi"] == 1.0 for r in both.collect())
    sweep = clustering.kmeans_sweep(blobs, (3, 4, 5), starts=2)
    assert sweep.where("best = 1").first()["k"] == 4


def test_internal_indices_match_their_definition(blobs):
    pdf = blobs.select("truth", "x").toPandas()
    x, t = np.stack(pdf.x), pdf.truth.to_numpy()
    mu = np.stack([x[t == k].mean(0) for k in range(4)])
    within = sum(((x[t == k] - mu[k]) ** 2).sum() for k in range(4))
    between = sum((t == k).sum() * ((mu[k] - x.mean(0)) ** 2).sum() for k in range(4))
    s = [np.sqrt(((x[t == k] - mu[k]) ** 2).sum(1)).mean() for k in range(4)]
    db = np.mean([max((s[i] + s[j]) / np.linalg.norm(mu[i] - mu[j]) for j in range(4) if j != i) for i in range(4)])
    got = clustering.internal_indices(blobs, "truth")
    assert got["calinski_harabasz"] == pytest.approx((between / 3) / (within / 396))
    assert got["davies_bouldin"] == pytest.approx(db)


def test_mixture_likelihood_matches_spark(blobs):
    model = mixtures.gaussian_mixture(blobs, 4, rounds=50)
    again = mixtures.log_likelihood(blobs, model)
    spark_fits = [GaussianMixture(k=4, seed=i, maxIter=100).fit(blobs.select("features")) for i in range(5)]
    best = max(m.summary.logLikelihood for m in spark_fits)
    assert again == pytest.approx(model.log_likelihood)
    assert again == pytest.approx(best, rel=1e-3)
    assert mixtures.mixture_parameters(3, 4) == 2 + 12 + 30


def test_refinement_sharpens_and_stops(blobs):
    start = np.array([[1.0, 0, 0], [5, 0, 0], [0, 5, 0], [0, 0, 5]])
    centres, log = clustering.refine(blobs, "x", start, rounds=6)
    assert log[-1][2] < 0.001
    assert np.allclose(np.sort(centres.max(1)), [0, 6, 6, 6], atol=0.6)
    soft = clustering.target_distribution(clustering.soft_assignment(blobs, "x", centres), 4)
    sums = soft.select(F.aggregate("q", F.lit(0.0), lambda a, v: a + v).alias("q"), F.aggregate("p", F.lit(0.0), lambda a, v: a + v).alias("p")).toPandas()
    assert np.allclose(sums.to_numpy(), 1)


def test_refinement_of_overlapping_groups_keeps_them_apart(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 1.0, size=(80, 3)) for c in ([0, 0, 0], [1.5, 0, 0], [0, 1.5, 0])])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, x array<double>")
    start = np.array([[0.2, 0.1, 0], [1, 0.2, 0], [0.2, 1, 0]])
    centres, log = clustering.refine(df, "x", start, rounds=60)
    apart = np.linalg.norm(centres[:, None] - centres, axis=2)[~np.eye(3, dtype=bool)]
    assert apart.min() > 0.5
    assert len(log) < 60 and log[-1][2] < 0.1
    assert clustering.refine(df.limit(0), "x", start)[1] == []


def test_quality_of_one_cluster_is_null(spark):
    df = spark.createDataFrame([(i, 0, [float(i), 1.0]) for i in range(5)], "id int, label int, x array<double>")
    df = embedding.as_vector(df, "x")
    assert clustering.quality(df, "label", "one") == ("one", None, None, None)


def test_agreement_properties(spark):
    rows = [(i, i % 3, (i % 3 + 1) % 3, 0) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, a int, b int, c int")
    got = {(r["row"], r["col"]): (r["ari"], r["nmi"]) for r in agreement.agreement_matrix(df, {x: x for x in "abc"}).collect()}
    assert got["a", "b"] == (1.0, 1.0)
    assert got["a", "c"] == (0.0, 0.0)
    counted = agreement.agreements(df, ["a", "b"]).agg(F.sum("high_confidence")).first()[0]
    aligned = agreement.align_labels(df, "a", "b", "a2")
    assert counted == 0
    assert agreement.agreements(aligned, ["a2", "b"]).agg(F.sum("high_confidence")).first()[0] == 90


def test_pca_reconstruction_is_exact_on_a_plane(spark):
    rng = np.random.default_rng(11)
    flat = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 5)) + 3
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(flat)], "id int, x array<double>")
    df = embedding.as_vector(df, "x")
    fit = embedding.fit_pca(df, 2)
    quality = embedding.reconstruction_quality(embedding.reconstruct(df, "id", fit))
    assert all(r["r2"] > 0.999999 for r in quality.collect())
    assert fit.explained.sum() == pytest.approx(1)


def test_ica_separates_independent_sources(spark):
    rng = np.random.default_rng(13)
    s = np.stack([rng.uniform(-1, 1, 4000), rng.laplace(size=4000)], 1)
    x = s @ np.array([[1.0, 0.5], [0.3, 1.0]])
    df = spark.createDataFrame([(i, *r.tolist(), *t.tolist()) for i, (r, t) in enumerate(zip(x, s, strict=True))], "id int, a double, b double, s1 double, s2 double")
    df = features.assemble(df, ["a", "b"])
    out = embedding.ica_scores(df, "id", embedding.fit_ica(df, 2)).join(df.select("id", "s1", "s2"), "id").toPandas()
    r = np.abs(np.corrcoef(out[["ic_1", "ic_2", "s1", "s2"]].T)[:2, 2:])
    assert r.max(1).min() > 0.97


def test_encoder_matches_numpy(spark):
    rng = np.random.default_rng(17)
    layers = [embedding.Dense(rng.normal(size=(4, 3)), rng.normal(size=3), rng.normal(size=3), rng.normal(size=3), True), embedding.Dense(rng.normal(size=(3, 2)), np.zeros(2))]
    x = rng.normal(size=(50, 4))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id int, x array<double>")
    got = embedding.encode(df, "id", "x", layers).orderBy("id").toPandas()[["z0", "z1"]].to_numpy()
    assert np.allclose(got, layers[1](layers[0](x)))


def test_rank_to_normal_is_standard_normal(spark):
    df = spark.range(5000).withColumn("x", F.exp(F.col("id") / 1000.0))
    out = features.rank_to_normal(df, "x", "z").agg(F.avg("z"), F.stddev("z"), F.corr("id", "z")).first()
    assert abs(out[0]) < 0.02 and abs(out[1] - 1) < 0.05 and out[2] > 0.95


def test_one_hot_unseen_value_becomes_the_first_label(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    labels = features.fit_labels(train, ["c"])
    assert labels == {"c": ["MISSING", "a", "b"]}
    row = features.one_hot_columns(spark.createDataFrame([("zz",)], "c string"), labels).first()
    assert (row["c__MISSING"], row["c__a"], row["c__b"]) == (1, 0, 0)
