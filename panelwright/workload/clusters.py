"""Queries over clusterings, their quality and their agreement."""

from __future__ import annotations

import numpy as np
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from panelwright.operators import agreement, clustering, mixtures, sampling
from panelwright.functions import columns as c
from panelwright.workload import embedding as embedding_book
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
GOLD = f"WITH {fx.gold_cte()}"
#: Numbers of clusters that are tried.
K_RANGE = range(3, 9)


def _vectors(spark, sf):
    return embedding_book.vectors(spark, sf)


@book.query("m27_kmeans")
def m27(spark, sf):
    rows = _vectors(spark, sf)
    out = clustering.label(rows, clustering.kmeans(rows, 6), "cluster")
    return out.select("vec_id", "cluster")


def _scores(spark, sf):
    return embedding_book.independent_scores(spark, sf)


@book.query("m28_gaussian_mixture")
def m28(spark, sf):
    rows = _scores(spark, sf)
    model = mixtures.gaussian_mixture(rows, 3)
    return mixtures.mixture_labels(rows, model, "cluster").select("vec_id", "cluster", "uncertainty")


@book.query("m29_mixture_bic_aic")
def m29(spark, sf):
    rows = _scores(spark, sf)
    n, found = rows.count(), []
    for k, model in mixtures.fit_mixtures(rows, K_RANGE, starts=5, rounds=100).items():
        ll, d = model.log_likelihood, model.d
        found.append((k, mixtures.mixture_parameters(k, d), mixtures.bic(ll, k, d, n), mixtures.aic(ll, k, d)))
    return spark.createDataFrame(found, "k int, parameters int, bic double, aic double")


@book.query("m30_hierarchical_ward")
def m30(spark, sf):
    rows = _vectors(spark, sf)
    return clustering.hierarchical(rows, 6).select("vec_id", "cluster")


@book.query("m30_bisecting_kmeans")
def m30_bisecting(spark, sf):
    rows = _vectors(spark, sf)
    return clustering.label(rows, clustering.bisecting(rows, 6), "cluster").select("vec_id", "cluster")


# squared-distance silhouette from per-cluster sums, as closed form
_CELLS = (
    "WITH cells AS (SELECT vec_id, label, unnest(range(1, 65)) AS i, unnest(embedding)::double AS x FROM embeddings), "
    "centre AS (SELECT label, i, avg(x) AS m FROM cells GROUP BY 1, 2), "
    "size AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1), "
    "own AS (SELECT vec_id, label, sum((x - m) * (x - m)) AS d2 FROM cells JOIN centre USING (label, i) GROUP BY 1, 2), "
    "grand AS (SELECT i, avg(x) AS g FROM cells GROUP BY 1)"
)


@book.query(
    "m31_silhouette",
    f"{_CELLS}, norm AS (SELECT vec_id, label, sum(x * x) AS s FROM cells GROUP BY 1, 2), "
    "psi AS (SELECT label, sum(s) AS psi FROM norm GROUP BY 1), "
    "dots AS (SELECT c.vec_id, c.label AS mine, m.label AS other, sum(c.x * m.m) AS dot FROM cells c JOIN centre m ON c.i = m.i GROUP BY 1, 2, 3), "
    "dist AS (SELECT vec_id, mine, other, CASE WHEN mine = other THEN "
    "(size.n * s + psi - 2 * size.n * dot) / nullif(size.n - 1, 0) ELSE s + psi / size.n - 2 * dot END AS d "
    "FROM dots JOIN norm USING (vec_id) JOIN psi ON psi.label = other JOIN size ON size.label = other), "
    "ab AS (SELECT vec_id, max(CASE WHEN mine = other THEN d END) AS a, min(CASE WHEN mine <> other THEN d END) AS b FROM dist GROUP BY 1) "
    "SELECT round(avg((b - a) / greatest(a, b)), 5) AS silhouette FROM ab",
)
def m31(spark, sf):
    value = clustering.silhouette(_vectors(spark, sf), "label")
    return spark.createDataFrame([(round(value, 5),)], "silhouette double")


@book.query(
    "m32_calinski_harabasz_davies_bouldin",
    f"{_CELLS}, w AS (SELECT sum(d2) AS w FROM own), "
    "b AS (SELECT sum(n * (m - g) * (m - g)) AS b FROM centre JOIN grand USING (i) JOIN size USING (label)), "
    "s AS (SELECT label, avg(sqrt(d2)) AS s FROM own GROUP BY 1), "
    "gap AS (SELECT a.label AS p, z.label AS q, sqrt(sum((a.m - z.m) * (a.m - z.m))) AS d FROM centre a JOIN centre z ON a.i = z.i "
    "AND a.label <> z.label GROUP BY 1, 2), "
    "worst AS (SELECT p, max((x.s + y.s) / d) AS r FROM gap JOIN s x ON x.label = p JOIN s y ON y.label = q GROUP BY 1) "
    "SELECT round((b / ((SELECT count(*) FROM size) - 1)) / (w / ((SELECT sum(n) FROM size) - (SELECT count(*) FROM size))), 5) "
    "AS calinski_harabasz, round((SELECT avg(r) FROM worst), 5) AS davies_bouldin FROM b, w",
)
def m32(spark, sf):
    found = clustering.internal_indices(_vectors(spark, sf), "label")
    row = (round(found["calinski_harabasz"], 5), round(found["davies_bouldin"], 5))
    return spark.createDataFrame([row], "calinski_harabasz double, davies_bouldin double")


@book.query("m33_kmeans_sweep")
def m33(spark, sf):
    return clustering.kmeans_sweep(_vectors(spark, sf), K_RANGE)


@book.query("m34_generalisation_ratio")
def m34(spark, sf):
    rows = sampling.hash_split(_scores(spark, sf), "vec_id", 0.8, 42)
    train, validation = (rows.where(F.col("split") == s).drop("split") for s in ("train", "validation"))
    return mixtures.mixture_sweep(train, validation, K_RANGE)


def _label_means(spark, sf):
    rows = (
        _vectors(spark, sf)
        .groupBy("label")
        .agg(Summarizer.mean(F.col("features")).alias("m"))
        .orderBy("label")
        .collect()
    )
    return np.stack([r["m"].toArray() for r in rows])


_Q = (
    f"{_CELLS}, kern AS (SELECT c.vec_id, m.label AS j, 1 / (1 + sum((c.x - m.m) * (c.x - m.m))) AS t FROM cells c "
    "JOIN centre m ON c.i = m.i GROUP BY 1, 2), "
    "q AS (SELECT vec_id, j, t / sum(t) OVER (PARTITION BY vec_id) AS q FROM kern), "
    "f AS (SELECT j, sum(q) AS f FROM q GROUP BY 1), "
    "p AS (SELECT vec_id, j, q, (q * q / f) / sum(q * q / f) OVER (PARTITION BY vec_id) AS p FROM q JOIN f USING (j))"
)


def _soft(spark, sf):
    rows = fx.read(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    centres = _label_means(spark, sf)
    return clustering.target_distribution(clustering.soft_assignment(rows, "x", centres), len(centres))


def _long(df, column):
    return df.select("vec_id", F.posexplode(column).alias("j", column)).withColumn(column, F.round(column, 6))


@book.query("m35_soft_assignment", f"{_Q} SELECT vec_id, j, round(q, 6) AS q FROM q")
def m35(spark, sf):
    return _long(_soft(spark, sf), "q")


@book.query("m36_target_distribution", f"{_Q} SELECT vec_id, j, round(p, 6) AS p FROM p")
def m36(spark, sf):
    return _long(_soft(spark, sf), "p")


@book.query(
    "m37_divergence",
    f"{_Q} SELECT count(DISTINCT vec_id) AS n, round(sum(p * ln(p / q)) / count(DISTINCT vec_id), 6) AS kl FROM p",
)
def m37(spark, sf):
    return clustering.divergence(_soft(spark, sf)).withColumn("kl", F.round("kl", 6))


@book.query(
    "m37_label_change",
    f"{_Q}, hard AS (SELECT vec_id, arg_max(j, q) AS j FROM q GROUP BY 1) "
    "SELECT round(avg(CASE WHEN j <> label THEN 1.0 ELSE 0.0 END), 6) AS changed FROM hard JOIN embeddings USING (vec_id)",
)
def m37_change(spark, sf):
    rows = _soft(spark, sf).withColumn("hard", clustering.hard_label("q"))
    return clustering.label_change(rows, "label", "hard").withColumn("changed", F.round("changed", 6))


@book.query("m38_centroid_refinement")
def m38(spark, sf):
    rows = fx.read(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    _, log = clustering.refine(rows, "x", _label_means(spark, sf))
    return spark.createDataFrame(log, "round int, kl double, changed double")


@book.query("m39_method_comparison")
def m39(spark, sf):
    rows = _scores(spark, sf)
    model = clustering.kmeans(rows, 6)
    centres, _ = clustering.refine(rows, "x", model.centres)
    soft = clustering.soft_assignment(rows, "x", centres)
    labelled = {
        "k-means": clustering.label(rows, model, "cluster"),
        "mixture": mixtures.mixture_labels(rows, mixtures.gaussian_mixture(rows, 6), "cluster"),
        "ward": clustering.hierarchical(rows, 6),
        "soft assignment": soft.withColumn("cluster", clustering.hard_label("q")),
    }
    return clustering.compare(spark, [clustering.quality(df, "cluster", name) for name, df in labelled.items()])


# four labellings of the loans by rule, so that both engines have the same labels
LABELS = {"kmeans": "cluster_kmeans", "gmm": "cluster_gmm", "ward": "cluster_hc", "dec": "cluster_dec"}
_RULES = {
    "cluster_kmeans": "least(coalesce(max_delinquency_status, 0), 3)",
    "cluster_gmm": "CASE stratum WHEN 'performing' THEN 0 WHEN 'early_dlq' THEN 1 WHEN 'serious_dlq' THEN 2 ELSE 3 END",
    "cluster_hc": "ever_d90 + 2 * is_default",
    "cluster_dec": "least(months_delinquent_30plus, 3)",
}
LABELLED_CTE = (
    f"{GOLD}, labelled AS (SELECT *, " + ", ".join(f"cast({e} as integer) AS {n}" for n, e in _RULES.items()) + " FROM gold)"
)


#: Columns that the labels are made of.
_RULED = ["max_delinquency_status", "stratum", "ever_d90", "is_default", "months_delinquent_30plus"]


def labelled(spark, sf, *columns):
    """The labelled loans; with ``columns`` only these, the labels and what they are made of."""
    loans = fx.loan_table(spark, sf, *dict.fromkeys([*columns, *_RULED])) if columns else fx.loan_table(spark, sf)
    return loans.selectExpr("*", *[f"cast({e} as int) AS {n}" for n, e in _RULES.items()])


def _agreement_sql() -> str:
    cells = []
    for a, x in LABELS.items():
        for b, y in LABELS.items():
            cells.append(f"SELECT '{a}' AS r, '{b}' AS c, {x} AS a, {y} AS b, count(*) AS n FROM labelled GROUP BY {x}, {y}")
    pairs = "n * (n - 1) / 2.0::double"
    return (
        f"{LABELLED_CTE}, cells AS ({' UNION ALL '.join(cells)}), "
        f"t AS (SELECT r, c, sum(n)::double AS total, sum({pairs}) AS pairs, "
        "-sum(n * ln(n)) AS nl FROM cells GROUP BY 1, 2), "
        f"ma AS (SELECT r, c, sum({pairs}) AS pairs, -sum(n * ln(n)) AS nl FROM (SELECT r, c, a, sum(n)::double AS n FROM cells GROUP BY 1, 2, 3) GROUP BY 1, 2), "
        f"mb AS (SELECT r, c, sum({pairs}) AS pairs, -sum(n * ln(n)) AS nl FROM (SELECT r, c, b, sum(n)::double AS n FROM cells GROUP BY 1, 2, 3) GROUP BY 1, 2), "
        "j AS (SELECT t.r, t.c, total, t.pairs AS p, ma.pairs AS pa, mb.pairs AS pb, t.nl / total + ln(total) AS h, "
        "ma.nl / total + ln(total) AS ha, mb.nl / total + ln(total) AS hb FROM t JOIN ma USING (r, c) JOIN mb USING (r, c)) "
        "SELECT r AS \"row\", c AS col, round((p - pa * pb / (total * (total - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (total * (total - 1) / 2)), 3) AS ari, "
        "round((ha + hb - h) / ((ha + hb) / 2), 3) AS nmi FROM j"
    )


@book.query("m40_m41_agreement_matrix", _agreement_sql())
def m40(spark, sf):
    return agreement.agreement_matrix(labelled(spark, sf), LABELS)


_PAIRS = [(a, b) for i, a in enumerate(_RULES) for b in list(_RULES)[i + 1 :]]
_SAME = " + ".join(f"(CASE WHEN {a} = {b} THEN 1 ELSE 0 END)" for a, b in _PAIRS)


@book.query(
    "m42_m55_agreement_count",
    f"{LABELLED_CTE} SELECT loan_id, cluster_dec, {_SAME} AS n_agreements, "
    f"CASE WHEN {_SAME} = 6 THEN 1 ELSE 0 END AS high_confidence FROM labelled",
)
def m42(spark, sf):
    from panelwright.operators.profiles import confidence_table

    return confidence_table(agreement.agreements(labelled(spark, sf), list(_RULES)), "loan_id", "cluster_dec")


@book.query("m42_aligned_agreement_count")
def m42_aligned(spark, sf):
    rows = labelled(spark, sf)
    for n in list(_RULES)[:-1]:
        rows = agreement.align_labels(rows, n, "cluster_dec", n)
    counted = agreement.agreements(rows, list(_RULES))
    return counted.groupBy("n_agreements").agg(F.count("*").alias("n"))


@book.query(
    "m43_cluster_balance",
    f"{LABELLED_CTE}, sizes AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS method, count(*) AS n FROM labelled GROUP BY {x}" for m, x in LABELS.items())
    + ") SELECT method, round(stddev_samp(n), 4) AS std, min(n) AS \"min\", max(n) AS \"max\", "
    "CASE WHEN stddev_samp(n) < 500 THEN 1 ELSE 0 END AS balanced FROM sizes GROUP BY 1",
)
def m43(spark, sf):
    return agreement.balance(labelled(spark, sf), LABELS).withColumn("std", F.round("std", 4))
