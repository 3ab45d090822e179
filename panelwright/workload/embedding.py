"""Queries over PCA, dense encoders and independent components. ``embeddings`` holds
64-dimensional vectors; the loan features give the mixed case."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from panelwright.operators import embedding, features
from panelwright.presets import mortgage
from panelwright.workload import features as feature_book
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()


def vectors(spark, sf):
    return embedding.as_vector(fx.read(spark, sf, "embeddings"), "embedding")


@book.query("m21_pca_embedding")
def m21(spark, sf):
    rows = vectors(spark, sf)
    return embedding.project(rows, "vec_id", embedding.fit_pca(rows, 16))


@book.query("m21_loan_pca_embedding")
def m21_loans(spark, sf):
    rows, names = feature_book.embedding_rows(spark, sf)
    table = features.assemble(rows, names).select("loan_id", "features")
    return embedding.project(table, "loan_id", embedding.fit_pca(table, 16))


@book.query("m21_pca_explained_variance")
def m21_variance(spark, sf):
    fit = embedding.fit_pca(vectors(spark, sf), 16)
    rows = [(i + 1, float(v)) for i, v in enumerate(fit.explained)]
    return spark.createDataFrame(rows, "component int, share double")


@book.query("m22_pca_reconstruction_quality")
def m22_pca(spark, sf):
    rows = vectors(spark, sf)
    pairs = embedding.reconstruct(rows, "vec_id", embedding.fit_pca(rows, 16))
    return embedding.reconstruction_quality(pairs)


@book.query(
    "m22_column_quality",
    f"WITH {fx.gold_cte()} SELECT 'orig_cltv' AS \"column\", 'r2' AS measure, "
    "round(corr(orig_cltv, orig_ltv) * corr(orig_cltv, orig_ltv), 6) AS value FROM gold UNION ALL "
    "SELECT 'ever_d90', 'accuracy', round(avg(CASE WHEN ever_d90 IS NOT DISTINCT FROM is_default THEN 1.0 ELSE 0.0 END), 6) FROM gold UNION ALL "
    "SELECT 'channel', 'accuracy', round(avg(CASE WHEN channel IS NOT DISTINCT FROM loan_purpose THEN 1.0 ELSE 0.0 END), 6) FROM gold",
)
def m22(spark, sf):
    loans = fx.loan_table(spark, sf)
    out = embedding.column_quality(
        loans, {"orig_cltv": "orig_ltv"}, {"ever_d90": "is_default", "channel": "loan_purpose"}
    )
    return out.withColumn("value", F.round("value", 6))


_UNITS = [f"z{i}" for i in range(64)]


@book.query(
    "m23_active_units",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT 'z{i}' AS \"column\", round(var_pop(embedding[{i + 1}]::double), 6) AS variance, "
        f"CASE WHEN var_pop(embedding[{i + 1}]::double) > 0.01 THEN 1 ELSE 0 END AS active FROM embeddings"
        for i in range(64)
    )
    + ")",
)
def m23(spark, sf):
    rows = fx.read(spark, sf, "embeddings")
    cells = rows.select(*[F.col("embedding")[i].cast("double").alias(f"z{i}") for i in range(64)])
    return embedding.active_units(cells, _UNITS).withColumn("variance", F.round("variance", 6))


# weights of a small two-layer encoder, by rule
_W1 = np.array([[((i * 7 + j * 3) % 11 - 5) / 10 for j in range(6)] for i in range(64)])
_W2 = np.array([[((i * 5 + j * 2) % 7 - 3) / 10 for j in range(3)] for i in range(6)])


def _encoder_sql() -> str:
    hidden = ", ".join(
        "greatest(("
        + " + ".join(f"x[{i + 1}] * ({_W1[i, j]:.1f})" for i in range(64))
        + f" + 0.1) * 2.0 - 0.05, 0) AS h{j}"
        for j in range(6)
    )
    out = ", ".join(
        "round(" + " + ".join(f"h{i} * ({_W2[i, j]:.1f})" for i in range(6)) + f", 5) AS z{j}" for j in range(3)
    )
    return (
        "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), "
        f"h AS (SELECT vec_id, {hidden} FROM v) SELECT vec_id, {out} FROM h"
    )


@book.query("m24_encoder_inference", _encoder_sql())
def m24(spark, sf):
    layers = [
        embedding.Dense(_W1, np.full(6, 0.1), scale=np.full(6, 2.0), shift=np.full(6, -0.05), relu=True),
        embedding.Dense(_W2, np.zeros(3)),
    ]
    out = embedding.encode(fx.read(spark, sf, "embeddings"), "vec_id", "embedding", layers)
    return out.select("vec_id", *[F.round(f"z{j}", 5).alias(f"z{j}") for j in range(3)])


@book.query("m25_independent_components")
def m25(spark, sf):
    rows = vectors(spark, sf)
    return embedding.ica_scores(rows, "vec_id", embedding.fit_ica(rows, 6))


#: Numbers of independent components that are tried.
COMPONENTS = range(5, 21)
_fits: dict[tuple, tuple] = {}


def _component_fits(spark, sf):
    """The fits of all numbers of components and their mean absolute kurtosis, made once a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _fits:
        rows = vectors(spark, sf)
        fits = embedding.fit_icas(rows, COMPONENTS)
        _fits[key] = fits, embedding.score_components(rows, "vec_id", fits)
    return _fits[key]


@book.query("m25_component_number_by_kurtosis")
def m25_choice(spark, sf):
    return embedding.component_table(spark, _component_fits(spark, sf)[1])


def independent_scores(spark, sf):
    """Independent components of the vectors, their number chosen by kurtosis, as ``features``; written once."""

    def build():
        fits, scored = _component_fits(spark, sf)
        scores = embedding.ica_scores(vectors(spark, sf), "vec_id", fits[max(scored, key=scored.get)])
        return scores.select("vec_id", F.array(*scores.columns[1:]).alias("x"))

    return embedding.as_vector(fx.table(spark, sf, "independent_scores", build), "x")


@book.query(
    "m26_kurtosis",
    " UNION ALL ".join(
        f"SELECT 'z{i}' AS \"column\", round(kurtosis_pop(embedding[{i + 1}]::double), 5) AS kurtosis FROM embeddings"
        for i in range(64)
    ),
)
def m26(spark, sf):
    rows = fx.read(spark, sf, "embeddings")
    cells = rows.select(*[F.col("embedding")[i].cast("double").alias(f"z{i}") for i in range(64)])
    return embedding.kurtosis_table(cells, _UNITS).withColumn("kurtosis", F.round("kurtosis", 5))
