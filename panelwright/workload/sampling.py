"""Queries over samples, splits and representativeness. Where DuckDB checks a sample,
the hash is modular arithmetic on the integer loan number, which both engines share."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.operators import features, sampling
from panelwright.presets import mortgage
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
TARGETS = {"performing": 2500, "early_dlq": 1000, "serious_dlq": 1000, "default": 500}
VINTAGES = list(mortgage.RISK.vintages)


def _loans(spark, sf):
    return fx.loan_table(spark, sf).withColumn("k", F.col("loan_id").cast("bigint"))


def _u(seed: int, key: str = "k") -> str:
    return f"(((({key} % 1000003) + {seed}) * 2654435761) % 1000000) / 1e6"


def _cells() -> str:
    wanted = " ".join(f"WHEN '{s}' THEN {n}" for s, n in TARGETS.items())
    bins = ", ".join(f"'{v}'" for v in VINTAGES)
    return f"""counted AS (SELECT stratum, vintage_bin, sample_key, count(*) AS n FROM gold GROUP BY 1, 2, 3),
totals AS (SELECT stratum, sum(n) AS stratum_n FROM counted GROUP BY 1),
cells AS (SELECT sample_key, stratum, vintage_bin, n,
    cast(floor((CASE stratum {wanted} END) * (cast(n as double) / cast(stratum_n as double))) as bigint) AS cell_target
  FROM counted JOIN totals USING (stratum) WHERE vintage_bin IN ({bins})),
fractions AS (SELECT *, least(cast(cell_target as double) / n, 1.0) AS fraction FROM cells WHERE cell_target > 0)"""


@book.query("o04_bernoulli_sample")
def o04(spark, sf):
    return sampling.bernoulli(fx.silver_table(spark, sf).select("loan_id", "orig_upb"), 0.05, 42)


@book.query(
    "o05_fixed_size_sample",
    f"WITH {fx.gold_cte()}, keyed AS (SELECT loan_id, stratum, {_u(7, 'cast(loan_id as bigint)')} AS u FROM gold) "
    "SELECT loan_id, stratum FROM keyed ORDER BY u, loan_id LIMIT 1000",
)
def o05(spark, sf):
    loans = fx.loan_table(spark, sf, "loan_id", "stratum")

    def by_number(key, seed):
        return c.modular_fraction(F.col(key).cast("bigint"), seed)

    return sampling.fixed_size(loans, "loan_id", 1000, 7, by_number)


@book.query("o06_entity_sample")
def o06(spark, sf):
    return sampling.entity_sample(fx.silver_table(spark, sf), "loan_id", 2000, 42)


def _fractions(loans):
    return sampling.cell_fractions(sampling.cell_counts(loans), TARGETS, VINTAGES)


@book.query(
    "o07_cell_fractions",
    f"WITH {fx.gold_cte()}, {_cells()} SELECT sample_key, stratum, vintage_bin, n, cell_target, "
    "round(fraction, 8) AS fraction FROM fractions",
)
def o07(spark, sf):
    return _fractions(fx.loan_table(spark, sf)).withColumn("fraction", F.round("fraction", 8))


@book.query(
    "o08_stratified_hash_sample",
    f"WITH {fx.gold_cte()}, {_cells()} SELECT loan_id, sample_key FROM gold JOIN "
    f"(SELECT sample_key, fraction FROM fractions) USING (sample_key) "
    f"WHERE {_u(42, 'cast(loan_id as bigint)')} < fraction",
)
def o08(spark, sf):
    loans = _loans(spark, sf).select("loan_id", "k", "sample_key", "stratum", "vintage_bin")
    return sampling.stratified(loans, _fractions(loans), "k", 42, c.modular_fraction).select("loan_id", "sample_key")


@book.query("o08_sample_by")
def o08_by(spark, sf):
    loans = fx.loan_table(spark, sf, "loan_id", "sample_key", "stratum", "vintage_bin")
    return sampling.stratified_by(loans, _fractions(loans), 42).select("loan_id", "sample_key")


@book.query(
    "o09_stratified_split",
    f"WITH {fx.gold_cte()} SELECT stratum, CASE WHEN {_u(777, 'cast(loan_id as bigint)')} < 0.8 THEN 'train' "
    "ELSE 'validation' END AS split, count(*) AS n FROM gold GROUP BY 1, 2",
)
def o09(spark, sf):
    split = sampling.hash_split(_loans(spark, sf), "k", 0.8, 777, c.modular_fraction)
    return split.groupBy("stratum", "split").agg(F.count("*").alias("n"))


@book.query("o10_random_split")
def o10(spark, sf):
    parts = sampling.random_split(fx.silver_table(spark, sf).select("loan_id"), [0.6, 0.4], 42)
    counted = [p.agg(F.count("*").alias("n")).select(F.lit(i).alias("part"), "n") for i, p in enumerate(parts)]
    return counted[0].unionByName(counted[1])


def _smd_sql(weighted: bool) -> str:
    w = "weight" if weighted else "1.0"
    rows = " UNION ALL ".join(
        f"SELECT '{n}' AS \"column\", (SELECT avg({n}) FROM gold) AS pop_mean, (SELECT stddev({n}) FROM gold) AS pop_std, "
        f"(SELECT sum({n} * {w}) / sum(CASE WHEN {n} IS NOT NULL THEN {w} END) FROM picked) AS sample_mean"
        for n in mortgage.SMD_COLUMNS
    )
    weight = (
        ", sizes AS (SELECT stratum, count(*) AS s FROM chosen GROUP BY 1), "
        "whole AS (SELECT stratum, count(*) AS p FROM gold GROUP BY 1), "
        "raw_weights AS (SELECT stratum, s, (p::double / (SELECT sum(p) FROM whole WHERE stratum IN (SELECT stratum FROM sizes))) "
        "/ (s::double / (SELECT sum(s) FROM sizes)) AS w FROM sizes JOIN whole USING (stratum)), "
        "picked AS (SELECT c.*, w / (SELECT sum(w * s) / sum(s) FROM raw_weights) AS weight FROM chosen c JOIN raw_weights USING (stratum))"
        if weighted
        else ", picked AS (SELECT * FROM chosen)"
    )
    return (
        f"WITH {fx.gold_cte()}, {_cells()}, chosen AS (SELECT gold.* FROM gold JOIN (SELECT sample_key AS sk, fraction "
        f"FROM fractions) f ON gold.sample_key = f.sk WHERE {_u(42, 'cast(loan_id as bigint)')} < fraction){weight}, "
        f"stats AS ({rows}) SELECT \"column\", round(pop_mean, 4) AS pop_mean, round(pop_std, 4) AS pop_std, "
        "round(sample_mean, 4) AS sample_mean, round(abs(sample_mean - pop_mean) / pop_std, 4) AS smd, "
        "CASE WHEN abs(sample_mean - pop_mean) / pop_std < 0.1 THEN 'OK' ELSE 'REVIEW' END AS status FROM stats"
    )


def _smd(spark, sf, weighted):
    loans = _loans(spark, sf).select("loan_id", "k", "sample_key", "stratum", "vintage_bin", *mortgage.SMD_COLUMNS)
    sample = sampling.stratified(loans, _fractions(loans), "k", 42, c.modular_fraction)
    weight = None
    if weighted:
        sample, weight = features.inverse_probability_weights(sample, loans, "stratum"), "weight"
    report = sampling.smd(loans, sample, mortgage.SMD_COLUMNS, weight)
    return report.withColumns({n: F.round(n, 4) for n in ("pop_mean", "pop_std", "sample_mean", "smd")})


@book.query("o11_sample_smd", _smd_sql(False))
def o11(spark, sf):
    return _smd(spark, sf, False)


@book.query("o11_weighted_smd", _smd_sql(True))
def o11_weighted(spark, sf):
    return _smd(spark, sf, True)
