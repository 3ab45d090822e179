"""Queries over cluster profiles, tests, crosstabs and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.operators import profiles
from panelwright.plans import ledger, segments
from panelwright.presets import mortgage
from panelwright.session import scratch_folder
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book
from panelwright.workload.clusters import GOLD, LABELLED_CTE, labelled

book = Book()
C = "cluster_dec"
_FACTORS = ["borrower_credit_score", "orig_ltv", "months_delinquent_30plus", "origination_year"]
_COLUMNS = mortgage.PROFILE_COLUMNS


@book.query(
    "m44_profile_means",
    f"{LABELLED_CTE} SELECT {C}, count(*) AS n, "
    + ", ".join(f"round(avg({n}), 4) AS {n}" for n in _COLUMNS)
    + f", round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS pct FROM labelled GROUP BY {C}",
)
def m44(spark, sf):
    return profiles.profile_means(labelled(spark, sf), C, _COLUMNS)


@book.query(
    "m44_profile_medians",
    f"{LABELLED_CTE} "
    + " UNION ALL ".join(
        f"SELECT {C}, '{n}' AS \"column\", count({n}) AS n, round(quantile_cont({n}, 0.5)::double, 4) AS median "
        f"FROM labelled GROUP BY {C} HAVING count({n}) > 0"
        for n in _COLUMNS
    ),
)
def m44_medians(spark, sf):
    return profiles.profile_medians(labelled(spark, sf), C, _COLUMNS).withColumn("median", F.round("median", 4))


_MEANS_CTE = (
    f"{LABELLED_CTE}, means AS (SELECT {C}, count(*) AS n, "
    + ", ".join(f"round(avg({n}), 4) AS {n}" for n in _FACTORS)
    + f" FROM labelled GROUP BY {C})"
)


def _scaled_sql(n: str) -> str:
    return f"({n} - min({n}) OVER ()) / (max({n}) OVER () - min({n}) OVER () + 1e-9)"


@book.query(
    "m45_normalised_profile",
    f"{_MEANS_CTE} SELECT {C}, " + ", ".join(f"round({_scaled_sql(n)}, 5) AS {n}" for n in _FACTORS) + " FROM means",
)
def m45(spark, sf):
    means = profiles.profile_means(labelled(spark, sf), C, _FACTORS)
    out = profiles.normalised_profile(means, C, _FACTORS)
    return out.select(C, *[F.round(n, 5).alias(n) for n in _FACTORS])


def _kruskal_sql(n: str) -> str:
    return (
        f"SELECT '{n}' AS \"column\", (SELECT count(*) FROM r_{n}) AS n, (SELECT count(DISTINCT {C}) FROM r_{n}) AS groups, "
        f"round((12.0 / (t * (t + 1)) * s - 3 * (t + 1)) / (1 - ties / (t * t * t - t)), 3) AS h FROM "
        f"(SELECT sum(r * r / m) AS s FROM (SELECT sum(rk) AS r, count(*)::double AS m FROM r_{n} GROUP BY {C})), "
        f"(SELECT sum(q * q * q - q) AS ties FROM (SELECT count(*)::double AS q FROM r_{n} GROUP BY v)), "
        f"(SELECT count(*)::double AS t FROM r_{n})"
    )


@book.query(
    "m46_kruskal_wallis",
    f"{LABELLED_CTE}, "
    + ", ".join(
        f"r_{n} AS (SELECT {C}, {n} AS v, rank() OVER (ORDER BY {n}) + (count(*) OVER (PARTITION BY {n}) - 1) / 2.0::double AS rk "
        f"FROM labelled WHERE {n} IS NOT NULL)"
        for n in _FACTORS
    )
    + " "
    + " UNION ALL ".join(_kruskal_sql(n) for n in _FACTORS),
)
def m46(spark, sf):
    return profiles.kruskal_wallis(labelled(spark, sf), C, _FACTORS).withColumn("h", F.round("h", 3))


@book.query("m46_kruskal_wallis_p_values")
def m46_p(spark, sf):
    return profiles.with_p_value(profiles.kruskal_wallis(labelled(spark, sf), C, _FACTORS))


@book.query(
    "m47_stratum_crosstab",
    f"{LABELLED_CTE} SELECT {C}, "
    + ", ".join(
        f"round(count(*) FILTER (WHERE stratum = '{s}') * 100.0 / count(stratum), 1) AS {s}" for s in mortgage.RISK.strata
    )
    + f" FROM labelled GROUP BY {C}",
)
def m47(spark, sf):
    return profiles.crosstab(labelled(spark, sf), C, "stratum", mortgage.RISK.strata)


_CROSSED = ["vintage_bin", "channel", "loan_purpose"]


@book.query(
    "m47_crosstab_long",
    f"{LABELLED_CTE} "
    + " UNION ALL ".join(
        f"SELECT {C}, '{n}' AS \"column\", {n} AS value, count(*) AS n, "
        f"round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY {C}), 1) AS pct FROM labelled "
        f"WHERE {n} IS NOT NULL GROUP BY {C}, {n}"
        for n in _CROSSED
    ),
)
def m47_long(spark, sf):
    return profiles.crosstab_long(labelled(spark, sf), C, _CROSSED)


@book.query(
    "m48_outcome_heat_table",
    f"{LABELLED_CTE} SELECT {C}, "
    + ", ".join(f"round(avg({n}) * 100, 2) AS {n}" for n in mortgage.OUTCOMES)
    + f" FROM labelled GROUP BY {C}",
)
def m48(spark, sf):
    return profiles.outcome_heat(labelled(spark, sf), C, mortgage.OUTCOMES)


_BOX = ["borrower_credit_score", "orig_ltv", "months_delinquent_30plus", "orig_upb"]


@book.query(
    "m49_five_number_summary",
    f"{LABELLED_CTE} "
    + " UNION ALL ".join(
        f"SELECT {C}, '{n}' AS \"column\", count({n}) AS n, "
        + ", ".join(
            f"round(quantile_cont({n}, {p})::double, 4) AS \"{a}\""
            for a, p in (("min", 0), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("max", 1))
        )
        + f" FROM labelled GROUP BY {C}"
        for n in _BOX
    ),
)
def m49(spark, sf):
    out = profiles.five_numbers(labelled(spark, sf, *_BOX), C, _BOX)
    return out.withColumns({n: F.round(n, 4) for n in ("min", "p25", "p50", "p75", "max")})


@book.query(
    "m50_histogram",
    f"{GOLD}, e AS (SELECT min(orig_ltv)::double AS lo, max(orig_ltv)::double AS hi FROM gold), "
    "b AS (SELECT cast(least(floor((orig_ltv - lo) / ((hi - lo) / 30)), 29) as integer) AS bin, lo, (hi - lo) / 30 AS w "
    "FROM gold, e WHERE orig_ltv IS NOT NULL) "
    "SELECT bin, round(lo + bin * w, 5) AS \"from\", round(lo + (bin + 1) * w, 5) AS \"to\", count(*) AS n, "
    "round(count(*) / (sum(count(*)) OVER () * w), 6) AS density FROM b GROUP BY bin, lo, w",
)
def m50(spark, sf):
    out = profiles.histogram(fx.loan_table(spark, sf, "orig_ltv"), "orig_ltv", 30)
    return out.withColumns({"from": F.round("from", 5), "to": F.round("to", 5), "density": F.round("density", 6)})


def _normalised(spark, sf):
    means = profiles.profile_means(labelled(spark, sf), C, _FACTORS)
    return means, profiles.normalised_profile(means, C, _FACTORS)


_RULE_SQL = (
    "CASE WHEN months_delinquent_30plus > 0.70 AND borrower_credit_score < 0.40 THEN 'HIGH RISK' "
    "WHEN borrower_credit_score > 0.70 AND months_delinquent_30plus < 0.30 THEN 'LOW RISK' "
    "WHEN orig_ltv > 0.70 THEN 'HIGH LEVERAGE' WHEN origination_year > 0.70 THEN 'MACRO RISK' "
    "WHEN months_delinquent_30plus < 0.30 AND borrower_credit_score > 0.50 THEN 'MATURE STABLE' ELSE 'MODERATE RISK' END"
)
_RULE_COLUMNS = ("borrower_credit_score", "orig_ltv", "months_delinquent_30plus", "origination_year")


@book.query(
    "m51_rule_based_names",
    f"{_MEANS_CTE}, scaled AS (SELECT {C}, " + ", ".join(f"{_scaled_sql(n)} AS {n}" for n in _FACTORS)
    + f" FROM means) SELECT {C}, {_RULE_SQL} AS auto_name FROM scaled",
)
def m51(spark, sf):
    _, scaled = _normalised(spark, sf)
    return profiles.rule_names(scaled, C, profiles.risk_rules(*_RULE_COLUMNS), profiles.MODERATE)


_GIVEN = {0: ("Clean", "LOW"), 1: ("Brief", "MODERATE"), 2: ("Repeated", "HIGH"), 3: ("Chronic", "VERY HIGH")}


@book.query(
    "m52_profile_catalogue",
    f"{_MEANS_CTE}, scaled AS (SELECT {C}, n, " + ", ".join(f"{_scaled_sql(n)} AS {n}" for n in _FACTORS)
    + f" FROM means) SELECT {C}, {_RULE_SQL} AS auto_name, CASE {C} "
    + " ".join(f"WHEN {k} THEN '{v[0]}'" for k, v in _GIVEN.items())
    + f" END AS given_name, CASE {C} "
    + " ".join(f"WHEN {k} THEN '{v[1]}'" for k, v in _GIVEN.items())
    + " END AS risk_level, n, round(n * 100.0 / sum(n) OVER (), 1) AS pct FROM scaled",
)
def m52(spark, sf):
    means, scaled = _normalised(spark, sf)
    names = profiles.rule_names(scaled, C, profiles.risk_rules(*_RULE_COLUMNS), profiles.MODERATE)
    return profiles.catalogue(names, means, C, _GIVEN)


@book.query(
    "m53_financial_validation",
    f"{LABELLED_CTE} SELECT {C}, count(*) AS n, round(avg(is_default), 4) AS default_rate, "
    "round(avg(ever_d180), 4) AS d180_rate, round(avg(net_severity) FILTER (WHERE is_default = 1), 4) AS severity_of_defaults, "
    f"round(avg(borrower_credit_score), 2) AS credit_score, round(avg(orig_ltv), 2) AS ltv FROM labelled GROUP BY {C}",
)
def m53(spark, sf):
    return profiles.financial_validation(labelled(spark, sf), C)


_MASKED = "borrower_credit_score co_borrower_credit_score dti orig_ltv mi_percentage vintage_bin".split()


@book.query(
    "m54_missing_patterns",
    f"{GOLD} SELECT concat("
    + ", ".join(f"CASE WHEN {n} IS NULL THEN '0' ELSE '1' END" for n in _MASKED)
    + ") AS pattern, count(*) AS n FROM gold GROUP BY 1",
)
def m54(spark, sf):
    return profiles.missing_patterns(fx.loan_table(spark, sf, *_MASKED), _MASKED)


#: Rows of the flow's sample per stratum; cells smaller than that are taken whole.
FLOW_TARGETS = {"performing": 25000, "early_dlq": 10000, "serious_dlq": 10000, "default": 5000}


@book.query("flow_samples_to_profiles")
def flow_samples_to_profiles(spark, sf):
    """Sample, latent space, clusters, profile tables and names of the loans as one flow with a ledger."""
    stages = segments.flow(FLOW_TARGETS, mortgage.SEED_A, k=4)
    sources = {"loans": fx.loan_folder(spark, sf)}
    done = ledger.run_flow(spark, stages, sources, scratch_folder(spark, "segments"))
    return done["profiles"].join(done["names"].select("cluster", "auto_name"), "cluster")
