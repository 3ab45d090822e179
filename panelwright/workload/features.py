"""Queries over feature preparation, correlation and factor scores of the loan table."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from panelwright.operators import correlation, factors, features, ranking, sampling
from panelwright.functions import columns as c
from panelwright.plans import segments
from panelwright.presets import mortgage
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
GOLD = f"WITH {fx.gold_cte()}"
VINTAGES = list(mortgage.RISK.vintages)


def _position(n: str, levels) -> str:
    cases = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(levels, 1))
    return f"CASE {n} {cases} END AS {n}_ord"


@book.query(
    "m01_ordinal_encoding",
    f"{GOLD} SELECT loan_id, {', '.join(_position(n, x) for n, x in mortgage.LEVELS.items())} FROM gold",
)
def m01(spark, sf):
    out = features.encode_ordinals(fx.loan_table(spark, sf), mortgage.LEVELS)
    return out.select("loan_id", *[f"{n}_ord" for n in mortgage.LEVELS])


@book.query(
    "m02_binary_map",
    f"{GOLD} SELECT loan_id, CASE WHEN first_time_buyer = 'Y' THEN 1 ELSE 0 END AS first_time_buyer, "
    "CASE WHEN high_balance_loan_indicator = 'Y' THEN 1 ELSE 0 END AS high_balance_loan_indicator FROM gold",
)
def m02(spark, sf):
    flags = ["first_time_buyer", "high_balance_loan_indicator"]
    return features.encode_yes_no(fx.loan_table(spark, sf, "loan_id", *flags), flags)


@book.query(
    "m03_m04_imputation",
    f"{GOLD}, mid AS (SELECT quantile_cont(dti, 0.5) AS d, quantile_cont(mi_percentage, 0.5) AS m FROM gold), "
    "era AS (SELECT vintage_bin AS v, quantile_cont(borrower_credit_score, 0.5) AS b FROM gold GROUP BY 1) "
    "SELECT loan_id, CASE WHEN co_borrower_credit_score IS NULL THEN 1 ELSE 0 END AS co_missing, "
    "coalesce(time_to_first_delinquency, loan_duration_months) AS time_to_first_delinquency, "
    "coalesce(time_to_default, loan_duration_months + 1) AS time_to_default, "
    "coalesce(ph_months_current_24, 0) AS ph_months_current_24, "
    "coalesce(dti, d)::double AS dti, coalesce(mi_percentage, m)::double AS mi_percentage, "
    "coalesce(borrower_credit_score, b)::double AS borrower_credit_score "
    "FROM gold CROSS JOIN mid JOIN era ON vintage_bin IS NOT DISTINCT FROM v",
)
def m03(spark, sf):
    wanted = (
        "loan_id co_missing time_to_first_delinquency time_to_default ph_months_current_24 dti "
        "mi_percentage borrower_credit_score"
    ).split()
    read = (
        "loan_id co_borrower_credit_score time_to_first_delinquency time_to_default loan_duration_months "
        "ph_months_current_24 dti mi_percentage borrower_credit_score vintage_bin"
    ).split()
    loans = features.flag_missing(fx.loan_table(spark, sf, *read), "co_borrower_credit_score", "co_missing")
    loans = features.fill_from(loans, "time_to_first_delinquency", "loan_duration_months")
    loans = features.fill_from(loans, "time_to_default", "loan_duration_months", plus=1)
    loans = features.fill_constant(loans, ["ph_months_current_24"])
    loans = features.fill_median(loans, ["dti", "mi_percentage"])
    return features.fill_group_median(loans, ["borrower_credit_score"], "vintage_bin").select(*wanted)


_HOT = {
    "channel": ["B", "C", "R"],
    "mi_type": ["1", "2", "3", "MISSING"],
    "num_units": ["1", "2", "3", "4", "MISSING"],
}


@book.query(
    "m05_one_hot_columns",
    f"{GOLD} SELECT loan_id, "
    + ", ".join(
        f"CASE WHEN coalesce(cast({n} as varchar), 'MISSING') = '{x}' THEN 1 ELSE 0 END AS {n}__{x}"
        for n, known in _HOT.items()
        for x in known
    )
    + " FROM gold",
)
def m05(spark, sf):
    loans = fx.loan_table(spark, sf, "loan_id", *_HOT)
    return features.one_hot_columns(loans, features.fit_labels(loans, list(_HOT))).drop(*_HOT)


@book.query("m05_one_hot_vectors")
def m05_vectors(spark, sf):
    loans = fx.loan_table(spark, sf, "loan_id", *_HOT)
    out = features.one_hot_vectors(loans, list(_HOT))
    return out.select("loan_id", *[F.col(f"{n}_hot").cast("string").alias(n) for n in _HOT])


_OPEN = ["property_state", "origination_date", "loan_id"]
_MOST = 8


@book.query(
    "m05_bounded_vocabulary",
    f"{GOLD}, cells AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS col, coalesce(cast({n} AS varchar), 'MISSING') AS label FROM gold" for n in _OPEN)
    + "), counts AS (SELECT col, label, count(*) AS n FROM cells GROUP BY 1, 2), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, label) AS place FROM counts) "
    f"SELECT col AS \"column\", CASE WHEN place <= {_MOST} THEN label ELSE '{features.OVERFLOW}' END AS label, "
    "cast(sum(n) AS bigint) AS n FROM ranked GROUP BY 1, 2",
)
def m05_bounded(spark, sf):
    loans = fx.loan_table(spark, sf, *_OPEN)
    labels = features.frequent_labels(loans, _OPEN, _MOST)
    hot = features.one_hot_bounded(loans, labels)
    names = [(n, x) for n in _OPEN for x in labels[n]]
    sums = hot.agg(*[F.sum(F.col(f"`{n}__{x}`")).alias(f"s{i}") for i, (n, x) in enumerate(names)])
    cells = [F.struct(F.lit(n).alias("column"), F.lit(x).alias("label"), F.col(f"s{i}").alias("n")) for i, (n, x) in enumerate(names)]
    return sums.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


_SCALED = ["orig_upb", "orig_ltv", "loan_duration_months"]


@book.query(
    "m06_standard_scaling",
    f"{GOLD}, train AS (SELECT * FROM gold WHERE (((cast(loan_id as bigint) % 1000003) + 777) * 2654435761) % 1000000 < 800000) "
    "SELECT loan_id, "
    + ", ".join(
        f"round(({n} - (SELECT avg({n}) FROM train)) / (SELECT stddev_pop({n}) FROM train), 5) AS {n}_scaled" for n in _SCALED
    )
    + " FROM gold",
)
def m06(spark, sf):
    loans = fx.loan_table(spark, sf).withColumn("k", F.col("loan_id").cast("bigint"))
    split = sampling.hash_split(loans, "k", 0.8, 777, c.modular_fraction)
    out = features.standardise(loans, _SCALED, train=split.where("split = 'train'"))
    return out.select("loan_id", *[F.round(f"{n}_scaled", 5).alias(f"{n}_scaled") for n in _SCALED])


@book.query("m07_rank_to_normal")
def m07(spark, sf):
    lines = fx.read(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice")
    return features.rank_to_normal(lines, "l_extendedprice", "score")


@book.query(
    "m08_inverse_probability_weights",
    f"{GOLD}, sample AS (SELECT * FROM gold WHERE cast(loan_id as bigint) % 3 = 0 OR stratum = 'default'), "
    "s AS (SELECT stratum, count(*) AS s FROM sample GROUP BY 1), p AS (SELECT stratum, count(*) AS p FROM gold GROUP BY 1), "
    "w AS (SELECT stratum, s, (p::double / (SELECT sum(p) FROM p)) / (s::double / (SELECT sum(s) FROM s)) AS w FROM s JOIN p USING (stratum)) "
    "SELECT stratum, s AS n, round(w / (SELECT sum(w * s) / sum(s) FROM w), 6) AS weight FROM w",
)
def m08(spark, sf):
    loans = fx.loan_table(spark, sf, "loan_id", "stratum")
    sample = loans.where((F.col("loan_id").cast("bigint") % 3 == 0) | (F.col("stratum") == "default"))
    weighted = features.inverse_probability_weights(sample, loans, "stratum")
    return weighted.groupBy("stratum").agg(F.count("*").alias("n"), F.round(F.max("weight"), 6).alias("weight"))


def embedding_rows(spark, sf):
    """(rows with one column per feature, names) of the whole loan table."""
    read = [*mortgage.CONTINUOUS, *mortgage.BINARY, *mortgage.CATEGORICAL, *mortgage.HISTORY_FEATURES]
    return features.embedding_input(
        fx.loan_table(spark, sf, *dict.fromkeys(["loan_id", *read])),
        mortgage.CONTINUOUS,
        mortgage.BINARY,
        mortgage.CATEGORICAL,
        mortgage.HISTORY_FEATURES,
    )


@book.query("m09_vector_assembly")
def m09(spark, sf):
    rows, names = embedding_rows(spark, sf)
    return features.assemble(rows, names).select("loan_id", F.col("features").cast("string").alias("features"))


_CORR = "orig_interest_rate orig_upb orig_ltv loan_duration_months max_delinquency_status months_delinquent_30plus".split()
_COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in _CORR)


def _matrix_sql(source: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 5) AS value FROM {source}"
        for a in _CORR
        for b in _CORR
    )
    return cells


@book.query("m10_pearson_matrix", f"{GOLD}, rows_ AS (SELECT * FROM gold WHERE {_COMPLETE}) {_matrix_sql('rows_')}")
def m10(spark, sf):
    matrix = correlation.pearson(fx.loan_table(spark, sf, *_CORR), _CORR)
    return matrix.withColumn("value", F.round("value", 5))


_RANKS = ", ".join(
    f"rank() OVER (ORDER BY {n}) + (count(*) OVER (PARTITION BY {n}) - 1) / 2.0 AS {n}" for n in _CORR
)


@book.query(
    "m10_w02_spearman_matrix",
    f"{GOLD}, rows_ AS (SELECT {_RANKS} FROM gold WHERE {_COMPLETE}) {_matrix_sql('rows_')}",
)
def m10_spearman(spark, sf):
    matrix = correlation.spearman(fx.loan_table(spark, sf), _CORR)
    return matrix.withColumn("value", F.round("value", 5))


@book.query(
    "w02_mid_ranks",
    f"{GOLD} SELECT 'orig_ltv' AS \"column\", orig_ltv::double AS value, count(*) AS n, "
    "sum(count(*)) OVER (ORDER BY orig_ltv)::bigint - count(*) + (count(*) + 1) / 2.0::double AS rank "
    "FROM gold WHERE orig_ltv IS NOT NULL GROUP BY orig_ltv",
)
def w02(spark, sf):
    counts = ranking.value_counts(ranking.melt(fx.loan_table(spark, sf), ["orig_ltv"]), ["column"])
    placed = ranking.with_positions(counts, ["column"])
    return placed.select("column", "value", "n", ranking.mid_rank().alias("rank"))


_MIXED = [*_CORR, "channel_ord", "occupancy_ord", "had_forbearance", "has_coborrower"]


def _mixed_matrix(spark, sf):
    loans = features.encode_ordinals(fx.loan_table(spark, sf), mortgage.LEVELS)
    return correlation.mixed(loans.withColumnRenamed("occupancy_status_ord", "occupancy_ord"), _MIXED)


@book.query("m11_mixed_correlation")
def m11(spark, sf):
    return correlation.to_long(spark, _mixed_matrix(spark, sf)[0], _MIXED)


@book.query("m12_m13_factorability")
def m12(spark, sf):
    matrix, n = correlation.pearson_matrix(fx.loan_table(spark, sf, *_CORR), _CORR)
    return correlation.factorability(spark, matrix, n, _CORR)


@book.query("m14_scree_and_factor_count")
def m14(spark, sf):
    matrix, _ = _mixed_matrix(spark, sf)
    wanted = factors.usable_factors(len(_MIXED), factors.velicer_map(matrix))
    return factors.scree(spark, matrix).withColumn("factors", F.lit(wanted))


@book.query("m15_factor_loadings")
def m15(spark, sf):
    matrix, _ = _mixed_matrix(spark, sf)
    return factors.loadings_table(spark, factors.fit(matrix, _MIXED))


_ORIGINATION = mortgage.ORIGINATION_BLOCK
_ORIGINATION_FACTORS = mortgage.ORIGINATION_FACTORS


def _origination_block(spark, sf):
    return segments.origination_block(fx.loan_table(spark, sf))


@book.query("m12_origination_factorability")
def m12_origination(spark, sf):
    matrix, n = correlation.mixed(_origination_block(spark, sf), _ORIGINATION)
    fixed = correlation.positive_definite(matrix)
    ends = [("least_eigenvalue_before", "all", fixed.least_before), ("least_eigenvalue_after", "all", fixed.least_after)]
    table = correlation.factorability(spark, fixed.matrix, n, _ORIGINATION)
    return table.unionByName(spark.createDataFrame(ends, table.schema))


@book.query("m15_origination_loadings")
def m15_origination(spark, sf):
    return factors.loadings_table(spark, segments.origination_model(_origination_block(spark, sf)))


@book.query("m16_factor_scores")
def m16(spark, sf):
    return segments.origination_scores(fx.loan_table(spark, sf))


_ORIGINATION_COMPLETE = " AND ".join(
    f"{n} IS NOT NULL" for n in _ORIGINATION if n not in segments.FLAGS and not n.endswith("_ord")
) + "".join(
    f" AND {n} IN ({', '.join(repr(x) for x in mortgage.LEVELS[n])})"
    for n in ("channel", "loan_purpose", "property_type", "occupancy_status")
)


@book.query(
    "m16_score_means",
    f"{GOLD}, names AS (SELECT unnest([{', '.join(repr(n) for n in _ORIGINATION_FACTORS)}]) AS factor) "
    "SELECT factor, n, 0.0::double AS mean FROM names, "
    f"(SELECT count(*) AS n FROM gold WHERE {_ORIGINATION_COMPLETE})",
)
def m16_means(spark, sf):
    """Scores exist for every complete row and centre on zero, whatever the rotation."""
    table = segments.origination_scores(fx.loan_table(spark, sf))
    long = ranking.melt(table, list(_ORIGINATION_FACTORS))
    return long.groupBy(F.col("column").alias("factor")).agg(
        F.count("*").alias("n"), F.abs(F.round(F.avg("value"), 6)).alias("mean")
    )


_BEHAVIOUR = mortgage.BEHAVIOUR_BLOCK
_HAVE = " AND ".join(f"{n} IS NOT NULL" for n in _BEHAVIOUR)
_PAIRS = " + ".join(f"corr({a}, {b})" for a, b in combinations(_BEHAVIOUR, 2))


@book.query(
    "m17_cronbach_alpha",
    f"{GOLD} SELECT count(*) AS n, round(4.0 / 3.0 * (1 - 4.0 / (4.0 + 2 * ({_PAIRS}))), 6) AS alpha FROM gold WHERE {_HAVE}",
)
def m17(spark, sf):
    return correlation.cronbach_alpha(fx.loan_table(spark, sf), _BEHAVIOUR).withColumn("alpha", F.round("alpha", 6))


_Z = " + ".join(f"({n} - avg({n}) OVER ()) / stddev_samp({n}) OVER ()" for n in _BEHAVIOUR)


@book.query(
    "m18_composite_index",
    f"{GOLD}, idx AS (SELECT loan_id, ({_Z}) / 4 AS indice FROM gold WHERE {_HAVE}) "
    "SELECT loan_id, round(indice, 5) AS indice, round((indice - (SELECT min(indice) FROM idx)) / "
    "((SELECT max(indice) FROM idx) - (SELECT min(indice) FROM idx)), 5) AS indice_01 FROM idx",
)
def m18(spark, sf):
    out = factors.composite_index(fx.loan_table(spark, sf), _BEHAVIOUR, "loan_id")
    return out.withColumns({n: F.round(n, 5) for n in ("indice", "indice_01")})


@book.query(
    "m19_context_columns",
    f"{GOLD}, states AS (SELECT property_state AS s, row_number() OVER (ORDER BY property_state) AS state_ord FROM "
    "(SELECT DISTINCT property_state FROM gold)) SELECT loan_id, "
    "round((origination_year - avg(origination_year) OVER ()) / stddev_samp(origination_year) OVER (), 5) AS orig_year_std, "
    "cast(substr(acquisition_quarter, 6, 1) as integer) AS acq_q_num, "
    f"{_position('vintage_bin', VINTAGES).replace('vintage_bin_ord', 'vintage_ord')}, state_ord "
    "FROM gold LEFT JOIN states ON property_state = s",
)
def m19_context(spark, sf):
    out = factors.context_columns(fx.loan_table(spark, sf), VINTAGES)
    return out.select("loan_id", F.round("orig_year_std", 5).alias("orig_year_std"), "acq_q_num", "vintage_ord", "state_ord")


@book.query("m19_latent_space")
def m19(spark, sf):
    return segments.latent_space(fx.loan_table(spark, sf))


_TARGETS = ["is_default", "ever_d90", "ever_d180", "ever_modified", "net_severity"]


@book.query(
    "m20_factor_outcome_correlation",
    f"{GOLD} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"row\", '{b}' AS col, round(corr({a}, {b}), 5) AS value FROM gold" for a in _CORR for b in _TARGETS
    ),
)
def m20(spark, sf):
    out = correlation.outcome_correlation(fx.loan_table(spark, sf), _CORR, _TARGETS)
    return out.withColumn("value", F.round("value", 5))


@book.query("m20_latent_outcome_correlation")
def m20_latent(spark, sf):
    """All factors of the latent space against the outcomes of the same loans."""
    loans = fx.loan_table(spark, sf)
    space = segments.latent_space(loans).select("loan_id", *segments.LATENT)
    rows = space.join(loans.select("loan_id", *_TARGETS), "loan_id")
    return correlation.outcome_correlation(rows, segments.LATENT, _TARGETS)


@book.query(
    "m20_index_outcome_correlation",
    f"{GOLD}, idx AS (SELECT *, ({_Z}) / 4 AS indice FROM gold WHERE {_HAVE}) "
    + " UNION ALL ".join(
        f"SELECT 'indice' AS \"row\", '{b}' AS col, round(corr(indice, {b}), 5) AS value FROM idx" for b in _TARGETS
    ),
)
def m20_index(spark, sf):
    loans = fx.loan_table(spark, sf)
    index = factors.composite_index(loans, _BEHAVIOUR, "loan_id").select("loan_id", "indice")
    rows = index.join(loans.select("loan_id", *_TARGETS), "loan_id")
    return correlation.outcome_correlation(rows, ["indice"], _TARGETS).withColumn("value", F.round("value", 5))
