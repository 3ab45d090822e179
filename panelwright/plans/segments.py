"""From the loan table to named segments: sample, latent space, clusters, profile tables, names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import clustering, correlation, factors, features, profiles, ranking
from panelwright.plans import stages
from panelwright.plans.ledger import Stage
from panelwright.presets import mortgage

KEY = "loan_id"
FLAGS = ("first_time_buyer", "high_balance_loan_indicator")
INDEX, COHORT = "comp_F_deterioro", "macro_F_cohorte"
LATENT = (*mortgage.ORIGINATION_FACTORS, INDEX, COHORT)
#: Columns the rule-based names look at: credit, leverage, deterioration and cohort.
NAMED_BY = ("orig_F_crediticia", "orig_F_apalancamiento", INDEX, COHORT)


def origination_block(loans: DataFrame) -> DataFrame:
    """The loans with the 16 columns of the origination block as numbers."""
    coded = features.encode_ordinals(loans, mortgage.LEVELS)
    return features.encode_yes_no(coded, list(FLAGS)).withColumnRenamed("occupancy_status_ord", "occupancy_ord")


def origination_model(block: DataFrame) -> factors.FactorModel:
    matrix, _ = correlation.mixed(block, mortgage.ORIGINATION_BLOCK)
    return factors.fit_blocks(matrix, mortgage.ORIGINATION_BLOCK, mortgage.ORIGINATION_FACTORS)


def origination_scores(loans: DataFrame) -> DataFrame:
    block = origination_block(loans)
    return factors.scores(block, origination_model(block), list(mortgage.ORIGINATION_FACTORS), KEY)


def latent_space(loans: DataFrame) -> DataFrame:
    """Four origination factors, the behaviour index, one cohort factor and the state."""
    context = factors.context_columns(loans, list(mortgage.RISK.vintages))
    matrix, _ = correlation.pearson_matrix(context, mortgage.CONTEXT_BLOCK)
    cohort = factors.scores(context, factors.fit(matrix, mortgage.CONTEXT_BLOCK, 1), [COHORT], KEY)
    index = factors.composite_index(loans, mortgage.BEHAVIOUR_BLOCK, KEY).select(KEY, F.col("indice").alias(INDEX))
    covariates = context.select(KEY, "state_ord", "property_state")
    return factors.latent_space([origination_scores(loans), index, cohort], covariates, KEY)


# --- the stages of the flow -------------------------------------------------------------


def sample(spark: SparkSession, loans: DataFrame, targets: Mapping[str, int], seed: int) -> DataFrame:
    return stages.draw_sample(loans, dict(targets), mortgage.RISK, seed, loans.columns, KEY)


def latent(spark: SparkSession, loans: DataFrame) -> DataFrame:
    return latent_space(loans)


def clusters(spark: SparkSession, space: DataFrame, k: int, starts: int) -> DataFrame:
    """Every loan of the latent space with the nearest of k centroids of its standardised factors."""
    spread = features.moments(space, LATENT)
    scaled = space.select(KEY, *[features.scaled(n, *spread[n]).alias(n) for n in LATENT])
    rows = features.assemble(scaled, list(LATENT)).select(KEY, "features")
    return clustering.label(rows, clustering.kmeans(rows, k, starts=starts), "cluster").select(KEY, "cluster")


def profile_tables(
    spark: SparkSession, loans: DataFrame, space: DataFrame, labels: DataFrame, columns: Sequence[str], outcomes: Sequence[str]
) -> DataFrame:
    """Long table (cluster, table, column, value): means of factors and loan columns, medians, outcome rates in percent."""
    extra = sorted({*columns, *outcomes})
    rows = labels.join(space.select(KEY, *LATENT), KEY).join(loans.select(KEY, *extra), KEY)
    means = _unfolded(profiles.profile_means(rows, "cluster", [*LATENT, *columns]), ["n", "pct", *LATENT, *columns], "mean")
    rates = _unfolded(profiles.outcome_heat(rows, "cluster", outcomes), outcomes, "outcome")
    medians = profiles.profile_medians(rows, "cluster", columns).select(
        "cluster", F.lit("median").alias("table"), "column", F.col("median").cast("double").alias("value")
    )
    return reduce(DataFrame.unionByName, [means, rates, medians])


def _unfolded(wide: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    return ranking.melt(wide.withColumn("_table", F.lit(table)), columns, ["cluster", "_table"]).select(
        "cluster", F.col("_table").alias("table"), "column", "value"
    )


def names(spark: SparkSession, tables: DataFrame) -> DataFrame:
    """Rule-based name, size and share of every cluster, from its mean factors rescaled over the clusters."""
    means = (
        tables.where("table = 'mean'").groupBy("cluster").pivot("column", [*NAMED_BY, "n", "pct"]).agg(F.first("value"))
    )
    scaled = profiles.normalised_profile(means, "cluster", NAMED_BY)
    named = profiles.rule_names(scaled, "cluster", profiles.risk_rules(*NAMED_BY), profiles.MODERATE)
    return named.join(means.select("cluster", F.col("n").cast("bigint").alias("n"), "pct"), "cluster")


def flow(targets: Mapping[str, int], seed: int, k: int, starts: int = 20) -> list[Stage]:
    """The stages over a source named ``loans``, to be run with a ledger."""
    shown = {"columns": mortgage.PROFILE_COLUMNS, "outcomes": mortgage.OUTCOMES}
    return [
        Stage("sample", sample, ("loans",), {"targets": dict(targets), "seed": seed}),
        Stage("latent", latent, ("sample",)),
        Stage("clusters", clusters, ("latent",), {"k": k, "starts": starts}),
        Stage("profiles", profile_tables, ("sample", "latent", "clusters"), shown),
        Stage("names", names, ("profiles",)),
    ]
