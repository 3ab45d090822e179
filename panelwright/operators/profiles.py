"""What the clusters look like: tests, profiles, crosstabs and names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.functions.stats import chi2_sf
from panelwright.operators import ranking
from panelwright.operators.clustering import min_max


def kruskal_wallis(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """H with tie correction and its p-value per column.

    Works on counts per (column, value, group): the ranks belong to distinct
    values, so no raw row is ever ranked.
    """
    cells = ranking.value_counts(ranking.melt(df, columns, [group]), ["column", group])
    values = cells.groupBy("column", "value").agg(F.sum("n").alias("n"))
    ranks = ranking.with_positions(values, ["column"]).withColumn("rank", ranking.mid_rank())
    ties = ranks.groupBy("column").agg(
        F.max("total").alias("total"),
        F.sum(F.pow(F.col("n").cast("double"), F.lit(3)) - F.col("n")).alias("ties"),
    )
    per_group = (
        cells.join(ranks.select("column", "value", "rank"), ["column", "value"])
        .groupBy("column", group)
        .agg(F.sum(F.col("n") * F.col("rank")).alias("r"), F.sum("n").alias("m"))
        .groupBy("column")
        .agg(F.sum(F.col("r") * F.col("r") / F.col("m")).alias("spread"), F.count("*").alias("groups"))
    )
    n = F.col("total").cast("double")
    raw = 12 / (n * (n + 1)) * F.col("spread") - 3 * (n + 1)
    correction = 1 - F.col("ties") / (n * n * n - n)
    return per_group.join(ties, "column").select(
        "column",
        F.col("total").alias("n"),
        "groups",
        F.when(correction > 0, raw / correction).alias("h"),
    )


def with_p_value(tests: DataFrame, alpha: float = 0.05) -> DataFrame:
    @F.pandas_udf("double")
    def tail(h: pd.Series, groups: pd.Series) -> pd.Series:
        return pd.Series([chi2_sf(x, g - 1) if x == x and g > 1 else None for x, g in zip(h, groups, strict=True)])

    return tests.withColumn("p", tail("h", "groups")).withColumn(
        "significant", c.flag(F.col("p") < alpha)
    )


def profile_means(df: DataFrame, group: str, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Means per cluster with size and share."""
    sizes = df.groupBy(group).agg(
        F.count("*").alias("n"), *[F.round(F.avg(n), digits).alias(n) for n in columns]
    )
    total = F.sum("n").over(W.partitionBy())
    return sizes.withColumn("pct", F.round(F.col("n") * 100.0 / total, 1))


def profile_quantiles(
    df: DataFrame, group: str, columns: Sequence[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """Exact quantiles per cluster and column."""
    q = ranking.exact_quantiles(df, columns, probabilities, [group])
    return q.select(
        group, "column", "n", *[F.col("quantiles")[i].alias(x) for i, x in enumerate(names)]
    )


def profile_medians(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return profile_quantiles(df, group, columns, [0.5], ["median"])


def five_numbers(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return profile_quantiles(
        df, group, columns, [0, 0.25, 0.5, 0.75, 1], ["min", "p25", "p50", "p75", "max"]
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and quartiles per column."""
    long = ranking.melt(df, columns)
    stats = long.groupBy("column").agg(
        F.avg("value").alias("mean"),
        F.stddev("value").alias("stddev"),
    )
    quartiles = ranking.exact_quantiles(df, columns, [0, 0.25, 0.5, 0.75, 1]).select(
        "column",
        "n",
        *[F.col("quantiles")[i].alias(x) for i, x in enumerate(["min", "p25", "p50", "p75", "max"])],
    )
    return stats.join(quartiles, "column")


def normalised_profile(means: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Each column of a small table of means rescaled to 0..1 across clusters."""
    return means.select(group, *[min_max(n).alias(n) for n in columns])


def crosstab(df: DataFrame, group: str, column: str, values: Sequence[str], digits: int = 1) -> DataFrame:
    """Share of each declared value within the cluster, in percent of its known rows."""
    counts = df.groupBy(group).agg(
        F.count(column).alias("_n"), *[F.count_if(F.col(column) == v).alias(v) for v in values]
    )
    shares = {v: F.round(F.col(f"`{v}`") * 100.0 / F.col("_n"), digits) for v in values}
    return counts.select(group, *[s.alias(v) for v, s in shares.items()])


def crosstab_long(df: DataFrame, group: str, columns: Sequence[str], digits: int = 1) -> DataFrame:
    """The same for undeclared values of several columns: (group, column, value, n, pct)."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(n).alias("column"), F.col(n).cast("string").alias("value")) for n in columns])
    )
    counts = (
        df.select(group, cells.alias("cell"))
        .where("cell.value IS NOT NULL")
        .groupBy(group, "cell.column", "cell.value")
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy(group, "column"))
    return counts.withColumn("pct", F.round(F.col("n") * 100.0 / total, digits))


def outcome_heat(df: DataFrame, group: str, outcomes: Sequence[str], digits: int = 2) -> DataFrame:
    rates = {n: F.round(F.avg(n) * 100, digits) for n in outcomes}
    return df.groupBy(group).agg(*[r.alias(n) for n, r in rates.items()])


def histogram(
    df: DataFrame, column: str, bins: int, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Equal-width bins over the range of the data (or a given one) with counts and density."""
    value = F.col(column).cast("double")
    if low is None or high is None:
        ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
        lo, hi = ends["lo"], ends["hi"]
    else:
        lo, hi = F.lit(float(low)), F.lit(float(high))
    placed = df.select(value.alias("v"), lo.alias("lo"), hi.alias("hi")).where("v BETWEEN lo AND hi")
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = (
        placed.select(at.alias("bin"), "lo", width.alias("width"))
        .groupBy("bin", "lo", "width")
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy())
    return counts.select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("from"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("to"),
        "n",
        (F.col("n") / (total * F.col("width"))).alias("density"),
    )


def rule_names(normalised: DataFrame, group: str, rules: Sequence[tuple[Column, str]], otherwise: str) -> DataFrame:
    return normalised.select(group, c.first_matching(rules, otherwise).alias("auto_name"))


# Names of the rule-based risk profiles and their thresholds.
HIGH, LOW, LEVERED, MACRO, MATURE, MODERATE = (
    "HIGH RISK",
    "LOW RISK",
    "HIGH LEVERAGE",
    "MACRO RISK",
    "MATURE STABLE",
    "MODERATE RISK",
)


def risk_rules(credit: str, leverage: str, decay: str, cohort: str) -> list[tuple[Column, str]]:
    cr, lv, dt, co = (F.col(x) for x in (credit, leverage, decay, cohort))
    return [
        ((dt > 0.70) & (cr < 0.40), HIGH),
        ((cr > 0.70) & (dt < 0.30), LOW),
        (lv > 0.70, LEVERED),
        (co > 0.70, MACRO),
        ((dt < 0.30) & (cr > 0.50), MATURE),
    ]


def catalogue(names: DataFrame, sizes: DataFrame, group: str, given: Mapping[int, tuple[str, str]]) -> DataFrame:
    """Cluster, rule name, given name, risk level, size and share."""
    title = c.label(F.col(group), {k: v[0] for k, v in given.items()})
    level = c.label(F.col(group), {k: v[1] for k, v in given.items()})
    return names.join(sizes.select(group, "n", "pct"), group).select(
        group, "auto_name", title.alias("given_name"), level.alias("risk_level"), "n", "pct"
    )


def financial_validation(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.round(F.avg("is_default"), 4).alias("default_rate"),
        F.round(F.avg("ever_d180"), 4).alias("d180_rate"),
        F.round(F.avg(F.when(F.col("is_default") == 1, F.col("net_severity"))), 4).alias("severity_of_defaults"),
        F.round(F.avg("borrower_credit_score"), 2).alias("credit_score"),
        F.round(F.avg("orig_ltv"), 2).alias("ltv"),
    )


def missing_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per pattern of filled (1) and missing (0) columns, in column order."""
    mask = F.concat(*[F.when(c.is_blank(F.col(n).cast("string")), "0").otherwise("1") for n in columns])
    return df.groupBy(mask.alias("pattern")).agg(F.count("*").alias("n"))


def confidence_table(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.select(key, label, "n_agreements", "high_confidence")
