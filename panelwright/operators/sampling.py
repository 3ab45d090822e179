"""Samples that can be repeated, and how well they represent the whole."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import columns as c

Fraction = Callable[[str | Column, int], Column]


def bernoulli(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def fixed_size(
    df: DataFrame, key: str, n: int, seed: int, fraction: Fraction = c.hash_fraction, bins: int = 4096
) -> DataFrame:
    """Exactly ``n`` rows (or all, if fewer) with the smallest hash of the key.

    A first pass counts rows per hash bin, a bounded table. Only the bins that can
    hold the ``n`` smallest hashes reach the final ordering.
    """
    u = fraction(key, seed)
    counts = df.groupBy(F.floor(u * bins).alias("bin")).agg(F.count("*").alias("n")).collect()
    kept, last = 0, bins
    for row in sorted(counts, key=lambda r: r["bin"]):
        kept += row["n"]
        if kept >= n:
            last = row["bin"]
            break
    return (
        df.withColumn("_u", u)
        .where(F.floor(F.col("_u") * bins) <= last)
        .orderBy("_u", key)
        .limit(n)
        .drop("_u")
    )


def entity_sample(df: DataFrame, entity: str, n: int, seed: int, fraction: Fraction = c.hash_fraction) -> DataFrame:
    """``n`` distinct entities."""
    return fixed_size(df.select(entity).distinct(), entity, n, seed, fraction)


def cell_fractions(
    counts: DataFrame, targets: Mapping[str, int], bins: Sequence[str]
) -> DataFrame:
    """Sampling fraction per (stratum, bin) cell from a table of cell counts.

    The target of a stratum is spread over its cells by size. Rows without a bin
    count towards the stratum but are never sampled.
    """
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("stratum_n"))
    wanted = c.label("stratum", {k: str(v) for k, v in targets.items()}).cast("bigint")
    cell = F.floor(F.col("target") * (F.col("n") / F.col("stratum_n")))
    return (
        counts.where(F.col("vintage_bin").isin(*bins))
        .join(totals, "stratum")
        .withColumn("target", wanted)
        .where(F.col("target").isNotNull())
        .withColumn("cell_target", cell)
        .withColumn("fraction", F.least(F.col("cell_target") / F.col("n"), F.lit(1.0)))
        .where("fraction > 0")
        .select("sample_key", "stratum", "vintage_bin", "n", "cell_target", "fraction")
    )


def cell_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("stratum", "vintage_bin", "sample_key").agg(F.count("*").alias("n"))


def stratified(
    df: DataFrame, fractions: DataFrame, key: str, seed: int, fraction: Fraction = c.hash_fraction
) -> DataFrame:
    """Keep a row when the hash of its key falls below the fraction of its cell.

    ``fractions`` has one row per listed stratum and bin, so its size is set by the
    rules, not by the data.
    """
    table = F.broadcast(fractions.select("sample_key", "fraction"))
    return (
        df.join(table, "sample_key")
        .where(fraction(key, seed) < F.col("fraction"))
        .drop("fraction")
        .select(*df.columns)
    )


def stratified_by(df: DataFrame, fractions: DataFrame, seed: int) -> DataFrame:
    """The same cells through Spark's own ``sampleBy``."""
    listed = {r["sample_key"]: r["fraction"] for r in fractions.collect()}
    return df.sampleBy("sample_key", listed, seed)


def hash_split(
    df: DataFrame, key: str, train: float, seed: int, fraction: Fraction = c.hash_fraction
) -> DataFrame:
    """Marks each row ``train`` or ``validation`` by the hash of its key. The hash is
    independent of the stratum, so every stratum is split in the same proportion."""
    return df.withColumn(
        "split", F.when(fraction(key, seed) < train, "train").otherwise("validation")
    )


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def smd(
    population: DataFrame, sample: DataFrame, columns: Sequence[str], weight: str | None = None
) -> DataFrame:
    """Difference of means in units of the population deviation, per column."""
    w = F.col(weight) if weight else F.lit(1.0)

    def sample_mean(n: str) -> Column:
        present = F.when(F.col(n).isNotNull(), w)
        return F.sum(F.col(n) * w) / F.sum(present)

    def unfold(df: DataFrame, measures: Callable[[str], dict[str, Column]]) -> DataFrame:
        rows = [
            F.struct(F.lit(n).alias("column"), *[m.alias(a) for a, m in measures(n).items()])
            for n in columns
        ]
        return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")

    whole = unfold(population, lambda n: {"pop_mean": F.avg(n), "pop_std": F.stddev(n)})
    part = unfold(sample, lambda n: {"sample_mean": sample_mean(n)})
    gap = F.abs(F.col("sample_mean") - F.col("pop_mean"))
    return (
        whole.join(part, "column")
        .withColumn("smd", F.coalesce(c.ratio(gap, "pop_std"), F.lit(0.0)))
        .withColumn("status", F.when(F.col("smd") < 0.1, "OK").otherwise("REVIEW"))
    )
