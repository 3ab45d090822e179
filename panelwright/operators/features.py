"""Feature preparation. Fitted parameters are a few numbers per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.functions import columns as c
from panelwright.functions.stats import normal_ppf
from panelwright.operators import ranking

MISSING = "MISSING"
#: Label of the values that a bounded vocabulary leaves out.
OVERFLOW = "OVERFLOW"
#: Distinct values that one task puts in order to find the most frequent ones.
VALUES_PER_TASK = 50_000


def encode_ordinals(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({f"{n}_ord": c.ordinal(n, values) for n, values in levels.items()})


def encode_yes_no(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({n: c.yes_no(n) for n in columns})


def flag_missing(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.withColumn(alias, F.col(column).isNull().cast("int"))


def fill_constant(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(value)) for n in columns})


def fill_from(df: DataFrame, column: str, other: str, plus: int = 0) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.col(other) + plus))


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    rows = ranking.exact_quantiles(df, columns, [0.5]).collect()
    return {r["column"]: r["quantiles"][0] for r in rows}


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns(
        {n: F.coalesce(F.col(n).cast("double"), F.lit(float(v))) for n, v in values.items()}
    )


def fill_median(df: DataFrame, columns: Sequence[str], train: DataFrame | None = None) -> DataFrame:
    """Exact median of the training rows (all rows if none are given)."""
    return fill_values(df, medians(train if train is not None else df, columns))


def fill_group_median(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Exact median of the group; a group without any value keeps NULL."""
    quantiles = ranking.exact_quantiles(df, columns, [0.5], [by])
    wide = quantiles.groupBy(F.col(by).alias("_group")).agg(
        *[
            F.max(F.when(F.col("column") == n, F.col("quantiles")[0])).alias(f"_median_{n}")
            for n in columns
        ]
    )
    joined = df.join(wide, df[by].eqNullSafe(wide["_group"]), "left")
    filled = {n: F.coalesce(F.col(n).cast("double"), F.col(f"_median_{n}")) for n in columns}
    return joined.withColumns(filled).select(*df.columns)


def fit_labels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted category labels per column, with a label of its own for NULL."""
    filled = df.select(*[F.coalesce(F.col(n).cast("string"), F.lit(MISSING)).alias(n) for n in columns])
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{n}_idx" for n in columns],
        stringOrderType="alphabetAsc",
    )
    model = indexer.fit(filled)
    return {n: list(labels) for n, labels in zip(columns, model.labelsArray, strict=True)}


def one_hot_columns(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 column per label; unseen values count as the first label."""
    extra = {}
    for n, known in labels.items():
        value = F.coalesce(F.col(n).cast("string"), F.lit(MISSING))
        value = F.when(value.isin(*known), value).otherwise(F.lit(known[0]))
        extra |= {f"{n}__{x}": (value == x).cast("int") for x in known}
    return df.withColumns(extra)


def label_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, label, n``: rows of each value of each column, null as MISSING; one exchange, combined before it."""
    cells = [
        F.struct(F.lit(n).alias("column"), F.coalesce(F.col(n).cast("string"), F.lit(MISSING)).alias("label")) for n in columns
    ]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    return long.groupBy("column", "label").agg(F.count("*").alias("n"))


def frequent_labels(
    df: DataFrame, columns: Sequence[str], most: int = 100, declared: Mapping[str, Sequence[str]] | None = None
) -> dict[str, list[str]]:
    """Per column the labels of a vocabulary of at most ``most``: the declared ones, and for the rest the most frequent (ties by
    label), sorted. OVERFLOW comes last in a column that has other values; a value of that very name counts among them.

    Counts are exact. The distinct values of a column are ranked in parts of some VALUES_PER_TASK, so that neither a task nor the
    driver sees them whole; the driver gets at most ``most`` + 1 labels a column. More declared labels than ``most`` are an error.
    A column without rows keeps its declared labels.
    """
    declared = {n: list(dict.fromkeys((declared or {}).get(n, ()))) for n in columns}
    for n, known in declared.items():
        if len(known) > most:
            raise ValueError(f"column {n} has {len(known)} declared labels, the vocabulary at most {most}")
        if OVERFLOW in known:
            raise ValueError(f"column {n} declares the label of the overflow")
    must = reduce(
        lambda a, b: a | b,
        [(F.col("column") == n) & F.col("label").isin(*known) for n, known in declared.items() if known],
        F.lit(False),
    )
    counts = label_counts(df, columns).where(~must)
    # one more than the room left tells whether any value is left out
    room = F.element_at(F.create_map(*[F.lit(x) for n in columns for x in (n, most - len(declared[n]) + 1)]), F.col("column"))
    parts = counts.select(F.greatest(F.ceil(F.count("*") / VALUES_PER_TASK), F.lit(1))).scalar()
    order = [(F.col("label") == OVERFLOW).cast("int"), F.desc("n"), F.col("label")]
    ranked = (
        counts.withColumn("part", F.pmod(F.xxhash64("label"), parts))
        .withColumn("place", F.row_number().over(W.partitionBy("column", "part").orderBy(*order)))
        .where(F.col("place") <= room)
        .withColumn("place", F.row_number().over(W.partitionBy("column").orderBy(*order)))
        .where(F.col("place") <= room)
    )
    found = {n: list(known) for n, known in declared.items()}
    over = set()
    for r in ranked.select("column", "label", "place", room.alias("room")).collect():
        if r["place"] == r["room"] or r["label"] == OVERFLOW:
            over.add(r["column"])
        else:
            found[r["column"]].append(r["label"])
    return {n: sorted(found[n]) + ([OVERFLOW] if n in over else []) for n in columns}


def one_hot_bounded(df: DataFrame, labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 column per label of a ``frequent_labels`` vocabulary; what it leaves out counts as OVERFLOW.

    A value that is in no label of a column without OVERFLOW, as new data may have, is an error of the running job.
    """
    extra = {}
    for n, known in labels.items():
        own = [x for x in known if x != OVERFLOW]
        value = F.coalesce(F.col(n).cast("string"), F.lit(MISSING))
        if OVERFLOW in known:
            other = F.lit(OVERFLOW)
        else:
            other = F.raise_error(F.concat(F.lit(f"column {n} has no label for "), value)).cast("string")
        value = F.when(value.isin(*own), value).otherwise(other)
        extra |= {f"{n}__{x}": (value == x).cast("int") for x in known}
    return df.withColumns(extra)


def one_hot_vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same through ``StringIndexer`` and ``OneHotEncoder``: one vector per column."""
    filled = df.withColumns({f"{n}_cat": F.coalesce(F.col(n).cast("string"), F.lit(MISSING)) for n in columns})
    indexed = StringIndexer(
        inputCols=[f"{n}_cat" for n in columns],
        outputCols=[f"{n}_idx" for n in columns],
        stringOrderType="alphabetAsc",
    ).fit(filled)
    encoder = OneHotEncoder(
        inputCols=[f"{n}_idx" for n in columns],
        outputCols=[f"{n}_hot" for n in columns],
        dropLast=False,
    )
    rows = indexed.transform(filled)
    out = encoder.fit(rows).transform(rows)
    return out.drop(*[f"{n}_cat" for n in columns], *[f"{n}_idx" for n in columns])


def moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate."""
    stats = [F.struct(F.avg(n).alias("m"), F.stddev_pop(n).alias("s")).alias(n) for n in columns]
    row = df.agg(*stats).first()
    return {n: (row[n]["m"], row[n]["s"]) for n in columns}


def scaled(n: str, mean: float, std: float) -> Column:
    return (F.col(n) - F.lit(float(mean))) / F.lit(float(std) if std else 1.0)


def standardise(
    df: DataFrame, columns: Sequence[str], train: DataFrame | None = None, suffix: str = "_scaled"
) -> DataFrame:
    """(value - mean) / population deviation, fitted on the training rows."""
    fitted = moments(train if train is not None else df, columns)
    return df.withColumns({f"{n}{suffix}": scaled(n, *fitted[n]) for n in columns})


def rank_to_normal(df: DataFrame, column: str, alias: str, points: int = 1000) -> DataFrame:
    """Map a column to normal scores through a grid of its quantiles."""
    probabilities = np.linspace(0, 1, points + 1)
    row = df.agg(F.percentile_approx(column, [float(p) for p in probabilities], 100_000).alias("q")).first()
    grid = np.asarray(row["q"], float)

    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        x = values.to_numpy(dtype=float)
        up = np.interp(x, grid, probabilities)
        down = -np.interp(-x, -grid[::-1], -probabilities[::-1])
        p = np.clip((up + down) / 2, 1e-7, 1 - 1e-7)
        return pd.Series(np.where(np.isnan(x), np.nan, normal_ppf(p)))

    return df.withColumn(alias, F.when(F.col(column).isNotNull(), score(F.col(column).cast("double"))))


def inverse_probability_weights(
    sample: DataFrame, population: DataFrame, stratum: str, alias: str = "weight"
) -> DataFrame:
    """Population share over sample share of the stratum, with mean one over the sample."""

    def shares(df: DataFrame, n: str) -> DataFrame:
        return df.groupBy(stratum).agg(F.count("*").alias(n))

    both = shares(sample, "s").join(shares(population, "p"), stratum)
    # one row per stratum: s/S and p/P as scalars, then normalised by the sample mean
    totals = both.agg(F.struct(F.sum("s").alias("s"), F.sum("p").alias("p"))).scalar()
    raw = both.withColumn("w", (F.col("p") / totals["p"]) / (F.col("s") / totals["s"]))
    mean = raw.agg(F.sum(F.col("w") * F.col("s")) / F.sum("s")).scalar()
    table = raw.select(stratum, (F.col("w") / mean).alias(alias))
    return sample.join(table, stratum, "left")


def assemble(df: DataFrame, columns: Sequence[str], alias: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=alias, handleInvalid="error").transform(df)


def embedding_input(
    df: DataFrame,
    continuous: Sequence[str],
    binary: Sequence[str],
    categorical: Sequence[str],
    zero_filled: Sequence[str],
    train: DataFrame | None = None,
    text_flags: Sequence[str] = ("first_time_buyer", "high_balance_loan_indicator"),
) -> tuple[DataFrame, list[str]]:
    """Imputed, scaled and one-hot encoded features plus the ordered feature names."""

    def prepare(rows: DataFrame) -> DataFrame:
        rows = flag_missing(rows, "co_borrower_credit_score", "co_borrower_fico_missing")
        rows = fill_from(rows, "time_to_first_delinquency", "loan_duration_months")
        rows = fill_constant(rows, zero_filled)
        rows = encode_yes_no(rows, text_flags)
        return fill_constant(rows, [b for b in binary if b not in text_flags])

    base = prepare(df)
    fit_on = prepare(train) if train is not None else base
    middle = medians(fit_on, continuous)
    filled = fill_values(base, middle)
    spread = moments(fill_values(fit_on, middle), continuous)
    labels = fit_labels(fit_on, categorical)
    ready = one_hot_columns(
        filled.withColumns({f"{n}_scaled": scaled(n, *spread[n]) for n in continuous}), labels
    )
    names = [f"{n}_scaled" for n in continuous] + [*binary, "co_borrower_fico_missing"]
    names += [f"{n}__{x}" for n, known in labels.items() for x in known]
    return ready, names
