"""How far several clusterings of the same entities agree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations, count, islice

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))


def contingencies(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Counts per pair of methods and pair of labels. Rows are first counted per
    combination of all labels; the pairs are unfolded from those counts."""
    combos = df.groupBy(*labels.values()).agg(F.count("*").alias("n"))
    pairs = [
        F.struct(
            F.lit(x).alias("row"),
            F.lit(y).alias("col"),
            F.col(labels[x]).cast("string").alias("a"),
            F.col(labels[y]).cast("string").alias("b"),
        )
        for x in labels
        for y in labels
    ]
    return (
        combos.select("n", F.explode(F.array(*pairs)).alias("p"))
        .groupBy("p.row", "p.col", "p.a", "p.b")
        .agg(F.sum("n").alias("n"))
    )


def _pairs_of(n: str):
    return F.col(n).cast("double") * (F.col(n) - 1) / 2


def agreement_matrix(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Adjusted Rand index and normalised mutual information of every pair of methods."""
    cells = contingencies(df, labels)
    keys = ["row", "col"]
    share = F.col("n") / F.col("total")
    entropy = -F.sum(share * F.ln(share))

    def margin(side: str, alias: str) -> DataFrame:
        totals = cells.groupBy(*keys).agg(F.sum("n").alias("total"))
        counted = cells.groupBy(*keys, side).agg(F.sum("n").alias("n")).join(totals, keys)
        return counted.groupBy(*keys).agg(
            F.sum(_pairs_of("n")).alias(f"pairs_{alias}"), entropy.alias(f"h_{alias}")
        )

    totals = cells.groupBy(*keys).agg(F.sum("n").alias("total"), F.sum(_pairs_of("n")).alias("pairs"))
    joint = (
        cells.join(totals.select(*keys, "total"), keys)
        .groupBy(*keys)
        .agg(entropy.alias("h_joint"))
    )
    table = reduce(
        lambda x, y: x.join(y, keys), [totals, joint, margin("a", "a"), margin("b", "b")]
    )
    expected = F.col("pairs_a") * F.col("pairs_b") / _pairs_of("total")
    top = (F.col("pairs_a") + F.col("pairs_b")) / 2
    ari = F.when(top == expected, 1.0).otherwise((F.col("pairs") - expected) / (top - expected))
    mean_entropy = (F.col("h_a") + F.col("h_b")) / 2
    mutual = F.col("h_a") + F.col("h_b") - F.col("h_joint")
    nmi = F.when(mean_entropy == 0, 1.0).otherwise(mutual / mean_entropy)
    return table.select(*keys, F.round(ari, 3).alias("ari"), F.round(nmi, 3).alias("nmi"))


def agreements(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Number of method pairs with equal labels; all equal means high confidence."""
    pairs = list(combinations(labels, 2))
    same = [(F.col(a) == F.col(b)).cast("int") for a, b in pairs]
    return df.withColumn("n_agreements", reduce(lambda x, y: x + y, same)).withColumn(
        "high_confidence", (F.col("n_agreements") == len(pairs)).cast("int")
    )


def best_assignment(gain: np.ndarray) -> np.ndarray:
    """Column of every row such that the sum of the chosen cells is greatest, no column twice. Square tables only.

    Rows are added one at a time along the shortest augmenting path, with prices on rows and columns.
    """
    n = len(gain)
    cost = gain.max(initial=0) - gain
    row_price, column_price = np.zeros(n), np.zeros(n)
    owner = np.full(n, -1)
    for new in range(n):
        reach, before = np.full(n, np.inf), np.full(n, -1)
        seen = np.zeros(n, bool)
        row, at, last = new, 0.0, -1
        while True:
            gap = at + cost[row] - row_price[row] - column_price
            nearer = ~seen & (gap < reach)
            reach[nearer], before[nearer] = gap[nearer], last
            last = int(np.argmin(np.where(seen, np.inf, reach)))
            at = reach[last]
            seen[last] = True
            if owner[last] < 0:
                break
            row = owner[last]
        # only columns reached before the last one change their price, and so do the rows that own them
        inner = seen & (owner >= 0)
        row_price[owner[inner]] += at - reach[inner]
        row_price[new] += at
        column_price[inner] -= at - reach[inner]
        while last >= 0:
            prior = before[last]
            owner[last] = owner[prior] if prior >= 0 else new
            last = prior
    chosen = np.empty(n, int)
    chosen[owner] = np.arange(n)
    return chosen


def align_labels(df: DataFrame, label: str, reference: str, alias: str) -> DataFrame:
    """Renames integer labels so that as many rows as possible carry their reference label.

    The renaming is the optimal one to one assignment on the k x k contingency table, which alone reaches the driver.
    Labels beyond the number of reference labels get the next free numbers, so no two labels become one. Null labels
    stay null and count for nothing.
    """
    cells = contingency(df, label, reference).where("a IS NOT NULL").collect()
    own = sorted({r["a"] for r in cells})
    others = sorted({r["b"] for r in cells if r["b"] is not None})
    if not own:
        return df.withColumn(alias, F.col(label))
    free = count(max([*own, *others]) + 1)
    targets = others + list(islice(free, max(len(own) - len(others), 0)))
    gain = np.zeros((len(targets), len(targets)))
    for r in cells:
        if r["b"] is not None:
            gain[own.index(r["a"]), targets.index(r["b"])] = r["n"]
    mapping = {a: targets[j] for a, j in zip(own, best_assignment(gain), strict=False)}
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return df.withColumn(alias, F.element_at(F.create_map(*pairs), F.col(label)))


def balance(df: DataFrame, labels: Mapping[str, str], limit: float = 500.0) -> DataFrame:
    """Spread of the cluster sizes per method."""
    cells = contingencies(df, labels).where("row = col")
    return (
        cells.groupBy(F.col("row").alias("method"))
        .agg(
            F.stddev_samp("n").alias("std"),
            F.min("n").alias("min"),
            F.max("n").alias("max"),
        )
        .withColumn("balanced", (F.col("std") < limit).cast("int"))
    )
