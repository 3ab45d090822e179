"""Bounded vocabularies of open columns, and ranges that grow with the distinct values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelwright.operators import features, ranking


@pytest.fixture(scope="module")
def open_columns(spark):
    """A column of which a third is one value and the rest 200,000 different ones, and a closed one."""
    hot = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, "warm").otherwise(F.concat(F.lit("v"), "id"))
    closed = F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 4)
    return spark.range(300_000).select(hot.alias("a"), closed.alias("b"), F.lit(None).cast("string").alias("c"))


def test_vocabulary_of_an_open_column(open_columns):
    found = features.frequent_labels(open_columns, ["a", "b", "c"], most=6, declared={"a": ["rare", "v5"]})
    assert found["a"] == ["hot", "rare", "v10", "v100", "v5", "warm", features.OVERFLOW]
    assert found["b"] == ["1", "2", "3", features.MISSING] and found["c"] == [features.MISSING]
    hot = features.one_hot_bounded(open_columns, found)
    names = [f"{n}__{x}" for n, known in found.items() for x in known]
    sums = hot.agg(*[F.sum(f"`{x}`").alias(x) for x in names]).first().asDict()
    assert (sums["a__hot"], sums["a__warm"], sums["a__rare"], sums["a__v5"]) == (100_000, 200, 0, 1)
    for n in "abc":
        assert sum(v for x, v in sums.items() if x.startswith(f"{n}__")) == 300_000


def test_vocabulary_edges(spark, open_columns):
    with pytest.raises(ValueError):
        features.frequent_labels(open_columns, ["a"], most=1, declared={"a": ["x", "y"]})
    with pytest.raises(ValueError):
        features.frequent_labels(open_columns, ["a"], declared={"a": [features.OVERFLOW]})
    empty = open_columns.limit(0)
    assert features.frequent_labels(empty, ["a", "b"], declared={"a": ["x"]}) == {"a": ["x"], "b": []}
    named = spark.createDataFrame([("x",), (features.OVERFLOW,), (features.OVERFLOW,)], "a string")
    found = features.frequent_labels(named, ["a"], most=5)
    assert found == {"a": ["x", features.OVERFLOW]}
    assert features.one_hot_bounded(named, found).agg(F.sum("a__OVERFLOW")).first()[0] == 2
    exact = spark.createDataFrame([("x",), ("y",)], "a string")
    assert features.frequent_labels(exact, ["a"], most=2) == {"a": ["x", "y"]}
    with pytest.raises(PySparkException):
        features.one_hot_bounded(named, {"a": ["x"]}).collect()


@pytest.mark.parametrize("values", [1, 19_999, 20_001, 130_000])
def test_ranges_follow_the_distinct_values(spark, values):
    df = spark.range(2 * values).select((F.col("id") % values).cast("double").alias("x"))
    counts = ranking.value_counts(ranking.melt(df, ["x"]), ["column"])
    cuts = counts.select(ranking._cuts(counts, None).alias("c")).first()["c"]
    assert len(cuts) == max(1, -(-values // ranking.RANGE_VALUES)) - 1
    assert np.allclose(np.diff([0, *cuts, values]), values / (len(cuts) + 1), rtol=0.05, atol=2)
    got = ranking.exact_quantiles(df, ["x"], [0, 0.1, 0.5, 0.77, 1]).first()["quantiles"]
    assert np.allclose(got, np.quantile(np.repeat(np.arange(values), 2), [0, 0.1, 0.5, 0.77, 1]))


def test_mid_ranks_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_VALUES", 10)
    x = np.random.default_rng(1).integers(0, 3000, 5000).astype(float)
    counts = ranking.value_counts(ranking.melt(spark.createDataFrame(pd.DataFrame({"x": x})), ["x"]), ["column"])
    got = ranking.with_positions(counts, ["column"]).withColumn("r", ranking.mid_rank()).toPandas()
    want = pd.Series(x).rank().groupby(x).first()
    assert np.allclose(got.set_index("value")["r"].sort_index(), want)
