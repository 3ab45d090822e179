import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelwright.operators import correlation, profiles, ranking, sampling
from panelwright.functions import columns as c


def _frame(spark, values, groups=None):
    groups = groups or ["g"] * len(values)
    return spark.createDataFrame(list(zip(groups, values, strict=True)), "g string, x double")


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_quantiles_equal_numpy(spark, values):
    df = _frame(spark, [float(v) for v in values])
    row = ranking.exact_quantiles(df, ["x"], [0, 0.25, 0.5, 0.9, 1], buckets=4).first()
    assert np.allclose(row["quantiles"], np.quantile(values, [0, 0.25, 0.5, 0.9, 1]))


def test_positions_with_a_hot_value_and_a_null_group(spark):
    values = [5.0] * 500 + [float(i) for i in range(200)]
    groups = ["a"] * 350 + [None] * 350
    df = _frame(spark, values, groups)
    counts = ranking.value_counts(ranking.melt(df, ["x"], ["g"]), ["g", "column"])
    out = ranking.with_positions(counts, ["g", "column"], buckets=8).withColumn("rank", ranking.mid_rank()).toPandas()
    for g in ("a", None):
        mine = np.array([v for v, k in zip(values, groups, strict=True) if k == g])
        part = out[out.g == g] if g else out[out.g.isna()]
        for _, r in part.iterrows():
            below = (mine < r["value"]).sum()
            assert r["below"] == below
            assert r["rank"] == below + ((mine == r["value"]).sum() + 1) / 2
            assert r["total"] == len(mine)


def test_lookup_reaches_hot_and_cold_keys(spark):
    values = [1.0] * 900 + [float(i) for i in range(2, 102)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, x double")
    counts = ranking.value_counts(ranking.melt(df, ["x"]), ["column"])
    table = ranking.with_positions(counts, ["column"]).withColumn("rank", ranking.mid_rank())
    out = ranking.lookup_by_value(df, "x", table.select("value", "n", "rank"), "rank", "r", share=10)
    got = {row["id"]: row["r"] for row in out.collect()}
    assert len(got) == len(values)
    assert got[0] == 450.5 and got[900] == 901.0 and got[999] == 1000.0 and got[1000] is None


def test_equal_rows_with_a_hot_key_are_spread(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        key = F.when(F.col("id") < 3600, 0.0).otherwise(F.col("id").cast("double"))
        df = spark.range(4000).select(key.alias("x"), F.col("id").alias("_row"))
        table = df.groupBy(F.col("x").alias("value")).agg(F.count("*").alias("n")).withColumn("rank", F.col("value") + 1)
        found = ranking.lookup_by_value(df, "x", table, "rank", "r")
        sizes = [r["count"] for r in found.where("x = 0").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 3600 and max(sizes) < 1200
        assert found.where("r is null or r <> x + 1").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept[0])
        spark.conf.set("spark.sql.adaptive.enabled", kept[1])


def test_spearman_equals_numpy_ranks(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, 300).astype(float)
    y = x + rng.normal(size=300).round(1)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "x double, y double")

    def rank(v):
        return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])

    want = np.corrcoef(rank(x), rank(y))[0, 1]
    got = {(r["row"], r["col"]): r["value"] for r in correlation.spearman(df, ["x", "y"]).collect()}
    assert got["x", "y"] == pytest.approx(want)
    assert got["x", "x"] == 1.0


def test_kruskal_wallis_known_case(spark):
    # three groups of five without ties: H from the definition
    groups = {"a": [1, 2, 3, 4, 5], "b": [6, 7, 8, 9, 10], "c": [11, 12, 13, 14, 15]}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, x double")
    row = profiles.with_p_value(profiles.kruskal_wallis(df, "g", ["x"])).first()
    assert row["h"] == pytest.approx(12.5)
    assert row["p"] == pytest.approx(np.exp(-12.5 / 2))
    assert row["significant"] == 1


def test_fixed_size_sample_is_exact_and_repeatable(spark):
    df = spark.range(10_000).withColumnRenamed("id", "k")
    a = sampling.fixed_size(df, "k", 777, 5)
    b = sampling.fixed_size(df.repartition(5), "k", 777, 5)
    assert a.count() == 777
    assert {r["k"] for r in a.collect()} == {r["k"] for r in b.collect()}
    assert sampling.fixed_size(df, "k", 20_000, 5).count() == 10_000


def test_stratified_sample_hits_its_cells(spark):
    rows = [(i, "s" if i % 4 else "t", "v" if i % 5 else None) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, stratum string, vintage_bin string").selectExpr(
        "*", "concat_ws('|', stratum, vintage_bin) AS sample_key"
    )
    fractions = sampling.cell_fractions(sampling.cell_counts(df), {"s": 3000, "t": 1000}, ["v"])
    got = {r["sample_key"]: r for r in fractions.collect()}
    # a stratum counts its rows without a vintage, which are never drawn
    assert got["s|v"]["cell_target"] == 3000 * 12000 // 15000
    sample = sampling.stratified(df, fractions, "k", 1, c.hash_fraction)
    counts = {r["sample_key"]: r["count"] for r in sample.groupBy("sample_key").count().collect()}
    assert set(counts) == {"s|v", "t|v"}
    assert abs(counts["s|v"] - 2400) < 200


def test_hash_fraction_is_uniform(spark):
    u = spark.range(20_000).select(c.hash_fraction("id", 9).alias("u"), c.modular_fraction("id", 9).alias("m")).toPandas()
    for n in ("u", "m"):
        assert 0 <= u[n].min() and u[n].max() < 1
        assert abs(u[n].mean() - 0.5) < 0.02
