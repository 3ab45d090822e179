import pytest
from pyspark.sql import functions as F

from panelwright.operators import auditing
from panelwright.sources import sinks


def _rows(spark, quarter, low, high):
    return spark.range(low, high).select(
        F.lit(quarter).alias("q"),
        F.col("id").cast("string").alias("many"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("v"), F.col("id") % 10)).alias("few"),
        F.lit(" ").alias("blank"),
        F.lit(None).cast("string").alias("never"),
    )


COLUMNS = ["many", "few", "blank", "never"]


def _found(sketches):
    return {r["column"]: r.asDict() for r in auditing.merged_distinct(sketches).collect()}


def test_a_new_quarter_is_added_without_the_old_rows(spark, tmp_path):
    folder = str(tmp_path / "sketches")
    # the quarters overlap by half, so their numbers of distinct values do not add up
    for quarter, low, high in (("2019Q1", 0, 20_000), ("2019Q2", 10_000, 30_000), ("2019Q2", 10_000, 40_000)):
        part = auditing.distinct_sketches(_rows(spark, quarter, low, high), COLUMNS, "q")
        sinks.overwrite_partitioned(part, folder, ["q"], dynamic=True)
    found = _found(spark.read.parquet(folder))
    assert found["many"]["rows"] == 50_000
    assert found["many"]["distinct"] == pytest.approx(40_000, rel=0.05)
    assert (found["few"]["distinct"], found["few"]["nulls"]) == (5, 25_000)
    assert (found["blank"]["distinct"], found["blank"]["nulls"]) == (1, 50_000)
    assert (found["never"]["distinct"], found["never"]["nulls"]) == (0, 50_000)


def test_empty_text_is_a_value(spark):
    df = spark.createDataFrame([("a", ""), ("a", "x"), ("b", ""), ("b", None)], "q string, v string")
    assert _found(auditing.distinct_sketches(df, ["v"], "q"))["v"] == {"column": "v", "rows": 4, "nulls": 3, "distinct": 2}


def test_merged_sketches_equal_those_of_all_rows(spark):
    parts = [_rows(spark, f"q{i}", 1000 * i, 1000 * i + 1500) for i in range(4)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    by_quarter = _found(auditing.distinct_sketches(rows, COLUMNS, "q"))
    at_once = _found(auditing.distinct_sketches(rows.withColumn("q", F.lit("all")), COLUMNS, "q"))
    assert by_quarter["few"] == at_once["few"]
    assert by_quarter["many"]["distinct"] == pytest.approx(at_once["many"]["distinct"], rel=0.02)
    assert auditing.merged_distinct(auditing.distinct_sketches(rows.where("false"), COLUMNS, "q")).count() == 0


def test_every_column_is_counted_by_itself(spark):
    rows = _rows(spark, "a", 0, 50).unionByName(_rows(spark, "b", 0, 50))
    rows = rows.unionByName(rows.limit(1).withColumns({n: F.lit("") for n in COLUMNS}))
    out = auditing.exact_distinct(rows, COLUMNS)
    # no rows are unfolded into cells, so one column's many values don't share a table with another's few
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["column"]: r["distinct"] for r in out.collect()} == {"many": 51, "few": 6, "blank": 2, "never": 1}
    assert auditing.exact_distinct(rows.where("false"), COLUMNS).count() == 0


def test_sketches_take_the_hash_of_the_text(spark):
    df = spark.createDataFrame([("a", ""), ("a", "x"), ("a", "x"), ("a", None)], "q string, v string")
    mine = auditing.distinct_sketches(df, ["v"], "q").first()["sketch"]
    assert mine == df.where("v is not null").agg(F.hll_sketch_agg(F.xxhash64("v"), 14)).first()[0]
