"""Stage tables make only what a query reads, and partitioned writes need no sort."""

import numpy as np
from pyspark.sql import functions as F

from conftest import DATA
from panelwright.operators import clustering, features
from panelwright.presets import mortgage
from panelwright.sources import sinks
from panelwright.workload import fixture as fx
from panelwright.workload import clusters, ingest


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_records_are_made_of_the_columns_a_query_reads(spark):
    plan = _plan(fx.silver_table(spark, DATA).select("loan_id"))
    assert "ReadSchema: struct<k:bigint>" in plan
    assert fx.silver_table(spark, DATA).columns == list(mortgage.CLEAN.kept)


def test_loans_of_some_columns_are_those_of_the_whole_table(spark):
    some = fx.loan_table(spark, DATA, "loan_id", "stratum")
    assert some.columns == ["loan_id", "stratum"]
    whole = fx.loan_table(spark, DATA).select("loan_id", "stratum")
    assert sorted(some.collect()) == sorted(whole.collect())
    assert some.inputFiles() != fx.loan_table(spark, DATA).inputFiles()


def test_raw_files_are_compressed_and_few(spark):
    folder = ingest.raw_folder(spark, DATA)
    files = spark.read.text(f"{folder}/*/*").inputFiles()
    assert all(f.endswith(".csv.gz") for f in files)
    quarters = fx.bronze_table(spark, DATA).select(mortgage.QUARTER).distinct().count()
    assert len(files) == quarters


def test_open_files_are_set_for_the_write_only(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with sinks.open_files(spark, 7):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name) == before


def test_sums_of_many_numbers_reach_the_driver_as_one_row(spark, monkeypatch):
    rows = spark.range(1000).repartition(10).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    seen = []
    collect = type(rows).collect

    def counted(df):
        found = collect(df)
        seen.append(len(found))
        return found

    monkeypatch.setattr(type(rows), "collect", counted)
    total = clustering._summed(rows, lambda x: x.sum(0), clustering.FEW_NUMBERS)
    assert total.tolist() == [499500.0, 1000.0] and seen == [1]
    monkeypatch.setattr(clustering, "FEW_TASKS", 4)
    assert np.array_equal(clustering._summed(rows, lambda x: x.sum(0)), total) and seen == [1, 1]


def test_sweep_over_few_vectors(spark):
    points = [(float(i % 3) * 10 + i / 100, float(i % 3)) for i in range(30)]
    rows = features.assemble(spark.createDataFrame(points, "a double, b double"), ["a", "b"])
    fits = clustering.kmeans_fits(rows, [3], starts=3)
    assert sorted(round(c[1]) for c in fits[3].centres) == [0, 1, 2]


def test_labelled_loans_of_some_columns(spark):
    some = clusters.labelled(spark, DATA, "orig_ltv")
    assert some.columns == ["orig_ltv", *clusters._RULED, *clusters.LABELS.values()]
    assert sorted(some.collect(), key=str) == sorted(clusters.labelled(spark, DATA).select(*some.columns).collect(), key=str)
