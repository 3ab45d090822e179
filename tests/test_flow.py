import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from panelwright.operators import agreement
from panelwright.plans import ledger, segments, stages
from panelwright.plans.ledger import Stage
from panelwright.presets import mortgage
from panelwright.workload import fixture as fx
from panelwright.workload import profiles as workload


def _counting(ran, broken=()):
    def stage(name):
        def run(spark, df, step):
            ran.append(name)
            if name in broken:
                raise RuntimeError(name)
            return df.withColumn("x", F.col("x") + step)

        return run

    names = ["one", "two", "three", "four", "five"]
    inputs = ["numbers", *names[:-1]]
    return [Stage(n, stage(n), (i,), {"step": j}) for j, (n, i) in enumerate(zip(names, inputs, strict=True), 1)]


def test_a_broken_run_goes_on_at_the_failed_stage(spark, tmp_path):
    source, folder = str(tmp_path / "numbers"), str(tmp_path / "flow")
    spark.range(10).select(F.col("id").alias("x")).write.parquet(source)
    ran = []
    with pytest.raises(RuntimeError, match="four"):
        ledger.run_flow(spark, _counting(ran, {"four"}), {"numbers": source}, folder)
    assert ran == ["one", "two", "three", "four"]
    ran.clear()
    done = ledger.run_flow(spark, _counting(ran), {"numbers": source}, folder)
    assert ran == ["four", "five"]
    assert sorted(r["x"] for r in done["five"].collect()) == list(range(15, 25))
    assert {r["stage"] for r in ledger.finished(spark, folder).collect()} == set(done)
    ran.clear()
    ledger.run_flow(spark, _counting(ran), {"numbers": source}, folder)
    assert ran == []


def test_changes_run_what_depends_on_them(spark, tmp_path):
    source, folder = str(tmp_path / "numbers"), str(tmp_path / "flow")
    spark.range(10).select(F.col("id").alias("x")).write.parquet(source)
    ran = []
    flow = _counting(ran)
    ledger.run_flow(spark, flow, {"numbers": source}, folder)
    ran.clear()
    flow[2] = Stage("three", flow[2].run, flow[2].inputs, {"step": 100})
    done = ledger.run_flow(spark, flow, {"numbers": source}, folder)
    assert ran == ["three", "four", "five"]
    assert done["five"].agg(F.min("x")).first()[0] == 112
    ran.clear()
    spark.range(10, 12).select(F.col("id").alias("x")).write.mode("append").parquet(source)
    done = ledger.run_flow(spark, flow, {"numbers": source}, folder)
    assert ran == ["one", "two", "three", "four", "five"]
    assert done["five"].count() == 12


def test_stage_names_are_unique(spark, tmp_path):
    source = str(tmp_path / "numbers")
    spark.range(2).select(F.col("id").alias("x")).write.parquet(source)
    flow = _counting([])
    with pytest.raises(ValueError, match="two stages"):
        ledger.run_flow(spark, [flow[0], flow[0]], {"numbers": source}, str(tmp_path / "flow"))


def test_profiles_of_the_flow_describe_its_clusters(spark, tmp_path):
    flow = segments.flow(workload.FLOW_TARGETS, mortgage.SEED_A, k=4, starts=4)
    done = ledger.run_flow(spark, flow, {"loans": fx.loan_folder(spark, DATA)}, str(tmp_path / "flow"))
    labels = done["clusters"].toPandas().set_index("loan_id")["cluster"]
    space = done["latent"].toPandas().set_index("loan_id")
    assert set(labels.index) == set(space.index) and labels.index.is_unique
    assert labels.nunique() == 4
    loans = done["sample"].toPandas().set_index("loan_id").loc[labels.index]
    tables = done["profiles"].toPandas().set_index(["table", "cluster", "column"])["value"]
    for cluster in range(4):
        mine = labels.index[labels == cluster]
        assert tables["mean", cluster, "n"] == len(mine)
        for n in segments.LATENT:
            assert tables["mean", cluster, n] == pytest.approx(space.loc[mine, n].mean(), abs=1e-4)
        assert tables["median", cluster, "orig_ltv"] == pytest.approx(loans.loc[mine, "orig_ltv"].median())
        assert tables["outcome", cluster, "ever_d90"] == pytest.approx(100 * loans.loc[mine, "ever_d90"].mean(), abs=0.006)
    names = done["names"].toPandas()
    assert names["n"].sum() == len(labels) and names["auto_name"].notna().all()


def test_best_assignment_equals_all_permutations():
    rng = np.random.default_rng(3)
    for k in (1, 2, 3, 4, 5, 6):
        for _ in range(20):
            gain = rng.integers(0, 9, (k, k)).astype(float)
            chosen = agreement.best_assignment(gain)
            assert sorted(chosen) == list(range(k))
            best = max(sum(gain[i, p[i]] for i in range(k)) for p in itertools.permutations(range(k)))
            assert gain[np.arange(k), chosen].sum() == best


def test_labels_are_aligned_where_the_largest_cell_misleads(spark):
    cells = {(0, 0): 10, (0, 1): 9, (1, 0): 9, (1, 1): 0}
    rows = [(a, b) for (a, b), n in cells.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "a int, b int")
    out = agreement.align_labels(df, "a", "b", "a2")
    # the largest cell first would leave 10 equal rows
    assert out.where("a2 = b").count() == 18


def test_labels_beyond_the_reference_stay_apart(spark):
    rows = [(0, 1), (0, 1), (1, 1), (2, 0), (3, None), (None, 0)]
    df = spark.createDataFrame(rows, "a int, b int")
    out = agreement.align_labels(df, "a", "b", "a2").collect()
    mapping = {r["a"]: r["a2"] for r in out}
    assert mapping[0] == 1 and mapping[2] == 0 and mapping[None] is None
    kept = [v for k, v in mapping.items() if k is not None]
    assert len(set(kept)) == len(kept) == 4


def test_files_without_a_quarter_are_reported_not_loaded(spark, tmp_path):
    rules = mortgage.CLEAN
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    line = "|".join(["1"] * len(rules.raw_schema.names)) + "\n"
    (folder / "2019Q4.csv").write_text(line)
    (folder / "notes.csv").write_text(line * 2)
    stages.ingest(spark, str(folder), target, rules, "q")
    assert spark.read.parquet(target).count() == 1
    assert [r["name"] for r in stages.rejected(spark, target).collect()] == ["notes.csv"]
    (folder / "2020Q1.csv").write_text(line)
    assert stages.ingest_pending(spark, str(folder), target, rules, "q") == 1
    found = spark.read.parquet(target)
    assert {r["q"]: r["count"] for r in found.groupBy("q").count().collect()} == {"2019Q4": 1, "2020Q1": 1}
    assert [r["name"] for r in stages.rejected(spark, target).collect()] == ["notes.csv"]
