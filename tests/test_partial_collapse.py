import uuid

from pyspark.sql import functions as F

from conftest import DATA
from panelwright.operators import collapse
from panelwright.presets import mortgage
from panelwright.sources import sinks
from panelwright.workload import fixture as fx

SPEC = mortgage.PANEL
BUCKETS = 8


def _rows(df):
    names = sorted(df.columns)
    return sorted(df.select(*names).collect(), key=lambda r: r["loan_id"])


def _stored(df, folder, dealt=False):
    return sinks.write_bucketed(df, f"partials_{uuid.uuid4().hex}", str(folder), SPEC.entity, BUCKETS, dealt)


def _parts(silver, n):
    month = F.year(SPEC.period) * 12 + F.month(SPEC.period)
    return [silver.where(F.coalesce(month, F.lit(0)) % n == i) for i in range(n)]


def test_partial_rows_of_the_whole_give_the_collapse(spark):
    silver = fx.silver_table(spark, DATA)
    whole = collapse.collapse(silver, SPEC)
    found = collapse.finish(collapse.partial(silver, SPEC), SPEC)
    assert found.columns == whole.columns and _rows(found) == _rows(whole)


def test_merged_parts_equal_the_collapse_of_all_rows(spark, tmp_path):
    silver = fx.silver_table(spark, DATA)
    parts = _parts(silver, 3)
    table = _stored(collapse.partial(parts[0], SPEC), tmp_path / "p0")
    for i, part in enumerate(parts[1:], 1):
        merged = collapse.merge_partials(table, collapse.partial(part, SPEC), SPEC, BUCKETS)
        table = _stored(merged, tmp_path / f"p{i}", dealt=True)
    found, whole = collapse.finish(table, SPEC), collapse.collapse(silver, SPEC)
    assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in whole.schema}
    assert _rows(found) == _rows(whole)
    # the merged table has a file per bucket again
    assert len(list((tmp_path / "p2").glob("*.parquet"))) <= BUCKETS


def test_a_loan_of_one_side_only_is_kept(spark, tmp_path):
    silver = fx.silver_table(spark, DATA)
    number = F.col("loan_id").cast("bigint") % 2
    table = _stored(collapse.partial(silver.where(number == 0), SPEC), tmp_path / "p")
    merged = collapse.merge_partials(table, collapse.partial(silver.where(number == 1), SPEC), SPEC)
    assert _rows(collapse.finish(merged, SPEC)) == _rows(collapse.collapse(silver, SPEC))


def test_empty_parts_change_nothing(spark, tmp_path):
    silver = fx.silver_table(spark, DATA)
    none = collapse.partial(silver.where("false"), SPEC)
    table = _stored(collapse.partial(silver, SPEC), tmp_path / "p")
    whole = _rows(collapse.collapse(silver, SPEC))
    assert _rows(collapse.finish(collapse.merge_partials(table, none, SPEC), SPEC)) == whole
    assert _rows(collapse.finish(collapse.merge_partials(none, table, SPEC), SPEC)) == whole


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    silver = fx.silver_table(spark, DATA)
    first, second = _parts(silver, 2)
    table = _stored(collapse.partial(first, SPEC), tmp_path / "p")
    new = collapse.partial(second, SPEC)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("8", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            plan = collapse.merge_partials(table, new, SPEC, BUCKETS)._jdf.queryExecution().executedPlan().toString()
            # the first branch of the join reads the stored table
            lines = plan[plan.index("FullOuter") :].splitlines()[1:]
            stored = lines[: next(i for i, x in enumerate(lines) if "FileScan" in x) + 1]
            assert "Bucketed: true" in stored[-1]
            assert not any("Exchange" in x for x in stored)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
