from pyspark.sql import functions as F

from panelwright.plans import stages
from panelwright.presets import mortgage
from panelwright.sources import listing, records, sinks
from panelwright.spec import CleanRules, Field
from panelwright.streaming.ingest import ingest_new_files

RULES = CleanRules(layout=(Field("id", "text"), Field("month", "date"), Field("amount", "float")), extra_text=("q",))


def _write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def _source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    _write(folder, "2019Q4.csv", "0001|102019|1.50", "0002|112019|")
    _write(folder, "2020Q1.csv", "0003|012020|2.50")
    return folder


def test_ids_keep_their_zeros_and_blanks_are_null(spark, tmp_path):
    df = records.read_records(spark, str(_source(tmp_path)), RULES.raw_schema)
    got = {r["id"]: r["amount"] for r in df.collect()}
    assert got == {"0001": "1.50", "0002": None, "0003": "2.50"}


def test_quarter_comes_from_the_file_name(spark, tmp_path):
    df = records.with_quarter(records.read_records(spark, str(_source(tmp_path)), RULES.raw_schema), "q")
    assert {(r["id"], r["q"]) for r in df.collect()} == {("0001", "2019Q4"), ("0002", "2019Q4"), ("0003", "2020Q1")}


def test_listing_marks_odd_names(spark, tmp_path):
    folder = _source(tmp_path)
    _write(folder, "notes.txt", "x")
    _write(folder, "2020Q1_old.csv", "x")
    got = {r["name"]: r["valid"] for r in listing.classify(listing.list_files(spark, str(folder))).collect()}
    assert got == {"2019Q4.csv": 1, "2020Q1.csv": 1, "notes.txt": 0, "2020Q1_old.csv": 0}


def test_field_counts(spark, tmp_path):
    _write(tmp_path, "lines.csv", "a|b|c", "a||", "a|b", "")
    row = records.field_count_report(records.read_lines(spark, str(tmp_path / "lines.csv")), 3).first()
    assert (row["lines"], row["malformed"]) == (4, 2)


def test_resumed_ingest_neither_skips_nor_doubles(spark, tmp_path):
    folder, target = _source(tmp_path), str(tmp_path / "out")
    stages.ingest(spark, str(folder / "2019Q4.csv"), target, RULES, "q")
    assert stages.ingest_pending(spark, str(folder), target, RULES, "q") == 1
    assert stages.ingest_pending(spark, str(folder), target, RULES, "q") == 0
    stages.ingest(spark, str(folder), target, RULES, "q")
    assert spark.read.parquet(target).count() == 3


def test_late_file_of_a_written_quarter_is_loaded(spark, tmp_path):
    folder, target = _source(tmp_path), str(tmp_path / "out")
    assert stages.ingest_pending(spark, str(folder), target, RULES, "q") == 2
    late = folder / "2019Q4"
    late.mkdir()
    _write(late, "more.csv", "0009|122019|9")
    _write(folder, "odd.csv", "0008|122019|9")
    assert stages.ingest_pending(spark, str(folder), target, RULES, "q") == 1
    assert stages.ingest_pending(spark, str(folder), target, RULES, "q") == 0
    found = spark.read.parquet(target)
    assert found.count() == 4 and found.where("q = ''").count() == 0


def test_streaming_ingest_takes_only_new_files(spark, tmp_path):
    folder, target, state = _source(tmp_path), str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        ingest_new_files(spark, str(folder), target, state, RULES, "q").awaitTermination()
        return spark.read.parquet(target).count()

    assert (run(), run()) == (3, 3)
    _write(folder, "2020Q2.csv", "0004|042020|9")
    assert run() == 4


def test_partition_filter_is_pruned(spark, tmp_path):
    target = str(tmp_path / "out")
    stages.ingest(spark, str(_source(tmp_path)), target, RULES, "q")
    plan = spark.read.parquet(target).where("q = '2020Q1'").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(q" in plan
    assert "ReadSchema: struct<id:string>" in plan


def test_export_of_a_small_frame_is_one_file(spark, tmp_path):
    df = spark.range(1000).withColumn("name", F.lit("x"))
    sinks.export_single_csv(df.repartition(5), str(tmp_path / "one"))
    sinks.export_csv(df.repartition(5), str(tmp_path / "many"))
    count = lambda p: len(list((tmp_path / p).glob("*.csv")))
    assert (count("one"), count("many")) == (1, 5)


def test_read_back_checks_can_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "n long, q string")
    path = str(tmp_path / "t")
    sinks.overwrite_partitioned(df, path, ["q"])

    def bad(rows, columns, parts, kinds):
        checked = sinks.validate_written(spark, path, rows, columns, "q", parts, kinds)
        return {r["check"] for r in checked.collect() if not r["ok"]}

    assert bad(3, ["n", "q"], {"a": 2, "b": 1}, {"n": "bigint"}) == set()
    assert bad(4, ["n", "m"], {"a": 2, "b": 2, "c": 1}, {"n": "int"}) == {
        "rows",
        "missing columns",
        "extra columns",
        "wrong types",
        "last partition",
        "partitions",
        "missing partitions",
        "wrong partition rows",
    }


def test_stages_end_to_end(spark, tmp_path, data):
    from panelwright.workload import fixture as fx

    bronze, silver, loans = (str(tmp_path / x) for x in ("bronze", "silver", "loans"))
    raw = fx.raw_panel(spark, data)
    sinks.overwrite_partitioned(raw, bronze, [mortgage.QUARTER])
    stages.build_silver(spark, bronze, silver, mortgage.CLEAN, mortgage.QUARTER)
    stages.build_loans(spark, silver, loans, mortgage.PANEL, mortgage.RISK)
    table = spark.read.parquet(loans)
    assert table.count() == raw.select("loan_id").distinct().count()
    sample = stages.draw_sample(table, mortgage.TARGETS_A, mortgage.RISK, mortgage.SEED_A, mortgage.SUBSET_A)
    assert sample.columns == mortgage.SUBSET_A
    assert 0 < sample.count() <= table.count()
