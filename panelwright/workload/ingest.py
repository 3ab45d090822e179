"""Queries over sources, sinks and ingest. The input is the raw panel derived from the
tables, written once per session as delimited text below the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwright.operators import cleaning
from panelwright.plans import stages
from panelwright.presets import mortgage
from panelwright.session import scratch_folder
from panelwright.sources import listing, records, sinks
from panelwright.streaming.ingest import ingest_new_files
from panelwright.workload import fixture as fx
from panelwright.workload.book import Book

book = Book()
Q = mortgage.QUARTER
RULES = mortgage.CLEAN
_written: dict[tuple, str] = {}


def raw_folder(spark, sf):
    """Folder with one sub-folder of compressed delimited files per acquisition quarter."""
    key = ("raw", spark.sparkContext.applicationId, sf)
    if key not in _written:
        folder = scratch_folder(spark, "raw")
        writer = fx.bronze_by_quarter(spark, sf).write.partitionBy(Q)
        with sinks.open_files(spark):
            writer.option("sep", "|").option("emptyValue", "").option("compression", "gzip").csv(folder)
        _written[key] = folder
    return _written[key]


def silver_folder(spark, sf):
    key = ("silver", spark.sparkContext.applicationId, sf)
    if key not in _written:
        folder = scratch_folder(spark, "silver")
        sinks.overwrite_partitioned(cleaning.clean(fx.bronze_by_quarter(spark, sf), RULES), folder, [Q])
        _written[key] = folder
    return _written[key]


def _records(spark, sf):
    folder = raw_folder(spark, sf)
    return records.read_records(spark, f"{folder}/*/*.csv.gz", RULES.raw_schema)


_BY_QUARTER = (
    f"WITH {fx.raw_cte()} SELECT {Q}, count(*) AS n, count(DISTINCT loan_id) AS loans FROM raw GROUP BY 1"
)


def _by_quarter(df):
    return (
        df.groupBy(Q, "loan_id")
        .agg(F.count("*").alias("n"))
        .groupBy(Q)
        .agg(F.sum("n").alias("n"), F.count("loan_id").alias("loans"))
    )


_FEW = ["loan_id", "monthly_reporting_period", Q, "orig_upb", "current_delinquency_status", "dti"]


@book.query("s01_delimited_scan", f"WITH {fx.silver_cte()} SELECT {', '.join(_FEW)} FROM silver")
def s01(spark, sf):
    raw = records.with_quarter(_records(spark, sf), Q)
    return cleaning.clean(raw, RULES).select(*_FEW)


@book.query("s02_list_of_paths_scan", _BY_QUARTER)
def s02(spark, sf):
    files = listing.list_files(spark, raw_folder(spark, sf), "*.csv.gz").select("path").collect()
    raw = records.read_records(spark, [r["path"] for r in files], RULES.raw_schema)
    return _by_quarter(records.with_quarter(raw, Q))


@book.query(
    "s03_infer_once_scan",
    f"WITH {fx.raw_cte()} SELECT trim(channel) AS channel, count(*) AS n, "
    "round(sum(cast(orig_upb as double)), 2) AS amount FROM raw GROUP BY 1",
)
def s03(spark, sf):
    folder = raw_folder(spark, sf)
    schema = records.infer_schema(spark, f"{folder}/{Q}=2005Q1")
    raw = records.read_records(spark, f"{folder}/*/*.csv.gz", schema)
    return raw.groupBy(F.trim("_c3").alias("channel")).agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("_c9").cast("double")), 2).alias("amount")
    )


@book.query(
    "s04_untyped_probe",
    f"WITH {fx.raw_cte()} SELECT count(*) AS rows, 110 AS columns FROM raw",
)
def s04(spark, sf):
    return records.probe(spark, f"{raw_folder(spark, sf)}/*/*.csv.gz")


def named_folder(spark, sf):
    """A file per acquisition quarter. Those of first and third quarters are called after it, as a supplier names them;
    the others keep the name of the task that wrote them."""
    key = ("named", spark.sparkContext.applicationId, sf)
    if key not in _written:
        folder = scratch_folder(spark, "named")
        few = fx.bronze_table(spark, sf).select("loan_id", "monthly_reporting_period", Q)
        few.repartition(Q).write.partitionBy(Q).option("sep", "|").csv(folder)
        files = listing.list_files(spark, folder, "*.csv").select("path", F.regexp_extract("path", rf"{Q}=(\d{{4}}Q[13])/", 1).alias("q"))
        path = spark._jvm.org.apache.hadoop.fs.Path
        for r in files.where("q <> ''").collect():
            old = path(r["path"])
            old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, path(old.getParent(), f"{r['q']}.csv"))
        _written[key] = folder
    return _written[key]


@book.query(
    "s05_source_listing",
    f"WITH {fx.raw_cte()} SELECT {Q}, CASE WHEN substr({Q}, 6, 1) IN ('1', '3') THEN 1 ELSE 0 END AS valid, "
    f"count(DISTINCT {Q}) AS files FROM raw GROUP BY {Q}",
)
def s05(spark, sf):
    """Files per quarter and whether their names follow the pattern."""
    files = listing.classify(listing.list_files(spark, named_folder(spark, sf), "*.csv"))
    quarter = F.regexp_extract("path", r"(\d{4}Q\d)(?!.*\d{4}Q\d)", 1)
    return files.groupBy(quarter.alias(Q), "valid").agg(F.count("*").alias("files"))


@book.query("s06_quarter_from_path", _BY_QUARTER)
def s06(spark, sf):
    return _by_quarter(records.with_quarter(_records(spark, sf), Q))


@book.query(
    "s07_year_quarter_from_path",
    f"WITH {fx.raw_cte()} SELECT cast(substr({Q}, 1, 4) as integer) AS year, "
    f"cast(substr({Q}, 6, 1) as integer) AS quarter, count(*) AS n FROM raw GROUP BY 1, 2",
)
def s07(spark, sf):
    keyed = records.with_year_quarter(_records(spark, sf))
    return keyed.groupBy("year", "quarter").agg(F.count("*").alias("n"))


@book.query(
    "s08_parquet_scan",
    f"WITH {fx.silver_cte()} SELECT {Q}, count(*) AS n, sum(cast(loan_age as bigint))::bigint AS age "
    "FROM silver GROUP BY 1",
)
def s08(spark, sf):
    silver = spark.read.parquet(silver_folder(spark, sf))
    return silver.groupBy(Q).agg(F.count("*").alias("n"), F.sum("loan_age").alias("age"))


@book.query("s09_resumable_ingest", _BY_QUARTER)
def s09(spark, sf):
    source, target = raw_folder(spark, sf), scratch_folder(spark, "bronze")
    stages.ingest(spark, f"{source}/{Q}=19*/*.csv.gz", target, RULES, Q)
    stages.ingest_pending(spark, source, target, RULES, Q)
    stages.ingest_pending(spark, source, target, RULES, Q)
    return _by_quarter(spark.read.parquet(target))


@book.query("s09_streaming_ingest", _BY_QUARTER)
def s09_stream(spark, sf):
    source, target = raw_folder(spark, sf), scratch_folder(spark, "bronze")
    checkpoint = scratch_folder(spark, "ingest-state")
    for _ in range(2):
        run = ingest_new_files(spark, f"{source}/*", target, checkpoint, RULES, Q, files_per_batch=1000)
        run.awaitTermination()
    return _by_quarter(spark.read.parquet(target))


_EXPORT = ["loan_id", Q, "stratum", "vintage_bin", "final_zero_balance_code", "orig_upb", "is_default"]


@book.query("s10_header_csv_with_schema", f"WITH {fx.gold_cte()} SELECT {', '.join(_EXPORT)} FROM gold")
def s10(spark, sf):
    path = scratch_folder(spark, "export")
    loans = fx.loan_table(spark, sf, *_EXPORT)
    sinks.export_csv(loans, path)
    return records.read_records(spark, path, loans.schema, sep=",", header=True)


@book.query(
    "s11_field_count_check",
    f"WITH {fx.months_cte()} SELECT count(*) AS lines, "
    "count(*) FILTER (WHERE k % 101 = 0) AS malformed FROM months",
)
def s11(spark, sf):
    path = scratch_folder(spark, "lines")
    names = RULES.raw_names
    raw = fx.bronze_table(spark, sf)
    short = F.col("loan_id").cast("bigint") % 101 == 0
    line = F.when(short, F.concat_ws("|", *names[:-1])).otherwise(F.concat_ws("|", *names))
    raw.select(line.alias("value")).write.text(path)
    return records.field_count_report(records.read_lines(spark, path), len(names))


@book.query(
    "s12_sql_over_delimited_files",
    f"WITH {fx.raw_cte()} SELECT property_state, count(*) AS n, "
    "round(avg(try_cast(orig_interest_rate AS double)), 4) AS rate FROM raw GROUP BY 1",
)
def s12(spark, sf):
    records.register(_records(spark, sf), "panel_records")
    return spark.sql(
        "SELECT property_state, count(*) AS n, "
        "round(avg(try_cast(orig_interest_rate AS double)), 4) AS rate "
        "FROM panel_records GROUP BY property_state"
    )


@book.query(
    "s13_k06_table_append_and_scan",
    f"WITH {fx.silver_cte()} SELECT channel, 2 * count(*) AS n FROM silver GROUP BY 1",
)
def s13(spark, sf):
    path = scratch_folder(spark, "table")
    part = spark.read.parquet(silver_folder(spark, sf)).select("loan_id", "channel")
    for _ in range(2):
        sinks.append_table(part, path)
    return records.read_table(spark, path).groupBy("channel").agg(F.count("*").alias("n"))


@book.query("k01_partitioned_append", _BY_QUARTER)
def k01(spark, sf):
    path = scratch_folder(spark, "append")
    sinks.append_partitioned(fx.bronze_table(spark, sf).select("loan_id", "msa", Q), path, [Q])
    return _by_quarter(spark.read.parquet(path))


@book.query("k02_partitioned_overwrite", _BY_QUARTER)
def k02(spark, sf):
    """Written twice and once more for some quarters only: the rows stay the same."""
    path = scratch_folder(spark, "overwrite")
    rows = sinks.sized(fx.bronze_table(spark, sf).select("loan_id", "msa", Q), [Q], ["loan_id"])
    sinks.overwrite_partitioned(rows, path, [Q])
    sinks.overwrite_partitioned(rows, path, [Q])
    sinks.overwrite_partitioned(rows.where(F.col(Q) < "2000"), path, [Q], dynamic=True)
    return _by_quarter(spark.read.parquet(path))


@book.query(
    "k03_year_quarter_partitions",
    f"WITH {fx.raw_cte()} SELECT cast(substr({Q}, 1, 4) as integer) AS year, "
    f"cast(substr({Q}, 6, 1) as integer) AS quarter, count(*) AS n FROM raw GROUP BY 1, 2",
)
def k03(spark, sf):
    path = scratch_folder(spark, "two-level")
    keyed = fx.bronze_table(spark, sf).select(
        "loan_id", F.substring(Q, 1, 4).cast("int").alias("year"), F.substring(Q, 6, 1).cast("int").alias("quarter")
    )
    by = ["year", "quarter"]
    sinks.overwrite_partitioned(sinks.sized(keyed, by, ["loan_id"]), path, by)
    return spark.read.parquet(path).groupBy("year", "quarter").agg(F.count("*").alias("n"))


@book.query("k04_fixed_file_count", f"WITH {fx.gold_cte()} SELECT count(*) AS n, 4 AS files FROM gold")
def k04(spark, sf):
    path = scratch_folder(spark, "four-files")
    sinks.write_files(fx.loan_table(spark, sf, "loan_id", "stratum"), path, 4)
    files = listing.list_files(spark, path, "*.parquet").select(F.count("*").cast("int")).scalar()
    return spark.read.parquet(path).agg(F.count("*").alias("n")).withColumn("files", files)


@book.query("k05_single_csv", f"WITH {fx.gold_cte()} SELECT count(*) AS n, 1 AS files FROM gold")
def k05(spark, sf):
    path = scratch_folder(spark, "one-csv")
    loans = fx.loan_table(spark, sf, "loan_id", "stratum")
    sinks.export_single_csv(loans, path)
    files = listing.list_files(spark, path, "*.csv").select(F.count("*").cast("int")).scalar()
    back = records.read_records(spark, path, loans.schema, sep=",", header=True)
    return back.agg(F.count("*").alias("n")).withColumn("files", files)


@book.query(
    "k07_capped_export",
    f"WITH {fx.raw_cte()} SELECT least(count(*), 200000) AS n FROM raw",
)
def k07(spark, sf):
    path = scratch_folder(spark, "capped")
    sinks.write_capped(fx.bronze_table(spark, sf).select("loan_id", Q), path)
    return spark.read.parquet(path).agg(F.count("*").alias("n"))


@book.query(
    "k08_read_back_validation",
    f"WITH {fx.raw_cte()}, parts AS (SELECT count(*) AS n, min({Q}) AS a, max({Q}) AS z, "
    f"count(DISTINCT {Q}) AS q FROM raw) "
    "SELECT 'rows' AS \"check\", cast(n as varchar) AS expected, cast(n as varchar) AS found, 1 AS ok FROM parts "
    f"UNION ALL SELECT 'columns', '{len(RULES.kept)}', '{len(RULES.kept)}', 1 "
    "UNION ALL SELECT 'missing columns', '', '', 1 UNION ALL SELECT 'extra columns', '', '', 1 "
    "UNION ALL SELECT 'wrong types', '', '', 1 UNION ALL SELECT 'missing partitions', '', '', 1 "
    "UNION ALL SELECT 'extra partitions', '', '', 1 UNION ALL SELECT 'wrong partition rows', '', '', 1 "
    "UNION ALL SELECT 'first partition', a, a, 1 FROM parts UNION ALL SELECT 'last partition', z, z, 1 FROM parts "
    "UNION ALL SELECT 'partitions', cast(q as varchar), cast(q as varchar), 1 FROM parts",
)
def k08(spark, sf):
    # what should be there comes from the raw panel and the specification
    parts = {r[Q]: r["count"] for r in fx.raw_panel(spark, sf).groupBy(Q).count().collect()}
    kinds = {n: cleaning.SPARK_TYPES[k].simpleString() for n, k in RULES.kinds.items()}
    return sinks.validate_written(spark, silver_folder(spark, sf), sum(parts.values()), RULES.kept, Q, parts, kinds)
