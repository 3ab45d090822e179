"""The stages end to end, each reading and writing Parquet.

raw files -> bronze (text, by quarter) -> silver (typed) -> loans -> two samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.operators import cleaning, collapse, risk, sampling
from panelwright.sources import listing, records, sinks
from panelwright.spec import CleanRules, PanelSpec, RiskRules


def _manifest(target: str) -> str:
    """Folder beside the target that lists the files each written quarter was made of."""
    return f"{target.rstrip('/')}_files"


def _replace(raw: DataFrame, target: str, partition: str) -> None:
    """Write the quarters of a scan anew, then their files to the manifest. A run that breaks in between leaves files
    unlisted, so the next one writes the same quarters again."""
    files = listing.source_files(raw, partition)
    sinks.overwrite_partitioned(records.with_quarter(raw, partition), target, [partition], dynamic=True)
    sinks.overwrite_partitioned(files.repartition(partition), _manifest(target), [partition], dynamic=True)


def _report(raw: DataFrame, target: str) -> None:
    """Write the files of a scan that cannot be loaded to a table beside the target, replacing that of the last run."""
    listing.rejected_files(raw).coalesce(1).write.mode("overwrite").parquet(f"{target.rstrip('/')}_rejected")


def rejected(spark: SparkSession, target: str) -> DataFrame:
    """``path`` and ``name`` of the files that the last ingest into the target left out, as their paths name no quarter."""
    return spark.read.parquet(f"{target.rstrip('/')}_rejected")


def ingest(spark: SparkSession, source: str, target: str, rules: CleanRules, partition: str, sep: str = "|") -> None:
    """All files of the folder in one scan, replacing the partitions they belong to. Files whose path names no quarter
    are not loaded; ``rejected`` lists them."""
    raw = records.read_records(spark, source, rules.raw_schema, sep)
    _report(raw, target)
    found = raw.inputFiles()
    paths = [r["path"] for r in listing.source_files(raw, partition).select("path").collect()]
    if paths and len(paths) < len(found):
        raw = records.read_records(spark, paths, rules.raw_schema, sep)
    if paths:
        _replace(raw, target, partition)


def ingest_pending(
    spark: SparkSession, source: str, target: str, rules: CleanRules, partition: str, sep: str = "|"
) -> int:
    """Loads the source files that the manifest of the target does not list, and returns their number.

    A quarter with a new file is written anew from all its files, so a file that arrives late is added and none is
    doubled. Files whose path names no quarter are not loaded; ``rejected`` lists them. The driver handles file paths, as many as there are
    source files; the records stay with the executors.
    """
    scan = spark.read.schema(rules.raw_schema).option("pathGlobFilter", "*.{csv,csv.gz}").option("recursiveFileLookup", "true")
    scanned = scan.csv(source)
    _report(scanned, target)
    files = listing.source_files(scanned, partition)
    manifest = _manifest(target)
    waiting = files
    if listing.exists(spark, manifest):
        waiting = listing.pending(files, spark.read.parquet(manifest).select("path"), "path")
    new = {r["path"]: r[partition] for r in waiting.collect()}
    if new:
        quarters = waiting.select(partition).distinct()
        paths = [r["path"] for r in files.join(quarters, partition, "left_semi").select("path").collect()]
        _replace(records.read_records(spark, paths, rules.raw_schema, sep), target, partition)
    return len(new)


def build_silver(spark: SparkSession, bronze: str, target: str, rules: CleanRules, partition: str) -> None:
    typed = cleaning.enforce(cleaning.clean(spark.read.parquet(bronze), rules), rules)
    sinks.overwrite_partitioned(typed, target, [partition])


def build_loans(spark: SparkSession, silver: str, target: str, spec: PanelSpec, rules: RiskRules) -> None:
    """The one wide shuffle of the flow. The loan table is written, so that the
    samples and reports read it instead of repeating the collapse."""
    loans = risk.derive(collapse.collapse(spark.read.parquet(silver), spec), rules)
    loans.write.mode("overwrite").parquet(target)


def draw_sample(
    loans: DataFrame, targets: dict[str, int], rules: RiskRules, seed: int, columns: list[str], key: str = "loan_id"
) -> DataFrame:
    fractions = sampling.cell_fractions(sampling.cell_counts(loans), targets, list(rules.vintages))
    return sampling.stratified(loans, fractions, key, seed).select(*columns)
