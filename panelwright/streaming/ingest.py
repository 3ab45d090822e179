"""Incremental ingest: only files that arrived since the last run."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from panelwright.sources.records import with_quarter
from panelwright.sources.sinks import open_files
from panelwright.spec import CleanRules


def ingest_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    rules: CleanRules,
    partition: str,
    files_per_batch: int = 50,
    sep: str = "|",
) -> StreamingQuery:
    """One run over all files not seen yet. The checkpoint remembers the files, and the
    file sink commits each batch once, so a broken run is simply started again."""
    records = (
        spark.readStream.schema(rules.raw_schema)
        .option("sep", sep)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
    )
    writer = (
        with_quarter(records, partition)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .partitionBy(partition)
        .trigger(availableNow=True)
    )
    with open_files(spark):  # a stream keeps the settings it is started with
        return writer.start()
