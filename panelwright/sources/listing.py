"""What lies in a folder, and what of it still has to be ingested.

Listings are frames over file metadata; no file content is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NAME_PATTERN = r"^\d{4}Q\d\.csv$"


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length", "modificationTime")
        .withColumn("name", F.element_at(F.split("path", "/"), -1))
    )


def classify(files: DataFrame, pattern: str = NAME_PATTERN) -> DataFrame:
    """Marks the files whose name follows the pattern."""
    return files.withColumn("valid", F.col("name").rlike(pattern).cast("int"))


def partition_values(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """Values of a partition column, taken from the directory names."""
    found = F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
    return list_files(spark, folder, "*.parquet").select(found.alias(column)).distinct()


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def _by_path(records: DataFrame, column: str) -> DataFrame:
    paths = records.sparkSession.createDataFrame([(p,) for p in records.inputFiles()], "path string")
    return paths.withColumn(column, F.regexp_extract("path", r"(\d{4}Q\d)(?!.*\d{4}Q\d)", 1))


def source_files(records: DataFrame, column: str) -> DataFrame:
    """``path`` of every file behind a scan, and as ``column`` the quarter that its path names; files that name none are
    left out. The driver handles the paths; no content is read."""
    return _by_path(records, column).where(F.col(column) != "")


def rejected_files(records: DataFrame) -> DataFrame:
    """``path`` and ``name`` of the files behind a scan whose path names no quarter."""
    without = _by_path(records, "_quarter").where("_quarter = ''")
    return without.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def pending(source: DataFrame, done: DataFrame, column: str) -> DataFrame:
    """Listed source rows whose value of ``column`` is not among those done."""
    return source.join(done, column, "left_anti")
