"""Reading delimited records and tables. Schemas are declared, never guessed, except
by the two operators whose purpose is to look at an unknown file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUARTER_IN_PATH = r"(\d{4})Q(\d)(?!.*\d{4}Q\d)"


def read_records(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = "|", header: bool = False
) -> DataFrame:
    """All files of a path or list of paths in one scan."""
    where = paths if isinstance(paths, str) else list(paths)
    return spark.read.csv(where, schema=schema, sep=sep, header=header, mode="PERMISSIVE")


def infer_schema(spark: SparkSession, sample: str, sep: str = "|") -> T.StructType:
    """Schema guessed from one file, to be applied to the others."""
    return spark.read.csv(sample, sep=sep, header=False, inferSchema=True).schema


def probe(spark: SparkSession, path: str | Sequence[str], sep: str = "|") -> DataFrame:
    """Rows and columns of an unknown file."""
    df = spark.read.csv(path, sep=sep, header=False)
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns)).alias("columns"))


def with_quarter(df: DataFrame, alias: str) -> DataFrame:
    """Adds the YYYYQn found last in the path of the row's file."""
    year, quarter = (F.regexp_extract("_metadata.file_path", QUARTER_IN_PATH, i) for i in (1, 2))
    return df.select("*", F.concat(year, F.lit("Q"), quarter).alias(alias))


def with_year_quarter(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        F.regexp_extract(path, QUARTER_IN_PATH, 1).cast("int").alias("year"),
        F.regexp_extract(path, QUARTER_IN_PATH, 2).cast("int").alias("quarter"),
    )


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path)


def field_count_report(lines: DataFrame, expected: int, sep: str = "|") -> DataFrame:
    """Lines, and lines whose number of fields is not the expected one."""
    fields = F.length("value") - F.length(F.replace(F.col("value"), F.lit(sep))) + 1
    return lines.agg(
        F.count("*").alias("lines"), F.count_if(fields != expected).alias("malformed")
    )


def register(df: DataFrame, view: str) -> DataFrame:
    df.createOrReplaceTempView(view)
    return df


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
