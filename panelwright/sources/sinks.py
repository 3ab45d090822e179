"""Writing tables and checking what was written."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.session import stored

#: Rows that a file of a partitioned table should hold.
ROWS_PER_FILE = 2_000_000
#: Partition values up to which their table of counts is sent to all tasks.
BROADCAST_VALUES = 10_000
#: Files that a task of a partitioned write keeps open: three decades of quarters.
OPEN_FILES = 128


@contextmanager
def open_files(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Partitioned writes inside keep up to ``files`` files of a task open, so that wide rows need no sort by partition
    and no spill of it; a task that meets more partition values sorts the rest."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def append_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    with open_files(df.sparkSession):
        df.write.mode("append").partitionBy(*by).parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, by: Sequence[str], dynamic: bool = False) -> None:
    """Replaces the table, or with ``dynamic`` only the partitions in the frame, so a
    repeated run neither skips nor doubles rows. No shuffle before the write."""
    writer = df.write.mode("overwrite").partitionBy(*by).option("compression", "snappy")
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.option("partitionOverwriteMode", "static")
    with open_files(df.sparkSession):
        writer.parquet(path)


def sized(
    df: DataFrame, by: Sequence[str], spread: Sequence[str], rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """The rows dealt so that a partitioned write makes files of even size and no more than needed.

    Rows are counted per partition value first. A value gets a task for every ``rows_per_file`` rows it holds, so a
    value with a third of all rows is written by many tasks and a small one by a single task. Within a value, rows go
    by a hash of the ``spread`` columns, which should tell most rows apart; equal rows share a file. Null values are a
    partition like any other. An empty frame is returned as it is.
    """
    counts = stored(df.groupBy(*by).agg(F.count("*").alias("_rows")), "partition_counts")
    files = F.ceil(F.col("_rows") / rows_per_file).cast("int")
    row = counts.agg(F.count("*").alias("values"), F.sum(files).alias("files")).first()
    if not row["values"]:
        return df
    # the first task of each value; the table has a row per partition folder
    places = counts.select(*[F.col(n).alias(f"_by_{n}") for n in by], files.alias("_files"))
    before = W.orderBy(*[f"_by_{n}" for n in by]).rowsBetween(W.unboundedPreceding, -1)
    places = places.withColumn("_first", F.coalesce(F.sum("_files").over(before), F.lit(0)))
    if row["values"] <= BROADCAST_VALUES:
        places = F.broadcast(places)
    same = F.lit(True)
    for n in by:
        same = same & df[n].eqNullSafe(F.col(f"_by_{n}"))
    task = F.col("_first") + F.pmod(F.xxhash64(*[df[n] for n in spread]), F.col("_files"))
    placed = df.join(places, same).withColumn("_task", task.cast("int"))
    return placed.repartitionById(int(row["files"]), "_task").select(*df.columns)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """A table in buckets of the key, a file each, at a path of its own. Joins and groupings by the key read it without
    a shuffle. ``dealt`` says that the frame comes out of such a join already, a bucket in each task."""
    rows = df if dealt else df.repartition(buckets, key)
    writer = rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite")
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def write_files(df: DataFrame, path: str, files: int) -> None:
    """A fixed number of Parquet files."""
    df.repartition(files).write.mode("overwrite").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, as many files as the frame has partitions."""
    df.write.mode("overwrite").option("header", "true").csv(path)


def export_single_csv(df: DataFrame, path: str) -> None:
    """CSV with header in exactly one file, for samples and reports: one task writes it. The shuffle before it
    leaves the work on the rows with all tasks."""
    df.repartition(1).write.mode("overwrite").option("header", "true").csv(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").save(path)


def write_capped(df: DataFrame, path: str, rows: int = 200_000) -> None:
    """The first rows only, as a hand-out extract."""
    df.limit(rows).write.mode("overwrite").parquet(path)


def validate_written(
    spark: SparkSession,
    path: str,
    expected_rows: int,
    expected_columns: Sequence[str],
    by: str | None = None,
    expected_partitions: Mapping[str, int] | None = None,
    expected_types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Re-reads a written table: (check, expected, found, ok).

    ``expected_partitions`` maps the values of ``by`` that should be there to their rows, ``expected_types`` columns to
    Spark type names; both come from the source or the specification, not from the table itself.
    """
    df = spark.read.parquet(path)
    if by:
        # one row per partition value, as many as directories
        found = {str(r[0]): r[1] for r in df.groupBy(by).count().collect()}
        rows = sum(found.values())
    else:
        rows = df.count()
    checks = [
        ("rows", str(expected_rows), str(rows)),
        ("columns", str(len(expected_columns)), str(len(df.columns))),
        ("missing columns", "", ",".join(sorted(set(expected_columns) - set(df.columns)))),
        ("extra columns", "", ",".join(sorted(set(df.columns) - set(expected_columns)))),
    ]
    if expected_types is not None:
        wrong = sorted(n for n, kind in df.dtypes if n in expected_types and expected_types[n] != kind)
        checks.append(("wrong types", "", ",".join(wrong)))
    if by and expected_partitions is not None:
        wanted = {str(k): n for k, n in expected_partitions.items()}
        checks += [
            ("first partition", min(wanted, default=""), min(found, default="")),
            ("last partition", max(wanted, default=""), max(found, default="")),
            ("partitions", str(len(wanted)), str(len(found))),
            ("missing partitions", "", ",".join(sorted(set(wanted) - set(found)))),
            ("extra partitions", "", ",".join(sorted(set(found) - set(wanted)))),
            ("wrong partition rows", "", ",".join(sorted(k for k in wanted if found.get(k, wanted[k]) != wanted[k]))),
        ]
    return spark.createDataFrame(
        [(*x, int(x[1] == x[2])) for x in checks], "check string, expected string, found string, ok int"
    )
