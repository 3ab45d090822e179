from pathlib import Path

import pandas as pd
from pyspark.sql import functions as F

from panelwright.sources import sinks


def _files(folder):
    return {d.name: [len(pd.read_parquet(f)) for f in d.glob("*.parquet")] for d in Path(folder).iterdir() if d.is_dir()}


def test_files_are_of_even_size_whatever_the_skew(spark, tmp_path):
    # q0 holds most rows, q1 a few, q2 one, and some rows have none
    q = F.expr("CASE WHEN id < 9000 THEN 'q0' WHEN id < 9500 THEN 'q1' WHEN id = 9500 THEN 'q2' END")
    df = spark.range(0, 9600, 1, 13).withColumn("q", q)
    dealt = sinks.sized(df, ["q"], ["id"], rows_per_file=1000)
    assert dealt.columns == df.columns
    folder = str(tmp_path / "out")
    sinks.overwrite_partitioned(dealt, folder, ["q"])
    files = _files(folder)
    assert {k: len(v) for k, v in files.items()} == {"q=q0": 9, "q=q1": 1, "q=q2": 1, "q=__HIVE_DEFAULT_PARTITION__": 1}
    assert max(files["q=q0"]) < 2 * min(files["q=q0"])
    back = spark.read.parquet(folder)
    assert back.count() == 9600 and back.select("id").distinct().count() == 9600


def test_two_levels_and_quotients(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr("id", "id % 3 AS a", "id % 2 AS b")
    folder = str(tmp_path / "out")
    sinks.overwrite_partitioned(sinks.sized(df, ["a", "b"], ["id"], rows_per_file=100), folder, ["a", "b"])
    found = [len(list(d.glob("*.parquet"))) for d in Path(folder).glob("a=*/b=*")]
    assert found == [2] * 6


def test_equal_rows_and_an_empty_frame(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)] * 50, "q string, v int")
    assert sinks.sized(df, ["q"], ["v"], rows_per_file=10).count() == 50
    assert sinks.sized(df.where("false"), ["q"], ["v"]).count() == 0
