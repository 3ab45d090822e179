"""Equi-joins on the entity key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_of(panel: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """Panel rows of the listed entities. Spark broadcasts the list only if it is small."""
    return panel.join(entities, key, "left_semi")


def rows_without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "left_anti")


def normalise_key(df: DataFrame, key: str, alias: str) -> DataFrame:
    """Key without leading zeros, for tables that lost them."""
    return df.withColumn(alias, F.ltrim(F.col(key), F.lit("0")))


def align(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows present in every table, with the columns of all of them."""
    return reduce(lambda a, b: a.join(b, key), tables)
