"""All registered queries."""

from __future__ import annotations

from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from panelwright.session import tune
from panelwright.workload import collapse
from panelwright.workload.book import Run

CHAPTERS = (
    "cleaning",
    "collapse",
    "ingest",
    "joins",
    "audits",
    "sampling",
    "features",
    "embedding",
    "clusters",
    "profiles",
)


def _books():
    return [import_module(f"panelwright.workload.{name}").book for name in CHAPTERS]


def _tuned(run: Run) -> Run:
    @wraps(run)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(tune(spark), sf_dir)

    return call


def queries() -> dict[str, Run]:
    return {name: _tuned(run) for book in _books() for name, run in book.runs.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for book in _books() for name, sql in book.sql.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse.cells(tune(spark), sf_dir)
