"""A small register of named queries and, where one exists, their SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


class Book:
    def __init__(self) -> None:
        self.runs: dict[str, Run] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            if name in self.runs:
                raise ValueError(f"query {name} is registered twice")
            self.runs[name] = run
            if sql is not None:
                self.sql[name] = sql
            return run

        return register
