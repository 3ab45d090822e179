"""Stages that are kept: what was computed from the same input with the same parameters is not computed again.

Every stage writes a table of its own below the flow's folder, then one row to the ledger. A run that breaks leaves
the tables of the finished stages and their rows, and the next one goes on at the stage that failed.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.sources import listing

LEDGER = "stage string, fingerprint string, folder string, parameters string, inputs string, finished timestamp"


@dataclass(frozen=True)
class Stage:
    """``run`` takes the session, a frame per input (a source or an earlier stage) and the parameters by name."""

    name: str
    run: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    parameters: Mapping[str, Any] = field(default_factory=dict)


def folder_fingerprint(spark: SparkSession, folder: str) -> str:
    """Digest of the paths, lengths and times of a folder's files; no content is read and no listing collected."""
    digest = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    files = listing.list_files(spark, folder).where(~F.col("name").rlike(r"^[_.]"))
    row = files.agg(F.count("*").alias("n"), digest.alias("digest")).first()
    return f"{row['n']}:{row['digest']}"


def _digest(*parts: Any) -> str:
    text = json.dumps(parts, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def finished(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger: a row per finished stage and fingerprint."""
    path = f"{folder.rstrip('/')}/ledger"
    if not listing.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def run_flow(
    spark: SparkSession, stages: Sequence[Stage], sources: Mapping[str, str], folder: str
) -> dict[str, DataFrame]:
    """Runs the stages in their order and returns the table of each.

    A stage's fingerprint covers its name, its parameters and the fingerprints of its inputs, so a changed source
    or parameter runs that stage and all that read it again, and nothing else. Parameters have to be plain values.
    The driver holds a row per stage.
    """
    folder = folder.rstrip("/")
    known = {r["fingerprint"]: r["folder"] for r in finished(spark, folder).collect()}
    prints = {name: folder_fingerprint(spark, path) for name, path in sources.items()}
    tables = {name: spark.read.parquet(path) for name, path in sources.items()}
    done: dict[str, DataFrame] = {}
    for stage in stages:
        if stage.name in tables:
            raise ValueError(f"{stage.name} is the name of two stages or of a source")
        inputs = [prints[n] for n in stage.inputs]
        mark = prints[stage.name] = _digest(stage.name, dict(stage.parameters), inputs)
        target = known.get(mark)
        if target is None:
            target = f"{folder}/{stage.name}-{mark[:16]}"
            frames = [tables[n] for n in stage.inputs]
            # what a broken run has left of the table is replaced
            stage.run(spark, *frames, **stage.parameters).write.mode("overwrite").parquet(target)
            row = (stage.name, mark, target, json.dumps(dict(stage.parameters), sort_keys=True, default=str), ",".join(stage.inputs))
            record = spark.createDataFrame([row], "stage string, fingerprint string, folder string, parameters string, inputs string")
            record.withColumn("finished", F.current_timestamp()).write.mode("append").parquet(f"{folder}/ledger")
        tables[stage.name] = done[stage.name] = spark.read.parquet(target)
    return done
