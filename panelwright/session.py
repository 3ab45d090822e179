"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# settings that can be changed on a running session
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.session.timeZone": "UTC",
    # the JVM does not compile methods above 8000 bytes of bytecode; a projection or
    # aggregate that would need one is generated in smaller parts instead; wide scans stay vectorised
    # up to maxFields columns
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.codegen.maxFields": "100",
}
STATIC = {
    # building wide column lists is several times faster without call-site capture
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (RUNTIME | STATIC | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    It lies under the folder the session names in ``spark.checkpoint.dir``. Only
    a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="panelwright-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame that is read many times to the scratch folder and read it back.
    Unlike a cache, the result outlives the executors that computed it."""
    folder = scratch_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)
