"""Session settings and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table, as text, that is sent whole to every executor.
BROADCAST_BYTES = 64 << 20
# Whether Spark removes a query's shuffle files when it ends.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "roleweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; extra settings by keyword with `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: `spark.checkpoint.dir`.

    Only a session in one process may fall back to a folder of its own; with executors elsewhere a
    machine-local folder would be lost with its machine, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="roleweave-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder nobody else uses."""
    return f"{scratch_root(spark)}/roleweave/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage, survives executor loss, fixes what a re-run could change (range boundaries,
    row order), and gives the planner the true size, so it broadcasts only what it has measured. Shuffle files behind the
    table go as soon as it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def byte_size(table: DataFrame) -> Column:
    """Aggregate: size of all rows as text, in bytes."""
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*table.columns)))), F.lit(0))


def fits_broadcast(size: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table of this measured size may be sent to every executor."""
    return size <= limit
