"""A session with the settings this library is written for."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "quillstack", **settings: str) -> SparkSession:
    """Adaptive execution, UTC and Arrow; the cluster's own settings for anything else."""
    builder = SparkSession.builder.appName(name)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the session's spark.checkpoint.dir.

    Only where that is unset on a local master, as in tests, a folder of this process is made and
    deleted at its end; on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quillstack-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """df from files in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def run_folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


#: While this holds, shuffle files of a finished write are deleted.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, folder: str, mode: str = "overwrite") -> DataFrame:
    """df from Parquet files in folder, in the place of what was there unless mode is append.

    Files are compressed and read by columns, which those of ``checkpoint`` are not, so steps that hold whole tables
    take a small part of the disk; the shuffles that made them go with the write.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.mode(mode).parquet(folder)
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def emptied(spark: SparkSession, folder: str) -> None:
    """Deletes what is in folder, as an empty table is written over it."""
    spark.range(0).coalesce(1).write.mode("overwrite").parquet(folder)


#: Rows that one task sorts and packs, whatever the table.
TASK_ROWS = 100_000


def dealt(rows: DataFrame, *keys: str, counted: DataFrame | None = None) -> DataFrame:
    """rows by their keys over as many partitions as hold about ``TASK_ROWS`` rows each, those of the session at least.

    Windows, aggregates and joins by these keys then need no shuffle of their own, and what a task holds
    does not grow with the table. counted: a table of as many rows that is counted more cheaply.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, -(-(rows if counted is None else counted).count() // TASK_ROWS)), *keys)
