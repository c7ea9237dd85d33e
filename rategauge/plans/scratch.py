"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

#: Spark's own switch: shuffle files of a finished SQL execution are removed at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or the one set on the context.

    Only a local-mode session without either gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rategauge-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before."""
    return f"{shared_folder(spark)}/rategauge-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Later steps start from files: a lost executor costs a re-read, not a
    recomputation, and Catalyst plans with the table's true size.  Shuffle files
    of the write are not needed afterwards and go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
