"""Session settings and the one shared folder the library may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A part of a series (about 33,000 rows) stays in memory while windows run over it.
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
}


def build_session(app: str = "ridgeline", master: str | None = None, **extra: str) -> SparkSession:
    """Get or create a session; ``extra`` holds further settings by their full names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to a temporary
    folder; a cluster session without it is refused.
    """
    return _workspaces[-1] if _workspaces else lasting_dir(spark)


def lasting_dir(spark: SparkSession) -> str:
    """The same folder without regard to a ``workspace``, for what is to outlast it."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ridgeline-"))
    return context.getCheckpointDir()


_workspaces: list[str] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder in the shared one for all that is stored inside the block; deleted at its end.

    Write or collect results inside: a frame returned from the block may still read
    tables that are gone after it.
    """
    folder = f"{shared_dir(spark)}/job-{uuid.uuid4().hex}"
    _workspaces.append(folder)
    try:
        yield folder
    finally:
        _workspaces.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    For a frame that several later steps read: they start from stored columns
    instead of repeating its shuffles, also after losing an executor, and Spark
    knows the table's real size when it plans a join with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
