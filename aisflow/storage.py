"""Where intermediate tables go, and when they are removed.

A cluster names a folder that all executors share in ``spark.checkpoint.dir``.
Only a session whose executors are threads of its own process may fall back to
a temporary folder.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Folder of the innermost job that is under way; each thread has jobs of its own.
_JOB: ContextVar[str | None] = ContextVar("aisflow-job", default=None)


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="aisflow-")


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the folder of the current job, or else the shared folder."""
    return f"{_JOB.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """A folder of its own for what a job writes on the way. It is removed when the job has
    written its result, or has failed."""
    folder = scratch_path(spark, "job")
    outer = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, lineage cut, columns still prunable."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
