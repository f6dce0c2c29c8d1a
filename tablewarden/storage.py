"""Stage boundaries: results that several later jobs read are written once.

They go to the shared folder of ``spark.checkpoint.dir``, so losing executors
costs a re-read and not a recomputation.
"""
from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_STAGED: list[str] = []


@cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="tablewarden-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local master without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted by :func:`discard`."""
    path = f"{shared_folder(spark)}/tablewarden/{label}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Delete all staged copies; jobs call it when their results are written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _STAGED:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        path.getFileSystem(conf).delete(path, True)
