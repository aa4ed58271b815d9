"""Intermediate tables in the shared folder of the cluster.

A result that several branches read is written once and read back as parquet. The reread
is column-pruned, carries true sizes for join planning, and survives executor loss.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback_root: str | None = None
_staged: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a local master gets a scratch folder; a cluster gets an error, as its
    executors would each write to a disk of their own.
    """
    global _fallback_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _fallback_root is None:
        _fallback_root = tempfile.mkdtemp(prefix="clickloom-")
    return _fallback_root


def stage(df: DataFrame) -> DataFrame:
    """Write a table once and read it back; ``release_staged`` deletes it."""
    spark = df.sparkSession
    path = f"{staging_root(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this process has staged so far, for when their results have been used;
    the number of folders removed."""
    removed = 0
    while _staged:
        removed += delete_folder(spark, _staged.pop())
    return removed


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder through its own file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.delete(folder, True)
