"""Cutting the lineage of iterative operators, and files in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in ``spark.checkpoint.dir``, which all executors share; only Spark on this machine alone may do without one."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and sc.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="galenus-"))
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``; Spark on this machine alone may do without the setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='galenus-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def put(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small file through the store's API; returns its path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return path
