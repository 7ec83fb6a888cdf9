"""Folders, tables and joins that the operators of this package share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest serialised size, in bytes, of a relation that may be broadcast.
BROADCAST_BYTES = 4 << 20

#: Bytes of one Arrow batch, about. A single text can be larger and then is a batch of its own.
BATCH_BYTES = 16 << 20

#: Rows, about, of a file of a table whose number of rows is known.
FILE_ROWS = 1 << 13


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is missing and Spark runs on this machine alone, a
    temporary folder takes its place; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="galenus-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def as_table(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives a lost executor.

    ``rows``, about how many there are, keeps a small table from being written as a file for each shuffle partition. On a local
    file system Spark starts a process for the permissions of each file (and one for its checksums), which for a moment shows
    the executor's memory a second time.
    """
    if rows is not None:
        df = df.coalesce(max(1, math.ceil(rows / FILE_ROWS)))
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes. All operators ask for the same bound, and one that is set stays, so
    plans that run later are bounded alike."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def maybe_broadcast(table: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Hint a broadcast if ``rows * row_bytes`` is within ``BROADCAST_BYTES``; else leave the join to a shuffle."""
    rows = table.count() if rows is None else rows
    return F.broadcast(table) if rows * row_bytes <= BROADCAST_BYTES else table


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays. Plain ASCII texts take the faster ``lower``."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def running_sums(values: Column, block: int = 256) -> Column:
    """Exclusive running sums of an array of int.

    Spark has no scan function, and a fold that appends copies its array each
    time. Blocks keep that to ``block`` entries, so the cost stays near linear.
    """

    def scan(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("seen"))
        step = lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["seen"], a["sum"]).alias("seen"))
        return F.aggregate(xs, start, step, lambda a: a["seen"])

    n = F.size(values)
    starts = F.sequence(F.lit(0), F.floor((n - 1) / F.lit(block)).cast("int"))
    blocks = F.transform(starts, lambda b: F.slice(values, b * block + 1, block))
    total = lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x)
    sums = F.flatten(F.zip_with(F.transform(blocks, scan), scan(F.transform(blocks, total)), lambda xs, o: F.transform(xs, lambda x: x + o)))
    return F.when(n > 0, sums).otherwise(F.array().cast("array<int>"))
