"""New files of a folder, once each: a file source with AvailableNow, whose checkpoint takes the place of success markers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from galenus.operators.articles import finalize
from galenus.operators.load import write_shards


def ingest_new_files(spark: SparkSession, path: str, schema: str, out: str, checkpoint: str, source: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df, fmt: str = "json") -> StreamingQuery:
    """Turn the files that arrived since the last call into finished article shards below ``out``.

    Each batch overwrites the partitions of its own files, so a batch that is
    repeated after a failure writes the same shards again.
    """

    def load(batch: DataFrame, _: int) -> None:
        rows = finalize(shape(batch).withColumn("source", F.lit(source)))
        write_shards(rows, out)

    stream = spark.readStream.format(fmt).schema(schema).load(path).withColumn("source_file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
