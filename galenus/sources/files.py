"""Discovery and identity of input files, shards, and rules on file names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Column names that mark question-answer data, and names of evaluation sets.
QA_COLUMNS = ("question", "answer", "options", "choices", "opa")
BENCHMARKS = ("medqa", "medmcqa", "pubmedqa", "mmlu", "benchmark", "usmle", "cmexam", "cmb", "headqa", "frenchmedmcqa")


def source_file(root: str) -> Column:
    """Path of the current file relative to ``root``."""
    return F.regexp_replace(F.col("_metadata.file_path"), r"^(?:[a-z0-9]+:/*)?/*" + root.strip("/").replace(".", r"\.").split("://")[-1].lstrip("/") + "/+", "")


def is_benchmark_path(path: Column) -> Column:
    return F.lower(path).rlike("|".join(BENCHMARKS))


def is_non_commercial_path(path: Column) -> Column:
    return F.upper(path).rlike("-NC|_NC|NON-COMMERCIAL")


def is_qa_shaped(columns: list[str]) -> bool:
    return bool({c.lower() for c in columns} & set(QA_COLUMNS))


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length, modified) of files below ``root``; hidden ones are skipped by the reader, and no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).distinct()


def highest_versions(files: DataFrame, name: Column, bucket_width: int = 1_000_000) -> tuple[DataFrame, DataFrame]:
    """(files of the highest version of each article, counts by bucket: kept, superseded versions, duplicate files).

    ``name`` is like PMC123.4.json; of files with one id and version the first
    path counts. Names of another form are the bucket null, counted as unrecognised.
    """
    parts = r"^PMC(\d+)\.(\d+)\.\w+$"
    number, version = (F.nullif(F.regexp_extract(name, parts, i), F.lit("")).cast("bigint") for i in (1, 2))
    marked = files.withColumns({"pmc_id": number, "version": version}).withColumn("bucket", F.floor(F.col("pmc_id") / bucket_width))
    copies = Window.partitionBy("pmc_id", "version").orderBy("path")
    ranked = marked.withColumn("_copy", F.row_number().over(copies)).withColumn("_top", F.max("version").over(Window.partitionBy("pmc_id")))
    named, first, top = F.col("pmc_id").isNotNull(), F.col("_copy") == 1, F.col("version") == F.col("_top")
    counts = ranked.groupBy("bucket").agg(
        F.count_if(named & first & top).alias("kept"), F.count_if(named & first & ~top).alias("superseded"), F.count_if(named & ~first).alias("duplicates"), F.count_if(~named).alias("unrecognised"),
    )
    return ranked.filter(named & first & top).drop("_copy", "_top"), counts


def read_text_lines(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    reader = spark.read
    if separator:
        reader = reader.option("lineSep", separator)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))


def read_shards(spark: SparkSession, parquet: list[str], jsonl: list[str]) -> DataFrame:
    """Union by name of parquet and JSON-lines shards, with their file name."""
    name = F.col("_metadata.file_name").alias("filename")
    frames = [spark.read.option("mergeSchema", "true").parquet(*parquet).select("*", name)] if parquet else []
    frames += [spark.read.json(jsonl).select("*", name)] if jsonl else []
    if not frames:
        raise ValueError("no shards")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_text_tree(spark: SparkSession, root: str) -> DataFrame:
    """Whole text files below ``root``, outside directories whose name says non-commercial."""
    texts = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(root).select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("source_file"))
    return texts.filter(~is_non_commercial_path(F.col("source_file")))
