"""Load modes over files: replace, retire, cross-source dedup and sweep, releases, dictionaries, fill-only updates."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def replace_source_file(stored: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """``stored`` after loading ``incoming``: rows of the same files go, then rows whose id arrives anew, then the new rows are appended."""
    files, arriving = incoming.select("source_file").distinct(), incoming.select(key).distinct()
    kept = stored.join(files, "source_file", "left_anti").join(arriving, key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def delete_source_files(stored: DataFrame, files: list[str]) -> DataFrame:
    return stored.filter(~F.col("source_file").isin(files)) if files else stored


def retire_source_files(stored: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """Drop every file that is not kept, within the files that start with ``prefix``. An empty keep list is refused."""
    if not keep:
        raise ValueError("an empty keep list would retire everything")
    return stored.filter(F.col("source_file").isin(keep) | ~F.col("source_file").startswith(prefix))


def classify_pending(pending: list[str], present: set[str], replaced: set[str]) -> dict[str, list[str]]:
    """Pending retirements: done if the file is gone, to_delete if its successor is loaded, else waiting."""
    out: dict[str, list[str]] = {"to_delete": [], "done": [], "waiting": []}
    for f in pending:
        out["done" if f not in present else "to_delete" if f in replaced else "waiting"].append(f)
    return out


def first_match(rows: DataFrame, held: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds ``matched``: the first of ``keys`` (name -> value here, value there) under which ``held`` has the row; null for none.

    Each key is a left join with the distinct held values, so no row multiplies
    and the larger side is shuffled once per key at most.
    """
    out = rows
    for name, (here, there) in keys.items():
        values = held.select(there.alias(f"_{name}")).filter(F.col(f"_{name}").isNotNull()).distinct().withColumn(f"_has_{name}", F.lit(True))
        out = out.join(values, here == F.col(f"_{name}"), "left").drop(f"_{name}")
    first = F.coalesce(*(F.when(F.col(f"_has_{n}"), F.lit(n)) for n in keys))
    return out.withColumn("matched", first).drop(*(f"_has_{n}" for n in keys))


def dedup_against(rows: DataFrame, held: DataFrame, keys: dict[str, tuple[Column, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows that ``held`` lacks, counts by first matching key)."""
    marked = first_match(rows, held, keys)
    return marked.filter("matched is null").drop("matched"), marked.groupBy(F.coalesce("matched", F.lit("loaded")).alias("outcome")).count()


def reverse_sweep(target: DataFrame, arrived: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``target`` without the rows that share any key with ``arrived``."""
    return first_match(target, arrived, keys).filter("matched is null").drop("matched")


def keep_last(rows: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """The row of the highest load sequence of each key."""
    return top_one(rows, keys, F.col(sequence).desc())


def latest_release(registry: DataFrame, dataset: str) -> str | None:
    row = registry.filter((F.col("dataset") == dataset) & F.col("is_latest")).select("release_id").head()
    return row[0] if row else None


def publish_release(registry: DataFrame, dataset: str, release_id: str, rows: int, source_file: str) -> DataFrame:
    """The registry with one latest release of the dataset, this one. Write it after the release's own partition."""
    others = registry.filter(~((F.col("dataset") == dataset) & (F.col("release_id") == release_id)))
    others = others.withColumn("is_latest", F.col("is_latest") & (F.col("dataset") != dataset))
    new = registry.sparkSession.createDataFrame([(dataset, release_id, True, rows, source_file)], "dataset string, release_id string, is_latest boolean, row_count long, source_file string")
    return others.unionByName(new)


def current_codes(codes: DataFrame, systems: DataFrame) -> DataFrame:
    """Codes of each system's latest release."""
    return codes.join(systems.filter("is_latest").select("system_key", "release_id"), ["system_key", "release_id"])


def extend_dictionary(stored: DataFrame, seen: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """``stored`` and the new distinct keys of ``seen``. Ids never change: new ones follow the largest, in key order.

    The numbering is two-step: rows count within range partitions of the sorted
    keys, and the partitions' counts (one number each) give the offsets, so no
    task holds all new keys.
    """
    same = reduce(lambda a, b: a & b, (F.col(f"n.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys))
    new = seen.select(*keys).distinct().alias("n").join(stored.alias("s"), same, "left_anti")
    top = stored.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long")).head()[0]
    ordered = new.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys)).withColumn("_p", F.spark_partition_id())
    sizes = {r[0]: r[1] for r in ordered.groupBy("_p").count().collect()}
    at, starts = top, []
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(at).cast("long")]
        at += sizes[p]
    if not starts:
        return stored
    w = Window.partitionBy("_p").orderBy(*(F.col(k).asc_nulls_first() for k in keys))
    numbered = ordered.withColumn(id_column, F.element_at(F.create_map(*starts), F.col("_p")) + F.row_number().over(w)).drop("_p")
    return stored.unionByName(numbered.select(*stored.columns))


def fill_only(stored: DataFrame, update: DataFrame, key: str, missing: dict[str, Column]) -> DataFrame:
    """Columns of ``missing`` (name -> condition that the stored value is missing) take the update's value; all else stays.

    ``update`` must have one row per key; adds ``changed``.
    """
    u = update.select(key, *(F.col(c).alias(f"_{c}") for c in missing))
    j = stored.join(u, key, "left")
    takes = {c: cond & F.col(f"_{c}").isNotNull() for c, cond in missing.items()}
    changed = reduce(lambda a, b: a | b, takes.values())
    new = {c: F.when(t, F.col(f"_{c}")).otherwise(F.col(c)) for c, t in takes.items()}
    return j.select(*(new.get(c, F.col(c)).alias(c) for c in stored.columns), F.coalesce(changed, F.lit(False)).alias("changed"))


#: Rows of a slice of a bucket, about. Each slice starts a part of its own, so a hot bucket is many tasks' work.
SLICE_ROWS = 5_000_000


def part_numbers(rows: DataFrame, bucket: str, order: str, size: Column, most_rows: int, most_bytes: int, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Adds ``part`` (long): within each bucket, in ``order``, a row that would take a part over a cap starts the next one.

    So a part has at most ``most_rows`` rows and ``most_bytes`` bytes, or is one
    row over the byte cap. Both counters start anew with each part, which no
    window can express: rows stream through one fold per task. A bucket of over
    ``slice_rows`` rows is dealt to slices by hash of the order; the slice is the
    part's number above 32 bits, 0 for buckets of one slice. A null size counts
    0. Rows with equal order are told apart by all their values.
    """
    slices = rows.groupBy(bucket).agg(F.ceil(F.count("*") / slice_rows).alias("_slices")).filter("_slices > 1")
    many = {r[0]: r[1] for r in slices.collect()}  # buckets with over slice_rows rows: a handful
    dealt = F.lit(0).cast("long")
    for k, n in many.items():
        dealt = F.when(F.col(bucket).eqNullSafe(F.lit(k)), F.pmod(F.xxhash64(order), F.lit(n))).otherwise(dealt)
    columns, kinds = rows.columns, dict(rows.dtypes)
    keyed = rows.withColumns({"_size": F.coalesce(size.cast("long"), F.lit(0)), "_slice": dealt})
    placed = keyed.repartition(F.col(bucket), F.col("_slice")).sortWithinPartitions(bucket, "_slice", order, *(c for c in columns if c not in (bucket, order) and not kinds[c].startswith("map")))
    at, in_slice, in_size = columns.index(bucket), len(columns) + 1, len(columns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, held, part = object(), 0, 0, 0
        for b in batches:
            parts = []
            for key, k, add in zip(b.column(at).to_pylist(), b.column(in_slice).to_pylist(), b.column(in_size).to_pylist(), strict=True):
                if (key, k) != now:
                    now, n, held, part = (key, k), 0, 0, k << 32
                elif n == most_rows or held + add > most_bytes:
                    n, held, part = 0, 0, part + 1
                n, held = n + 1, held + add
                parts.append(part)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(columns))), pa.array(parts, pa.int64())], names=[*columns, "part"])

    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.LongType())])
    return placed.mapInArrow(number, schema)


def write_corpus(rows: DataFrame, path: str) -> None:
    """Hive partitions by source and year, zstd, files sorted by content hash. Only hot partitions spread over several files."""
    spread = rows.repartition(F.col("source"), F.col("year"), F.pmod(F.xxhash64("content_hash"), F.lit(8)))
    spread.sortWithinPartitions("source", "year", "content_hash").write.mode("overwrite").partitionBy("source", "year").option("compression", "zstd").parquet(path)


def write_shards(rows: DataFrame, path: str, most_rows: int = 50_000, fmt: str = "parquet") -> None:
    """Shards below ``source=/source_file=``; a repeated load overwrites only the partitions that it holds."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", most_rows).partitionBy("source", "source_file").format(fmt).save(path)


def swap_pointer(spark, path: str, generation: str) -> None:
    """Publish a generation: a one-row pointer below ``path``, written after the generation itself."""
    spark.createDataFrame([(generation,)], "generation string").coalesce(1).write.mode("overwrite").json(f"{path}/_current")


def read_generation(spark, path: str) -> DataFrame:
    now = spark.read.schema("generation string").json(f"{path}/_current").head()[0]
    return spark.read.parquet(f"{path}/generation={now}")


def substances(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Substance dictionary: the first named row of each UNII, stub rows for moieties without a record, keys kept and moiety keys set."""
    own = top_one(records, ["unii"], F.col("name").isNull(), F.col("seq")).select("unii", "name", "moiety_unii")
    stubs = own.select(F.col("moiety_unii").alias("unii")).filter("unii is not null").distinct().join(own, "unii", "left_anti")
    rows = own.unionByName(stubs.withColumn("name", F.lit(None).cast("string")).withColumn("moiety_unii", F.lit(None).cast("string")))
    keys = extend_dictionary(stored.select("unii", "substance_key"), rows, ["unii"], "substance_key")
    keyed = rows.join(keys, "unii")
    moiety = keys.select(F.col("unii").alias("moiety_unii"), F.col("substance_key").alias("moiety_key"))
    return keyed.join(moiety, "moiety_unii", "left").select("substance_key", "unii", "name", "moiety_unii", "moiety_key")


def stale_rows(stored: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    return stored.join(now.select(*keys).distinct(), keys, "left_anti")
