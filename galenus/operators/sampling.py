"""Positions, representative units and spaced samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_position(rows: DataFrame, order: str) -> DataFrame:
    """Adds ``position`` from 1 in the order of a unique column. Range partitions number their rows; only one count per partition reaches the driver."""
    spread = rows.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id())
    sizes = {r[0]: r[1] for r in spread.groupBy("_p").count().collect()}
    starts, at = [], 0
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(at).cast("long")]
        at += sizes[p]
    if not starts:
        return rows.withColumn("position", F.lit(None).cast("long"))
    w = Window.partitionBy("_p").orderBy(order)
    return spread.withColumn("position", F.element_at(F.create_map(*starts), F.col("_p")) + F.row_number().over(w)).drop("_p")


def representative_units(units: DataFrame, by: str = "source") -> DataFrame:
    """(by, which, unit): largest, smallest, median, newest and oldest unit of each group. ``units``: unit, bytes, stamp."""
    size, when = F.struct("bytes", "unit"), F.struct("stamp", "unit")
    stats = units.groupBy(by).agg(
        F.max_by("unit", size).alias("largest"), F.min_by("unit", size).alias("smallest"), F.max_by("unit", when).alias("newest"), F.min_by("unit", when).alias("oldest"),
        F.expr("percentile_disc(0.5) within group (order by bytes)").alias("_mid"),
    )
    middle = units.join(stats.select(by, "_mid"), by).filter("bytes = _mid").groupBy(by).agg(F.min("unit").alias("median"))
    wide = stats.drop("_mid").join(middle, by)
    return wide.unpivot(by, ["largest", "smallest", "median", "newest", "oldest"], "which", "unit")


def nearest(units: DataFrame, column: str, target, k: int = 1) -> DataFrame:
    """The k units whose value is nearest to ``target``, ties by value."""
    return units.orderBy(F.abs(F.col(column) - F.lit(target)), column).limit(k)


def range_cut(tables: dict[str, DataFrame], key: str, ranges: list[tuple[int, int]]) -> dict[str, DataFrame]:
    """The same key ranges of several tables."""
    keep = F.lit(False)
    for low, high in ranges:
        keep = keep | F.col(key).between(low, high)
    return {n: t.filter(keep) for n, t in tables.items()}


def evenly_spaced(items: list, n: int) -> list:
    return [items[i * len(items) // n] for i in range(min(n, len(items)))] if n > 0 else []
