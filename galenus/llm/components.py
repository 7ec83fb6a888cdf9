"""Connected components of an edge table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import as_table


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One large-star (``larger``) or small-star step on edges (u, v) with u > v."""
    if larger:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = edges.join(least, "u")
        out = linked.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def connected_components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v): root is the smallest node of its component.

    Alternating stars: each round is two aggregations and joins on the node, so
    a hub's edges are pre-aggregated and AQE may split them. Each round is
    written to the shared folder, and the rounds end when the edges stay as they
    are, which then form stars.

    Loops and repeated edges are no harm; nulls are left out; no edges, no rows. ``rows``, about how many edges there are, only
    sets the number of files of the first table; no round has more edges than the one before.
    """
    now = as_table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", rows)
    sign = None
    while True:
        new = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).head())
        if new == sign:
            break
        sign = new
        if not new[0]:
            break
        now = as_table(_star(_star(now, True), False), "edges", new[0])
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
