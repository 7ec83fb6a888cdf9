"""Citation, vocabulary and facet graphs: edges, hierarchy, hop-bounded reachability, neighbour kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galenus.operators.checkpoints import cut

# Facet rules (facet, kind, value), version 1.
FACET_RULES = (
    ("condition", "tree_prefix", "C"), ("condition", "tree_prefix", "F03"), ("test", "tree_prefix", "E01"), ("test", "tree_prefix", "E05"), ("drug", "tree_prefix", "D"),
    ("demographic", "descriptor", "D006801"), ("demographic", "descriptor", "D000818"), ("demographic", "descriptor", "D008297"), ("demographic", "descriptor", "D005260"),
    ("demographic", "tree_prefix", "M01.060"), ("demographic", "tree_prefix", "M01.390"), ("demographic", "tree_prefix", "M01.975"),
    ("special_population", "descriptor", "D011247"), ("special_population", "descriptor", "D037841"), ("special_population", "descriptor", "D007231"),
    ("special_population", "descriptor", "D007234"), ("special_population", "descriptor", "D000369"),
    ("special_population", "tree_prefix", "M01.066"), ("special_population", "tree_prefix", "M01.150"), ("special_population", "tree_prefix", "M01.169"),
    ("special_population", "tree_prefix", "M01.189"), ("special_population", "tree_prefix", "M01.270"), ("special_population", "tree_prefix", "M01.325"),
    ("special_population", "tree_prefix", "M01.385"), ("special_population", "tree_prefix", "M01.686"), ("special_population", "tree_prefix", "M01.729"),
    ("special_population", "tree_prefix", "M01.755"), ("special_population", "tree_prefix", "M01.873"), ("special_population", "tree_prefix", "M01.920"),
    ("special_population", "tree_prefix", "M01.925"), ("special_population", "tree_prefix", "M01.930"),
)
KINDS = ("mesh", "cites", "part", "mesh_parent", "mesh_child", "cited_by", "comments", "chemical", "keyword", "author", "facet")


def facet_rules(spark) -> DataFrame:
    return spark.createDataFrame([(*r, 1) for r in FACET_RULES], "facet string, kind string, value string, rule_version int")


def tree_prefixes(tree: Column) -> Column:
    """The first letter and every dotted prefix of a tree number, itself included: a prefix join becomes an equi join."""
    parts = F.split(tree, r"\.")
    dotted = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."))
    return F.array_distinct(F.concat(F.array(F.substring(tree, 1, 1)), dotted))


def parent_of(tree: Column) -> Column:
    """Tree number without its last segment; null at the top."""
    return F.when(F.contains(tree, F.lit(".")), F.regexp_replace(tree, r"\.[^.]+$", ""))


def hierarchy_edges(trees: DataFrame) -> DataFrame:
    """(child, parent) descriptors of a table (descriptor_ui, tree_number); edges of a descriptor to itself are left out."""
    child, up = trees.alias("c"), trees.alias("p")
    j = child.join(up, parent_of(F.col("c.tree_number")) == F.col("p.tree_number"))
    return j.select(F.col("c.descriptor_ui").alias("child"), F.col("p.descriptor_ui").alias("parent")).filter("child <> parent").distinct()


def part_edges(articles: DataFrame) -> DataFrame:
    return articles.filter("container_id is not null").select(F.col("id").alias("part_id"), "container_id")


def descendants(trees: DataFrame, ui: str) -> DataFrame:
    """Descriptors at or below any tree position of ``ui``."""
    tops = trees.filter(F.col("descriptor_ui") == ui).select(F.col("tree_number").alias("prefix"))
    below = trees.select("descriptor_ui", F.explode(tree_prefixes(F.col("tree_number"))).alias("prefix"))
    return below.join(tops, "prefix", "left_semi").select("descriptor_ui").unionByName(trees.sparkSession.createDataFrame([(ui,)], "descriptor_ui string")).distinct()


def articles_for_descriptor(mesh: DataFrame, trees: DataFrame, ui: str, include_descendants: bool = True, major_only: bool = False, limit: int | None = None) -> DataFrame:
    """Distinct sorted record ids indexed with a descriptor, or with one below it."""
    hits = mesh.join(descendants(trees, ui), "descriptor_ui", "left_semi") if include_descendants else mesh.filter(F.col("descriptor_ui") == ui)
    hits = hits.filter("major_topic") if major_only else hits
    out = hits.select("pmid").distinct().orderBy(F.length("pmid"), "pmid")
    return out.limit(limit) if limit is not None else out


def facets(mesh: DataFrame, trees: DataFrame, chemicals: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (pmid, facet, descriptor_ui) of the newest rule version: descriptor rules, tree-prefix rules, and chemicals below D as drug.

    A one-letter prefix fits any continuation, longer ones only whole segments.
    """
    newest = rules.join(rules.agg(F.max("rule_version").alias("rule_version")), "rule_version", "left_semi")
    by_ui = newest.filter("kind = 'descriptor'").select("facet", F.col("value").alias("descriptor_ui"))
    positions = trees.select("descriptor_ui", F.explode(tree_prefixes(F.col("tree_number"))).alias("value"))
    by_tree = positions.join(newest.filter("kind = 'tree_prefix'").select("facet", "value"), "value").select("facet", "descriptor_ui").distinct()
    indexed = mesh.filter("pmid is not null and descriptor_ui is not null").select("pmid", "descriptor_ui")
    direct = indexed.join(by_ui.unionByName(by_tree).distinct(), "descriptor_ui").select("pmid", "facet", "descriptor_ui")
    drugs = trees.filter(F.col("tree_number").startswith("D")).select(F.col("descriptor_ui").alias("substance_ui")).distinct()
    substances = chemicals.join(drugs, "substance_ui", "left_semi").select("pmid", F.lit("drug").alias("facet"), F.col("substance_ui").alias("descriptor_ui"))
    return direct.unionByName(substances).distinct()


def reachable(edges: DataFrame, seeds: DataFrame, hops: int) -> DataFrame:
    """(seed, node, hop): nodes within ``hops`` edges (src, dst) of each seed (node), the seed left out; hop is the least.

    Breadth first with a visited set, so cycles end; null destinations are
    ignored. Each round's frontier is cut, and the visited set is the union of
    frontiers, so no round computes an earlier one again.
    """
    steps = edges.filter("src is not null and dst is not null").select("src", "dst").distinct()
    frontier = cut(seeds.select(F.col("node").alias("seed"), "node", F.lit(0).alias("hop")).distinct())
    seen = frontier
    for hop in range(1, hops + 1):
        nxt = frontier.join(steps, frontier.node == steps.src).select("seed", F.col("dst").alias("node")).distinct()
        frontier = cut(nxt.join(seen.select("seed", "node"), ["seed", "node"], "left_anti").withColumn("hop", F.lit(hop)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen.filter("hop > 0")


def neighbours(tables: dict[str, DataFrame], key: str, kind: str, hops: int = 1, ref_type: str | None = None) -> DataFrame:
    """Sorted distinct neighbours (one column) of a record, descriptor or part, by one of KINDS."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind {kind!r}")
    spark = next(iter(tables.values())).sparkSession
    of = lambda name, column="pmid": tables[name].filter(F.col(column) == key)
    if kind == "mesh":
        out = of("mesh").select(F.coalesce("descriptor_ui", "descriptor_name").alias("n"))
    elif kind == "cites":
        edges = tables["cites"].select(F.col("src_pmid").alias("src"), F.col("dst_pmid").alias("dst"))
        out = reachable(edges, spark.createDataFrame([(key,)], "node string"), hops).select(F.col("node").alias("n"))
    elif kind == "cited_by":
        out = of("cites", "dst_pmid").select(F.col("src_pmid").alias("n"))
    elif kind == "part":
        out = of("parts", "container_id").select(F.col("part_id").alias("n")).unionByName(of("parts", "part_id").select(F.col("container_id").alias("n")))
    elif kind == "mesh_parent":
        out = of("hierarchy", "child").select(F.col("parent").alias("n"))
    elif kind == "mesh_child":
        out = of("hierarchy", "parent").select(F.col("child").alias("n"))
    elif kind == "comments":
        rows = of("comments")
        rows = rows.filter(F.col("ref_type") == ref_type) if ref_type else rows
        out = rows.select(F.concat_ws(":", "ref_type", F.coalesce("ref_pmid", F.lit(""))).alias("n"))
    elif kind == "chemical":
        out = of("chemicals").select(F.coalesce("substance_ui", "name").alias("n"))
    elif kind == "keyword":
        out = of("keywords").select(F.lower("keyword").alias("n"))
    elif kind == "author":
        name = F.coalesce(F.nullif(F.concat_ws(" ", "fore_name", "last_name"), F.lit("")), F.col("collective_name"), F.lit(""))
        out = of("authors").select(F.concat_ws(":", F.col("position").cast("string"), name, F.coalesce("orcid", F.lit(""))).alias("n"))
    else:
        out = of("facets").select(F.concat_ws(":", "facet", "descriptor_ui").alias("n"))
    return out.filter("n is not null").distinct().orderBy("n")


def articles_for_facet(facet_table: DataFrame, facet: str, ui: str | None = None, limit: int = 100) -> DataFrame:
    hits = facet_table.filter(F.col("facet") == facet)
    hits = hits.filter(F.col("descriptor_ui") == ui) if ui else hits
    return hits.select("pmid").distinct().orderBy(F.length("pmid"), "pmid").limit(limit)


def articles_by_orcid(authors: DataFrame, orcid: str, limit: int = 100) -> DataFrame:
    return authors.filter(F.col("orcid") == orcid).select("pmid").distinct().orderBy(F.length("pmid"), "pmid").limit(limit)


def stale_facets(facet_table: DataFrame, rules: DataFrame) -> DataFrame:
    """Per file: rows in all, rows of an older rule version, and distinct older versions."""
    newest = rules.agg(F.max("rule_version").alias("newest"))
    j = facet_table.crossJoin(F.broadcast(newest))  # one row
    old = F.col("rule_version") < F.col("newest")
    return j.groupBy("source_file").agg(F.count("*").alias("rows"), F.count_if(old).alias("stale_rows"), F.count_distinct(F.when(old, F.col("rule_version"))).alias("old_versions"))
