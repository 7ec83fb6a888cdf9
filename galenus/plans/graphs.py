"""Graph queries. Proxy: region, nation and customer form a tree of dotted numbers; consecutive parts of an order cite each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.operators import graph
from galenus.plans.registry import query
from galenus.session import table

_TREE = """
tree as (select 'R' || r_regionkey as ui, 'C' || lpad(cast(r_regionkey as varchar), 2, '0') as t from region
  union all select 'N' || n_nationkey, 'C' || lpad(cast(n_regionkey as varchar), 2, '0') || '.' || lpad(cast(n_nationkey as varchar), 3, '0') from nation
  union all select 'S' || s_suppkey, 'C' || lpad(cast(n_regionkey as varchar), 2, '0') || '.' || lpad(cast(n_nationkey as varchar), 3, '0') || '.' || lpad(cast(s_suppkey as varchar), 6, '0') from supplier join nation on s_nationkey = n_nationkey)
"""


def _tree(spark: SparkSession, d: str) -> DataFrame:
    n, s = table(spark, d, "nation"), table(spark, d, "supplier")
    pad = lambda c, k: F.lpad(F.col(c).cast("string"), k, "0")
    top = F.concat(F.lit("C"), pad("n_regionkey", 2), F.lit("."), pad("n_nationkey", 3))
    ui = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string")).alias("descriptor_ui")
    regions = table(spark, d, "region").select(ui("R", "r_regionkey"), F.concat(F.lit("C"), pad("r_regionkey", 2)).alias("tree_number"))
    suppliers = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(ui("S", "s_suppkey"), F.concat(top, F.lit("."), pad("s_suppkey", 6)).alias("tree_number"))
    return regions.unionByName(n.select(ui("N", "n_nationkey"), top.alias("tree_number"))).unionByName(suppliers)


@query(f"with {_TREE}, p as (select t from tree where ui = 'R1') select distinct ui as descriptor_ui from tree, p where tree.t = p.t or tree.t like p.t || '.%'")
def tree_prefix_descendants(spark: SparkSession, d: str) -> DataFrame:
    return graph.descendants(_tree(spark, d), "R1")


@query(f"with {_TREE} select distinct c.ui as child, p.ui as parent from tree c join tree p on regexp_replace(c.t, '\\.[^.]+$', '') = p.t and contains(c.t, '.') where c.ui <> p.ui")
def parent_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.hierarchy_edges(_tree(spark, d))


_RULES = [("place", "tree_prefix", "C01", 1), ("place", "tree_prefix", "C02.008", 1), ("any", "tree_prefix", "C", 1), ("named", "descriptor", "S3", 1), ("old", "descriptor", "S4", 0)]


@query(f"""
with {_TREE}, rules(facet, kind, value) as (values ('place', 'tree_prefix', 'C01'), ('place', 'tree_prefix', 'C02.008'), ('any', 'tree_prefix', 'C'), ('named', 'descriptor', 'S3')),
m as (select distinct cast(l_orderkey as varchar) as pmid, 'S' || l_suppkey as ui from lineitem)
select distinct pmid, facet, m.ui as descriptor_ui from m join rules on kind = 'descriptor' and value = m.ui
union select distinct pmid, facet, m.ui from m join tree on tree.ui = m.ui join rules on kind = 'tree_prefix' and (t = value or t like value || '.%' or (length(value) = 1 and t like value || '%'))
""")
def facet_rules(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: an order is indexed with its suppliers."""
    li = table(spark, d, "lineitem")
    mesh = li.select(F.col("l_orderkey").cast("string").alias("pmid"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("descriptor_ui"))
    none = mesh.limit(0).select("pmid", F.col("descriptor_ui").alias("substance_ui"))
    rules = spark.createDataFrame(_RULES, "facet string, kind string, value string, rule_version int")
    return graph.facets(mesh, _tree(spark, d), none, rules)


@query("""
with recursive e as (select distinct a.l_partkey as src, b.l_partkey as dst from lineitem a join lineitem b on a.l_orderkey = b.l_orderkey and b.l_linenumber = a.l_linenumber + 1),
walk as (select cast(1 as bigint) as node, 0 as hop union select dst, hop + 1 from walk join e on src = node where hop < 3)
select node, min(hop) as hop from walk where node <> 1 group by node
""")
def bfs_reachability(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    edges = li.join(nxt, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").alias("src"), "dst")
    return graph.reachable(edges, spark.createDataFrame([(1,)], "node long"), 3).select("node", "hop")


@query(f"with {_TREE} select distinct cast(l_orderkey as varchar) as pmid from lineitem join tree on ui = 'S' || l_suppkey join (select t as p from tree where ui = 'N8') on t = p or t like p || '.%'")
def articles_for_descriptor(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    mesh = li.select(F.col("l_orderkey").cast("string").alias("pmid"), F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("descriptor_ui"), F.lit(True).alias("major_topic"))
    return graph.articles_for_descriptor(mesh, _tree(spark, d), "N8")
