"""Load-mode queries: replace, priority dedup, sweep, retire, releases, enrichment, set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.operators import load, lookups
from galenus.plans.registry import query
from galenus.session import table


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as k from events) where k = 1")
def keep_last_by_sequence(spark: SparkSession, d: str) -> DataFrame:
    return load.keep_last(table(spark, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


_HELD = "held as (select c_custkey as a, c_name as b, c_nationkey * 10000 + c_custkey % 100 as c from customer where c_custkey % 7 = 0)"
_ROWS = "r as (select o_orderkey, o_custkey as a, 'Customer#' || lpad(cast(o_orderkey % 2000 as varchar), 9, '0') as b, o_orderkey % 25 * 10000 + o_orderkey % 100 as c from orders)"
_MARK = "m as (select *, case when a in (select a from held) then 'pmid' when b in (select b from held) then 'pmcid' when c in (select c from held) then 'doi' end as matched from r)"


def _dedup_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, dict]:
    """Proxy: orders arrive, a seventh of the customers is held; three made-up keys."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    held = table(spark, d, "customer").filter(c % 7 == 0).select(c.alias("a"), F.col("c_name").alias("b"), (F.col("c_nationkey") * 10000 + c % 100).cast("long").alias("c"))
    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("ra"), F.concat(F.lit("Customer#"), F.lpad((k % 2000).cast("string"), 9, "0")).alias("rb"), (k % 25 * 10000 + k % 100).alias("rc"))
    keys = {"pmid": (F.col("ra"), F.col("a")), "pmcid": (F.col("rb"), F.col("b")), "doi": (F.col("rc"), F.col("c"))}
    return rows, held, keys


@query(f"with {_HELD}, {_ROWS}, {_MARK} select coalesce(matched, 'loaded') as outcome, count(*) as count from m group by 1")
def priority_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Rows in counted under the first key that matches; the counts add up to the rows."""
    return load.dedup_against(*_dedup_inputs(spark, d))[1]


@query(f"with {_HELD}, {_ROWS}, {_MARK} select o_orderkey from m where matched is null")
def reverse_sweep(spark: SparkSession, d: str) -> DataFrame:
    return load.reverse_sweep(*_dedup_inputs(spark, d)).select("o_orderkey")


@query("select doc_id, source from documents where source in ('src0', 'src1') or not starts_with(source, 'src1')")
def retire_keep_set(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("source_file"))
    return load.retire_source_files(docs, ["src0", "src1"], "src1").withColumnRenamed("source_file", "source")


@query("""
with n as (select doc_id, 'src0' as source, n_chars + 1 as n_chars from documents where source = 'src0' and doc_id % 2 = 0 union all select doc_id, 'src0', n_chars from documents where source = 'src1' and doc_id % 3 = 0)
select doc_id, source, n_chars from documents where source <> 'src0' and doc_id not in (select doc_id from n) union all select doc_id, source, n_chars from n
""")
def replace_load(spark: SparkSession, d: str) -> DataFrame:
    """A new version of one file, which also claims some ids of another."""
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("source_file"), "n_chars")
    k = F.col("doc_id")
    own = docs.filter((F.col("source_file") == "src0") & (k % 2 == 0)).withColumn("n_chars", F.col("n_chars") + 1)
    taken = docs.filter((F.col("source_file") == "src1") & (k % 3 == 0)).withColumn("source_file", F.lit("src0"))
    return load.replace_source_file(docs, own.unionByName(taken), "doc_id").withColumnRenamed("source_file", "source")


@query("""
with r as (select distinct event_type as dataset, strftime(ts, '%Y-%m-%d') as release_id from events), l as (select dataset, max(release_id) as release_id from r group by 1)
select e.event_type as dataset, l.release_id, count(*) as rows from events e join l on e.event_type = l.dataset and strftime(e.ts, '%Y-%m-%d') = l.release_id group by all
""")
def latest_release(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a day of an event type is a release of its dataset; rows of the newest."""
    e = table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.date_format("ts", "yyyy-MM-dd").alias("release_id"))
    newest = load.top_one(e.distinct(), ["dataset"], F.col("release_id").desc()).withColumn("is_latest", F.lit(True))
    rows = e.withColumnRenamed("dataset", "system_key")
    return load.current_codes(rows, newest.withColumnRenamed("dataset", "system_key")).groupBy(F.col("system_key").alias("dataset"), "release_id").agg(F.count("*").alias("rows"))


@query("""
select c_custkey, case when c_acctbal < 0 then r_name else n_name end as region, c_acctbal < 0 as changed from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def enrichment_fill_only(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: customers in debt lack their place and take the region; others keep the nation."""
    c = F.col
    n = table(spark, d, "nation").join(table(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    stored = table(spark, d, "customer").join(table(spark, d, "nation"), c("c_nationkey") == c("n_nationkey")).select("c_custkey", F.when(c("c_acctbal") >= 0, c("n_name")).alias("region"))
    update = table(spark, d, "customer").join(n, c("c_nationkey") == c("n_nationkey")).select("c_custkey", c("r_name").alias("region"))
    return load.fill_only(stored, update, "c_custkey", {"region": c("region").isNull()})


@query("""
select n_nationkey as k from nation where n_nationkey in (select c_nationkey from customer where c_acctbal > 5000 union select s_nationkey from supplier) and n_nationkey not in (select c_nationkey from customer where c_mktsegment = 'BUILDING' and c_acctbal > 9900)
""")
def set_ops_union_except(spark: SparkSession, d: str) -> DataFrame:
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    some = c.filter("c_acctbal > 5000").select(F.col("c_nationkey").alias("k")).union(s.select("s_nationkey")).distinct()
    return some.join(table(spark, d, "nation").select(F.col("n_nationkey").alias("k")), "k", "left_semi").subtract(c.filter("c_mktsegment = 'BUILDING' and c_acctbal > 9900").select("c_nationkey"))


@query("select p_brand as name, cast(row_number() over (order by p_brand) as bigint) + 2 as id from (select distinct p_brand from part) where p_brand not in ('Brand#11', 'Brand#33') union all select 'Brand#11', 1 union all select 'Brand#33', 2")
def dictionary_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Stable ids: two brands are known, the others follow in order."""
    stored = spark.createDataFrame([("Brand#11", 1), ("Brand#33", 2)], "name string, id long")
    return load.extend_dictionary(stored, table(spark, d, "part").select(F.col("p_brand").alias("name")), ["name"], "id")


@query("""
select o_orderkey as record_key, cast(o_orderdate as date) as event_date, o_orderstatus as status from orders where o_custkey in (1, 4, 7, 10) and cast(o_orderdate as date) between date '1996-01-01' and date '1998-12-31'
""")
def safety_actions_between(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: an order is a regulatory record named after its customer."""
    o = table(spark, d, "orders")
    records = o.select(
        F.lit("ds").alias("dataset"), F.lit("r1").alias("release_id"), F.col("o_orderkey").alias("record_key"), F.array(F.col("o_custkey").cast("string")).alias("substance_names"),
        F.col("o_orderdate").alias("event_date"), F.col("o_orderstatus").alias("status"),
    )
    return lookups.records_for_names(records, ("1", "4", "7", "10"), "ds", "r1", date(1996, 1, 1), date(1998, 12, 31)).select("record_key", "event_date", "status")


@query("""
select cast(q as date) as quarter from (select unnest(generate_series(date '1994-01-01', date '2002-10-01', interval 3 month)) as q) where q not in (select date_trunc('quarter', cast(o_orderdate as date)) from orders)
""")
def quarter_gaps(spark: SparkSession, d: str) -> DataFrame:
    totals = table(spark, d, "orders").select(F.trunc("o_orderdate", "quarter").alias("quarter")).distinct()
    return lookups.quarter_gaps(totals, date(1994, 1, 1), date(2002, 12, 31))


@query("select l_orderkey, cast(count(*) as bigint) as n_parts from lineitem join part on l_partkey = p_partkey group by 1 having bool_or(p_brand in ('Brand#12', 'Brand#34'))")
def array_overlap_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Orders whose brands overlap a list."""
    j = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    a = j.groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("brands"), F.count("*").alias("n_parts"))
    return a.filter(F.arrays_overlap("brands", F.array(F.lit("Brand#12"), F.lit("Brand#34")))).select("l_orderkey", "n_parts")


@query("""
with m as (select cast(doc_id as varchar) as pmid, source as descriptor_name, lang as q from documents),
h as (select pmid from m where descriptor_name in ('src1', 'src2') and q = 'en')
select pmid, cast(2000 + cast(pmid as bigint) % 20 as int) as year from h order by year desc nulls last, length(pmid) desc, pmid desc limit 20
""")
def literature_topk(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: the source is a descriptor, the language its qualifier."""
    docs, pmid = table(spark, d, "documents"), F.col("doc_id").cast("string").alias("pmid")
    mesh = docs.select(pmid, F.col("source").alias("descriptor_name"), F.array("lang").alias("qualifiers"), F.lit("f").alias("source_file"))
    articles = docs.select(pmid, (2000 + F.col("doc_id") % 20).cast("int").alias("year"))
    return lookups.indexed_literature(mesh, articles, ("src1", "src2"), "en").select("pmid", "year")


@query("""
with o as (select c_custkey as substance_key, 'U' || c_custkey as unii, c_mktsegment as name, case when c_custkey % 4 = 0 then c_custkey - 1 end as moiety_key from customer where c_custkey <= 200)
select substance_key, unii, coalesce(moiety_key = substance_key, true) as is_moiety from o where unii = 'U8' or substance_key in (select c_custkey from customer where c_custkey <= 200 and lower(c_mktsegment) = 'u8')
union all select substance_key, unii, coalesce(moiety_key = substance_key, true) from o where lower(name) = 'building' and unii <> 'U8' and false
""")
def resolve_entity(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: customers are substances named after their segment; a code resolves to its owner."""
    k = F.col("c_custkey")
    subs = table(spark, d, "customer").select(k.alias("substance_key"), F.concat(F.lit("U"), k.cast("string")).alias("unii"), F.col("c_mktsegment").alias("name"), F.when(k % 4 == 0, k - 1).alias("moiety_key"))
    xref = subs.select("substance_key", F.lit("name").alias("id_type"), F.lower("name").alias("id_value"))
    return lookups.resolved("u8", subs, xref).select("substance_key", "unii", "is_moiety")
