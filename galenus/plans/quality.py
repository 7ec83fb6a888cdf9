"""Quality-measure and audit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.operators import quality
from galenus.plans.registry import query
from galenus.session import table


@query("""
select count(*) as rows, count(distinct doc_id) as distinct_ids, count(doc_id) - count(distinct doc_id) as duplicate_ids, round(100.0 * count(*) filter (trim(text) = '') / count(*), 4) as empty_text_pct,
  quantile_disc(strlen(text), 0.5) as bytes_p50, quantile_disc(strlen(text), 0.99) as bytes_p99, max(strlen(text)) as bytes_max, cast(sum(strlen(text)) as bigint) as bytes_total from documents
""")
def staging_profile(spark: SparkSession, d: str) -> DataFrame:
    p = quality.shard_profile(table(spark, d, "documents"), "doc_id")
    return p.select(*(F.col(c).cast("long").alias(c) if c.startswith("bytes") else F.col(c) for c in p.columns))


@query("select source as source_file, count(*) as rows, cast(sum(strlen(text) + 64) as bigint) as est_bytes, case when count(*) > 1 then cast(sum(strlen(text) + 64) as bigint) end as capped_bytes from documents group by 1")
def part_profile(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumnRenamed("source", "source_file")
    return quality.part_profile(docs, F.octet_length("text") + 64)


@query("""
select 'c_mktsegment' as "column", round(100.0 * count(c_mktsegment) / count(*), 4) as non_null_pct, count(distinct c_mktsegment) as "distinct", min(c_mktsegment) as least, max(c_mktsegment) as greatest from customer
union all select 'c_name', round(100.0 * count(c_name) / count(*), 4), count(distinct c_name), min(c_name), max(c_name) from customer
""")
def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.column_profile(table(spark, d, "customer").select("c_mktsegment", "c_name")).drop("flag")


@query("select count(*) as rows, count(*) filter (l.doc_id is null) as orphans, round(100.0 * count(*) filter (l.doc_id is null) / count(*), 4) as orphan_pct from documents d left join (select distinct doc_id from labels) l on l.doc_id = d.doc_id")
def orphan_share(spark: SparkSession, d: str) -> DataFrame:
    """Documents without a label."""
    return quality.orphan_share(table(spark, d, "documents"), table(spark, d, "labels"), "doc_id")


@query("select source as value, count(*) as n from documents group by 1")
def source_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.histogram(table(spark, d, "documents"), "source")


@query("select cast(floor(year(o_orderdate) / 10) * 10 as int) as decade, count(*) as n from orders group by 1")
def decade_histogram(spark: SparkSession, d: str) -> DataFrame:
    return quality.decades(table(spark, d, "orders").select(F.year("o_orderdate").alias("year")))


@query("""
with k as (select distinct p_brand as name from part where p_partkey % 3 = 0), n as (select distinct p_brand as name from part union select distinct p_type from part)
select count(*) as names, count(k.name) as known, round(100.0 * count(k.name) / count(*), 4) as coverage_pct from n left join k using (name)
""")
def name_coverage(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    names = p.select(F.col("p_brand").alias("name")).union(p.select("p_type"))
    return quality.coverage_pct(names, p.filter("p_partkey % 3 = 0").select(F.col("p_brand").alias("name")))


@query("""
with h as (select event_id as seq, sha256(event_id || '|' || event_type || '|' || user_id) as h from events), l as (select seq, h, lag(h) over (order by seq) as before from h)
select seq from l where seq % 500 = 7 and before is not null
""")
def audit_chain_verify(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: events are audit records; every 500th link is broken on purpose, and exactly those are found."""
    e = table(spark, d, "events").select(F.col("event_id").alias("seq"), F.sha2(F.concat_ws("|", F.col("event_id").cast("string"), "event_type", F.col("user_id").cast("string")), 256).alias("record_hash"))
    before = e.select((F.col("seq") + 1).alias("seq"), F.col("record_hash").alias("before"))
    chain = e.join(before, "seq", "left").withColumn("prev_hash", F.when(F.col("seq") % 500 == 7, F.lit("broken")).otherwise(F.col("before")))
    return chain.filter(F.col("before").isNotNull() & (F.col("prev_hash") != F.col("before"))).select("seq")
