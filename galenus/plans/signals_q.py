"""Safety-signal queries. Proxy: an order is a report, its lines are drug rows (first line suspect, supplier as lot),
a part is a drug entry, its brand the moiety, and flag plus status of a line the reaction term."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.operators import load, signals
from galenus.plans.registry import query
from galenus.session import table

CAP = signals.PAIR_CAP
_BASE = """
rep as (select o_orderkey as rid, cast(date_trunc('quarter', cast(o_orderdate as date)) as date) as quarter from orders where o_orderdate is not null),
dr as (select l_orderkey as rid, quarter, p_brand as moiety, l_linenumber = 1 as sus, cast(l_suppkey as varchar) as lot from lineitem join rep on l_orderkey = rid join part on l_partkey = p_partkey),
rm as (select rid, quarter, moiety, bool_or(sus) as suspect from dr group by all),
rt as (select distinct l_orderkey as rid, quarter, l_returnflag || l_linestatus as term from lineitem join rep on l_orderkey = rid),
sz as (select rid, quarter, count(*) as n from rm group by all)
"""


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    reports = table(spark, d, "orders").select(F.col("o_orderkey").alias("rid"), F.col("o_orderdate").alias("receive_date"))
    li = table(spark, d, "lineitem")
    role = F.when(F.col("l_linenumber") == 1, "suspect").otherwise("concomitant")
    drugs = li.select(F.col("l_orderkey").alias("rid"), F.col("l_partkey").alias("entry_id"), role.alias("role"), F.col("l_suppkey").cast("string").alias("lot"))
    reactions = li.select(F.col("l_orderkey").alias("rid"), F.concat("l_returnflag", "l_linestatus").alias("term_id"))
    moiety = table(spark, d, "part").select(F.col("p_partkey").alias("entry_id"), F.col("p_brand").alias("moiety"))
    terms = reactions.select("term_id", F.lower("term_id").alias("term_norm")).distinct()
    return reports, drugs, reactions, moiety, signals.canonical_terms(terms)


def _tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return signals.rebuild(*_inputs(spark, d), cap=CAP)


@query(f"with {_BASE} select rid, quarter, moiety, suspect from rm")
def report_moiety_collapse(spark: SparkSession, d: str) -> DataFrame:
    reports, drugs, _, moiety, _ = _inputs(spark, d)
    return signals.report_moieties(signals.drug_rows(reports, drugs, moiety))


@query(f"with {_BASE}, ok as (select rid from sz where n <= {CAP}) select x.moiety as a, y.moiety as b, x.quarter, count(*) filter (x.suspect) as reports_suspect, count(*) as reports_any from rm x join rm y on x.rid = y.rid and x.moiety <> y.moiety where x.rid in (select rid from ok) group by all")
def pair_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["pair_quarter"]


@query(f"with {_BASE} select moiety, term, rm.quarter, count(*) filter (suspect) as reports_suspect, count(*) as reports_any from rm join rt using (rid) group by all")
def event_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["event_quarter"]


@query(f"with {_BASE} select moiety, quarter, count(*) filter (suspect) as reports_suspect, count(*) as reports_any from rm group by all")
def moiety_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["moiety_quarter"]


@query(f"with {_BASE} select term, quarter, count(*) as reports from rt group by all")
def term_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["term_quarter"]


@query(f"""with {_BASE}, t as (select quarter, count(*) as reports from rep group by 1), l as (select quarter, count(*) as reports_listed, count(*) filter (n > {CAP}) as reports_over_pair_cap from sz group by 1),
r as (select quarter, count(distinct rid) as reports_with_reaction from rt group by 1)
select quarter, reports, coalesce(reports_listed, 0) as reports_listed, coalesce(reports_over_pair_cap, 0) as reports_over_pair_cap, coalesce(reports_with_reaction, 0) as reports_with_reaction from t left join l using (quarter) left join r using (quarter)""")
def quarter_totals(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["quarter_totals"]


@query(f"with {_BASE} select moiety, quarter, count(*) as drug_rows, count(*) filter (lot is not null) as rows_with_lot from dr group by all")
def batch_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["batch_coverage"]


@query(f"with {_BASE} select moiety, lot, quarter, count(distinct rid) as reports from dr group by all")
def batch_quarter(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d)["batch_quarter"]


@query("select distinct l_returnflag || l_linestatus as term_id, min(l_returnflag || l_linestatus) over (partition by lower(l_returnflag)) as canonical from lineitem")
def canonical_term_window(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("term_id"), F.lower("l_returnflag").alias("term_norm")).distinct()
    return signals.canonical_terms(terms)


@query("""
with c as (select p_partkey as entry_id, 1 as rank, p_type as v from part where p_partkey % 3 = 0 union all select p_partkey, 2, lower(split_part(p_name, ' ', 1)) from part union all select p_partkey, 3, lower(p_brand) from part),
x as (select lower(p_brand) as v, cast(row_number() over (order by p_brand) as bigint) as substance_key from (select distinct p_brand from part) union all select p_type, 1000 + row_number() over (order by p_type) from (select distinct p_type from part)),
h as (select distinct entry_id, rank, substance_key from c join x using (v)), m as (select entry_id, min(rank) as rank from h group by 1)
select entry_id, substance_key, h.rank from h join m using (entry_id, rank)
""")
def bridge_best_rank(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: type, first word of the name and brand are the three ranks of a part's candidates."""
    p = table(spark, d, "part")
    one = lambda rank, v, where="true": p.filter(where).select(F.col("p_partkey").alias("entry_id"), F.lit(rank).alias("rank"), F.lit("name").alias("id_type"), v.alias("id_value"))
    found = one(1, F.col("p_type"), "p_partkey % 3 = 0").unionByName(one(2, F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))))).unionByName(one(3, F.lower("p_brand")))
    from galenus.operators.sampling import with_position

    numbered = lambda c, base, v: with_position(p.select(c).distinct(), c).select(F.lit("name").alias("id_type"), v.alias("id_value"), (F.col("position") + base).alias("substance_key"))
    xref = numbered("p_brand", 0, F.lower("p_brand")).unionByName(numbered("p_type", 1000, F.col("p_type")))
    return signals.bridge(found, xref)


@query("""
with c as (select o_orderkey as safetyreportid, 1 as version, cast(o_orderdate as date) as receipt_date, 'a' as source_file from orders union all
  select o_orderkey, case when o_orderkey % 2 = 0 then 2 else 1 end, case when o_orderkey % 5 = 0 then null else cast(o_orderdate as date) end, 'b' from orders where o_orderkey % 3 = 0)
select safetyreportid, version, receipt_date, source_file from (select *, row_number() over (partition by safetyreportid order by version desc nulls last, receipt_date desc nulls last, source_file desc nulls last) as k from c) where k = 1
""")
def report_winner_dedup(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    first = o.select(k.alias("safetyreportid"), F.lit(1).alias("version"), F.col("o_orderdate").alias("receipt_date"), F.lit("a").alias("source_file"))
    again = o.filter(k % 3 == 0).select(k, F.when(k % 2 == 0, 2).otherwise(1), F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("o_orderdate")), F.lit("b"))
    return signals.winners(first.union(again))


@query("""
with b as (select p_brand as moiety, cast(l_suppkey as varchar) as lot, cast(date_trunc('quarter', cast(o_orderdate as date)) as date) as quarter, count(distinct o_orderkey) as reports
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by all), r as (select s_suppkey as recall_number, cast(s_suppkey as varchar) as lot_norm, 'Brand#' || (s_suppkey % 5 + 1) || (s_suppkey % 4 + 1) as moiety from supplier)
select moiety, recall_number, lot_norm, cast(sum(reports) as bigint) as reports, min(quarter) as first_quarter, max(quarter) as last_quarter from r join b using (moiety) where lot = lot_norm group by all
""")
def recall_lot_matches(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: each supplier recalls its own lot for one brand."""
    from galenus.operators import recall

    k = F.col("s_suppkey")
    brand = F.concat(F.lit("Brand#"), (k % 5 + 1).cast("string"), (k % 4 + 1).cast("string"))
    recalled = table(spark, d, "supplier").select(k.alias("recall_number"), F.array(brand).alias("substance_names"), k.cast("string").alias("lot_norm"), F.lit("prefix").alias("method"))
    names = table(spark, d, "part").select(F.col("p_brand").alias("moiety"), F.col("p_brand").alias("name")).distinct()
    return recall.lot_matches(recalled, _tables(spark, d)["batch_quarter"], names)[0]


@query("""
with o as (select c_custkey as id, c_name as name, c_nationkey % 5 as fam from customer)
select fam as moiety, id, name from (select *, row_number() over (partition by fam order by name is null, id) as k from o) where k = 1
""")
def first_per_group_distinct_on(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select((F.col("c_nationkey") % 5).alias("moiety"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return load.top_one(c, ["moiety"], F.col("name").isNull(), F.col("id"))
