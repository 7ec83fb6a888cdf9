"""Load, article, training and audit flows on the provided tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.operators import articles, curate, examples, gate, graph, load, quality, recall, rules, sampling, signals, training
from galenus.operators.checkpoints import scratch
from galenus.plans.registry import query
from galenus.session import table
from galenus.sources import documents


@query(r"""
with p as (select 'doc:' || doc_id as id, case when doc_id % 4 = 0 then null else source end as title, case when doc_id % 3 = 0 then null else text end as body from documents),
j as (select *, coalesce(concat_ws(chr(10) || chr(10), case when trim(title, chr(32) || chr(9) || chr(10) || chr(13)) <> '' then title end, case when trim(body, chr(32) || chr(9) || chr(10) || chr(13)) <> '' then body end), '') as joined from p),
n as (select *, regexp_replace(regexp_replace(regexp_replace(replace(joined, chr(0), ' '), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') as txt from j)
select id, case when txt = '' then null else sha256(txt) end as content_hash,
       case when length(txt) = 0 and not coalesce(regexp_matches(body, '\S'), false) then 'empty' when coalesce(regexp_matches(body, '\S'), false) or length(txt) >= 200 then 'ok' else 'partial' end as extract_status, false as is_retracted
from n
""")
def finished_articles(spark: SparkSession, d: str) -> DataFrame:
    """Parsed fields to article rows, divided into metadata and text and joined again."""
    k = F.col("doc_id")
    fields = table(spark, d, "documents").select(F.concat(F.lit("doc:"), k.cast("string")).alias("id"), F.when(k % 4 != 0, F.col("source")).alias("title"), F.when(k % 3 != 0, F.col("text")).alias("body_text"))
    whole = articles.join_hot_body(*articles.split_hot_body(articles.finalize(fields)))
    return whole.select("id", "content_hash", "extract_status", "is_retracted")


@query("select doc_id, source from documents where source not in ('src1', 'src3')")
def deleted_files(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("source_file"))
    return load.delete_source_files(docs, ["src1", "src3"]).withColumnRenamed("source_file", "source")


@query("select doc_id, n_chars from documents where doc_id % 2 = 1")
def published_generation(spark: SparkSession, d: str) -> DataFrame:
    """Two generations are written and published in turn; readers see the second."""
    path, docs = scratch(spark, "generations"), table(spark, d, "documents").select("doc_id", "n_chars")
    for generation in (0, 1):
        docs.filter(F.col("doc_id") % 2 == generation).write.parquet(f"{path}/generation=g{generation}")
        load.swap_pointer(spark, path, f"g{generation}")
    return load.read_generation(spark, path)


@query("select source, count(*) as n, sum(n_chars)::bigint as chars from documents group by 1")
def staged_shards(spark: SparkSession, d: str) -> DataFrame:
    """Shards by source and file; a repeated load of some files overwrites only theirs."""
    path = scratch(spark, "staging")
    docs = table(spark, d, "documents").select("doc_id", "n_chars", "source", F.concat(F.lit("f"), (F.col("doc_id") % 3).cast("string")).alias("source_file"))
    load.write_shards(docs, path, 100)
    load.write_shards(docs.filter("source_file = 'f1'"), path, 100)
    return spark.read.parquet(path).groupBy(F.col("source").cast("string").alias("source")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("""
with s as (select 'U' || c_nationkey as unii, min(case when c_custkey % 5 = 0 then c_name end) as name from customer group by 1)
select unii, name, 'M' || (substr(unii, 2)::int % 4) as moiety_unii from s union all select distinct 'M' || (substr(unii, 2)::int % 4), null, null from s
""")
def substance_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The first named row of each code, stubs for moieties without a record; every key is one of its own."""
    n = F.col("c_nationkey").cast("string")
    records = table(spark, d, "customer").select(F.concat(F.lit("U"), n).alias("unii"), F.when(F.col("c_custkey") % 5 == 0, F.col("c_name")).alias("name"), F.concat(F.lit("M"), (F.col("c_nationkey") % 4).cast("string")).alias("moiety_unii"), F.col("c_name").alias("seq"))
    stored = spark.createDataFrame([("U3", 7)], "unii string, substance_key long")
    return load.substances(records, stored).dropDuplicates(["substance_key"]).select("unii", "name", "moiety_unii")


@query("""
with e as (select p_partkey as entry_id, p_brand as name from part), b as (select entry_id, s_suppkey as substance from e join supplier on entry_id % 97 = s_suppkey), m as (select distinct entry_id, case when substance % 3 = 0 then 1 else substance end as moiety from b)
select entry_id, moiety from m union all select entry_id, null from e where entry_id not in (select entry_id from b)
""")
def bridged_entries(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: parts are drug entries, suppliers substances; entries with their moieties, and those without a bridge."""
    entries = table(spark, d, "part").select(F.col("p_partkey").alias("entry_id"))
    subs = table(spark, d, "supplier").select(F.col("s_suppkey").alias("substance_key"), F.when(F.col("s_suppkey") % 3 == 0, F.lit(1)).cast("long").alias("moiety_key"))
    bridged = entries.withColumn("substance_key", (F.col("entry_id") % 97).cast("long")).join(subs.select("substance_key"), "substance_key")
    with_moiety = signals.moiety_map(bridged, subs).select("entry_id", F.col("moiety").cast("long").alias("moiety"))
    return with_moiety.unionByName(signals.unbridged(entries, bridged).select("entry_id", F.lit(None).cast("long").alias("moiety")))


@query("select c_name as name, n_nationkey::bigint as substance_key from customer join nation on lower(n_name) = 'nation_' || (c_custkey % 40)")
def resolved_names(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: each customer writes a nation's name in another case and spacing; most have a key."""
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("substance_key"), F.lit("name").alias("id_type"), F.lower("n_name").alias("id_value"))
    c = table(spark, d, "customer").select("c_name", F.concat(F.lit("  NATION_"), (F.col("c_custkey") % 40).cast("string")).alias("name"))
    hits, _ = recall.resolve_names(c, n)
    return c.join(hits, "name").select(F.col("c_name").alias("name"), "substance_key")


@query("""
with h as (select doc_id from documents where doc_id % 10 <> 0) select (select count(*) from h) as rows_loaded, (select count(*) from documents where doc_id not in (select doc_id from h)) as orphan_bodies, (select count(*) from h) = 5 as rows_loaded_equals_staging
""")
def load_measures(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return quality.load_measures(docs.filter("doc_id % 10 <> 0").select(F.col("doc_id").alias("id")), docs.select(F.col("doc_id").alias("article_id")), 5)


@query("select bool_and(false) as meta_total_equals_rows from documents")
def declared_totals(spark: SparkSession, d: str) -> DataFrame:
    """One dataset declares a row too many, and one has no total: the measure fails."""
    rows = table(spark, d, "documents").select(F.col("source").alias("dataset"))
    declared = rows.groupBy("dataset").agg((F.count("*") + F.when(F.col("dataset") == "src1", 1).otherwise(0)).alias("total")).filter("dataset <> 'src2'")
    return quality.declared_totals(rows, declared)


@query("""
select p_brand as source_file, count(*) as rows, count(*) filter (p_size % 4 < 3) as stale_rows, count(distinct case when p_size % 4 < 3 then p_size % 4 end) as old_versions from part group by 1
""")
def stale_facets(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: parts are facet rows of rule versions 0 to 3."""
    rows = table(spark, d, "part").select(F.col("p_brand").alias("source_file"), (F.col("p_size") % 4).alias("rule_version"))
    return graph.stale_facets(rows, spark.createDataFrame([(1,), (3,)], "rule_version int"))


@query("select lower(p_brand) as n from part where p_size = 7 union select lower(p_type) from part where p_size = 7")
def keyword_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: sizes are records, brands and types their keywords."""
    p = table(spark, d, "part")
    words = p.select(F.col("p_size").cast("string").alias("pmid"), F.explode(F.array("p_brand", "p_type")).alias("keyword"))
    return graph.neighbours({"keywords": words}, "7", "keyword")


@query("""
select doc_id, case when source = 'src2' then 'excluded_source' when doc_id % 2 = 0 and doc_id % 3 = 0 then 'pending_licence' when doc_id % 2 = 0 and doc_id % 3 = 1 then 'non_commercial' when doc_id % 2 = 1 and doc_id % 5 = 0 then 'pending_licence' when doc_id % 2 = 1 and doc_id % 5 = 1 then 'non_commercial' end as refusal from documents
""")
def refused_examples(spark: SparkSession, d: str) -> DataFrame:
    """Why a row may not be used: tool rows look at their lookups' licences, others at their own."""
    k = F.col("doc_id")
    kind = F.when(k % 2 == 0, "tool_draft").otherwise("grounded")
    subset = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "research").otherwise("commercial")
    lookups = F.array(F.lit("commercial"), F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, "research").otherwise("commercial"))
    return table(spark, d, "documents").select("doc_id", training.licence_gate(kind, F.col("source"), subset, lookups, ("src2",)).alias("refusal"))


@query("""
with r as (select doc_id, case when doc_id % 7 = 0 then 'type' when doc_id % 5 = 0 then 'id' when doc_id % 3 = 0 then 'url' end as reason from documents)
select 'refused ' || reason as outcome, count(*) as n from r where reason is not null group by reason union all select 'kept', count(*) from r where reason is null
""")
def selected_documents(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.when(k % 7 == 0, "other").otherwise("epar").alias("type"), F.when(k % 5 == 0, "x").otherwise(k.cast("string")).alias("id"), F.when(k % 3 == 0, "http://y").otherwise("https://x/a").alias("url"), k.alias("position"), F.lit(1).alias("last_updated"))
    kept, refused = documents.select_documents(rows, ("epar",), "https://x/")
    return refused.select(F.concat(F.lit("refused "), "reason").alias("outcome"), F.col("count").alias("n")).unionByName(documents.newest_documents(kept).agg(F.lit("kept").alias("outcome"), F.count("*").alias("n")))


@query("select doc_id from documents where doc_id % 3 = 0 and doc_id % 4 <> 0 and text is not null and source <> 'src4'")
def eligible_rows(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select("doc_id", "source", "text", F.when(k % 3 == 0, "commercial").alias("subset"), F.when(k % 4 == 0, "partial").otherwise("ok").alias("extract_status"))
    return curate.eligible(rows, ("src4",)).select("doc_id")


@query("select 'part' as name, p_partkey as k from part where p_partkey between 3 and 9 or p_partkey between 50 and 60 union all select 'line', l_partkey from lineitem where l_partkey between 3 and 9 or l_partkey between 50 and 60")
def range_cuts(spark: SparkSession, d: str) -> DataFrame:
    """The same key ranges of two tables."""
    cut = sampling.range_cut({"part": table(spark, d, "part").select(F.col("p_partkey").alias("k")), "line": table(spark, d, "lineitem").select(F.col("l_partkey").alias("k"))}, "k", [(3, 9), (50, 60)])
    return cut["part"].select(F.lit("part").alias("name"), "k").unionByName(cut["line"].select(F.lit("line").alias("name"), "k"))


@query("""
select n_nationkey::varchar as draft_id, 's2' as rule_id, 'missing required section 2' as message from nation where n_nationkey % 3 = 0 union all
select n_nationkey::varchar, 's1', 'wrong order: section 1' from nation where n_nationkey % 3 = 1 union all select n_nationkey::varchar, 's1', 'duplicate section ''1 Introduction''' from nation where n_nationkey % 3 = 2
""")
def heading_findings(spark: SparkSession, d: str) -> DataFrame:
    """Drafts that lack a section, change the order of two, or repeat one."""
    sections = [rules.Section("s1", "1", "Introduction"), rules.Section("s2", "2", "Status"), rules.Section("s3", "3", "Data")]
    k = F.col("n_nationkey") % 3
    texts = lambda *t: F.array(*map(F.lit, t))
    headings = F.when(k == 0, texts("1 Introduction", "3 Data")).when(k == 1, texts("2 Status", "1 Introduction", "3. Data")).otherwise(texts("1 Introduction", "1 Introduction", "2 Status", "3 Data"))
    drafts = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("draft_id"), headings.alias("headings"))
    return rules.heading_findings(drafts, sections).select("draft_id", "rule_id", "message")


@query("select conv_id from conversations group by 1 having conv_id % 3 <> 0")
def pending_inputs(spark: SparkSession, d: str) -> DataFrame:
    """Inputs of a batch that its ledger doesn't hold."""
    c = table(spark, d, "conversations").select("conv_id")
    return examples.pending(c.distinct(), c.filter("conv_id % 3 = 0"), "conv_id")


@query("""
with q as (select distinct year(o_orderdate) * 4 + quarter(o_orderdate) - 1 as n from orders where quarter(o_orderdate) <> 3)
select m // 4 || 'q' || (m % 4 + 1) || ' is missing' as problem from (select unnest(generate_series((select min(n) from q), (select max(n) from q))) as m) where m not in (select n from q)
""")
def input_set_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Quarters of the orders as an input set from which the third ones are left out."""
    o = table(spark, d, "orders").select(F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).distinct().filter("q <> 3").collect()
    return spark.createDataFrame([(p,) for p in gate.input_set_problems([(f"{r.y}q{r.q}", 1, 1) for r in o])], "problem string")


@query("select conv_id, turn, string_agg(w, ' ' order by i) as text from (select conv_id, turn, unnest(range(len(ws))) as i, unnest(ws) as w from (select conv_id, turn, regexp_extract_all(text, '\\S+') as ws from conversations)) where i < 5 group by all")
def truncated_turns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "conversations").select("conv_id", "turn", training.truncate_tokens(F.col("text"), 5).alias("text")).filter("text <> ''")
