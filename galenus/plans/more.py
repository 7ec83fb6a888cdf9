"""Further operators on proxies: serialised records, label and trial lookups, training data, manifests of parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions import answers, ids, json, lots, sentences, text
from galenus.operators import articles, load, lookups, quality, recall, rules, sampling, signals, training
from galenus.plans.registry import query
from galenus.session import table
from galenus.sources.feeds import Feed, prepare


@query("""
with p as (select p_partkey, case when p_size % 3 = 0 then null else p_name end as t, case when p_size % 4 = 0 then '  ' else p_type end as a, p_brand as b, case p_size % 5 when 0 then '' when 1 then 'own' end as o from part)
select p_partkey, case when o = '' then null else coalesce(o, nullif(concat_ws(chr(10) || chr(10), t, nullif(trim(a), ''), b), '')) end as text from p
""")
def virtual_text(spark: SparkSession, d: str) -> DataFrame:
    """The text column that is derived from an override or the non-blank parts."""
    size = F.col("p_size")
    parts = (F.when(size % 3 != 0, F.col("p_name")), F.when(size % 4 == 0, "  ").otherwise(F.col("p_type")), F.col("p_brand"))
    override = F.when(size % 5 == 0, "").when(size % 5 == 1, "own")
    return table(spark, d, "part").select("p_partkey", text.virtual_text(override, *parts).alias("text"))


@query("""
with v as (select p_partkey as variation_id, p_name as name, a as assembly from part, (select unnest(['GRCh37', 'GRCh38', 'NCBI36', 'T2T']) as a) where (p_partkey + length(a)) % 3 <> 0 or a = 'NCBI36')
select variation_id, assembly, 'Variant ' || name || ', as catalogued in the NCBI ClinVar database.' as sentence from (select *, row_number() over (partition by variation_id order by case assembly when 'GRCh38' then 0 when 'GRCh37' then 1 when 'NCBI36' then 2 else 3 end) as k from v) where k = 1
""")
def assembly_dedup_sentence(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: parts are variations with several assemblies."""
    none = F.lit(None).cast("string")
    a = F.explode(F.array(*map(F.lit, ("GRCh37", "GRCh38", "NCBI36", "T2T")))).alias("assembly")
    v = table(spark, d, "part").select(F.col("p_partkey").alias("variation_id"), F.col("p_name").alias("name"), none.alias("rcv_accession"), a)
    v = v.filter(((F.col("variation_id") + F.length("assembly")) % 3 != 0) | (F.col("assembly") == "NCBI36"))
    return articles.preferred_assembly(v).select("variation_id", "assembly", sentences.variant(F.col("variation_id"), F.col("name"), none, none, none).alias("sentence"))


@query("""
select p_partkey, 'PubChem compound CID ' || p_partkey || ' (' || p_name || ') has ' || case when p_size % 2 = 0 then 'IUPAC name ' || p_type || ', molecular formula ' || p_brand || ', and canonical SMILES C' else 'molecular formula ' || p_brand || ', and canonical SMILES C' end
  || ', as catalogued in the NCBI PubChem Compound database.' as sentence from part
""")
def compound_sentence(spark: SparkSession, d: str) -> DataFrame:
    """Four property tables merged by key, then a sentence."""
    p = table(spark, d, "part").withColumnRenamed("p_partkey", "cid")
    merged = articles.merge_compounds(p.select("cid", F.lit("C").alias("smiles")), p.filter("p_size % 2 = 0").select("cid", F.col("p_type").alias("iupac_name")), p.select("cid", F.col("p_name").alias("title")), p.select("cid", F.col("p_brand").alias("formula")))
    return merged.select(F.col("cid").alias("p_partkey"), sentences.compound(F.col("cid"), F.col("smiles"), F.col("iupac_name"), F.col("title"), F.col("formula")).alias("sentence"))


@query("""
select conv_id, string_agg(role, ' ' order by turn, role) as text from conversations group by conv_id
""")
def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    """Roles of a conversation as an index role -> positions, turned back into text."""
    c = table(spark, d, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role")
    index = c.groupBy("conv_id", "role").agg(F.collect_list("turn").alias("at")).groupBy("conv_id").agg(F.map_from_entries(F.collect_list(F.struct("role", "at"))).alias("index"))
    return index.select("conv_id", json.inverted_index_text(F.col("index")).alias("text"))


@query("""
with m as (select p_partkey, p_brand as list, row_number() over (partition by p_brand order by p_partkey) - 1 as k from part)
select list, cast(k // 20 as int) + 1 as part, count(*) as n_terms, cast(max(max(k // 20)) over (partition by list) as int) + 1 as n_parts from m group by list, k // 20
""")
def codelist_parts(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a brand is a code list, its parts are the terms, twenty to a part."""
    p, none = table(spark, d, "part"), F.lit(None).cast("string")
    heads = p.select(F.lit(0).cast("long").alias("line"), F.col("p_brand").alias("code"), F.lit("").alias("codelist_code"), F.col("p_brand").alias("name"), F.col("p_brand").alias("submission_value")).distinct()
    terms = p.select(F.col("p_partkey").alias("line"), F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("code"), F.col("p_brand").alias("codelist_code"), F.lit("").alias("name"), F.col("p_name").alias("submission_value"))
    rows = heads.unionByName(terms).withColumns({c: none for c in ("synonyms", "definition", "preferred_term")})
    parts, _ = articles.codelist_parts(rows, "P", "R", 20)
    return parts.select(F.split_part("id", F.lit(":"), F.lit(3)).alias("list"), "part", "n_terms", "n_parts")


@query("""
with recursive o as (select doc_id, source, n_chars, row_number() over (partition by source order by doc_id) as k from documents),
r as (select doc_id, source, k, 0::bigint as part, 1 as n, n_chars::bigint as held from o where k = 1 union all
      select o.doc_id, o.source, o.k, case when f then r.part + 1 else r.part end, case when f then 1 else r.n + 1 end, case when f then o.n_chars else r.held + o.n_chars end
      from r join o on o.source = r.source and o.k = r.k + 1, lateral (select r.n = 25 or r.held + o.n_chars > 50000 as f))
select doc_id, source, part from r
""")
def bounded_parts(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return load.part_numbers(docs, "source", "doc_id", F.col("n_chars"), 25, 50_000).select("doc_id", "source", "part")


@query("""
with l as (select distinct s_suppkey as article_id from supplier where s_nationkey in (3, 7))
select o_orderkey as section, s_suppkey as article_id from orders join supplier on o_custkey % 50 + 1 = s_suppkey where s_suppkey in (select article_id from l)
""")
def label_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a supplier is a label, its nation the substance code, an order a section."""
    s = table(spark, d, "supplier")
    holds = s.select(F.col("s_suppkey").alias("article_id"), F.col("s_nationkey").cast("string").alias("unii"))
    about = s.select(F.col("s_suppkey").alias("id"), F.lit("dailymed").alias("source"), F.lit(None).cast("string").alias("book_meta"), F.lit(2020).alias("year"), F.lit("f").alias("source_file"))
    sections = table(spark, d, "orders").select((F.col("o_custkey") % 50 + 1).alias("article_id"), F.col("o_orderkey").alias("section"), F.lit(0).alias("start_offset"), F.lit("x").alias("loinc_code"))
    known = sections.join(holds.select("article_id"), "article_id", "left_semi")
    return lookups.label_sections(known, holds, about, ("3", "7")).select("section", "article_id")


@query("select o_orderkey as nct_id, o_orderstatus as status from orders where o_orderkey in (select l_orderkey from lineitem where l_partkey in (5, 6, 7))")
def trials_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: an order is a study, its parts are interventions."""
    studies = table(spark, d, "orders").select(F.col("o_orderkey").alias("nct_id"), F.col("o_orderstatus").alias("status"))
    return lookups.trials_for(studies, table(spark, d, "lineitem").select(F.col("l_orderkey").alias("nct_id"), F.col("l_partkey").alias("substance_key")), (5, 6, 7))


@query("""
select conv_id, turn, case turn % 4 when 1 then 'answer does not cite its reference' when 2 then 'answer has no quoted span' when 3 then 'quote not in passage: elsewhere' end as problem from conversations
""")
def citation_check(spark: SparkSession, d: str) -> DataFrame:
    """Turns as passages; answers that quote their beginning and cite it, don't cite, don't quote, or quote something else."""
    c, k = table(spark, d, "conversations"), F.col("turn") % 4
    passage = F.concat(F.lit("it begins  so. "), "text")
    answer = F.when(k == 0, 'It says "it begins\n so." [r1]').when(k == 1, "As in “it begins so.”").when(k == 2, "No quote [r1]").otherwise('"it begins so." and "elsewhere" [r1]')
    return c.select("conv_id", "turn", answers.citation_problem(answer, passage, F.lit("r1")).alias("problem"))


@query("select count(*) as total, count(*) filter (toxic = quality) as correct, round(100.0 * count(*) filter (toxic = quality) / count(*), 4) as accuracy_pct from labels")
def benchmark_accuracy(spark: SparkSession, d: str) -> DataFrame:
    return training.accuracy(table(spark, d, "labels"), "toxic", "quality")


@query("""
with a as (select conv_id, max(text) filter (role = 'user') as prompt, max(text) filter (role = 'assistant') as chosen, min(text) filter (role = 'assistant') as rejected from conversations group by conv_id)
select prompt, chosen, rejected from a where prompt is not null and chosen is not null and rejected is not null and chosen <> rejected
""")
def preference_pairs(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    of = lambda f, role: f(F.when(F.col("role") == role, F.col("text")))
    return training.preference_pairs(c.groupBy("conv_id").agg(of(F.max, "user").alias("prompt"), of(F.max, "assistant").alias("chosen"), of(F.min, "assistant").alias("rejected")))


@query("""
with a as (select doc_id as id, row_number() over (order by doc_id) as n from documents where lang = 'en'), b as (select doc_id as id, row_number() over (order by doc_id) as n from documents where lang <> 'en')
select id, n as position, 0 as stream, round((n - 0.5) / 0.75, 6) as place from a union all select id, n, 1, round((n - 0.5) / 0.25, 6) from b
""")
def ratio_interleave(spark: SparkSession, d: str) -> DataFrame:
    """English and other documents mixed three to one."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")
    mixed = training.interleave(docs.filter("lang = 'en'"), docs.filter("lang <> 'en'"), 0.75, "id")
    return mixed.select("id", "position", "stream", F.round("place", 6).alias("place"))


@query("""
with u as (select source, cast(doc_id as varchar) as unit, n_chars as bytes from documents), m as (select source, quantile_disc(bytes, 0.5) as mid from u group by 1)
select source, max(bytes) as largest, min(bytes) as smallest, any_value(mid) as median from u join m using (source) group by source
""")
def representative_units(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the largest, smallest and median document of each source."""
    units = table(spark, d, "documents").select("source", F.col("doc_id").cast("string").alias("unit"), F.col("n_chars").alias("bytes"), F.col("doc_id").alias("stamp"))
    picked = sampling.representative_units(units).filter("which in ('largest', 'smallest', 'median')").join(units.select("unit", "bytes"), "unit")
    return picked.groupBy("source").pivot("which", ["largest", "smallest", "median"]).agg(F.first("bytes"))


@query("select source, count(*) as rows, max(epoch_ms(1000 * doc_id)) as newest from documents group by 1")
def source_inventory(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").withColumn("retrieved_at", F.timestamp_seconds("doc_id").cast("timestamp_ntz"))
    return quality.inventory(docs)


@query("""
with k as (select distinct 'Manufacturer' as x), n as (select p_partkey, lower(p_brand || ' ' || split_part(p_type, ' ', 1)) as name from part where p_partkey % 2 = 0), r as (select p_partkey, lower(p_brand) as b, lower(split_part(p_type, ' ', 1)) as t from part)
select p_partkey as recall_number, b || ' ' || t as name from r where (b || ' ' || t) in (select name from n)
""")
def gram_dictionary_join(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a part's brand and type stand in a recall's description; names of even parts are known."""
    p = table(spark, d, "part")
    name = F.concat_ws(" ", "p_brand", F.split_part("p_type", F.lit(" "), F.lit(1)))
    recalls = p.select(F.col("p_partkey").alias("recall_number"), F.concat(name, F.lit(" packed, manufactured by "), F.lit("someone else")).alias("description"))
    known = p.filter("p_partkey % 2 = 0").select(F.lower(name).alias("name")).distinct()
    return recall.names_by_text(recalls, known).select("recall_number", F.get("names", F.lit(0)).alias("name"))


@query("select s_suppkey, lpad(cast(s_suppkey as varchar), 5, '0') || '0012' as product from supplier")
def ndc_in_text(spark: SparkSession, d: str) -> DataFrame:
    k = F.lpad(F.col("s_suppkey").cast("string"), 5, "0")
    info = F.concat(F.lit("Package NDC "), k, F.lit("-0012-05, lot X1"))
    return table(spark, d, "supplier").select("s_suppkey", F.get(lots.ndc_products(info), F.lit(0)).alias("product"))


@query("""
with o as (select c_custkey, lpad(cast(c_custkey as varchar), 15, '0') as digits from customer),
t as (select c_custkey, digits, list_reduce(list_prepend(0, list_transform(string_split(digits, ''), lambda x: cast(x as bigint))), lambda a, b: ((a + b) * 2) % 11) as total from o)
select c_custkey, (12 - total % 11) % 11 = c_custkey % 11 as check_ok from t
""")
def orcid_check(spark: SparkSession, d: str) -> DataFrame:
    """Check digits of made-up author ids."""
    k = F.col("c_custkey")
    digits = F.lpad(k.cast("string"), 15, "0")
    last = F.when(k % 11 == 10, "X").otherwise((k % 11).cast("string"))
    dashed = ids.normalize_orcid(F.concat(digits, last))
    return table(spark, d, "customer").select("c_custkey", ids.orcid_check_ok(dashed).alias("check_ok"))


@query("""
with p as (select distinct event_type, props from events) select count(*) as keys from (select distinct event_type, json_extract_string(props, '$.k') as k, sha256(props) as h from p)
""")
def feed_rows(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: event payloads are feed rows; distinct ones become reference records."""
    e = table(spark, d, "events")
    rows = e.select(F.col("props").alias("payload"), F.col("event_type").alias("source_file"))
    kinds = [r[0] for r in e.select("event_type").distinct().orderBy("event_type").collect()]
    frames = [prepare(rows.filter(F.col("source_file") == k), Feed(k, "json_lines", "EU"), "r")[0].select("dataset", "record_key") for k in kinds]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.agg(F.count("*").alias("keys"))


@query("select l_orderkey as rid, count(distinct p_brand) as n, count(distinct p_brand) > 30 as over_cap from lineitem join part on l_partkey = p_partkey group by 1")
def listed_reports(spark: SparkSession, d: str) -> DataFrame:
    """Per-report lists of moieties and the pair cap."""
    from galenus.plans.signals_q import _inputs

    reports, drugs, _, moiety, _ = _inputs(spark, d)
    return signals.listed_reports(signals.report_moieties(signals.drug_rows(reports, drugs, moiety))).select("rid", "n", "over_cap")


@query("""
with n as (select o_orderkey as record_key, cast(o_orderdate as date) as event_date, o_custkey % 40 as moiety from orders where o_orderstatus = 'F')
select record_key, event_date, moiety, cast(event_date - interval 12 month as date) as start_date, cast(event_date - interval 1 day as date) as end_date from n where moiety < 20 order by event_date desc, record_key limit 25
""")
def newest_cases(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: finished orders are records named after a customer group; half of the groups resolve."""
    name = (F.col("o_custkey") % 40).cast("string")
    records = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("record_key"), F.col("o_orderdate").alias("event_date"), F.array(name).alias("substance_names"))
    subs = spark.range(20).select(F.col("id").alias("substance_key"), F.lit(None).cast("long").alias("moiety_key"))
    xref = subs.select("substance_key", F.lit("name").alias("id_type"), F.col("substance_key").cast("string").alias("id_value"))
    out = rules.cases(records, xref, subs, 25)
    return out.select("record_key", "event_date", "moiety", F.col("interval.start").alias("start_date"), F.col("interval.end").alias("end_date"))


@query(r"""
with b as (select page_id, regexp_replace(regexp_replace(html, '(?is)<(?:script|style|title)[^>]*>.*?</(?:script|style|title)>|<!--.*?-->', '', 'g'), '(?i)<(?:br|/?(?:p|div|h[1-6]|li|ul|ol|tr|table|nav|article|section|header|footer|aside|body))(?:\s[^>]*)?/?>', chr(10), 'g') as t from pages),
l as (select page_id, list_filter(list_transform(string_split(regexp_replace(t, '<[^>]*>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') as ls from b)
select page_id, len(ls) as n_lines, sha256(array_to_string(ls, chr(10))) as digest from l
""")
def markup_to_text(spark: SparkSession, d: str) -> DataFrame:
    """All lines of a page, menus too: block markup to plain lines."""
    lines = table(spark, d, "pages").select("page_id", text.markup_lines(F.col("html")).alias("t"))
    return lines.select("page_id", F.when(F.col("t") == "", 0).otherwise(F.size(F.split("t", "\n"))).cast("long").alias("n_lines"), F.sha2("t", 256).alias("digest"))
