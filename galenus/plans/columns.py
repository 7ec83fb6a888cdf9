"""Column functions, measures and checks on values made from the provided tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions import answers, dates, ids, json, licences, lots, markup, sentences, text
from galenus.operators import articles, examples, gate, load, quality, recall
from galenus.plans.registry import query
from galenus.session import table
from galenus.sources import files


@query(r"""
with c as (select c_custkey as k, c_custkey::varchar as s from customer)
select k, case k % 4 when 0 then s when 1 then s when 3 then s || s end as application,
       case k % 3 when 0 then '10.1/ab' || s when 1 then '10.2/x' end as doi,
       case when k > 0 and k % 3 < 2 then s end as pmid,
       case when k > 0 and k % 2 = 0 then 'PMC' || s end as pmcid,
       'a,b ' || s as parts, md5(s || chr(31) || '' || chr(31) || 'x') as composite, length(s) + 1998 <= 2000 as fits
from c
""")
def identifiers(spark: SparkSession, d: str) -> DataFrame:
    """Application numbers, DOIs, PMIDs, PMCIDs, split names, composite digests and the key limit."""
    k, s = F.col("c_custkey"), F.col("c_custkey").cast("string")
    of = lambda n, *forms: F.element_at(F.array(*forms), (k % n + 1).cast("int"))
    cat = lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in p))
    none = F.lit(None).cast("string")
    return table(spark, d, "customer").select(
        k.alias("k"), ids.norm_application_number(of(4, cat("NDA ", s), cat(" anda", s), cat("x", s), cat(s, "-", s))).alias("application"),
        ids.bare_doi(of(3, cat("https://doi.org/10.1/AB", s), cat(" http://dx.doi.org/10.2/X"), F.lit(""))).alias("doi"),
        ids.bare_pmid(of(3, cat("https://pubmed.ncbi.nlm.nih.gov/00", s, "/"), cat("00", s), cat("x", s))).alias("pmid"),
        ids.bare_pmcid(of(2, cat("https://www.ncbi.nlm.nih.gov/pmc/articles/pmc0", s, "/"), cat("PMCx", s))).alias("pmcid"),
        F.array_join(ids.split_names(cat(" a |;b ", s, "; ")), ",").alias("parts"), ids.composite_md5(s, none, F.lit("x")).alias("composite"), ids.fits_key(cat(F.repeat(F.lit("é"), 999), s)).alias("fits"),
    )


@query("""
with o as (select o_orderkey as k, cast(o_orderdate as date) as day, o_custkey as c from orders)
select k, case when k % 3 <> 0 then day end as strict, least(day, day - interval 3 day)::date as receipt, case when c % 2 = 0 then c / 12.0 when c % 4 = 1 then c * 10.0 end::double as age,
       case when k % 4 = 0 then null else (k % 997) + 0.5 end::double as measured, case when k % 3 = 0 then k % 1000 end::int as whole from o
""")
def dates_and_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Strict dates, first receipts, ages in years, bounded measures and whole numbers."""
    k, day, c = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_custkey")
    written = F.when(k % 3 == 0, F.date_format(day, "yyyy-MM-dd")).otherwise(F.date_format(day, "yyyyMMdd"))
    unit = F.when(c % 2 == 0, "802").when(c % 4 == 1, "800").otherwise("x")
    number = F.when(k % 4 == 0, "-1").otherwise(F.concat((k % 997).cast("string"), F.lit(".5")))
    whole = F.when(k % 3 == 0, F.concat(F.lit(" "), (k % 1000).cast("string"))).otherwise(F.concat((k % 1000).cast("string"), F.lit(".0")))
    return table(spark, d, "orders").select(
        k.alias("k"), dates.strict_date(written).alias("strict"), dates.first_receipt(day, F.date_sub(day, 3)).alias("receipt"), dates.age_years(c.cast("string"), unit).alias("age"),
        dates.measure(number).alias("measured"), dates.bounded_int(whole).alias("whole"),
    )


@query("select k, case when k % 3 = 0 then null else s end as version from (select c_custkey as k, (c_custkey % 7) || '.' || (c_custkey % 40) as s, row_number() over (partition by c_nationkey order by case when c_custkey % 3 = 0 then -1 else c_custkey % 7 end desc, c_custkey % 40 desc, c_custkey) as n from customer) where n = 1")
def newest_version(spark: SparkSession, d: str) -> DataFrame:
    """The highest dotted version of each nation: numbers sort by value, text below them."""
    k = F.col("c_custkey")
    major = F.when(k % 3 == 0, "beta").otherwise((k % 7).cast("string"))
    rows = table(spark, d, "customer").select(k.alias("k"), "c_nationkey", F.concat(major, F.lit("."), (k % 40).cast("string")).alias("version"))
    top = load.top_one(rows, ["c_nationkey"], ids.version_rank(F.col("version")).desc(), F.col("k"))
    return top.select("k", F.when(F.col("k") % 3 == 0, F.lit(None)).otherwise(F.col("version")).alias("version"))


@query("""select p_partkey, sha256('{"a":' || p_size || case when p_size % 2 = 0 then ',"b":"' || p_brand || '"' else '' end || ',"c":"' || p_name || '"}') as digest from part""")
def canonical_digest(spark: SparkSession, d: str) -> DataFrame:
    """Digest of compact JSON with sorted keys and without nulls."""
    fields = {"c": F.col("p_name"), "a": F.col("p_size"), "b": F.when(F.col("p_size") % 2 == 0, F.col("p_brand"))}
    return table(spark, d, "part").select("p_partkey", json.digest(fields).alias("digest"))


@query("select p_partkey, case when length(p_name || p_type) <= 20 then p_name || p_type else left(p_name || p_type, 17) || '…' end as capped, 64 + strlen(p_name || 'é') + strlen(p_type) as size from part")
def capped_elements(spark: SparkSession, d: str) -> DataFrame:
    """List elements cut to a number of bytes, and the estimated size of a row."""
    return table(spark, d, "part").select("p_partkey", text.cap_element(F.concat("p_name", "p_type"), 20).alias("capped"), text.row_bytes([F.concat("p_name", F.lit("é")), F.col("p_type")]).cast("long").alias("size"))


@query("""
with p as (select p_partkey, p_name as t, case when p_size % 2 = 0 then ' ' else p_type end as a, case when p_size % 3 = 0 then null else p_brand end as b from part),
j as (select *, concat_ws(chr(10) || chr(10), t, case when trim(a) <> '' then a end, b) as joined from p)
select p_partkey, joined, case when p_partkey % 4 = 0 then 'own text' when p_partkey % 4 = 1 then '' end as override from j
""")
def joined_text(spark: SparkSession, d: str) -> DataFrame:
    """The joined non-blank parts, and what must be stored where the text is something else."""
    size, k = F.col("p_size"), F.col("p_partkey")
    parts = (F.col("p_name"), F.when(size % 2 == 0, " ").otherwise(F.col("p_type")), F.when(size % 3 != 0, F.col("p_brand")))
    joined = text.join_parts(*parts)
    own = F.when(k % 4 == 0, "own text").when(k % 4 == 1, F.lit(None)).otherwise(joined)
    return table(spark, d, "part").select("p_partkey", joined.alias("joined"), text.text_override(own, *parts).alias("override"))


@query("select p_partkey, p_name || ' sold.' as title, lower(regexp_replace(p_type || p_size, '[^a-zA-Z0-9]+', '', 'g')) as heading from part")
def title_lines(spark: SparkSession, d: str) -> DataFrame:
    """A title out of a body's first sentence, and a heading without punctuation."""
    body = F.concat(F.lit(" "), "p_name", F.lit(" sold. Then more. "), "p_type")
    return table(spark, d, "part").select("p_partkey", text.synth_title(body).alias("title"), text.heading_key(F.concat(F.lit("- "), "p_type", F.lit(": "), F.col("p_size").cast("string"))).alias("heading"))


@query("select n_nationkey, 'Question: Where is ' || n_name || '?' || chr(10) || 'A. here' || chr(10) || 'B. ' || n_name || chr(10) || 'Reasoning: ' || case when n_nationkey % 2 = 0 then 'known' else '' end || chr(10) || 'Answer: B' as prompt from nation")
def worked_prompts(spark: SparkSession, d: str) -> DataFrame:
    question, options = F.concat(F.lit("Where is "), "n_name", F.lit("?")), F.array(F.lit("here"), F.col("n_name"))
    return table(spark, d, "nation").select("n_nationkey", sentences.question_prompt(question, options, F.when(F.col("n_nationkey") % 2 == 0, "known"), F.lit("B")).alias("prompt"))


@query("select doc_id, doc_id % 9 in (0, 1, 2, 4, 5, 7) as commercial from documents")
def commercial_codes(spark: SparkSession, d: str) -> DataFrame:
    codes = ("CC0", "cc by", "CC_BY-SA 3.0", "CC BY-NC", "CC BY ND 4.0", " CC  BY 4.0 ", "CC BY-NC-SA", "CC0 1.0", "none")
    code = F.element_at(F.array(*map(F.lit, codes)), (F.col("doc_id") % len(codes) + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", licences.is_commercial(code).alias("commercial"))


@query("""
with f as (select o_custkey as id, o_orderkey % 3 as v, o_orderkey as k from orders), m as (select id, max(v) as top from f group by 1)
select 'PMC' || f.id || '.' || v as name, min(k) as k from f join m on f.id = m.id and v = top group by all
""")
def newest_article_files(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: orders are files of an article's versions; of equal ones the first path counts."""
    c = F.col
    rows = table(spark, d, "orders").select(F.concat(F.lit("PMC"), c("o_custkey").cast("string"), F.lit("."), (c("o_orderkey") % 3).cast("string"), F.lit(".json")).alias("name"), F.lpad(c("o_orderkey").cast("string"), 12, "0").alias("path"))
    kept, _ = files.highest_versions(rows, c("name"))
    return kept.select(F.regexp_replace("name", r"\.json$", "").alias("name"), c("path").cast("long").alias("k"))


@query("""
with r as (select o_orderkey as id, year(o_orderdate) as y from orders union all select o_orderkey, year(o_orderdate) from orders where o_orderkey % 10 = 0), y as (select y, count(*) as n from r group by 1),
d as (select l_orderkey * 10 + l_linenumber as e, l_partkey % 3 = 0 as linked from lineitem)
select (select count(*) from r) as reports, (select count(*) - count(distinct id) from r) as duplicate_ids, (select min(y) from r) as receive_year_min, (select max(y) from r) as receive_year_max,
       (select y from y order by n desc, y desc limit 1) as largest_year, (select max(n) from y) as largest_year_reports, (select count(*) from lineitem) as drug_rows, (select count(*) from events) as reaction_rows,
       (select count(*) from part) as signal_pair_rows, (select count(*) from supplier) as signal_event_rows, (select round(100.0 * count(*) filter (e in (select e from d where linked)) / count(*), 4) from d) as xref_coverage_pct
""")
def report_measures(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: orders are reports, a tenth of them twice; a third of the lines is linked."""
    t = lambda n: table(spark, d, n)
    reports = t("orders").select(F.col("o_orderkey").alias("safetyreportid"), F.year("o_orderdate").alias("receive_year"))
    entries = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entry_id"), "l_partkey")
    return quality.report_measures(reports.unionByName(reports.filter("safetyreportid % 10 = 0")), t("lineitem"), t("events"), t("part"), t("supplier"), entries.select("entry_id"), entries.filter("l_partkey % 3 = 0"))


@query("with w as (select doc_id in (select page_id from pages) as has from documents) select count(*) filter (has) as documents_with_sections, count(*) filter (not has) as documents_without_sections, round(100.0 * count(*) filter (has) / nullif(count(*), 0), 4) as sections_share_pct from w")
def section_share(spark: SparkSession, d: str) -> DataFrame:
    docs, pages = table(spark, d, "documents").select(F.col("doc_id").alias("document_id")), table(spark, d, "pages").select(F.col("page_id").alias("document_id"))
    return quality.section_share(docs, pages)


@query("""
with r as (select event_type as dataset, count(*) as rows from events group by 1), n as (select distinct event_type as dataset, user_id from events)
select r.dataset, rows, rows % 2 = 0 as meta_total_equals_rows, (select round(100.0 * count(*) filter (user_id % 3 = 0) / count(*), 4) from n where n.dataset = r.dataset) as xref_coverage_pct from r
""")
def feed_measures(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: event types are datasets, users are names; odd totals are declared too high by one."""
    e = table(spark, d, "events").select(F.col("event_type").alias("dataset"), F.col("user_id").cast("string").alias("name"), "user_id")
    declared = e.groupBy("dataset").agg((F.count("*") + F.count("*") % 2).alias("total"))
    return quality.feed_measures(e, declared, e, e.filter("user_id % 3 = 0").select("name"))


@query("""
with m as (select count(*) as rows, count(*) - count(distinct doc_id) as dup, round(100.0 * count(*) filter (text is null or trim(text) = '') / count(*), 4) as empty from documents)
select 'min_rows: rows is ' || rows || ', the minimum is 1000000000' as failed from m union all select 'min_rows_per_input: the measure is missing' union all select 'max_empty_text_pct: empty_text_pct is ' || empty || ', the limit is -1' from m
""")
def gate_verdict(spark: SparkSession, d: str) -> DataFrame:
    """Failed rules on the measures of the documents; a missing measure fails its rule."""
    docs, blank = table(spark, d, "documents"), text.is_blank(F.col("text"))
    found = docs.agg(F.count("*").alias("rows"), (F.count("*") - F.count_distinct("doc_id")).alias("duplicate_ids"), F.round(100.0 * F.count_if(blank) / F.count("*"), 4).cast("double").alias("empty_text_pct"))
    rules = {"min_rows": 1_000_000_000, "min_rows_per_input": 1, "max_duplicate_ids": 0, "max_empty_text_pct": -1}
    return spark.createDataFrame([(line,) for line in gate.evaluate(quality.measures(found), rules)], "failed string")


@query("""
select 'epar:' || doc_id as id, nullif(case when doc_id % 2 = 0 then 'P' || doc_id else '' end, '') as source_record_id, case when doc_id % 3 = 0 then 'EPAR document ' || doc_id else source end as title, (1990 + doc_id % 30)::int as year,
       case when text is null or trim(text, chr(32)) = '' then 'empty' else 'ok' end as extract_status, '{"doc_type":"t","document_id":"' || doc_id || '","medicine_name":null,"first_published_date":"' || (1990 + doc_id % 30) || '-01-01","last_updated_date":null}' as book_meta from documents
""")
def document_articles(spark: SparkSession, d: str) -> DataFrame:
    k, none = F.col("doc_id"), F.lit(None).cast("string")
    docs = table(spark, d, "documents").select(
        k.cast("string").alias("id"), F.when(k % 3 == 0, "").otherwise(F.col("source")).alias("name"), F.lit("t").alias("type"), F.lit("https://x").alias("url"), F.when(k % 2 == 0, F.concat(F.lit("P"), k.cast("string"))).otherwise("").alias("product_number"),
        none.alias("medicine_name"), F.concat((1990 + k % 30).cast("string"), F.lit("-01-01")).alias("first_published"), none.alias("last_updated"), "text",
    )
    return articles.document_articles(docs, F.lit("f"), "raw").select("id", "source_record_id", "title", "year", "extract_status", "book_meta")


@query("""
select c_custkey as claim_id, case when c_custkey % 3 = 0 and c_custkey % 2 = 0 then 'lookup' else 'model' end as route, case when c_custkey % 3 = 0 and c_custkey % 2 = 0 then 'safety_actions' end as function from customer
""")
def routed_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims with a term for a third of the customers; half of the names are known."""
    k = F.col("c_custkey")
    word = F.concat(F.lit("Zeta"), F.translate(k.cast("string"), "0123456789", "abcdefghij"))
    claims = table(spark, d, "customer").select(k.alias("claim_id"), F.concat(F.lit("There is "), word, F.when(k % 3 == 0, " with recalls").otherwise(" with nothing")).alias("claim"))
    return examples.route_claims(claims, table(spark, d, "customer").filter(k % 2 == 0).select(F.upper(word).alias("name")))


@query("select o_orderkey, case when o_orderkey % 2 = 0 then (o_orderkey + 100)::varchar else strftime(o_orderdate, '%Y-%m-%d') || ',' || (o_orderkey + 100) end as missing from orders")
def unstated_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of an answer that the known text doesn't state: a date in another form agrees."""
    day, k = F.col("o_orderdate"), (F.col("o_orderkey") + 100).cast("string")
    answer = F.concat(F.lit("On "), F.date_format(day, "yyyy-MM-dd"), F.lit(" there were "), k, F.lit(" cases of NCT12345678"))
    known = F.concat(F.lit("NCT12345678 began "), F.when(F.col("o_orderkey") % 2 == 0, F.date_format(day, "d MMMM yyyy")).otherwise("then"))
    return table(spark, d, "orders").select("o_orderkey", F.array_join(answers.unstated_values(answer, known), ",").alias("missing"))


@query("select p_partkey, 'AB' || (p_partkey + 1000) || ':prefix,C' || (p_partkey + 100) || ':range,C' || (p_partkey + 101) || ':range,C' || (p_partkey + 102) || ':range' as lots from part")
def lots_of_known_forms(spark: SparkSession, d: str) -> DataFrame:
    """A single lot and a range behind their marks; dates, product codes, amounts and "all lots" give none."""
    k = F.col("p_partkey")
    s = lambda c: c.cast("string")
    info = F.concat(F.lit("Lot # AB"), s(k + 1000), F.lit(", exp 12/2025; NDC 12345-678-90; all lots ZZ9999. Batch numbers: C"), s(k + 100), F.lit(" through C"), s(k + 102), F.lit(" 500 mg X12345"))
    found = lots.extract_lots(info)
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["lot_norm"], x["method"])), ",").alias("lots"))


@query("""
select c_custkey as recall_number, case c_custkey % 4 when 0 then 'own' || c_nationkey when 1 then 'prod' || c_nationkey when 2 then 'aspirin acid' end as name, case c_custkey % 4 when 0 then 'openfda' when 1 then 'ndc' when 2 then 'product_text' else 'none' end as method from customer
""")
def recall_routes(spark: SparkSession, d: str) -> DataFrame:
    """The first route whose names have a key: a quarter of the recalls each have own names, product codes, text and none."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    recalls = table(spark, d, "customer").select(
        k.alias("recall_number"), F.when(k % 4 == 2, "Aspirin acid, made by X").otherwise("box").alias("description"),
        F.when(k % 4 == 1, F.concat(F.lit("NDC "), F.lpad(n, 5, "0"), F.lit("-001-01"))).alias("code_info"), F.array(F.when(k % 4 == 0, F.concat(F.lit("own"), n)).otherwise("keyless")).alias("substance_names"), F.array().cast("array<string>").alias("uniis"),
    )
    nations = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("n"))
    products = nations.select(F.concat(F.lpad("n", 5, "0"), F.lit("0001")).alias("product_key"), F.concat(F.lit("prod"), "n").alias("name"))
    known = products.select("name").unionByName(nations.select(F.concat(F.lit("own"), "n").alias("name"))).unionByName(spark.createDataFrame([("aspirin acid",)], "name string"))
    found = recall.recall_lots(recalls, products, spark.createDataFrame([], "unii string, name string"), known, "r")
    return found.select("recall_number", F.get("substance_names", F.lit(0)).alias("name"), F.coalesce("substance_method", F.lit("none")).alias("method"))


@query("""
select n_nationkey, '34067-9' as loinc_code, '4.1 Therapeutic indications' as title, 'Drug ' || n_name as product, 'For ' || n_name || '.' as body from nation union all
select n_nationkey, '34070-3', '4.3 Contraindications', 'Drug ' || n_name, 'None' from nation where n_nationkey % 2 = 0
""")
def summary_sections(spark: SparkSession, d: str) -> DataFrame:
    """Numbered sections of product summaries with the text between their offsets."""
    n = F.col("n_name")
    more = F.when(F.col("n_nationkey") % 2 == 0, "\n4.3 Contraindications\nNone").otherwise("")
    body = F.concat(F.lit("ANNEX I\nSUMMARY OF PRODUCT CHARACTERISTICS\n1. NAME OF THE MEDICINAL PRODUCT\nDrug "), n, F.lit("\n4. CLINICAL PARTICULARS\n4.1\nTherapeutic indications\nFor "), n, F.lit("."), more, F.lit("\nANNEX II\n4.8 Not here"))
    rows = table(spark, d, "nation").select("n_nationkey", body.alias("body")).select("n_nationkey", "body", F.explode(markup.product_summary_sections("body")).alias("s"))
    piece = F.substring("body", F.col("s.start_offset") + 1, F.col("s.end_offset") - F.col("s.start_offset"))
    return rows.select("n_nationkey", "s.loinc_code", "s.title", "s.product", F.element_at(F.split(piece, "\n"), -1).alias("body"))
