"""Text, licence, identifier and curation queries. Proxy: ``documents`` are articles, ``benchmark`` is the evaluation set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galenus.functions import answers, dates, ids, json, licences, lots, sentences, text
from galenus.operators import curate, training
from galenus.plans.registry import query
from galenus.session import table

_GRAMS = """
norm as (select doc_id, regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\S+') as ws from documents),
tnorm as (select regexp_extract_all(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\S+') as ws from benchmark),
tg as (select distinct unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(list_slice(ws, i, i + 12), ' '))) as g from tnorm where len(ws) >= 13),
dg as (select doc_id, unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(list_slice(ws, i, i + 12), ' '))) as g from norm where len(ws) >= 13),
hit as (select distinct doc_id from dg join tg using (g))
"""


@query(f"with {_GRAMS} select doc_id, source, lang, n_chars from documents where doc_id not in (select doc_id from hit)")
def decontaminate(spark: SparkSession, d: str) -> DataFrame:
    """Documents that share no 13-gram with the evaluation set."""
    docs = table(spark, d, "documents")
    return curate.decontaminate(docs, table(spark, d, "benchmark")).select("doc_id", "source", "lang", "n_chars")


@query(f"with {_GRAMS} select doc_id from hit")
def contaminated_docs(spark: SparkSession, d: str) -> DataFrame:
    return curate.contaminated_ids(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("select doc_id, sha256(text) as content_hash from (select *, row_number() over (partition by sha256(text) order by doc_id) as k from documents where text <> '') where k = 1")
def exact_dedup_by_hash(spark: SparkSession, d: str) -> DataFrame:
    """First document of each content hash, over all documents."""
    docs = table(spark, d, "documents").withColumn("content_hash", text.content_hash(F.col("text"))).filter("content_hash is not null")
    return curate.exact_duplicates(docs.select("doc_id", "content_hash"))


@query(r"""
with w as (select doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+'), lambda x: x <> '') as ws from documents),
s as (select doc_id, list_distinct(case when len(ws) < 3 then ws else list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) end) as sh from w where len(ws) > 0),
m as (select doc_id, sh, min(doc_id) over (partition by list_sort(sh)) as class_id from s),
e as (select class_id, len(sh) as n, unnest(sh) as g from m where doc_id = class_id),
p as (select x.class_id as a, y.class_id as b, count(*) as c, any_value(x.n) as na, any_value(y.n) as nb from e x join e y on x.g = y.g and x.class_id <> y.class_id group by 1, 2),
l as (select a, count(*) as n_links, max(round(c / (na + nb - c), 6)) as nearest from p where c / (na + nb - c) >= 0.8 group by 1)
select doc_id, class_id, coalesce(n_links, 0) as n_links, nearest from m left join l on class_id = a
""")
def jaccard_near_dups(spark: SparkSession, d: str) -> DataFrame:
    """Each document's class of equal sets of word 3-shingles, and the number and nearest of the classes that are similar by 0.8 or more."""
    members, links = curate.jaccard_classes(table(spark, d, "documents"))
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))
    per = both.groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("n_links"), F.max(F.round("jaccard", 6)).alias("nearest"))
    return members.join(per, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "nearest")


@query()
def minhash_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """Banded MinHash, first document stays; its test compares with a sequential version."""
    from galenus.operators.checkpoints import cut

    return curate.near_dup_keep_first(table(spark, d, "documents").select("doc_id", "source", "text"), checkpoint=cut).select("doc_id", "source", "kept")


@query(f"""
with {_GRAMS}, first as (select * from (select *, row_number() over (partition by sha256(text) order by doc_id) as k from documents where text <> '') where k = 1)
select source, lang, count(*) as n_docs, cast(sum(n_chars) as bigint) as n_chars from first where doc_id not in (select doc_id from hit) group by source, lang
""")
def curated_corpus_counts(spark: SparkSession, d: str) -> DataFrame:
    """Exact deduplication, then decontamination, counted by source and language."""
    docs = table(spark, d, "documents")
    narrow = docs.select("doc_id", "source", "lang", "n_chars", text.content_hash(F.col("text")).alias("content_hash")).filter("content_hash is not null")
    clean = curate.exact_duplicates(narrow).join(curate.contaminated_ids(docs, table(spark, d, "benchmark")), "doc_id", "left_anti")
    return clean.groupBy("source", "lang").agg(F.count("*").alias("n_docs"), F.sum("n_chars").alias("n_chars"))


@query("""
with s as (select source, case when length(trim(text, E' \\t\\r\\n')) = 0 then 'empty' when length(trim(text, E' \\t\\r\\n')) >= 200 then 'ok' else 'partial' end as status,
  case when length(trim(text, E' \\t\\r\\n')) = 0 then 'no_title_abstract_body' when length(trim(text, E' \\t\\r\\n')) < 200 then 'short_text' end as notes from documents)
select source, status, notes, count(*) as n from s group by all
""")
def extract_status_hist(spark: SparkSession, d: str) -> DataFrame:
    """Histogram of the extract status by the 200-character rule; every document has an id."""
    null = F.lit(None).cast("string")
    s = table(spark, d, "documents").select("source", text.extract_status(F.col("text"), null, null, F.lit(True)).alias("s"))
    notes = F.regexp_replace("s.notes", "_len=.*$", "")
    return s.groupBy("source", F.col("s.status").alias("status"), notes.alias("notes")).agg(F.count("*").alias("n"))


@query(r"""
select source, cast(sum(length(t)) as bigint) as chars, cast(sum(strlen(t)) as bigint) as bytes, cast(sum(len(regexp_extract_all(t, '[^\s]+'))) as bigint) as tokens, cast(max(length(t)) as bigint) as longest
from (select source, regexp_replace(regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '\n{3,}', E'\n\n', 'g'), '^\s+|\s+$', '', 'g') as t from documents) group by source
""")
def normalize_text_profile(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("source", text.normalize_whitespace(F.col("text")).alias("t"))
    return t.groupBy("source").agg(
        F.sum(F.char_length("t")).alias("chars"), F.sum(F.octet_length("t")).alias("bytes"), F.sum(text.token_count(F.col("t"))).alias("tokens"), F.max(F.char_length("t")).cast("long").alias("longest")
    )


@query("""
with t as (select source, cast(sum(len(regexp_extract_all(text, '[^\\s]+'))) as double) as tokens from documents group by source)
select source, cast(tokens as bigint) as tokens, round(least(1.0, 100000.0 * tokens / sum(tokens) over () / tokens), 9) as share from t
""")
def token_quota_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of each source and its keep share for a target of 100,000 tokens."""
    return training.keep_share(table(spark, d, "documents"), 100_000).select("source", F.col("tokens").cast("long").alias("tokens"), F.round("share", 9).alias("share"))


@query(r"""
with d as (select doc_id, source, case when text <> '' then sha256(text) end as content_hash, sha256(text) as h, len(regexp_extract_all(coalesce(text, ''), '\S+'))::double as n from documents),
s as (select source, sum(n) as tokens from d group by 1), t as (select sum(tokens) as total from s),
k as (select d.*, least(1.0, 100000.0 * tokens / total / nullif(tokens, 0)) as share, ('0x' || substr(sha256(h || '7'), 1, 8))::bigint::double / 4294967296 as draw from d join s using (source), t)
select doc_id, source, content_hash from (select *, row_number() over (partition by h order by doc_id) as r from k where draw < coalesce(share, 0)) where r = 1
""")
def slice_sample(spark: SparkSession, d: str) -> DataFrame:
    """A slice of about 100,000 tokens; the draw is a digest of content and seed."""
    docs = table(spark, d, "documents").withColumn("subset", F.lit("commercial")).withColumn("content_hash", text.content_hash(F.col("text")))
    kept, _ = training.build_slice(docs, 100_000, seed=7, order="doc_id")
    return kept.select("doc_id", "source", "content_hash")


_LICENCES = "'cc by 4.0', 'CC BY-NC-SA 4.0', 'CC0', 'https://creativecommons.org/licenses/by/4.0/', 'MIT License', 'apache-2.0.', 'text mining only', 'see terms', ''"


@query(f"""
with l as (select p_partkey, list_extract([{_LICENCES}], cast(p_partkey % 9 + 1 as int)) as raw from part),
c as (select p_partkey, raw, case when trim(raw) = '' then 'unknown' when regexp_matches(upper(raw), '\\bCC0\\b') then 'CC0' when contains(upper(raw), 'BY-NC-SA') then 'CC BY-NC-SA'
  when regexp_matches(upper(raw), '\\bCC\\s*BY\\b') or regexp_matches(raw, '(?i)creativecommons\\.org/licenses/by/') then 'CC BY' when contains(upper(raw), 'TEXT MINING') then 'text_mining'
  when trim(lower(raw), ' .') in ('mit license', 'apache-2.0') then 'permissive' else 'unknown' end as license from l)
select license, case when license in ('CC0', 'CC BY', 'permissive') then 'commercial' when license in ('CC BY-NC-SA', 'text_mining') then 'text_mining' else 'open_metadata' end as subset, count(*) as n from c group by all
""")
def licence_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Licence codes and subsets of raw licence texts dealt to parts."""
    raw = F.element_at(F.array(*(F.lit(x.strip().strip("'")) for x in _LICENCES.split(", "))), (F.col("p_partkey") % 9 + 1).cast("int"))
    c = table(spark, d, "part").select(licences.licence_code(raw).alias("license"))
    return c.groupBy("license", licences.subset_of(F.col("license")).alias("subset")).agg(F.count("*").alias("n"))


@query("""
select p_partkey, lpad(cast(p_partkey % 99999 as varchar), 5, '0') || lpad(cast(p_size as varchar), 4, '0') || lpad(cast(p_partkey % 90 as varchar), 2, '0') as ndc,
  lpad(cast(p_partkey % 99999 as varchar), 5, '0') || lpad(cast(p_size as varchar), 4, '0') as product from part
""")
def ndc_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Eleven and nine-digit codes of hyphenated ones built from part keys."""
    key = F.col("p_partkey")
    code = F.concat_ws("-", (key % 99999).cast("string"), F.col("p_size").cast("string"), (key % 90).cast("string"))
    return table(spark, d, "part").select("p_partkey", ids.norm_ndc(code).alias("ndc"), ids.norm_ndc_product(code).alias("product"))


@query("""
with s as (select s_suppkey, case s_suppkey % 5 when 0 then 'unk' when 1 then 'n/a' else lower(s_name) || ' lot-' || s_suppkey end as raw from supplier),
n as (select s_suppkey, regexp_replace(upper(raw), '[^0-9A-Z]', '', 'g') as lot from s)
select s_suppkey, lot, lot not in ('ASKU','NA','NI','NONE','NOTAVAILABLE','NOTKNOWN','NOTREPORTED','NOTSTATED','UNK','UNKNOWN','UNKNWON','UNKONWN') as is_real from n
""")
def lot_normalise(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = F.when(k % 5 == 0, "unk").when(k % 5 == 1, "n/a").otherwise(F.concat(F.lower("s_name"), F.lit(" lot-"), k.cast("string")))
    lot = ids.norm_lot(raw)
    return table(spark, d, "supplier").select("s_suppkey", lot.alias("lot"), ids.is_real_lot(lot).alias("is_real"))


@query("""
select o_orderkey, cast(o_orderdate as date) as day, cast(date_trunc('quarter', cast(o_orderdate as date)) as date) as quarter, cast(year(o_orderdate) as varchar) || 'Q' || quarter(o_orderdate) as label,
  strftime(o_orderdate, '%Y-%m') as monthly, strftime(o_orderdate, '%G-W%V') as weekly from orders
""")
def date_parse_orders(spark: SparkSession, d: str) -> DataFrame:
    """Dates written in three forms and parsed back, quarters and release ids."""
    o, day, k = table(spark, d, "orders"), F.col("o_orderdate"), F.col("o_orderkey") % 3
    written = F.when(k == 0, F.date_format(day, "yyyy-MM-dd")).when(k == 1, F.date_format(day, "yyyyMMdd")).otherwise(F.date_format(day, "d/M/yyyy"))
    parsed = o.select("o_orderkey", dates.parse_date(written).alias("day"))
    q = F.col("day")
    return parsed.select("o_orderkey", "day", dates.quarter_start(q).alias("quarter"), dates.quarter_label(q).alias("label"), dates.release_id(q, "monthly").alias("monthly"), dates.release_id(q, "weekly").alias("weekly"))


@query("""
select event_id, event_type, cast(json_extract_string(props, k) as varchar) as value, k as field from events, (select unnest(['$.k', '$.page', '$.ref', '$.device', '$.v']) as k) where json_extract_string(props, k) is not null
""")
def json_payload_paths(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    fields = F.explode(F.array(*(F.struct(F.lit(f"$.{k}").alias("field"), json.payload_text(F.col("props"), k).alias("value")) for k in ("k", "page", "ref", "device", "v"))))
    return e.select("event_id", "event_type", fields.alias("f")).select("event_id", "event_type", "f.value", "f.field").filter("value is not null")


@query(r"""
with a as (select conv_id, turn, lower(text) as t from conversations where role = 'assistant'),
m as (select conv_id, turn, t, regexp_extract_all(t, '(?:correct option is|option|answer is|correct choice is|choice)\s*\(?([a-d])\)?', 1) as x, regexp_extract_all(t, '\b([a-d])\b', 1) as y from a)
select conv_id, turn, upper(coalesce(x[-1], y[-1], 'a')) as letter, case when contains(t, 'yes') then 'yes' when contains(t, 'no') then 'no' else 'maybe' end as decision from m
""")
def answer_extraction(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").filter("role = 'assistant'")
    return c.select("conv_id", "turn", answers.choice_letter(F.col("text")).alias("letter"), answers.yes_no_maybe(F.col("text")).alias("decision"))


@query("""
select conv_id, cast(count(*) as int) as n_turns, sha256(string_agg(turn || ':' || role || ':' || text, chr(10) order by turn, role, text)) as digest from conversations group by conv_id
""")
def chat_examples(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as ordered turns; the digest covers what the chat JSON holds."""
    chats = training.chat_conversations(table(spark, d, "conversations"))
    turns = F.from_json("chat", "array<struct<role:string,content:string>>")
    t = table(spark, d, "conversations")
    lines = t.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.concat_ws(":", x["turn"].cast("string"), x["role"], x["text"])).alias("lines"))
    return chats.filter(F.size(turns) == F.col("n_turns")).join(lines, "conv_id").select("conv_id", "n_turns", F.sha2(F.array_join("lines", "\n"), 256).alias("digest"))


@query("""
with j as (select l_orderkey, l_linenumber, p_name, s_name, n_name, l_quantity, o_orderstatus from lineitem left join orders on l_orderkey = o_orderkey left join part on l_partkey = p_partkey
  left join supplier on l_suppkey = s_suppkey left join nation on s_nationkey = n_nationkey)
select l_orderkey, l_linenumber, 'Compound ' || coalesce(p_name, 'unknown compound') || ' exhibits ' || coalesce(o_orderstatus, 'an activity') || ' = ' || cast(cast(l_quantity as int) as varchar) || ' units'
  || coalesce(' against ' || s_name || coalesce(' (' || n_name || ')', ''), '') || ', as reported in the ChEMBL curated bioactivity database.' as sentence from j
""")
def five_way_left_join_sentence(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a line item is an activity; part, order, supplier and nation are its dimensions."""
    c = F.col
    j = table(spark, d, "lineitem").join(table(spark, d, "orders"), c("l_orderkey") == c("o_orderkey"), "left").join(table(spark, d, "part"), c("l_partkey") == c("p_partkey"), "left")
    j = j.join(table(spark, d, "supplier"), c("l_suppkey") == c("s_suppkey"), "left").join(table(spark, d, "nation"), c("s_nationkey") == c("n_nationkey"), "left")
    none = F.lit(None).cast("string")
    s = sentences.bioactivity(c("p_name"), none, c("o_orderstatus"), F.lit("="), c("l_quantity"), F.lit("units"), c("s_name"), c("n_name"), none)
    return j.select("l_orderkey", "l_linenumber", s.alias("sentence"))


@query("""
with m as (select distinct p_brand, p_name from part), r as (select *, row_number() over (partition by p_brand order by p_name) as k from m)
select p_brand, string_agg(p_name, ', ' order by p_name) filter (k <= 5) as sample, count(*) as n_members from r group by p_brand
""")
def capped_member_sample(spark: SparkSession, d: str) -> DataFrame:
    """Proxy: a brand is a pathway, its parts are the members."""
    from galenus.operators.articles import pathway_table

    p = table(spark, d, "part")
    brands = p.select(F.col("p_brand").alias("pathway_id")).distinct()
    none = p.limit(0).select(F.col("p_brand").alias("pathway_id"), F.col("p_name").alias("summation"))
    out = pathway_table(brands, none, p.select(F.col("p_brand").alias("pathway_id"), F.col("p_name").alias("uniprot_id")))
    return out.select(F.col("pathway_id").alias("p_brand"), F.col("proteins_sample").alias("sample"), F.col("n_proteins").alias("n_members"))


@query()
def lot_extraction(spark: SparkSession, d: str) -> DataFrame:
    """Lots of recall texts built from supplier keys; the test has its own probe table."""
    k = F.col("s_suppkey")
    info = F.when(k % 3 == 0, F.format_string("Lot #: AB%04d, AB%04d; Exp 12/25", k, k + 2)).when(k % 3 == 1, F.format_string("Lots A%05d through A%05d", k, k + 3)).otherwise(F.lit("All lots within expiry"))
    t = table(spark, d, "supplier").select("s_suppkey", F.explode_outer(lots.extract_lots(info)).alias("l"))
    return t.select("s_suppkey", F.col("l.lot").alias("lot"), F.col("l.lot_norm").alias("lot_norm"), F.coalesce("l.method", F.lit("none")).alias("method"))
