"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import ascii_lower, as_table, maybe_broadcast

#: A window is this many consecutive words of a benchmark item.
WINDOW = 10

#: Words of a hashed gram. The least hash of each WINDOW - GRAM + 1 neighbouring
#: grams is kept, so every shared span of WINDOW words shares a kept gram.
GRAM = 6

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _row_key(text: Column) -> Column:
    """With doc_id it tells rows apart; rows with equal key have equal text and so equal results."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _grams(hashes: Column, n: int) -> Column:
    """Hash of each ``n`` neighbouring entries; empty if there are fewer."""
    whole = F.transform(hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, n))))
    return F.when(F.size(hashes) >= n, F.slice(whole, F.lit(1), F.size(hashes) - (n - 1))).otherwise(F.array().cast("array<bigint>"))


def _minima(grams: Column) -> Column:
    """Winnowing: the distinct least hashes of all windows of WINDOW - GRAM + 1 grams."""
    width = WINDOW - GRAM + 1
    least = F.transform(grams, lambda g, i: F.least(g, *(F.get(grams, i + j) for j in range(1, width))))
    return F.array_distinct(F.slice(least, F.lit(1), F.greatest(F.size(grams) - (width - 1), F.lit(0))))


def _hashed(df: DataFrame) -> DataFrame:
    """Adds ``hs``, the hash of each word, materialised once per row so that no later lambda splits the text again."""
    return df.withColumn("hs", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))


def _windows(ws: Column, n: int) -> Column:
    """Array of (at, len, window), one for each ``n`` neighbouring words, joined by a space."""
    whole = F.transform(ws, lambda w, i: F.struct(i.alias("at"), F.lit(n).alias("len"), F.concat_ws(" ", w, *(F.get(ws, i + j) for j in range(1, n))).alias("window")))
    return F.slice(whole, F.lit(1), F.greatest(F.size(ws) - (n - 1), F.lit(0)))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of each document that lie inside an occurrence of a benchmark window.

    ``docs`` (doc_id, text) and ``benchmark`` (item_id, text); other columns are
    not read. Returns, for every row of ``docs``: doc_id, n_words, n_hit,
    n_items, items_sha256, contaminated.

    Fingerprints of both sides (winnowing) are joined, and only documents that
    share one are compared word by word, where hits are extended to all their
    windows. Items of fewer than WINDOW words are one window of their own
    length; they and their documents meet on the hash of whole windows of that
    length. Null and wordless texts have no words and no hits; repeated rows
    each get their result; rows of one doc_id with different texts stay apart;
    items without words or with a null item_id: the former are no windows, the
    latter count as the text ``null``. An empty benchmark hits nothing.
    """
    bench = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words(F.col("text")).alias("ws"))
    bench = as_table(bench.filter(F.size("ws") > 0), "benchmark_words")
    short = sorted(r[0] for r in bench.filter(F.size("ws") < WINDOW).select(F.size("ws")).distinct().collect())
    own = F.when(F.size("ws") >= WINDOW, _windows(F.col("ws"), WINDOW))
    for n in short:
        own = own.when(F.size("ws") == n, _windows(F.col("ws"), n))
    windows = bench.select("item", F.explode(own).alias("w")).groupBy("w.len", "w.window").agg(F.collect_set("item").alias("items"))
    windows = as_table(windows, "benchmark_windows")

    b = bench.withColumn("hs", F.transform("ws", lambda w: F.xxhash64(w)))
    prints = b.filter(F.size("ws") >= WINDOW).withColumn("grams", _grams(F.col("hs"), GRAM)).select(F.explode(_minima(F.col("grams"))).alias("print"))
    for n in short:
        prints = prints.unionByName(b.filter(F.size("ws") == n).select(F.explode(_grams(F.col("hs"), n)).alias("print")))
    prints = as_table(prints.distinct(), "benchmark_prints")

    base = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    keyed = _hashed(base.withColumn("key", _row_key(F.col("text"))))
    own = _minima(F.col("grams"))
    for n in short:
        own = F.array_union(own, _grams(F.col("hs"), n))
    marks = keyed.withColumn("grams", _grams(F.col("hs"), GRAM)).withColumn("marks", own)
    # posexplode_outer keeps a row of every document, whose first mark carries its number of words: the text is split once
    marks = marks.select("doc_id", "key", F.size("hs").cast("long").alias("n_words"), F.posexplode_outer("marks").alias("at", "print"))
    known = maybe_broadcast(prints.withColumn("known", F.lit(True)), 24)
    marked = marks.join(known, "print", "left")
    first = F.coalesce("at", F.lit(0)) == 0
    marked = marked.filter(F.col("known") | first)
    marked = as_table(marked.select("doc_id", "key", F.when(first, F.col("n_words")).alias("n_words"), F.coalesce("known", F.lit(False)).alias("known")), "marks")
    found = as_table(marked.filter("known").select("doc_id", "key").distinct(), "candidates")

    same = [F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")), F.col("d.key") == F.col("c.key")]
    candidates = base.withColumn("key", _row_key(F.col("text"))).alias("d").join(maybe_broadcast(found, 48).alias("c"), same, "left_semi")
    candidates = candidates.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", words(F.col("text")).alias("ws"))
    spans = candidates.select("doc_id", "key", F.explode_outer(F.concat(*(_windows(F.col("ws"), n) for n in [*short, WINDOW]))).alias("w"))
    hits = spans.select("doc_id", "key", "w.*").join(maybe_broadcast(windows, 400), ["len", "window"]).select("doc_id", "key", "at", "len", "items")
    per_doc = hits.groupBy("doc_id", "key").agg(
        F.array_sort(F.collect_set(F.struct("at", "len"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("ids"),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def extend(a: Column, s: Column) -> Column:
        end = s["at"] + s["len"]
        return F.struct(F.greatest(a["end"], end).alias("end"), (a["n"] + F.greatest(end - F.greatest(a["end"], s["at"]), F.lit(0))).alias("n"))

    per_doc = as_table(per_doc.select("doc_id", "key", F.aggregate("spans", start, extend)["n"].alias("n_hit"), "ids"), "hits")

    sized = marked.filter("n_words is not null").select("doc_id", "key", "n_words")
    same = [F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")), F.col("d.key") == F.col("h.key")]
    n_hit = F.coalesce("h.n_hit", F.lit(0).cast("long"))
    return sized.alias("d").join(per_doc.alias("h"), same, "left").select(
        "d.doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("h.ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("h.ids", F.array().cast("array<string>")), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id has no row that holds a benchmark window. Rows without a doc_id stay."""
    gone = as_table(contamination(docs, benchmark).filter("contaminated and doc_id is not null").select("doc_id").distinct(), "contaminated")
    return docs.join(maybe_broadcast(gone, 32), "doc_id", "left_anti").select(*docs.columns)


ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from documents),
b as (
  select cast(item_id as varchar) as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark),
bs as (select item, ws, least(len(ws), 10) as n from b where len(ws) > 0),
bw as (select item, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(list_slice(ws, i, i + n - 1), ' '))) as w from bs),
lens as (select distinct n from bs),
dw as (
  select r, n, unnest(range(1, len(ws) - n + 2)) as i,
         unnest(list_transform(range(1, len(ws) - n + 2), lambda i: array_to_string(list_slice(ws, i, i + n - 1), ' '))) as w
  from d, lens where len(ws) >= n),
h as (select r, i, dw.n, item from dw join bw on dw.w = bw.w and dw.n = bw.n),
hit as (select r, count(*) as n_hit from (select distinct r, unnest(range(i, i + n)) as p from h) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from h) group by r)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join items using (r)
"""
