"""Quality measures of shards, parts, columns, loads and feeds; each is one aggregation whose row becomes the measures of a gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Values of a column that are brought to the driver at most.
MOST_VALUES = 10_000


def _pct(part: Column, whole: Column) -> Column:
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 4)


def shard_profile(rows: DataFrame, id_column: str = "id", text_column: str = "text") -> DataFrame:
    """One row: counts, distinct and duplicate ids, empty texts, byte lengths (p50, p99, max) and null shares."""
    text, n = F.col(text_column), F.count(F.lit(1))
    size = F.octet_length(text)
    return rows.agg(
        n.alias("rows"), F.count_distinct(id_column).alias("distinct_ids"), (F.count(id_column) - F.count_distinct(id_column)).alias("duplicate_ids"),
        _pct(F.count_if(F.coalesce(F.trim(text), F.lit("")) == ""), n).alias("empty_text_pct"),
        F.expr(f"percentile_disc(0.5) within group (order by octet_length({text_column}))").alias("bytes_p50"),
        F.expr(f"percentile_disc(0.99) within group (order by octet_length({text_column}))").alias("bytes_p99"),
        F.max(size).alias("bytes_max"), F.sum(size).alias("bytes_total"),
    )


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def part_profile(rows: DataFrame, size: Column, part: str = "source_file") -> DataFrame:
    """Rows and bytes per part; one-row parts have no byte measure, since a row over the cap stands alone."""
    return rows.groupBy(part).agg(F.count("*").alias("rows"), F.sum(size).alias("est_bytes")).withColumn("capped_bytes", F.when(F.col("rows") > 1, F.col("est_bytes")))


def column_profile(rows: DataFrame, samples: int = 5) -> DataFrame:
    """Per column: share of non-null values, distinct values, the least samples, and flags. One pass, then unpivoted."""
    stats = []
    for c in rows.columns:
        v = F.col(f"`{c}`").cast("string")
        stats.append(F.struct(
            F.lit(c).alias("column"), _pct(F.count(v), F.count(F.lit(1))).alias("non_null_pct"), F.count_distinct(v).alias("distinct"),
            F.min(F.substring(v, 1, 80)).alias("least"), F.max(F.substring(v, 1, 80)).alias("greatest"),
        ))
    flat = rows.agg(F.array(*stats).alias("s")).select(F.explode("s").alias("s")).select("s.*")
    flag = F.when(F.col("non_null_pct") == 0, "empty").when(F.col("distinct") <= 1, "constant").when(F.col("non_null_pct") < 50, "sparse")
    return flat.withColumn("flag", flag)


def literature_audit(articles: DataFrame, edges: dict[str, DataFrame]) -> DataFrame:
    """One row of completeness, validity, uniqueness and link-resolution measures of literature records."""
    n = F.count(F.lit(1))
    filled = lambda c: F.count_if(F.coalesce(F.trim(c), F.lit("")) != "")
    base = articles.agg(
        n.alias("rows"), F.count_distinct("pmid").alias("distinct_pmids"), *(_pct(filled(c), n).alias(f"{c}_pct") for c in ("title", "abstract", "journal", "doi", "pmcid", "language")),
        _pct(F.count_if(F.col("pmid").rlike(r"^[1-9]\d*$")), F.count("pmid")).alias("valid_pmid_pct"), _pct(F.count_if(F.col("doi").rlike(r"^10\.\d{4,9}/\S+$")), F.count("doi")).alias("valid_doi_pct"),
        _pct(F.count_if(F.col("pmcid").rlike(r"^PMC\d+$")), F.count("pmcid")).alias("valid_pmcid_pct"), _pct(F.count_if(F.col("year").between(1780, 2100)), n).alias("valid_year_pct"),
        _pct(F.count_if(F.size("authors") > 0), n).alias("authors_pct"), _pct(F.count_if(F.size("mesh") > 0), n).alias("mesh_pct"),
        F.expr("percentile(char_length(abstract), 0.5)").alias("abstract_chars_p50"), F.expr("percentile(char_length(abstract), 0.95)").alias("abstract_chars_p95"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )
    if "cites" in edges:
        known = articles.select(F.col("pmid").alias("dst_pmid")).filter("dst_pmid is not null").distinct().withColumn("_known", F.lit(True))
        links = edges["cites"].join(known, "dst_pmid", "left")
        base = base.crossJoin(links.agg(F.count("*").alias("cites"), _pct(F.count("_known"), F.count("dst_pmid")).alias("cites_resolved_pct")))
    return base


def decades(articles: DataFrame) -> DataFrame:
    return articles.groupBy((F.floor(F.col("year") / 10) * 10).cast("int").alias("decade")).agg(F.count("*").alias("n"))


def load_measures(hot: DataFrame, body: DataFrame, staged: int) -> DataFrame:
    orphans = body.join(hot, body.article_id == hot.id, "left_anti").agg(F.count("*").alias("orphan_bodies"))
    loaded = hot.agg(F.count("*").alias("rows_loaded"))
    return loaded.crossJoin(orphans).withColumn("rows_loaded_equals_staging", F.col("rows_loaded") == staged)


def orphan_share(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows, orphans and their share. ``parents`` may repeat the key."""
    marked = children.join(parents.select(key).distinct().withColumn("_held", F.lit(True)), key, "left")
    return marked.agg(F.count("*").alias("rows"), F.count_if(F.col("_held").isNull()).alias("orphans"), _pct(F.count_if(F.col("_held").isNull()), F.count("*")).alias("orphan_pct"))


def coverage_pct(names: DataFrame, known: DataFrame) -> DataFrame:
    """Share of distinct names that are known; null without names."""
    j = names.select("name").distinct().join(known.select("name").distinct().withColumn("_known", F.lit(True)), "name", "left")
    return j.agg(F.count("*").alias("names"), F.count("_known").alias("known"), _pct(F.count("_known"), F.count("*")).alias("coverage_pct"))


def declared_totals(rows: DataFrame, declared: DataFrame) -> DataFrame:
    """Whether every dataset has as many rows as it declares; a missing total fails."""
    counted = rows.groupBy("dataset").agg(F.count("*").alias("rows"))
    j = counted.join(declared, "dataset", "full")
    return j.agg(F.bool_and(F.coalesce(F.col("rows") == F.col("total"), F.lit(False))).alias("meta_total_equals_rows"))


def inventory(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.count("*").alias("rows"), F.max("retrieved_at").alias("newest"))


def source_tokens(rows: DataFrame) -> DataFrame:
    from galenus.functions.text import token_count

    return rows.groupBy("source").agg(F.sum(token_count(F.col("text"))).alias("tokens"))


def measures(*frames: DataFrame) -> dict:
    """Dict of one-row frames' columns, for the gate."""
    return {k: v for f in frames for k, v in f.head().asDict(recursive=True).items()}


def count_map(rows: DataFrame, column: str) -> dict:
    """value -> count of a column with at most MOST_VALUES values; ValueError beyond."""
    found = histogram(rows, column).limit(MOST_VALUES + 1).collect()
    if len(found) > MOST_VALUES:
        raise ValueError(f"{column} has over {MOST_VALUES} values")
    return {r["value"]: r["n"] for r in found}


def report_measures(reports: DataFrame, drugs: DataFrame, reactions: DataFrame, pairs: DataFrame, events: DataFrame, entries: DataFrame, bridged: DataFrame) -> DataFrame:
    """One row: reports and how many ids repeat, the years and the largest of them (ties to the later), rows of the parts and
    of the signal tables, and the share of drug entries (entry_id) that the bridge links; null without entries."""
    years = reports.groupBy("receive_year").agg(F.count("*").alias("n"))
    whole = reports.agg(
        F.count("*").alias("reports"), (F.count("*") - F.count_distinct("safetyreportid")).alias("duplicate_ids"), F.min("receive_year").alias("receive_year_min"), F.max("receive_year").alias("receive_year_max"),
    )
    largest = years.agg(F.max(F.struct("n", "receive_year")).alias("m")).select(F.col("m.receive_year").alias("largest_year"), F.coalesce("m.n", F.lit(0)).alias("largest_year_reports"))
    sizes = [f.agg(F.count("*").alias(n)) for n, f in {"drug_rows": drugs, "reaction_rows": reactions, "signal_pair_rows": pairs, "signal_event_rows": events}.items()]
    linked = entries.join(bridged.select("entry_id").distinct().withColumn("_linked", F.lit(True)), "entry_id", "left")
    share = linked.agg(_pct(F.count("_linked"), F.count("*")).alias("xref_coverage_pct"))
    out = whole
    for one in (largest, *sizes, share):  # frames of one row
        out = out.crossJoin(one)
    return out


def section_share(documents: DataFrame, sections: DataFrame) -> DataFrame:
    """Documents (document_id) with and without a row in ``sections``, and the percentage with; null without documents."""
    marked = documents.select("document_id").join(sections.select("document_id").distinct().withColumn("_has", F.lit(True)), "document_id", "left")
    return marked.agg(F.count("_has").alias("documents_with_sections"), F.count_if(F.col("_has").isNull()).alias("documents_without_sections"), _pct(F.count("_has"), F.count("*")).alias("sections_share_pct"))


def feed_measures(records: DataFrame, declared: DataFrame, names: DataFrame, known: DataFrame) -> DataFrame:
    """By dataset: rows, whether they are as many as declared, and the share of its distinct names that are known."""
    rows = records.groupBy("dataset").agg(F.count("*").alias("rows")).join(declared, "dataset", "full")
    named = names.select("dataset", "name").distinct().join(known.select("name").distinct().withColumn("_known", F.lit(True)), "name", "left")
    cover = named.groupBy("dataset").agg(_pct(F.count("_known"), F.count("*")).alias("xref_coverage_pct"))
    out = rows.join(cover, "dataset", "left")
    return out.select("dataset", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(F.col("rows") == F.col("total"), F.lit(False)).alias("meta_total_equals_rows"), "xref_coverage_pct")
