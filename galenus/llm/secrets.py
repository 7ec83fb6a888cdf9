"""Secret scans over a trigram inverted index, in DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import as_table, maybe_broadcast, running_sums
from galenus.llm.trigrams import ALL, matching, trigram_query


@dataclass(frozen=True)
class Rule:
    """A match counts if the text of ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Base rules first, in the order that breaks ties of position.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

#: Documents of one index segment, about; bounds the longest posting list.
SEGMENT_ROWS = 4096

MASK = "[SECRET]"

# What belongs to a pem header: all up to the END line or, where that is missing, the key's own headers and base64 lines.
# Groups repeat possessively: a greedy one takes a frame of the stack for each line, and a long key would overflow it.
_GAP = r"\s*+(?:\\[nr]\s*+){0,4}+"
_LAST_LINE = r"(?:[ \t]*+(?:\r?\n|\\n)[ \t]*+[A-Za-z0-9+/]{1,31}+={0,2}+(?=[ \t]*(?:$|[\r\n\\\"'])))?"
_BASE64 = rf"(?:{_GAP}(?:Proc-Type|DEK-Info): [^\r\n\\]*+){{0,2}}+(?:{_GAP}[A-Za-z0-9+/]{{32,}}+={{0,2}}+)++{_LAST_LINE}"
PEM_BODY = rf"^(?:[^-]*+(?:-{{1,4}}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----|{_BASE64})"
_SPAN = "struct<start:int,ord:int,end:int,kind:string>"


def _row_id(text: Column) -> Column:
    return F.xxhash64("doc_id", F.coalesce(text, F.lit("")))


def posting_lists(docs: DataFrame, trigrams: list[str], segments: int) -> DataFrame:
    """(segment, trigram, rows): for each segment of the documents (row, text) the sorted rows whose lower-cased text holds the trigram."""
    low = docs.select("row", F.lower("text").alias("low"))
    held = F.filter(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)), lambda t: t.isNotNull())
    occurrences = low.select(F.pmod("row", F.lit(segments)).alias("segment"), "row", F.explode_outer(held).alias("trigram"))
    # explode_outer and a later filter: the filter of a plain explode would be pushed below lower(), once per trigram
    return occurrences.filter(F.col("trigram").isNotNull()).groupBy("segment", "trigram").agg(F.array_sort(F.collect_set("row")).alias("rows"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(row, rule): the rows of ``docs`` (row, text) whose posting lists satisfy a rule's trigram query."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ALL}
    trigrams = sorted(set().union(*(q.trigrams() for q in queries.values())))
    segments = max(1, math.ceil(docs.count() / SEGMENT_ROWS))
    lists = posting_lists(docs, trigrams, segments)
    by_segment = lists.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "rows"))).alias("p"))
    hits = F.array(*(F.struct(F.lit(k).alias("rule"), matching(q, F.col("p")).alias("rows")) for k, q in queries.items()))
    return by_segment.select(F.explode(hits).alias("h")).select("h.rule", F.explode("h.rows").alias("row"))


def _matches(df: DataFrame, rule: Rule, order: int, only: Column | None = None) -> DataFrame:
    """Adds ``<kind>``, the spans of the rule's matches in ``text``: pieces between matches and matches add up to positions."""
    k, pattern = rule.kind, F.lit(rule.pattern)
    empty = F.array().cast("array<string>")
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    df = df.withColumn("_m", found if only is None else F.when(only, found).otherwise(empty))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split("text", rule.pattern, -1)).otherwise(empty))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.regexp_extract_all("text", pattern, F.lit(rule.group))).otherwise(empty) if rule.group else F.col("_m"))
    df = df.withColumn("_w", F.transform("_m", lambda m, i: F.char_length(F.get(F.col("_p"), i)) + F.char_length(m)))
    df = df.withColumn("_b", F.when(F.size("_w") > 0, running_sums(F.col("_w"))))

    def span(m: Column, i: Column) -> Column:
        start = F.get(F.col("_b"), i) + F.char_length(F.get(F.col("_p"), i))
        return F.struct(start.alias("start"), F.lit(order).alias("ord"), (start + F.char_length(m)).alias("end"), F.lit(k).alias("kind"), F.char_length(F.get(F.col("_g"), i)).alias("n"))

    spans = F.filter(F.transform("_m", span), lambda s: s["n"] >= rule.least)
    plain = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind")))
    return df.withColumn(k, plain.cast(f"array<{_SPAN}>")).drop("_m", "_p", "_g", "_w", "_b")


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, row, and per rule an array of spans) for every row of ``docs`` (doc_id, text).

    Rules with mandatory trigrams look only at the documents that the index
    yields; the others scan all texts. Positions are code points. A null text is
    empty; repeated rows each get their result.
    """
    base = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("row", _row_id(F.col("text")))
    order = {r.kind: i for i, r in enumerate(rules)}
    scanned = [r for r in rules if trigram_query(r.pattern) == ALL]
    indexed = [r for r in rules if r not in scanned]
    out = base
    for r in scanned:
        out = _matches(out, r, order[r.kind])
    out = out.drop("text")
    if not indexed:
        return out
    found = candidates(base, tuple(indexed)).groupBy("row").agg(F.collect_set("rule").alias("rules"))
    found = as_table(found, "secret_candidates")
    checked = base.join(maybe_broadcast(found, 96), "row")
    for r in indexed:
        checked = _matches(checked, r, order[r.kind], F.array_contains("rules", F.lit(r.kind)))
    kinds = [r.kind for r in indexed]
    some = checked.groupBy("doc_id", "row").agg(*(F.first(k).alias(k) for k in kinds))
    some = as_table(some.filter(sum((F.size(k) for k in kinds), F.lit(0)) > 0), "secret_spans")
    same = [F.col("a.doc_id").eqNullSafe(F.col("s.doc_id")), F.col("a.row") == F.col("s.row")]
    none = F.array().cast(f"array<{_SPAN}>")
    return out.alias("a").join(some.alias("s"), same, "left").select(
        "a.doc_id", "a.row", *(f"a.{r.kind}" for r in scanned), *(F.coalesce(f"s.{k}", none).alias(k) for k in kinds)
    )


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``docs``; see ``secret_spans``."""
    kinds, base = [r.kind for r in RULES], [r.kind for r in BASE]
    return secret_spans(docs).select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in base),
        F.sha2(_written(F.concat(*base)), 256).alias("base_sha256"), _written(F.concat(*kinds)).alias("spans"),
    )


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by MASK (overlapping ones by one), and n_chars, if there, counted anew.

    A private key goes with its body. All rows and columns stay; texts without secrets, null ones too, stay as they are.
    """
    kinds = [r.kind for r in RULES]
    spans = secret_spans(docs).select("doc_id", "row", F.array_sort(F.concat(*kinds)).alias("_spans")).filter(F.size("_spans") > 0)
    spans = as_table(spans.dropDuplicates(["doc_id", "row"]).withColumnRenamed("doc_id", "_id").withColumnRenamed("row", "_row"), "secret_masks")
    text = F.col("text")
    keyed = docs.withColumn("_key", F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(text.cast("string"), F.lit(""))))
    joined = keyed.join(maybe_broadcast(spans, 160), [F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), F.col("_key") == F.col("_row")], "left")

    def whole(s: Column) -> Column:
        body = F.regexp_extract(F.substring(text, s["end"] + 1, F.char_length(text)), PEM_BODY, 0)
        end = F.when(s["kind"] == "pem", s["end"] + F.char_length(body)).otherwise(s["end"])
        return F.struct(s["start"].alias("start"), end.alias("end"))

    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<string>").alias("parts"))

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["end"]
        between = F.substring(text, a["end"] + 1, s["start"] - a["end"])
        inside = F.when(new, F.concat(a["parts"], F.array(between, F.lit(MASK)))).otherwise(a["parts"])
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"), inside.alias("parts"))

    rest = lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(text, a["end"] + 1, F.char_length(text)))
    masked = F.when(F.col("_spans").isNull(), text).otherwise(F.aggregate(F.transform("_spans", whole), start, step, rest))
    out = joined.withColumn("text", masked)
    if "n_chars" in docs.columns:
        kept = F.col("n_chars")
        out = out.withColumn("n_chars", F.when(F.col("_spans").isNull(), kept).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def oracle() -> str:
    """DuckDB SQL for ``find_secrets``: the same rules, scanned over all texts."""
    parts = []
    for i, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"select r, '{r.kind}' as kind, {i} as ord, unnest(range(1, len(m) + 1)) as i, m, g, p, {r.least} as least from (select r, regexp_extract_all(text, '{p}') as m, "
            f"regexp_extract_all(text, '{p}', {r.group}) as g, regexp_split_to_array(text, '{p}') as p from d)"
        )
    written = "string_agg(kind || ':' || s || ':' || e, ',' order by s, ord, e)"
    return f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
f as ({' union all '.join(parts)}),
s as (select r, kind, ord, cast(list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as bigint) as s, length(m[i]) as n
      from f where length(g[i]) >= least),
a as (select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
      coalesce({written} filter (ord < {len(BASE)}), '') as base, {written} as spans from (select *, s + n as e from s) group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join a using (r)
"""
