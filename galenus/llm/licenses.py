"""Licence scans: Dice coefficient of word bigrams between windows of a text and licence templates, in DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass
from fractions import Fraction
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galenus.functions.text import let
from galenus.llm.licence_texts import TEMPLATES
from galenus.llm.shared import ascii_lower

#: Least Dice coefficient of a hit.
THRESHOLD = 0.8

WORD = "[a-z0-9]+"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Numbers of distinct bigrams that can reach ``threshold`` against ``n``: 2 min(a, n) / (a + n) >= threshold.

    In exact fractions; scores are rounded to six digits, so one half of the last digit less reaches it too.
    """
    least = Fraction(str(threshold)) - Fraction(1, 2_000_000)
    ratio = least / (2 - least)
    return -(-n * ratio // 1), n // ratio


@dataclass(frozen=True)
class Template:
    """A template's distinct bigrams, those that a notice must hold, its length, and the bigrams that a window holds at least and at most."""

    license: str
    grams: tuple[str, ...]
    needs: tuple[str, ...]
    length: int
    low: int
    high: int


@cache
def compiled(templates: tuple[tuple[str, str, tuple[str, ...]], ...], threshold: float) -> tuple[Template, ...]:
    out = []
    for name, text, phrases in sorted(templates):
        grams = tuple(template_bigrams(text))
        length = len(re.findall(WORD, text.lower())) - 1
        needs = tuple(sorted({g for p in phrases for g in template_bigrams(p)}))
        out.append(Template(name, grams, needs, length, size_bounds(len(grams), threshold)[0], size_bounds(length, threshold)[1]))
    return tuple(out)


def _mandatory(templates: tuple[Template, ...]) -> str:
    """A pattern that every text with a hit matches: for each template the longest word of what it needs, else every word of it."""
    words: set[str] = set()
    for t in templates:
        words |= {max(" ".join(t.needs).split(), key=lambda w: (len(w), w))} if t.needs else set(" ".join(t.grams).split())
    return rf"(?<![a-z0-9])(?:{'|'.join(sorted(words))})(?![a-z0-9])"


_FOUND = "array<struct<matched:int,score:double,t:int,license:string,p:int,q:int>>"


def license_scan(docs: DataFrame, threshold: float = THRESHOLD, templates: tuple[tuple[str, str, tuple[str, ...]], ...] = TEMPLATES) -> DataFrame:
    """(doc_id, licenses, n_notices, best_score, license, spans) of every row's whole text.

    The text is normalised to its words (A-Z as a-z, runs of letters and digits),
    so line breaks and punctuation don't matter. For each template:

    1. A window runs from one bigram of the template to another and has as many
       bigrams as the size bounds allow. Of the windows that begin at a place,
       the one with the most of the template's bigrams for its size counts (2k /
       (m + n), repeats included), ties to the shortest.
    2. Its Dice coefficient is that of the distinct bigrams. It is a hit from
       ``threshold`` on, if it holds the phrases (name and version) that the
       template needs.
    3. A hit counts if neither the hit before nor the one after it that overlaps
       it is better.

    Of hits of all templates that overlap, only the best is a notice. Better is
    who shares more bigrams with its template, then the larger score, the first
    template and the first place.

    licenses joins the distinct identifiers, sorted; license and best_score are
    those of the notice with the largest score, ties to the first identifier
    (null without any); spans lists notices as identifier:first word:last word, the words
    of the text counted from 0. Null and empty texts have no notice; repeated
    rows each get their result.
    """
    known = compiled(templates, threshold)
    literal = F.array(*(F.struct(F.lit(k).alias("t"), F.lit(t.license).alias("license"), F.array(*map(F.lit, t.grams)).alias("grams"), F.array(*map(F.lit, t.needs)).cast("array<string>").alias("needs"), F.lit(t.length).alias("length"), F.lit(int(t.low)).alias("low"), F.lit(int(t.high)).alias("high")) for k, t in enumerate(known)))
    every = sorted({g for t in known for g in t.grams})
    none = F.array().cast("array<string>")
    base = docs.select(F.col("doc_id").cast("long"), ascii_lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    base = base.select("doc_id", F.when(F.col("text").rlike(_mandatory(known)), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).otherwise(none).alias("words"))
    pairs = F.zip_with(F.slice("words", F.lit(1), F.size("words") - 1), F.slice("words", F.lit(2), F.size("words") - 1), lambda a, b: F.concat_ws(" ", a, b))
    base = base.select("doc_id", F.when(F.size("words") >= 2, pairs).otherwise(none).alias("grams"))
    places = F.filter(F.transform("grams", lambda g, i: F.when(g.isin(every), i)), lambda i: i.isNotNull())
    base = base.withColumn("places", places)

    def of_template(t: Column) -> Column:
        return let(F.filter("places", lambda i: F.array_contains(t["grams"], F.get("grams", i))), lambda at: windows(t, at))

    def windows(t: Column, at: Column) -> Column:
        low, high, n = t["low"], t["high"], t["length"]

        def widest(j: Column) -> Column:
            """The best end of the windows that begin at place j."""
            ends = F.filter(F.sequence(j + low - 1, F.least(F.size(at) - 1, j + high - 1)), lambda e: F.get(at, e) - F.get(at, j) < high)
            size = lambda e: F.get(at, e) - F.get(at, j) + 1
            return F.array_max(F.transform(ends, lambda e: F.struct((2.0 * F.least(e - j + 1, n) / (size(e) + n)).alias("value"), (-F.get(at, e)).alias("end"))))

        starts = F.filter(F.sequence(F.lit(0), F.size(at) - low), lambda j: F.get(at, j + low - 1) - F.get(at, j) < high)
        scored = F.transform(starts, lambda j: let(-widest(j)["end"], lambda q: dice(t, F.get(at, j), q)))
        hits = F.filter(scored, lambda h: (h["score"] >= threshold) & h["whole"])
        best = let(hits, lambda hs: F.filter(hs, lambda h, i: ~better(F.get(hs, i - 1), h) & ~better(F.get(hs, i + 1), h)))
        return F.when(F.size(at) >= low, F.transform(best, lambda h: h.dropFields("whole"))).otherwise(F.array().cast(_FOUND))

    def dice(t: Column, p: Column, q: Column) -> Column:
        def of(own: Column) -> Column:
            matched = F.size(F.array_intersect(own, t["grams"]))
            score = F.round(2.0 * matched / (F.size(own) + F.size(t["grams"])), 6)
            return F.struct(matched.alias("matched"), score.alias("score"), t["t"].alias("t"), t["license"].alias("license"), p.alias("p"), q.alias("q"), (F.size(F.array_except(t["needs"], own)) == 0).alias("whole"))

        return let(F.array_distinct(F.slice("grams", p + 1, q - p + 1)), of)

    def better(a: Column, b: Column) -> Column:
        rank = lambda h: F.struct(h["matched"], h["score"], -h["t"], -h["p"])
        return F.coalesce((a["p"] <= b["q"]) & (b["p"] <= a["q"]) & (rank(a) > rank(b)), F.lit(False))

    found = F.flatten(F.transform(F.filter(literal, lambda t: t["low"] <= F.size("places")), of_template))
    base = base.select("doc_id", F.when(F.size("places") > 0, found).otherwise(F.array().cast(_FOUND)).alias("found"))
    notices = F.array_sort(F.transform(F.filter("found", lambda h: ~F.exists("found", lambda o: better(o, h))), lambda h: F.struct(h["p"].alias("p"), h["q"].alias("q"), h["license"].alias("license"), h["score"].alias("score"))))
    base = base.select("doc_id", notices.alias("notices"))
    best = F.element_at(F.array_sort(F.transform("notices", lambda h: F.struct((-h["score"]).alias("minus"), h["license"].alias("license")))), 1)
    base = base.withColumn("best", F.when(F.size("notices") > 0, best))
    names = F.array_sort(F.array_distinct(F.transform("notices", lambda h: h["license"])))
    spans = F.transform("notices", lambda h: F.concat_ws(":", h["license"], h["p"], h["q"] + 1))
    return base.select("doc_id", F.array_join(names, ",").alias("licenses"), F.size("notices").cast("long").alias("n_notices"), (-F.col("best.minus")).alias("best_score"), F.col("best.license").alias("license"), F.array_join(spans, ",").alias("spans"))


def oracle(threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for ``license_scan`` over ``documents``: joins of bigrams, without the search for mandatory words."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    known = compiled(TEMPLATES, threshold)
    sizes = ",".join(f"({k},{quote(t.license)},{len(t.grams)},{t.length},{t.low},{t.high},{len(t.needs)})" for k, t in enumerate(known))
    grams = ",".join(f"({k},{quote(g)},{str(g in t.needs).lower()})" for k, t in enumerate(known) for g in t.grams)
    return f"""
with t(t, license, n, length, low, high, needs) as (values {sizes}),
tg(t, gram, need) as (values {grams}),
d as (select row_number() over () as r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
w as (select r, regexp_extract_all(text, '{WORD}') as ws from d),
g as (select r, unnest(range(0, len(ws) - 1)) as i, unnest(list_transform(range(1, len(ws)), lambda j: ws[j] || ' ' || ws[j + 1])) as gram from w where len(ws) >= 2),
h as (select r, tg.t, i, row_number() over (partition by r, tg.t order by i) as j from g join tg using (gram)),
v as (select a.r, a.t, a.i as p, b.i as q, 2.0::double * least(b.j - a.j + 1, length) / (b.i - a.i + 1 + length) as value
      from h a join t on a.t = t.t join h b on a.r = b.r and a.t = b.t and b.j >= a.j + low - 1 and b.i < a.i + high),
s as (select r, t, p, arg_max(q, (value, -q)) as q from v group by r, t, p),
z as (select s.r, s.t, p, q, count(distinct g.gram) as size, count(distinct tg.gram) as matched, count(distinct case when tg.need then tg.gram end) as held
      from s join g on g.r = s.r and g.i between p and q left join tg on tg.t = s.t and tg.gram = g.gram group by s.r, s.t, p, q),
e as (select r, z.t, license, p, q, matched, round(2.0::double * matched / (size + n), 6) as score from z join t on z.t = t.t where held = needs and round(2.0::double * matched / (size + n), 6) >= {threshold}),
l as (select *, lag({{'p': p, 'q': q, 'm': matched, 's': score}}) over o as b, lead({{'p': p, 'q': q, 'm': matched, 's': score}}) over o as a from e window o as (partition by r, t order by p)),
f as (select r, t, license, p, q, matched, score from l
      where not coalesce(b.p <= q and p <= b.q and (b.m, b.s, -b.p) > (matched, score, -p), false) and not coalesce(a.p <= q and p <= a.q and (a.m, a.s, -a.p) > (matched, score, -p), false)),
k as (select * from f x where not exists (select 1 from f y where y.r = x.r and y.p <= x.q and x.p <= y.q and (y.matched, y.score, -y.t, -y.p) > (x.matched, x.score, -x.t, -x.p))),
n as (select r, string_agg(distinct license, ',' order by license) as licenses, count(*) as n_notices, max(score) as best_score, arg_min(license, (-score, license)) as license,
             string_agg(license || ':' || p || ':' || (q + 1), ',' order by p, q, license, score) as spans from k group by r)
select doc_id, coalesce(licenses, '') as licenses, coalesce(n_notices, 0) as n_notices, best_score, license, coalesce(spans, '') as spans from d left join n using (r)
"""
