"""Personal data: exact seed entities, and identifiers that bootstrapped context patterns discover."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galenus.llm.shared import as_table, bounded_batches, maybe_broadcast

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

#: An identifier-like token: a run of characters between white space, quotes and brackets that holds a digit or an @.
TOKEN = re.compile(r"(?<![^\s\"'<>()\[\]{},;|])[^\s\"'<>()\[\]{},;|0-9@]*+[0-9@][^\s\"'<>()\[\]{},;|]*+")
MIN_TOKEN = 5

#: Two words, each behind one to three characters that are no words; and the part of that which any text may begin with.
NEAR = re.compile(r"[^\w]{1,3}+([^\W\d_]++)(?:[^\w]{1,3}+([^\W\d_]++))?+")
NEXT = re.compile(r"[^\w]{0,3}+(?:[^\W\d_]++[^\w]{0,3}+(?:[^\W\d_]++)?+)?+")
REACH = 160

#: Bootstrapping: rounds at most, and what a pattern and an instance must reach. A pattern needs MIN_SEEDS trusted instances
#: and MIN_CONFIDENCE, both without the instance that it judges.
ROUNDS, MIN_SEEDS, MIN_CONFIDENCE, MIN_SCORE = 4, 3, 0.8, 0.7

#: Instances of more characters go by their digest.
LONG_INSTANCE = 64


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each @ outwards: time stays linear in long runs of letters."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", m.end() if m else at + 1)


def candidates(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(start, order of the kind, end, valid) of each match of the base patterns; no retries where the check fails."""
    if "@" in text:
        for s, e in email_spans(text):
            yield s, 0, e, True
    for m in IP.finditer(text):
        yield m.start(), 1, m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
    for m in CARD.finditer(text):
        n = len(d := _digits(m.group()))
        if n >= 12:
            yield m.start(), 2, m.end(), n <= 19 and luhn(d)
    if "+" in text:
        for m in PHONE.finditer(text):
            yield m.start(), 3, m.end(), 9 <= len(_digits(m.group())) <= 15


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of the kind, end) of the seed entities, sorted; failing matches are dropped without retries."""
    return sorted((s, k, e) for s, k, e, valid in candidates(text) if valid)


def _words(text: str, at: int, step: int) -> list[str]:
    """Up to two words next to ``at``: before it (``step`` -1, nearest first) or behind it. As much is read as they take."""
    reach = REACH
    while True:
        near = text[max(0, at - reach) : at][::-1] if step < 0 else text[at : at + reach]
        if len(near) < reach or NEXT.match(near).end() < reach:
            m = NEAR.match(near)
            return [w[::step].lower() for w in m.groups() if w] if m else []
        reach *= 8


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns of what stands there: two words to the left, two to the right, and one on each side."""
    left, right = _words(text, start, -1), _words(text, end, 1)
    out = [f"{left[1]} {left[0]} _"] if len(left) == 2 else []
    out += [f"_ {right[0]} {right[1]}"] if len(right) == 2 else []
    return out + ([f"{left[0]} _ {right[0]}"] if left and right else [])


def form(token: str) -> str:
    """A coarse form: what identifiers of one kind have in common however they are written."""
    digits = len(_digits(token))
    if "@" in token:
        return "at"
    if token.count(".") >= 2 and digits >= 3 or token.count(":") >= 2 and digits:
        return "parts"
    return "digits" if digits >= 7 and 2 * digits >= len(token) else "other"


def _instance(token: str) -> str:
    return token if len(token) <= LONG_INSTANCE else "sha256:" + hashlib.sha256(token.encode()).hexdigest()


def occurrences(text: str) -> list[tuple[str, str, str, int, int, int]]:
    """(pattern, instance, form, kind, start, end) of each context of the seeds (kind 0 to 3), of matches that fail their
    kind's check (kind -2 to -5, evidence against it) and of other identifier-like tokens (kind -1)."""
    found = list(candidates(text))
    busy = sorted((s, e, k if valid else -2 - k) for s, k, e, valid in found)
    valid = [(s, e) for s, e, k in busy if k >= 0]
    spans, i = [], 0
    for s, e, k in busy:
        while i < len(valid) and valid[i][1] <= s:
            i += 1
        if k >= 0 or i == len(valid) or valid[i][0] >= e:  # a failing match counts where no seed overlaps it
            spans.append((s, e, k))
    i, reached = 0, 0
    for m in TOKEN.finditer(text):
        s = m.start()
        e = s + len(m.group().rstrip(".:!?"))
        while i < len(busy) and busy[i][0] < e:
            reached = max(reached, busy[i][1])
            i += 1
        if reached <= s and e - s >= MIN_TOKEN:
            spans.append((s, e, -1))
    return [(p, _instance(text[s:e]), form(text[s:e]), k, s, e) for s, e, k in sorted(spans) for p in contexts(text, s, e)]


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_SEEN = "array<struct<pattern:string,instance:string,form:string,kind:int,start:int,end:int>>"
_SCAN = f"row string, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start:int,ord:int,end:int>>, seen {_SEEN}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, at = TaskContext.get(), 0
    span = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "ord", "end")]))
    seen = pa.list_(pa.struct([(n, pa.string()) for n in ("pattern", "instance", "form")] + [(n, pa.int32()) for n in ("kind", "start", "end")]))
    for b in batches:
        rows, base, near = [], [], []
        for text in b.column(1).to_pylist():
            rows.append(f"{task.partitionId() if task else 0}-{at}")
            at += 1
            base.append(base_spans(text or ""))
            near.append(occurrences(text or ""))
        counts = [pa.array([sum(k == i for _, k, _ in x) for x in base], pa.int64()) for i in range(len(KINDS))]
        sha = [hashlib.sha256(_written(x).encode()).hexdigest() for x in base]
        lists = [
            pa.array([[dict(zip(("start", "ord", "end"), s, strict=True)) for s in x] for x in base], span),
            pa.array([[dict(zip(("pattern", "instance", "form", "kind", "start", "end"), s, strict=True)) for s in x] for x in near], seen),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(rows), b.column(0), *counts, pa.array(sha), *lists], names="row doc_id n_email n_ip n_card n_phone base_sha256 base seen".split())


def scan(docs: DataFrame) -> DataFrame:
    """Seeds and pattern occurrences of every row's whole text, written as a table; ``row`` names its row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan, _SCAN)
    return as_table(rows, "pii_scan")


def discover(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bootstrap: (instance, kind) that were promoted, and (pattern, kind, trusted, n) of the patterns that trusted instances induce.

    The graph's edges are the distinct pairs of a pattern and an instance.
    Trusted are at first the seeds. Each round:

    - A pattern's confidence for a kind is the share of trusted instances of the
      kind among its instances. Unknown ones and matches that fail a check count
      against it. An instance is judged by what is left of a pattern without it:
      trusted / (n - 1), at least MIN_SEEDS and MIN_CONFIDENCE.
    - An unknown instance's score is the noisy-or of its patterns' confidence
      times the share of its form among the kind's trusted instances. From
      MIN_SCORE on it is promoted (ties to the first kind), and so it induces
      patterns in the next round. A round without a promotion is the last.
    """
    seen = scanned.select(F.explode("seen").alias("s")).select("s.pattern", "s.instance", "s.form", "s.kind")
    edges = as_table(seen.distinct(), "pii_edges")
    sizes = edges.select("pattern", "instance").distinct().groupBy("pattern").agg(F.count("*").alias("n"))
    trusted = edges.filter("kind >= 0").select("instance", "form", "kind").distinct().withColumn("round", F.lit(0))
    trusted = as_table(trusted, "pii_trusted")
    pairs = edges.filter("kind >= -1").select("pattern", "instance").distinct()
    unknown = edges.filter("kind = -1").select("pattern", "instance", "form")

    def induced(trusted: DataFrame) -> DataFrame:
        held = pairs.join(trusted.select("instance", "kind"), "instance").groupBy("pattern", "kind").agg(F.count("*").alias("trusted"))
        held = as_table(held.filter(F.col("trusted") >= MIN_SEEDS), "pii_held")
        return as_table(sizes.join(maybe_broadcast(held, 120), "pattern"), "pii_patterns")

    patterns = induced(trusted)
    for k in range(1, ROUNDS + 1):
        rest = patterns.withColumn("confidence", F.col("trusted") / F.greatest(F.col("n") - 1, F.lit(1))).filter(F.col("confidence") >= MIN_CONFIDENCE)
        forms = trusted.groupBy("kind", "form").agg(F.count("*").alias("m"))
        forms = forms.withColumn("usual", F.col("m") / F.sum("m").over(Window.partitionBy("kind"))).select("kind", "form", "usual")
        judged = unknown.join(maybe_broadcast(rest.select("pattern", "kind", "confidence"), 120), "pattern").join(trusted.select("instance"), "instance", "left_anti")
        score = judged.groupBy("instance", "form", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("belief"))
        score = score.join(F.broadcast(forms), ["kind", "form"]).withColumn("score", F.col("belief") * F.col("usual"))  # forms: at most 16 rows
        best = F.max_by("kind", F.struct("score", -F.col("kind"))).alias("kind")
        fresh = as_table(score.filter(F.col("score") >= MIN_SCORE).groupBy("instance", "form").agg(best).withColumn("round", F.lit(k)), "pii_promoted")
        if fresh.isEmpty():
            break
        trusted = as_table(trusted.unionByName(fresh), "pii_trusted")
        patterns = induced(trusted)
    return trusted.filter("round > 0").select("instance", "kind"), patterns


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data in every row's whole text: doc_id, counts of the base kinds, base_sha256, spans, n_found.

    base_sha256 covers the base spans; spans lists them with the occurrences of
    promoted instances (``discover``) at patterns of their kind, n_found of them.
    Positions are code points, ends exclusive. A null text is empty: no spans.
    Repeated rows each get their result; a null doc_id stays null. No rows, no
    results.
    """
    scanned = scan(docs)
    promoted, patterns = discover(scanned)
    # without the instance, the pattern must still reach both bounds, as where it was promoted
    sure = patterns.filter((F.col("trusted") > MIN_SEEDS) & (F.col("trusted") - 1 >= MIN_CONFIDENCE * (F.col("n") - 1))).select("pattern", "kind")
    sure = as_table(sure, "pii_sure")
    unknown = scanned.select("row", F.explode("seen").alias("s")).filter("s.kind = -1").select("row", "s.pattern", "s.instance", "s.start", "s.end")
    found = unknown.join(maybe_broadcast(promoted, 120), "instance").join(maybe_broadcast(sure, 120), ["pattern", "kind"]).groupBy("row")
    found = found.agg(F.collect_set(F.struct(F.col("start"), F.col("kind").alias("ord"), F.col("end"))).alias("found"))
    found = as_table(found, "pii_found")
    size = found.agg(F.sum(F.size("found") * 32 + 100)).head()[0] or 0
    out = scanned.drop("seen").join(maybe_broadcast(found, 1, rows=size), "row", "left")
    more = F.coalesce("found", F.array().cast("array<struct<start:int,ord:int,end:int>>"))
    kinds = F.array(*(F.lit(k) for k in KINDS))
    written = F.transform(F.array_sort(F.concat("base", more)), lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"], s["end"]))
    return out.select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", F.array_join(written, ",").alias("spans"), F.size(more).cast("long").alias("n_found"))
