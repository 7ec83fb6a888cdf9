"""Read-only lookups. The relational part of each is a DataFrame function; ``Lookups`` turns their small results into claims."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.functions import dates
from galenus.functions.json import payload_values
from galenus.operators.claims import Claim, Coverage, LookupResult, Provenance

# The datasets of each regulatory lookup, and the payload fields that hold a status.
DATASETS = {
    "approval_status": ("fda_drugsfda", "ema_medicines", "ema_article57", "ema_outside_eu"),
    "safety_actions": ("fda_enforcement", "ema_referrals", "ema_dhpc", "ema_psusa"),
}
STATUS_FIELD = {"fda_drugsfda": "products[*].marketing_status", "ema_medicines": "medicine_status", "fda_enforcement": "status", "ema_referrals": "referral_status", "ema_psusa": "regulatory_outcome"}
#: Records that one lookup brings to the driver at most; what is beyond is counted in a note. The DataFrame functions have no limit.
PAGE = 1000
HISTORY_NOTE = "only the newest version of each label is kept; earlier versions are not covered"


def first_page(found: DataFrame, what: str, *order: str) -> tuple[list, tuple[str, ...]]:
    """The first PAGE rows in order, and a note if there are more."""
    rows = found.orderBy(*order).limit(PAGE + 1).collect()
    return rows[:PAGE], (f"limited to the first {PAGE} of {found.count()} {what}",) if len(rows) > PAGE else ()


@dataclass(frozen=True)
class Scope:
    """A moiety family: its keys, substance codes and normalised names."""

    moiety: int
    keys: tuple[int, ...]
    uniis: tuple[str, ...]
    names: tuple[str, ...]


def resolved(text: str, substances: DataFrame, xref: DataFrame, id_type: str | None = None) -> DataFrame:
    """Substances that own the code or are named so; moieties first, then the lowest key."""
    code, name = text.strip().upper(), " ".join(unicodedata.normalize("NFKC", text).casefold().split())
    if id_type is None:
        hit = ((F.col("id_type") == "unii") & (F.col("id_value") == code)) | ((F.col("id_type") == "name") & (F.col("id_value") == name))
        own = substances.filter(F.col("unii") == code).select("substance_key")
    else:
        hit = (F.col("id_type") == id_type) & F.col("id_value").isin(code, name, text.strip())
        own = substances.filter((F.lit(id_type) == "unii") & (F.col("unii") == code)).select("substance_key")
    keys = own.unionByName(xref.filter(hit).select("substance_key")).distinct()
    is_moiety = F.coalesce(F.col("moiety_key") == F.col("substance_key"), F.lit(True))
    return substances.join(keys, "substance_key", "left_semi").withColumn("is_moiety", is_moiety).orderBy(F.desc("is_moiety"), "substance_key")


def family(substances: DataFrame, moiety: int) -> DataFrame:
    return substances.filter(F.coalesce("moiety_key", "substance_key") == moiety)


def records_for_names(records: DataFrame, names: tuple[str, ...], dataset: str, release: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Records of one release whose names overlap ``names``; newest first, undated last, or only those dated in the interval."""
    hit = records.filter((F.col("dataset") == dataset) & (F.col("release_id") == release))
    hit = hit.filter(F.arrays_overlap("substance_names", F.array(*map(F.lit, names))))
    if start is not None:
        hit = hit.filter(F.col("event_date").between(F.lit(start), F.lit(end)))
    return hit.orderBy(F.col("event_date").desc_nulls_last(), "record_key")


def label_sections(sections: DataFrame, label_substances: DataFrame, articles: DataFrame, uniis: tuple[str, ...]) -> DataFrame:
    """Sections of the distinct labels that hold one of the codes, with version and year where the label's row exists."""
    mine = label_substances.filter(F.col("unii").isin(*uniis)).select("article_id").distinct()
    about = articles.filter("source = 'dailymed'").select(F.col("id").alias("article_id"), F.get_json_object("book_meta", "$.version").alias("version"), F.nullif(F.col("year"), F.lit(0)).alias("year"), "source_file")
    return sections.join(mine, "article_id", "left_semi").join(about, "article_id", "left").orderBy("article_id", "start_offset", "loinc_code")


def trials_for(studies: DataFrame, interventions: DataFrame, keys: tuple[int, ...]) -> DataFrame:
    return studies.join(interventions.filter(F.col("substance_key").isin(*keys)).select("nct_id").distinct(), "nct_id", "left_semi").orderBy("nct_id")


def quarter_gaps(totals: DataFrame, start: date, end: date) -> DataFrame:
    """Quarters between two dates without a totals row."""
    wanted = totals.sparkSession.range(1).select(F.explode(F.sequence(F.trunc(F.lit(start), "quarter"), F.trunc(F.lit(end), "quarter"), F.expr("interval 3 months"))).alias("quarter"))
    return wanted.join(totals.select("quarter"), "quarter", "left_anti").orderBy("quarter")


def indexed_literature(mesh: DataFrame, articles: DataFrame, names: tuple[str, ...], topic: str | None = None, limit: int = 20) -> DataFrame:
    """Newest records indexed under a name, and under the topic as descriptor or qualifier. Text ids sort by length, then value."""
    mine = mesh.filter(F.lower("descriptor_name").isin(*names))
    if topic:
        t = topic.strip().lower()
        about = mesh.filter((F.lower("descriptor_name") == t) | F.exists(F.coalesce("qualifiers", F.array().cast("array<string>")), lambda q: F.lower(q) == t))
        mine = mine.join(about.select("pmid").distinct(), "pmid", "left_semi")
    hits = mine.groupBy("pmid").agg(F.array_sort(F.collect_set("descriptor_name")).alias("descriptors"), F.min("source_file").alias("source_file"))
    years = articles.join(hits.select("pmid"), "pmid", "left_semi").groupBy("pmid").agg(F.nullif(F.max("year"), F.lit(0)).alias("year"))
    return hits.join(years, "pmid", "left").orderBy(F.col("year").desc_nulls_last(), F.length("pmid").desc(), F.col("pmid").desc()).limit(limit)


def code_rows(current: DataFrame, system: str, code: str) -> DataFrame:
    return current.filter((F.col("system_key") == system) & (F.col("code") == code))


class Lookups:
    """Lookups over a dict of tables. A table that is absent is named in ``coverage.missing``; nothing raises for it."""

    def __init__(self, tables: dict[str, DataFrame]):
        self.tables = tables

    def ready(self, *names: str) -> bool:
        """The tables exist and the last of them has a row."""
        return all(n in self.tables for n in names) and bool(self.tables[names[-1]].head(1))

    def latest(self, dataset: str) -> str | None:
        from galenus.operators.load import latest_release

        return latest_release(self.tables["releases"], dataset) if "releases" in self.tables else None

    def scope(self, key: int) -> Scope | None:
        substances, xref = self.tables["substances"], self.tables["xref"]
        row = substances.filter(F.col("substance_key") == key).head()
        if row is None:
            return None
        moiety = row.moiety_key or key
        members = family(substances, moiety)
        rows = members.orderBy("substance_key").collect()  # one family, a handful of rows
        listed = xref.filter("id_type = 'name'").join(members.select("substance_key"), "substance_key", "left_semi").select("id_value").orderBy("id_value")
        own = [" ".join(unicodedata.normalize("NFKC", r.name).casefold().split()) for r in rows if r.name]
        return Scope(moiety, tuple(r.substance_key for r in rows), tuple(r.unii for r in rows if r.unii), tuple(dict.fromkeys([*own, *(r[0] for r in listed.collect())])))

    def resolve_entity(self, text: str, id_type: str | None = None) -> LookupResult:
        rows = resolved(text, self.tables["substances"], self.tables["xref"], id_type).collect() if (text or "").strip() else []
        if not rows:
            return LookupResult((), Coverage(0, ("substance",)))
        n = len(rows)
        basis = "exact code or normalised name match" if n == 1 else f"{n} substances share this name"
        make = lambda r, more=(): Claim(f"{r.name or r.unii} (key {r.substance_key})", str(r.substance_key), "fetched" if n == 1 else "mapped", Provenance("substance", record_key=r.unii), 1 / n, basis, more)
        return LookupResult((make(rows[0], tuple(make(r) for r in rows[1:])),), Coverage(n))

    def _missing(self, datasets: tuple[str, ...], key: int) -> LookupResult:
        return LookupResult((), Coverage(0, datasets, (f"substance {key} not found",)))

    def _records(self, function: str, key: int, start: date | None = None, end: date | None = None) -> LookupResult:
        scope = self.scope(key)
        if scope is None:
            return self._missing(DATASETS[function], key)
        claims: list[Claim] = []
        missing: list[str] = []
        notes: list[str] = []
        for dataset in DATASETS[function]:
            release = self.latest(dataset)
            if release is None or "records" not in self.tables:
                missing.append(dataset)
                continue
            if not scope.names:
                continue
            every = records_for_names(self.tables["records"], scope.names, dataset, release)
            if start is not None and (undated := every.filter("event_date is null").count()):
                notes.append(f"{dataset}: {undated} records with no date not checked")
            found = records_for_names(self.tables["records"], scope.names, dataset, release, start, end)
            status = payload_values(F.col("payload"), STATUS_FIELD[dataset]) if dataset in STATUS_FIELD else F.array().cast("array<string>")
            page, more = first_page(found.withColumn("status", F.array_join(status, "; ")), f"records of {dataset}", "record_key")
            notes += more
            for r in page:
                parts = [f"{dataset} {r.record_key}", *([f"status: {r.status}"] if r.status else []), *([f"date: {r.event_date}"] if r.event_date else []), *([f"jurisdiction: {r.jurisdiction}"] if r.jurisdiction else [])]
                claims.append(Claim(", ".join(parts), r.status or None, "fetched", Provenance(dataset, release, r.source_file, r.record_key, r.jurisdiction), 1.0, "exact normalised substance name in the latest release"))
        if not scope.names:
            notes.append(f"substance {key} has no name to match")
        return LookupResult(tuple(claims), Coverage(len(claims), tuple(missing), tuple(notes)))

    def approval_status(self, key: int) -> LookupResult:
        return self._records("approval_status", key)

    def safety_actions(self, key: int, start: date, end: date) -> LookupResult:
        return self._records("safety_actions", key, start, end)

    def current_label(self, key: int) -> LookupResult:
        scope = self.scope(key)
        if scope is None:
            return self._missing(("dailymed",), key)
        if not self.ready("articles", "label_substances", "label_sections"):
            return LookupResult((), Coverage(0, ("dailymed",), (HISTORY_NOTE,)))
        found = label_sections(self.tables["label_sections"], self.tables["label_substances"], self.tables["articles"], scope.uniis)
        rows, more = first_page(found, "sections", "article_id", "start_offset") if scope.uniis else ([], ())
        claims = tuple(
            Claim(f"{r.article_id} section {r.loinc_code} {r.title or '(no title)'}, version {r.version or 'unknown'}, effective year {r.year or 'unknown'}", r.title, "fetched",
                  Provenance("dailymed", r.version, r.source_file, f"{r.article_id}#{r.loinc_code}", "US"), 1.0, "exact substance code in the label's active ingredients")
            for r in rows
        )
        return LookupResult(claims, Coverage(len(claims), (), (HISTORY_NOTE, *more)))

    def trials(self, key: int) -> LookupResult:
        scope = self.scope(key)
        if scope is None:
            return self._missing(("aact",), key)
        if not self.ready("intervention_substance", "studies"):
            return LookupResult((), Coverage(0, ("aact",)))
        rows, more = first_page(trials_for(self.tables["studies"], self.tables["intervention_substance"], scope.keys), "trials", "nct_id")
        claims = tuple(
            Claim(f"{r.nct_id}: {r.brief_title}, {r.overall_status}, {r.phase}", r.nct_id, "fetched", Provenance("aact", record_key=r.nct_id), 1.0, "intervention name resolved to the substance")
            for r in rows
        )
        return LookupResult(claims, Coverage(len(claims), (), more))

    def report_counts(self, key: int, start: date, end: date) -> LookupResult:
        scope = self.scope(key)
        if scope is None:
            return self._missing(("faers",), key)
        if not self.ready("quarter_totals", "moiety_quarter"):
            return LookupResult((), Coverage(0, ("faers",)))
        mine = self.tables["moiety_quarter"].filter((F.col("moiety") == scope.moiety) & F.col("quarter").between(F.trunc(F.lit(start), "quarter"), F.lit(end)))
        rows = mine.withColumn("label", dates.quarter_label(F.col("quarter"))).orderBy("quarter").collect()
        gaps = quarter_gaps(self.tables["quarter_totals"], start, end).select(dates.quarter_label(F.col("quarter")).alias("q")).collect()
        claims = tuple(
            Claim(f"{r.label}: {r.reports_any} adverse event reports, {r.reports_suspect} as suspect", str(r.reports_any), "computed", Provenance("faers", record_key=f"{scope.moiety}:{r.label}"), 1.0, "count of distinct reports")
            for r in rows
        )
        return LookupResult(claims, Coverage(len(claims), (), tuple(f"no data for {g.q}" for g in gaps)))

    def literature(self, key: int, topic: str | None = None, limit: int = 20) -> LookupResult:
        scope = self.scope(key)
        if scope is None:
            return self._missing(("article_mesh",), key)
        if not self.ready("articles", "mesh"):
            return LookupResult((), Coverage(0, ("article_mesh",)))
        if not scope.names or limit <= 0:
            return LookupResult()
        rows = indexed_literature(self.tables["mesh"], self.tables["articles"], scope.names, topic, limit).collect()
        claims = tuple(
            Claim(f"PMID {r.pmid} ({r.year or 'year unknown'}): {', '.join(r.descriptors)}" + (f"; topic {topic.strip()}" if topic else ""), r.pmid, "fetched",
                  Provenance("pubmed", None, r.source_file, f"pmid:{r.pmid}"), 1.0, "exact descriptor name match")
            for r in rows
        )
        return LookupResult(claims, Coverage(len(claims), (), (f"limited to the {limit} newest records",) if len(claims) == limit else ()))

    def lookup_code(self, system: str, code: str) -> LookupResult:
        if not self.ready("codes"):
            return LookupResult((), Coverage(0, (system,)))
        rows = code_rows(self.tables["codes"], system, code).collect()
        claims = tuple(Claim(f"{system} {code}: {r.label}", r.label, "fetched", Provenance(system, r.release_id, record_key=code), 1.0, "exact code in the current release") for r in rows)
        return LookupResult(claims, Coverage(len(claims), () if claims else (system,)))

    def tools(self) -> dict[str, Callable[..., LookupResult]]:
        """Functions by name, for a tool-calling client."""
        return {n: getattr(self, n) for n in ("resolve_entity", "approval_status", "safety_actions", "current_label", "trials", "report_counts", "literature", "lookup_code")}

    def call(self, name: str, arguments: dict) -> LookupResult:
        """Dispatch with ISO dates parsed; reserved arguments are dropped, an unknown name raises KeyError."""
        parse = lambda k, v: date.fromisoformat(v) if k in ("start", "end") and isinstance(v, str) else v
        return self.tools()[name](**{k: parse(k, v) for k, v in arguments.items() if k not in ("tenant", "caller")})
