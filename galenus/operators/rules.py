"""Rules on structured reports: section order, company-data markers, message checks, facts and skeleton."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.functions.markup import local, safe_xml
from galenus.operators.claims import LookupResult, merge

MARKER = "MAH data required"
NUMBERED = re.compile(r"^\s*(?:section\s+)?((?:appendix\s+)?[0-9a-z]+(?:\.[0-9]+)*)[.):]?\s+(?=\S)", re.I)


@dataclass(frozen=True)
class Section:
    id: str
    number: str
    title: str
    clause: str = ""
    aliases: tuple[str, ...] = ()
    required: bool = True
    mah_data: bool = False
    region: str = "ich"


@dataclass(frozen=True)
class Finding:
    rule_id: str
    clause: str
    message: str


def plain(text: str) -> str:
    return " ".join(re.findall(r"[0-9a-z]+", text.casefold()))


def longest_rising(values: list[int]) -> set[int]:
    """Positions of a longest strictly rising subsequence; of several, each element is the earliest that fits."""
    tops: list[int] = []  # least last value of a rise of each length
    length: list[int] = []
    for v in values:
        k = bisect_left(tops, v)
        tops[k : k + 1] = [v]
        length.append(k + 1)
    keep: set[int] = set()
    want, below, stop = len(tops), None, len(values)
    while want:
        stop = next(i for i in range(stop) if length[i] == want and (below is None or values[i] < below))
        keep.add(stop)
        want, below = want - 1, values[stop]
    return keep


def match_headings(sections: list[Section], headings: list[str]) -> list[tuple[int | None, bool]]:
    """(index of the section, repeated) of each heading. A number decides if it is given; a shared title goes to the next free section."""
    titles: dict[str, list[int]] = {}
    for i, s in enumerate(sections):
        for name in {plain(s.title), *map(plain, s.aliases)}:
            titles.setdefault(name, []).append(i)
    out: list[tuple[int | None, bool]] = []
    used: set[int] = set()
    last = -1
    for h in headings:
        found, number = titles.get(plain(h)), None
        if found is None and (m := NUMBERED.match(h)):
            number, found = plain(m[1]), titles.get(plain(h[m.end() :]))
        if number is not None and found:
            found = [i for i in found if plain(sections[i].number) == number] or [i for i in found if not sections[i].number]
        if not found:
            out.append((None, False))
            continue
        free = [i for i in found if i not in used]
        if not free:
            out.append((found[0], True))
            continue
        last = next((i for i in free if i > last), free[0])
        used.add(last)
        out.append((last, False))
    return out


def check_sections(sections: list[Section], headings: list[str], region: str = "ich") -> list[Finding]:
    """Repeated sections, sections out of order, and required ones that are missing. Unknown headings are ignored."""
    allowed = {"ich", region}
    out, placed = [], []
    for h, (i, again) in zip(headings, match_headings(sections, headings), strict=True):
        if i is None or sections[i].region not in allowed:
            continue
        if again:
            out.append(Finding(sections[i].id, sections[i].clause, f"duplicate section {h!r}"))
        else:
            placed.append(i)
    keep = longest_rising(placed)
    out += [Finding(sections[i].id, sections[i].clause, f"wrong order: section {sections[i].number or sections[i].title}") for at, i in enumerate(placed) if at not in keep]
    out += [Finding(s.id, s.clause, f"missing required section {s.number or s.title}") for i, s in enumerate(sections) if s.required and s.region in allowed and i not in placed]
    return out


def check_markers(sections: list[Section], bodies: dict[str, str], supplied: frozenset[str] = frozenset(), strict: bool = False) -> list[Finding]:
    """Sections on company data must say so, with ``strict`` nothing else, unless the data is supplied."""
    out = []
    for (i, _), body in zip(match_headings(sections, list(bodies)), bodies.values(), strict=True):
        if i is None or not sections[i].mah_data or sections[i].id in supplied:
            continue
        text = (body or "").strip()
        if MARKER not in text:
            out.append(Finding(sections[i].id, sections[i].clause, f"must say {MARKER!r}"))
        elif strict and text != MARKER:
            out.append(Finding(sections[i].id, sections[i].clause, f"{MARKER!r} plus other content"))
    return out


def heading_findings(drafts: DataFrame, sections: list[Section], region: str = "ich") -> DataFrame:
    """(draft_id, rule_id, clause, message) of drafts (draft_id, headings array)."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(d, f.rule_id, f.clause, f.message) for d, hs in zip(b["draft_id"], b["headings"], strict=True) for f in check_sections(sections, list(hs), region)]
            yield pd.DataFrame(rows, columns=["draft_id", "rule_id", "clause", "message"])

    kind = dict(drafts.dtypes)["draft_id"]
    return drafts.select("draft_id", "headings").mapInPandas(check, f"draft_id {kind}, rule_id string, clause string, message string")


@dataclass(frozen=True)
class FieldRule:
    """A field of a report message: path of local names, whether it must be there, pattern, longest value, allowed values, date limit."""

    id: str
    path: tuple[str, ...]
    mandatory: bool = False
    pattern: str | None = None
    longest: int | None = None
    allowed: frozenset[str] | None = None
    not_after_today: bool = False
    region: str = "ich"


def _at(node, path: tuple[str, ...]) -> list:
    for name in path:
        node = [c for n in (node if isinstance(node, list) else [node]) for c in n if local(c.tag) == name]
    return node if isinstance(node, list) else [node]


def check_message(data: bytes | str, rules: list[FieldRule], today: date, region: str = "ich") -> list[Finding]:
    """Findings on one report message by a table of field rules; text that is no XML is one finding."""
    try:
        root = safe_xml(data)
    except Exception as e:
        return [Finding("xml", "", f"not readable: {type(e).__name__}")]
    out = []
    for r in rules:
        if r.region not in ("ich", region):
            continue
        values = [v for n in _at(root, r.path) if (v := (n.get("value") or n.get("code") or n.get("extension") or n.text or "").strip())]
        tests: list[tuple[bool, Callable[[str], bool], str]] = [
            (r.pattern is not None, lambda v, r=r: re.fullmatch(r.pattern, v) is not None, "has a wrong form"),
            (r.longest is not None, lambda v, r=r: len(v) <= r.longest, "is too long"),
            (r.allowed is not None, lambda v, r=r: v in r.allowed, "is not in its list"),
            (r.not_after_today, lambda v: not v[:8].isdigit() or v[:8] <= today.strftime("%Y%m%d"), "lies in the future"),
        ]
        if r.mandatory and not values:
            out.append(Finding(r.id, r.region, "is missing"))
        out += [Finding(r.id, r.region, f"{what}: {v}") for v in values for on, ok, what in tests if on and not ok(v)]
    return out


def message_findings(files: DataFrame, rules: list[FieldRule], today: date, region: str = "ich") -> DataFrame:
    """(path, rule_id, clause, message) of binary files (path, content), one message each."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(p, f.rule_id, f.clause, f.message) for p, c in zip(b["path"], b["content"], strict=True) for f in check_message(c, rules, today, region)]
            yield pd.DataFrame(rows, columns=["path", "rule_id", "clause", "message"])

    return files.select("path", "content").mapInPandas(check, "path string, rule_id string, clause string, message string")


def assemble_facts(call: Callable[[str, dict], LookupResult], key: int, start: date, end: date, plan: dict[str, tuple[str, ...]]) -> dict[str, LookupResult]:
    """Section id -> merged results of its lookups. ``plan`` names the lookups; those over an interval get it."""
    ranged = {"safety_actions", "report_counts"}
    run = lambda name: call(name, {"key": key, **({"start": start, "end": end} if name in ranged else {})})
    done = {name: run(name) for name in dict.fromkeys(n for names in plan.values() for n in names)}
    return {s: merge([done[n] for n in names]) for s, names in plan.items()}


def skeleton(sections: list[Section], facts: dict[str, LookupResult], region: str = "ich") -> dict[str, str]:
    """Heading -> body in rule order: the facts, what they lack, or the company-data marker."""
    out = {}
    for s in sections:
        if s.region not in ("ich", region):
            continue
        r = facts.get(s.id)
        lines = [c.text for c in r.claims] + [f"not available: {m}" for m in r.coverage.missing] + list(r.coverage.notes) if r else []
        out[f"{s.number} {s.title}".strip()] = MARKER if s.mah_data else "\n".join(lines)
    return out


def cases(records: DataFrame, xref: DataFrame, substances: DataFrame, limit: int) -> DataFrame:
    """Newest records (record_key, event_date, substance_names) whose names all resolve to one moiety, with the interval before the event."""
    from galenus.functions.dates import interval_before

    names = records.filter("event_date is not null").select("record_key", "event_date", F.explode("substance_names").alias("name"))
    moiety = xref.filter("id_type = 'name'").join(substances, "substance_key").select(F.col("id_value").alias("name"), F.coalesce("moiety_key", "substance_key").alias("moiety")).distinct()
    per = names.join(moiety, "name", "left").groupBy("record_key", "event_date").agg(F.count_distinct("moiety").alias("n"), F.min("moiety").alias("moiety"), F.bool_and(F.col("moiety").isNotNull()).alias("known"))
    one = per.filter("known and n = 1").orderBy(F.desc("event_date"), "record_key").limit(limit)
    return one.select("record_key", "event_date", "moiety", interval_before(F.col("event_date")).alias("interval"))
