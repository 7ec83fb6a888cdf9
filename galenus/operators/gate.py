"""Gate rules over a dict of measures. A missing measure fails its rule; an unknown rule raises."""

from __future__ import annotations

import ast
import hashlib
import importlib.util
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame

# Rule -> the measure that it bounds.
MINIMUM = {"min_rows": "rows", "min_rows_per_input": "rows_per_input", "min_text_bytes_per_input_byte": "text_bytes_per_input_byte"}
MAXIMUM = {
    "max_duplicate_ids": "duplicate_ids", "max_duplicate_ids_in_shard": "duplicate_ids_in_shard", "max_empty_text_pct": "empty_text_pct", "max_failed_inputs": "failed_inputs",
    "max_orphan_bodies": "orphan_bodies", "max_peak_rss_mb": "peak_rss_mb", "max_empty_tables": "empty_tables", "max_upstream_empty_tables": "upstream_empty_table_count", "max_orphan_share_pct": "orphan_share_pct_max",
}
KEYED_MAXIMUM = {"max_status_pct": "extract_status_pct", "max_null_pct": "null_pct"}
KEYED_MINIMUM = {"min_xref_coverage_pct": "xref_coverage_pct", "min_counts": "counts"}
TRUE = ("rows_loaded_equals_staging", "studies_equal_distinct_nct_id", "meta_total_equals_rows")
PART_CAPS = (("max_rows_per_source_file", "part_rows"), ("max_est_bytes_per_source_file", "part_bytes"))


def _rules() -> dict[str, Callable[[dict, object], list[str]]]:
    lost = "the measure is missing"

    def bound(key: str, below: bool) -> Callable:
        def rule(m: dict, limit) -> list[str]:
            v = m.get(key)
            wrong = v is not None and (v < limit if below else v > limit)
            return [lost] if v is None else [f"{key} is {v}, the {'minimum' if below else 'limit'} is {limit}"] * wrong

        return rule

    def keyed(key: str, below: bool) -> Callable:
        def rule(m: dict, limits) -> list[str]:
            seen = m.get(key)
            if not isinstance(seen, dict):
                return [lost]
            out = []
            for name, limit in limits.items():
                v = seen.get(name) if below else seen.get(name, 0.0)
                if v is None:
                    out.append(f"{key}[{name}] is missing")
                elif v < limit if below else v > limit:
                    out.append(f"{key}[{name}] is {v}, the {'minimum' if below else 'limit'} is {limit}")
            return out

        return rule

    def must_hold(key: str) -> Callable:
        return lambda m, on: [] if not on or m.get(key) else [lost if m.get(key) is None else "does not hold"]

    def licences(m: dict, allowed) -> list[str]:
        seen = m.get("license_counts")
        if not isinstance(seen, dict):
            return [lost]
        bad = sorted(str(k) for k, n in seen.items() if n and k not in allowed)
        return [f"not allowed: {', '.join(bad)}"] * bool(bad)

    def parts(m: dict, on) -> list[str]:
        out = []
        for key, cap in PART_CAPS if on else ():
            if m.get(key) is None or m.get(cap) is None:
                out.append(lost)
            elif m[key] > m[cap]:
                out.append(f"{key} is {m[key]}, over the cap of {m[cap]}")
        return out

    return (
        {r: bound(k, True) for r, k in MINIMUM.items()} | {r: bound(k, False) for r, k in MAXIMUM.items()} | {r: keyed(k, False) for r, k in KEYED_MAXIMUM.items()}
        | {r: keyed(k, True) for r, k in KEYED_MINIMUM.items()} | {r: must_hold(r) for r in TRUE} | {"allowed_licenses": licences, "parts_within_caps": parts}
    )


RULES = _rules()


def evaluate(measures: dict, rules: dict) -> list[str]:
    """Failed rules as lines; empty is a pass."""
    if unknown := sorted(set(rules) - set(RULES)):
        raise ValueError(f"unknown gate rules: {', '.join(unknown)}")
    return [f"{rule}: {what}" for rule, limit in rules.items() for what in RULES[rule](measures, limit)]


def below_floor(reports: int, live: int, share: float) -> bool:
    """Whether a new generation holds less than a share of the live one."""
    return live > 0 and reports < live * share


def signal_problems(counts: dict[str, int]) -> list[str]:
    return [f"no {what}" for what in ("bridged_rows", "pair_rows") if not counts.get(what)]


def empty_tables(rows: dict[str, int], allowed: set[str]) -> list[str]:
    return sorted(t for t, n in rows.items() if n == 0 and t not in allowed)


def orphan_breaches(counts: dict[str, tuple[int, int]], limit: float = 0.05) -> dict[str, float]:
    """table -> share of orphans (orphans, rows) above the limit."""
    return {t: o / n for t, (o, n) in counts.items() if n and o / n > limit}


def part_gaps(numbers: list[int]) -> list[int]:
    """Part numbers 1..max that are absent."""
    return sorted(set(range(1, max(numbers, default=0) + 1)) - set(numbers))


def withdrawn_share(before: set[str], now: set[str], limit: float) -> float:
    """Share of earlier ids that vanished; raises above the limit."""
    share = len(before - now) / len(before) if before else 0.0
    if share > limit:
        raise ValueError(f"{share:.2%} of the earlier ids vanished, the limit is {limit:.2%}")
    return share


def input_set_problems(parts: list[tuple[str, int, int]]) -> list[str]:
    """Of (quarter 2020q1, part, of): parts that are missing, and quarters that are skipped."""
    by: dict[str, tuple[set[int], set[int]]] = {}
    for q, part, of in parts:
        have, totals = by.setdefault(q, (set(), set()))
        have.add(part)
        totals.add(of)
    out = []
    for q, (have, totals) in sorted(by.items()):
        if len(totals) > 1:
            out.append(f"{q}: different totals {sorted(totals)}")
        out += [f"{q}: part {n} of {max(totals)} is missing" for n in sorted(set(range(1, max(totals) + 1)) - have)]
    at = sorted(int(q[:4]) * 4 + int(q[-1]) - 1 for q in by)
    out += [f"{n // 4}q{n % 4 + 1} is missing" for a, b in zip(at, at[1:], strict=False) for n in range(a + 1, b)]
    return out


def unexpected_missing(known: set[str], have: set[str], absent: set[str] = frozenset()) -> list[str]:
    """Tables of the dictionary that a release lacks, other than those known to be ``absent``: each fails its load."""
    return sorted(known - have - absent)


def unmarked_shards(files: DataFrame, mark: str, value: str) -> DataFrame:
    """(path, problem) of shards (path) that may not be matched by id: not parquet, or without ``mark`` = ``value`` in the
    file's key-value metadata. Only footers are read."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path in b["path"]:
                if not path.endswith(".parquet"):
                    out.append((path, "not parquet"))
                    continue
                store, name = pafs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    held = pq.ParquetFile(f).schema_arrow.metadata or {}
                if held.get(mark.encode()) != value.encode():
                    out.append((path, f"no {mark}={value}"))
            yield pd.DataFrame(out, columns=["path", "problem"])

    return files.select("path").mapInPandas(check, "path string, problem string")


def code_hash(module: str, package: str = "galenus") -> str:
    """Digest of a module's source and of all modules of the package that it imports, directly or not: a change makes an
    earlier pass void."""
    found: dict[str, bytes] = {}
    waiting = [module]
    while waiting:
        name = waiting.pop()
        spec = importlib.util.find_spec(name) if name not in found else None
        if spec is None or not spec.origin:
            continue
        found[name] = Path(spec.origin).read_bytes()
        for node in ast.walk(ast.parse(found[name])):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else []
            if isinstance(node, ast.ImportFrom) and node.module:
                names = [node.module, *(f"{node.module}.{a.name}" for a in node.names if _is_module(f"{node.module}.{a.name}", package))]
            waiting += [n for n in names if n.split(".")[0] == package]
    return hashlib.sha256(b"".join(n.encode() + b"\0" + hashlib.sha256(found[n]).digest() for n in sorted(found))).hexdigest()


def _is_module(name: str, package: str) -> bool:
    if name.split(".")[0] != package:
        return False
    try:
        return importlib.util.find_spec(name) is not None
    except ModuleNotFoundError:
        return False
