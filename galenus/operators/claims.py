"""Answers of a lookup: claims with provenance, and what the lookup covered."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

METHODS = ("fetched", "mapped", "computed")


@dataclass(frozen=True)
class Provenance:
    source: str
    release: str | None = None
    source_file: str | None = None
    record_key: str | None = None
    jurisdiction: str | None = None


@dataclass(frozen=True)
class Claim:
    """``alternatives`` are for mapped claims only; confidence is within 0 and 1."""

    text: str
    value: str | None
    method: str
    provenance: Provenance
    confidence: float = 1.0
    confidence_basis: str = ""
    alternatives: tuple[Claim, ...] = ()

    def __post_init__(self) -> None:
        problems = {
            f"method must be one of {METHODS}": self.method not in METHODS,
            "confidence must be within [0, 1]": not 0 <= self.confidence <= 1,
            "only mapped claims have alternatives": bool(self.alternatives) and self.method != "mapped",
        }
        for message, wrong in problems.items():
            if wrong:
                raise ValueError(f"{message}: {self.method}, {self.confidence}")


@dataclass(frozen=True)
class Coverage:
    matched: int = 0
    missing: tuple[str, ...] = ()
    notes: tuple[str, ...] = ()


@dataclass(frozen=True)
class LookupResult:
    claims: tuple[Claim, ...] = ()
    coverage: Coverage = field(default_factory=Coverage)

    def to_json(self) -> dict:
        return asdict(self)

    @classmethod
    def from_json(cls, d: dict) -> LookupResult:
        def claim(c: dict) -> Claim:
            return Claim(**{**c, "provenance": Provenance(**c["provenance"]), "alternatives": tuple(map(claim, c.get("alternatives", ())))})

        cover = {k: tuple(v) if isinstance(v, list | tuple) else v for k, v in d["coverage"].items()}
        return cls(tuple(map(claim, d["claims"])), Coverage(**cover))


def merge(results: list[LookupResult]) -> LookupResult:
    """All claims, and the union of what was missing or noted."""
    flat = lambda f: tuple(dict.fromkeys(x for r in results for x in f(r.coverage)))
    claims = tuple(c for r in results for c in r.claims)
    return LookupResult(claims, Coverage(sum(r.coverage.matched for r in results), flat(lambda c: c.missing), flat(lambda c: c.notes)))
