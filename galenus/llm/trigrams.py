"""Boolean trigram queries of regular expressions, derived on the driver from the parsed pattern."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from re import _constants as sre
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A set of alternative literal strings beyond this size is cut into its trigrams.
MAX_EXACT = 64


@dataclass(frozen=True)
class Query:
    """op is "all" (no condition), "tri" (one trigram), "and" or "or"."""

    op: str
    parts: tuple = ()

    def trigrams(self) -> set[str]:
        if self.op == "tri":
            return {self.parts[0]}
        return set().union(*(p.trigrams() for p in self.parts)) if self.op in ("and", "or") else set()


ALL = Query("all")


def both(*queries: Query) -> Query:
    parts = tuple(dict.fromkeys(q for q in queries if q != ALL))
    return ALL if not parts else parts[0] if len(parts) == 1 else Query("and", parts)


def either(*queries: Query) -> Query:
    parts = tuple(dict.fromkeys(queries))
    return ALL if ALL in parts or not parts else parts[0] if len(parts) == 1 else Query("or", parts)


def _of_strings(strings: frozenset[str]) -> Query:
    """Any of the strings occurs; one of under three letters makes that unconditional."""
    return either(*(both(*(Query("tri", (s[i : i + 3],)) for i in range(len(s) - 2))) if len(s) > 2 else ALL for s in sorted(strings)))


def _walk(nodes) -> tuple[frozenset[str] | None, Query]:
    """The strings that match exactly, if they are few, else None; and what any match must contain."""
    run: frozenset[str] = frozenset({""})
    exact, need = True, ALL

    def flush() -> None:
        nonlocal run, need
        need, run = both(need, _of_strings(run)), frozenset({""})

    for op, arg in nodes:
        strings, query = None, ALL
        if op is sre.LITERAL:
            strings = frozenset({chr(arg).lower()})
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            strings = frozenset(chr(a).lower() for _, a in arg)
        elif op is sre.SUBPATTERN:
            strings, query = _walk(arg[-1])
        elif op is sre.BRANCH:
            found = [_walk(b) for b in arg[1]]
            if all(s is not None for s, _ in found):
                strings = frozenset().union(*(s for s, _ in found))
            else:
                query = either(*(q if s is None else _of_strings(s) for s, q in found))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            least, most, inner = arg
            s, q = _walk(inner)
            if s is not None and (least, most) in ((0, 1), (1, 1)):
                strings = s | {""} if least == 0 else s
            elif s is not None and least and len(s) ** least <= MAX_EXACT:
                head = reduce(lambda a, _: frozenset(x + y for x in a for y in s), range(least), frozenset({""}))
                strings, query = (head, ALL) if least == most else (None, _of_strings(head))
            elif least:
                query = q if s is None else _of_strings(s)
        elif op is sre.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MAX_EXACT:
            run = frozenset(a + b for a in run for b in strings)
        else:
            exact = False
            flush()
            if strings is not None:
                run = strings
            need = both(need, query)
    if exact:
        return run, ALL
    flush()
    return None, need


def trigram_query(pattern: str) -> Query:
    """What the lower-cased text of any match of ``pattern`` contains; ALL if no trigram is mandatory."""
    strings, query = _walk(_parser.parse(pattern))
    return query if strings is None else _of_strings(strings)


def matching(query: Query, postings: Column) -> Column:
    """Row ids that satisfy ``query``, by union and intersection of the posting lists in the map ``postings``."""
    if query.op == "tri":
        return F.coalesce(F.element_at(postings, F.lit(query.parts[0])), F.array().cast("array<bigint>"))
    first, *rest = (matching(p, postings) for p in query.parts)
    return F.aggregate(F.array(*rest), first, F.array_intersect if query.op == "and" else F.array_union)
