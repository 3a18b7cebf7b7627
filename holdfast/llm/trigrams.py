"""Boolean trigram queries that every text with a match of a regular expression meets.

A part of an expression is known by the strings it can match, as long as these are few (exact), else
by what a match begins and ends with, and by a query over trigrams that every match meets. Joining
parts multiplies exact strings, and gives trigrams where the end of one meets the begin of the next.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as c  # the tree of the standard library's own parser
from re import _parser as parser

#: Strings that a part is known by, at most; and characters of a class.
FEW = 24
CLASS = 6
#: Times a part is repeated when its strings are multiplied.
TIMES = 4


@dataclass(frozen=True)
class Query:
    """A trigram (kind ``gram``), or all or any of several queries. All of none: no condition."""

    kind: str
    gram: str = ""
    parts: frozenset[Query] = frozenset()

    def holds(self, has: Callable[[str], bool]) -> bool:
        if self.kind == "gram":
            return has(self.gram)
        return (all if self.kind == "all" else any)(p.holds(has) for p in self.parts)

    def grams(self) -> set[str]:
        return {self.gram} if self.kind == "gram" else set().union(*(p.grams() for p in self.parts))


ANYTHING = Query("all")


def all_of(queries: Iterable[Query]) -> Query:
    parts: set[Query] = set()
    for q in queries:
        parts |= q.parts if q.kind == "all" else {q}
    return parts.pop() if len(parts) == 1 else Query("all", parts=frozenset(parts))


def any_of(queries: Iterable[Query]) -> Query:
    parts: set[Query] = set()
    for q in queries:
        if q == ANYTHING:
            return ANYTHING
        parts |= q.parts if q.kind == "any" else {q}
    return parts.pop() if len(parts) == 1 else Query("any", parts=frozenset(parts))


def trigrams(text: str) -> list[str]:
    return [text[i : i + 3] for i in range(len(text) - 2)]


def has_one(strings: Iterable[str]) -> Query:
    """Any of the strings, by its trigrams; no condition if one is too short to have any."""
    return any_of(all_of(Query("gram", t) for t in trigrams(s)) for s in strings)


@dataclass(frozen=True)
class Part:
    """exact: all strings it matches, None if not known. begins, ends: what every match begins and
    ends with, one of them. query: what every match meets beside that."""

    exact: frozenset[str] | None
    begins: frozenset[str]
    ends: frozenset[str]
    query: Query = ANYTHING


NOTHING = frozenset([""])
UNKNOWN = Part(None, NOTHING, NOTHING)


def exactly(strings: Iterable[str]) -> Part:
    strings = frozenset(strings)
    return Part(strings, strings, strings)


def _short(part: Part) -> Part:
    """The part with sets of bounded size; what is cut off stays in the query."""
    query = part.query
    exact = part.exact
    if exact is not None:
        if len(exact) <= FEW:
            return Part(exact, exact, exact, query)
        query = all_of([query, has_one(exact)])
    begins, ends = part.begins, part.ends
    if exact is None:
        query = all_of([query, has_one(begins), has_one(ends)])
    begins, ends = frozenset(s[:2] for s in begins), frozenset(s[-2:] for s in ends)
    return Part(None, begins if len(begins) <= FEW else NOTHING, ends if len(ends) <= FEW else NOTHING, query)


def _joined(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= FEW:
        return exactly_with(product(a.exact, b.exact), all_of([a.query, b.query]))
    crossing = [ANYTHING]
    if len(a.ends) * len(b.begins) <= FEW * FEW:
        crossing = [has_one(x + y for x, y in product(a.ends, b.begins))]
    own = [has_one(p.exact) for p in (a, b) if p.exact is not None]
    begins = frozenset(map("".join, product(a.exact, b.begins))) if a.exact is not None else a.begins
    ends = frozenset(map("".join, product(a.ends, b.exact))) if b.exact is not None else b.ends
    return _short(Part(None, begins, ends, all_of([a.query, b.query, *crossing, *own])))


def exactly_with(pairs: Iterable[tuple[str, str]], query: Query) -> Part:
    strings = frozenset(map("".join, pairs))
    return Part(strings, strings, strings, query)


def _either(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None:
        return _short(Part(a.exact | b.exact, a.exact | b.exact, a.exact | b.exact, any_of([a.query, b.query])))
    whole = [p.query if p.exact is None else all_of([p.query, has_one(p.exact)]) for p in (a, b)]
    return _short(Part(None, a.begins | b.begins, a.ends | b.ends, any_of(whole)))


def _repeated(part: Part, least: int, most: int | None) -> Part:
    if least == 0:
        once = _either(exactly([""]), part)
        return once if most == 1 else UNKNOWN
    found = part
    for _ in range(min(least, TIMES) - 1):
        found = _joined(found, part)
    if most == least and least <= TIMES:
        return found
    query = found.query if found.exact is None else all_of([found.query, has_one(found.exact)])
    return _short(Part(None, found.begins, found.ends, query))


def _class(items: list, fold: Callable[[str], str]) -> Part:
    chars: set[str] = set()
    for kind, value in items:
        if kind is c.LITERAL:
            chars.add(fold(chr(value)))
        elif kind is c.RANGE and value[1] - value[0] < 2 * CLASS:
            chars |= {fold(chr(x)) for x in range(value[0], value[1] + 1)}
        else:  # a category, a large range, or all but these
            return UNKNOWN
    return exactly(chars) if len(chars) <= CLASS else UNKNOWN


def _sequence(tree, fold: Callable[[str], str]) -> Part:
    found = exactly([""])
    for kind, value in tree:
        found = _joined(found, _part(kind, value, fold))
    return found


def _part(kind, value, fold: Callable[[str], str]) -> Part:
    if kind is c.LITERAL:
        return exactly([fold(chr(value))])
    if kind is c.IN:
        return _class(value, fold)
    if kind is c.BRANCH:
        branches = [_sequence(b, fold) for b in value[1]]
        found = branches[0]
        for branch in branches[1:]:
            found = _either(found, branch)
        return found
    if kind is c.SUBPATTERN:
        return _sequence(value[3], fold)
    if kind is c.ATOMIC_GROUP:
        return _sequence(value, fold)
    if kind in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
        least, most, body = value
        return _repeated(_sequence(body, fold), least, None if most is c.MAXREPEAT else most)
    if kind in (c.AT, c.ASSERT, c.ASSERT_NOT):
        return exactly([""])
    return UNKNOWN  # any character, all but one, references


def ignores_case(pattern: str) -> bool:
    """Whether any part of the expression ignores case."""
    tree = parser.parse(pattern)
    return bool(tree.state.flags & re.IGNORECASE) or "(?i" in pattern


def derive(pattern: str) -> Query:
    """The query of an expression. Where any part ignores case, it is for the text in lower case of
    A-Z, else for the text as it is. Only syntax that Java and Python share is understood alike."""
    fold = str.lower if ignores_case(pattern) else str
    found = _sequence(parser.parse(pattern), lambda x: fold(x) if x.isascii() else x)
    if found.exact is not None:
        return all_of([found.query, has_one(found.exact)])
    return all_of([found.query, has_one(found.begins), has_one(found.ends)])
