"""Boolean trigram queries of regular expressions.

``trigram_query`` gives a condition on the trigrams of a text (in lower case) that every text with a match
fulfils: a trigram, ("and", ...), ("or", ...), or ANY where the expression demands none.
"""

from __future__ import annotations

import re._parser as syntax
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ANY = ("any",)
Query = tuple | str
MOST_STRINGS = 32  # longer alternatives are not followed literally


def both(parts: list[Query]) -> Query:
    left = list(dict.fromkeys(p for p in parts if p != ANY))
    return ANY if not left else left[0] if len(left) == 1 else ("and", *left)


def either(parts: list[Query]) -> Query:
    left = list(dict.fromkeys(parts))
    return ANY if not left or ANY in left else left[0] if len(left) == 1 else ("or", *left)


def of_strings(strings: set[str]) -> Query:
    """The text holds one of the strings."""
    return either([both([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def class_members(items: list) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if kind is syntax.LITERAL:
            found.add(chr(value).lower())
        elif kind is syntax.RANGE and value[1] - value[0] < MOST_STRINGS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= MOST_STRINGS // 4 else None


def read(node: tuple) -> tuple[set[str] | None, Query]:
    """All strings the node can match, if few, and the query of the node by itself."""
    kind, value = node
    if kind is syntax.LITERAL:
        return {chr(value).lower()}, ANY
    if kind is syntax.IN:
        return class_members(value), ANY
    if kind is syntax.SUBPATTERN:
        return sequence(value[3])
    if kind is syntax.BRANCH:
        sides = [sequence(side) for side in value[1]]
        exact = [s for s, _ in sides]
        if all(s is not None for s in exact) and sum(map(len, exact)) <= MOST_STRINGS:
            return set().union(*exact), ANY
        return None, either([of_strings(s) if s is not None else q for s, q in sides])
    if kind in (syntax.MAX_REPEAT, syntax.MIN_REPEAT):
        least, most, inner = value
        strings, query = sequence(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, ANY
        if strings is not None and least == most and len(strings) ** least <= MOST_STRINGS:
            return reduce(lambda a, _: {x + y for x in a for y in strings}, range(least), {""}), ANY
        if least == 0:
            return None, ANY
        return None, of_strings(strings) if strings is not None else query
    return None, ANY


def sequence(nodes) -> tuple[set[str] | None, Query]:
    run, exact, parts = {""}, True, []
    for node in nodes:
        strings, query = read(node)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        parts += [of_strings(run), query]
        exact = False
        run = strings if strings is not None else {""}
    if exact:
        return run, ANY
    return None, both([*parts, of_strings(run)])


def trigram_query(pattern: str) -> Query:
    strings, query = sequence(syntax.parse(pattern))
    return of_strings(strings) if strings is not None else query


def trigrams_of(query: Query) -> set[str]:
    if query == ANY:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1:]))


def holds(query: Query, found: Column) -> Column:
    """The query as a condition on an array column of a text's trigrams."""
    if query == ANY:
        return F.lit(True)
    if isinstance(query, str):
        return F.array_contains(found, query)
    join = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return reduce(join, [holds(part, found) for part in query[1:]])
