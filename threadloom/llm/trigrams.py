"""Boolean trigram queries of regular expressions.

A query is in disjunctive form: a frozenset of branches, each a frozenset of trigrams that all occur in
every match (lower case). The one branch without trigrams means that nothing is known: scan fully.
"""

from __future__ import annotations

from re import _constants as sre, _parser

Query = frozenset
ANY: Query = frozenset([frozenset()])
#: Literal alternatives that are followed at once; beyond, what is known so far is closed.
MAX_STRINGS = 32
MAX_BRANCHES = 32


def absorbed(query) -> Query:
    """Without branches that another one implies: A or (A and B) is A."""
    return frozenset(b for b in query if not any(other < b for other in query))


def both(x: Query, y: Query) -> Query:
    merged = absorbed({a | b for a in x for b in y})
    return merged if len(merged) <= MAX_BRANCHES else min(x, y, key=len)


def either(queries) -> Query:
    merged = absorbed(frozenset().union(*queries))
    return merged if len(merged) <= MAX_BRANCHES else ANY


def of_strings(strings) -> Query:
    return either([frozenset([frozenset(s[i:i + 3] for i in range(len(s) - 2))]) for s in strings])


def _class_chars(items) -> set[str] | None:
    """The characters of a small class, lower case; None where it is negated or large."""
    chars: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            chars.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < 4:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= 4 else None


def _walk(tokens, strings: set[str], query: Query) -> tuple[set[str], Query, bool]:
    """Follows a concatenation: ``strings`` are the literal endings so far, ``query`` what is certain.

    The last value tells whether the endings are all that the tokens match; else something stands before them.
    """
    complete = True
    for kind, value in tokens:
        options: set[str] | None = None
        certain, whole = ANY, True
        if kind is sre.LITERAL:
            options = {chr(value).lower()}
        elif kind is sre.IN:
            options = _class_chars(value)
        elif kind is sre.SUBPATTERN:
            options, certain, whole = _walk(value[3], {""}, ANY)
        elif kind is sre.BRANCH:
            parts = [_walk(branch, {""}, ANY) for branch in value[1]]
            options, whole = set().union(*(p[0] for p in parts)), all(p[2] for p in parts)
            certain = either([both(p[1], of_strings(p[0])) for p in parts]) if any(p[1] != ANY for p in parts) else ANY
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            inner, certain, whole = _walk(body, {""}, ANY)
            if (low, high) == (0, 1):
                options, certain = inner | {""}, ANY
            elif low == high and low <= 4 and (whole or not low):
                options, certain, whole = {""}, certain if low else ANY, True
                for _ in range(low):
                    options = {a + b for a in options for b in inner}
            elif low >= 1:
                certain = both(certain, of_strings(inner))
                options = inner if low == high else None
                whole = False
            else:
                certain = ANY
        elif kind is sre.AT:
            continue
        query = both(query, certain)
        if options is not None and whole and len(strings) * len(options) <= MAX_STRINGS:
            strings = {a + b for a in strings for b in options}
        else:
            query = both(query, of_strings(strings))
            strings = options if options is not None and len(options) <= MAX_STRINGS else {""}
            complete = False
    return strings, query, complete


def trigram_query(pattern: str) -> Query:
    """What every match of ``pattern`` must contain, in lower case."""
    strings, query, _ = _walk(_parser.parse(pattern), {""}, ANY)
    return both(query, of_strings(strings))
