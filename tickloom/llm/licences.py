"""License scans: tags and notices by an Aho-Corasick automaton, expressions by a shunting yard.

A text becomes its words, lower-cased (A-Z) and joined by single spaces; one automaton walks over them
and reports every phrase wherever its words stand consecutively. Where it reports an identifier tag, the
licence expression after each tag is read with an operator stack (WITH before AND before OR) and
evaluated: OR takes the freer side, AND the stricter one, an exception frees a little. The score of a
text is the strictest of all it says: 1 may be used freely, 0 says nothing or reserves all rights.

Defined results: null and empty texts have no words, no labels and score 0; texts are scanned whole;
overlapping phrases count each, but of added phrases that begin at one place only the longest counts; an expression is read as far as it is well formed; repeated rows are
scanned each; an existing column of the result's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache
from itertools import product

import ahocorasick
from pyspark.sql import DataFrame

from tickloom.llm.common import per_batch, python_settings

# Phrases of lower-cased words and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
ADDED = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd",
    "isc license": "isc", "boost software license": "bsl", "cc0": "cc0", "creative commons zero": "cc0",
    "creativecommons org publicdomain zero": "cc0", "public domain": "public-domain",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit", "all rights reserved": "reserved",
    "gnu free documentation license": "gfdl", "open database license": "odbl", "zlib license": "zlib",
    "artistic license": "artistic", "unlicense": "unlicense", "wtfpl": "wtfpl",
    "european union public license": "eupl",
    # Short names, as SPDX and package lists write them.
    "apache 2 0": "apache", "apache2": "apache", "bsd 2 clause": "bsd", "bsd 3 clause": "bsd", "bsd 4 clause": "bsd",
    "gpl": "gpl", "gplv2": "gpl", "gplv3": "gpl", "lgpl": "lgpl", "lgplv2": "lgpl", "lgplv3": "lgpl",
    "agpl": "agpl", "agplv3": "agpl", "mpl 1 1": "mpl", "mpl 2 0": "mpl", "epl 1 0": "epl", "epl 2 0": "epl",
    "bsl 1 0": "bsl", "gfdl": "gfdl", "odbl": "odbl", "eupl": "eupl", "opensource org licenses mit": "mit",
}
# The terms of Creative Commons, by short name, and how notices write them.
TERMS = {
    "nc": ("nc", "noncommercial", "non commercial"), "sa": ("sa", "sharealike", "share alike"),
    "nd": ("nd", "noderivatives", "noderivs", "no derivatives", "no derivs"),
}
BEGINNINGS = ("cc by", "creative commons attribution", "creativecommons org licenses by")


def _phrases() -> dict[str, str]:
    """All phrases that are not base ones; the other spelling of "license" too."""
    found = dict(ADDED)
    for terms in ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd")):
        for words in product(BEGINNINGS, *(TERMS[t] for t in terms)):
            found[" ".join(words)] = "-".join(("cc-by", *terms))
    for phrase, label in {**found, **BASE}.items():
        found[re.sub(r"license\b", "licence", phrase)] = label
    return {p: label for p, label in found.items() if p not in BASE}


PHRASES = _phrases()
TAG = "spdx license identifier"
# How freely a text under a licence may be used, by the start of its label.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "bsl": 0.95,
    "apache": 0.9, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.6, "cc-by": 0.85, "mpl": 0.6, "epl": 0.55,
    "lgpl": 0.5, "gpl": 0.4, "agpl": 0.3, "gfdl": 0.4, "odbl": 0.6, "zlib": 0.95, "artistic": 0.7, "wtfpl": 1.0,
    "eupl": 0.5, "reserved": 0.0,
}
UNKNOWN, EXCEPTION = 0.5, 0.1

_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_TAG = re.compile(r"(?ai:spdx-license-identifier)[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"[ \t]*(\(|\)|[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)")
_RANK = {"or": 1, "and": 2, "with": 3}

Value = tuple[float, frozenset[str]]


def freedom(label: str) -> float:
    start = max((s for s in FREEDOM if label.startswith(s)), key=len, default=None)
    return UNKNOWN if start is None else FREEDOM[start]


def _apply(name: str, values: list[Value]) -> None:
    (b, y), (a, x) = values.pop(), values.pop()
    if name == "with":
        values.append((min(1.0, a + EXCEPTION), x))
    else:
        values.append((max(a, b) if name == "or" else min(a, b), x | y))


def _read(expression: str) -> tuple[list[str], int]:
    """The tokens of the longest well-formed start, and where it ends."""
    tokens: list[str] = []
    at = depth = whole = end = 0
    operand = True  # one is expected next
    while m := _TOKEN.match(expression, at):
        name, at = m[1].lower(), m.end()
        if operand != (name == "(" or name not in (*_RANK, ")")):
            break
        depth += (name == "(") - (name == ")")
        if depth < 0:
            break
        operand = name in (*_RANK, "(")
        tokens.append(name)
        if depth == 0 and not operand:
            whole, end = len(tokens), at
    return tokens[:whole], end


def evaluate(expression: str) -> Value | None:
    """(freedom, labels) of a licence expression; of its longest well-formed start; None if there is none."""
    tokens, _ = _read(expression)
    return _evaluate(tokens) if tokens else None


def _evaluate(tokens: list[str]) -> Value:
    """Of a well-formed expression: operands and pending operators on two stacks."""
    values: list[Value] = []
    waiting: list[str] = []
    for name in tokens:
        if name == "(":
            waiting.append(name)
        elif name == ")":
            while waiting[-1] != "(":
                _apply(waiting.pop(), values)
            waiting.pop()
        elif name in _RANK:
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[name]:
                _apply(waiting.pop(), values)
            waiting.append(name)
        else:
            values.append((freedom(name), frozenset([name])))
    while waiting:
        _apply(waiting.pop(), values)
    return values[0]


def expressions(text: str) -> list[Value]:
    return [v for m in _TAG.finditer(text) if (v := evaluate(m[1])) is not None]


@cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *PHRASES, TAG}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def _without_expressions(text: str) -> str:
    """The text without the expressions of its tags: their names are operands there, not notices."""
    return _TAG.sub(lambda m: m[0][:m.start(1) - m.start()] + " " + m[1][_read(m[1])[1]:], text)


def _found(words: list[bytes]) -> tuple[str, list[tuple[int, str]]]:
    """The words as one line, and the phrases in it by their start; a longer one after a shorter."""
    line = f" {b' '.join(words).decode('latin-1')} "  # a byte a letter: phrases are ASCII
    return line, sorted((end - len(phrase) - 1, phrase) for end, phrase in _automaton().iter(line))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD).split()


def scan_text(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one text."""
    words = _words(text or "")
    line, found = _found(words)
    places: list[int] = []
    before = at = 0
    for start, phrase in found:
        before += line.count(" ", at, start)
        at = start
        if phrase in BASE:
            places.append(before)
    base = {BASE[p] for _, p in found if p in BASE}
    values: list[Value] = []
    if any(p == TAG for _, p in found):
        values = expressions(text)
        _, found = _found(_words(_without_expressions(text)))
    longest = dict(found)
    added = {PHRASES[p] for start, p in found if p in PHRASES and longest[start] == p}
    freedoms = [*map(freedom, base | added), *(value for value, _ in values)]
    labels = base | added | {name for _, names in values for name in names}
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), min(freedoms, default=0.0))


def _scanner() -> Callable[[list], list[tuple]]:
    return lambda texts: [scan_text(t) for t in texts]


_scan = per_batch(_scanner, {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long",
                             "base_labels": "string", "labels": "string", "score": "double"})


def scan(docs: DataFrame, text: str = "text", into: str = "licence") -> DataFrame:
    """``docs`` with a struct of what ``scan_text`` says."""
    python_settings(docs.sparkSession)
    return docs.withColumn(into, _scan(text))
