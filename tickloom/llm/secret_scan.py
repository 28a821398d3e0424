"""Secret scans: a trigram index narrows each rule to candidate texts, which its pattern verifies.

From a rule's pattern follows a Boolean query of trigrams that every match must hold. Each Arrow
batch is a segment of the index: it gets postings (trigram -> rows) for the trigrams of all queries,
a query unites and intersects postings, and only the rows left are searched with the pattern. A rule
without a mandatory trigram (bare hexadecimal) searches every row. The index is over lower-cased
bytes, so it admits more rows than needed and never fewer: the result is that of a full search.

A private key's span runs from its BEGIN line over the body to its END line, or over the base64 lines
where the END is missing.

Defined results: null and empty texts have no span; texts are searched whole; spans of different
kinds may overlap, those of one kind don't; repeated rows are scanned each; an empty table stays
empty; an existing column of the result's name is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import per_batch, python_settings

try:
    from re import _constants as op
    from re import _parser as parser
except ImportError:  # before Python 3.11
    import sre_constants as op
    import sre_parse as parser

# A private key in PEM or PGP armour: BEGIN, then all up to the END of the same label (no other BEGIN or
# END between). Where that END is missing: the header lines and base64 runs that follow, over line breaks
# (also escaped ones), indents and quotes; a short run counts where it fills the rest of its line, since
# a key's last line is short.
_BASE64 = r"(?:[A-Za-z0-9+/=]|\\/)"
_INDENT = r"""[\x20\t>"'`#*|]*+"""
_BREAK = r"""(?:\r?\n|\r|(?:\\r)?\\n(?:["']\x20*+\r?\n)?)"""
_GAP = r"""(?:[\s>"'`#*|]|\\[rn])*+"""
_ARMOUR = (
    r"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?)-----(?:"
    r"[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1-----"
    rf"|(?:{_INDENT}{_BREAK}{_INDENT}(?:Proc-Type|DEK-Info|Version|Comment|Charset|Hash|MessageID):(?:(?!\\[rn])[^\r\n])*+)*+"
    rf"(?:{_GAP}{_BASE64}{{16,}}+|{_INDENT}{_BREAK}{_INDENT}{_BASE64}++(?=[\x20\t\"'`,;]*+(?:[\r\n]|\\[rn]|\Z)))*+)"
)

# Fixed values. kind -> (pattern, least length, group whose length counts); kinds in the order of ties.
RULES: dict[str, tuple[str, int, int]] = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    "access": (r"AKIA[A-Z0-9]+", 16, 0),
    "hex": (r"[0-9a-f]{32,}", 0, 0),  # the runs of 32 and more are the same, found faster
    "pem": (_ARMOUR, 0, 0),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "google": (r"AIza[A-Za-z0-9_-]{35,}", 0, 0),
    "stripe": (r"[rs]k_live_[A-Za-z0-9]{16,}", 0, 0),
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
}
BASE = ("assign", "access", "hex")

#: Most strings that are spelled out for one stretch of a pattern, and letters of one class.
MOST_STRINGS, MOST_LETTERS = 64, 8

# -- trigram queries: None is "every text", else ("tri", bytes), ("and", [...]) or ("or", [...]) -----


def _all_of(parts: list) -> tuple | None:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _any_of(parts: list) -> tuple | None:
    if not parts or any(p is None for p in parts):
        return None
    return parts[0] if len(parts) == 1 else ("or", parts)


def _of_strings(strings: set[str]) -> tuple | None:
    """What a text must hold that has one of these strings."""
    grams = ([s.encode()[i:i + 3] for i in range(len(s.encode()) - 2)] for s in sorted(strings))
    return _any_of([_all_of([("tri", g) for g in dict.fromkeys(gs)]) for gs in grams])


def _node(kind, arg) -> tuple[set[str] | None, tuple | None]:
    """(every string that this node matches, or None if too many; the trigram query)."""
    if kind is op.LITERAL:
        return {chr(arg).lower()}, None
    if kind is op.IN:
        letters: set[str] = set()
        for k, a in arg:
            if k is op.LITERAL:
                letters.add(chr(a).lower())
            elif k is op.RANGE and a[1] - a[0] < MOST_LETTERS:
                letters |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None, None
        return (letters, None) if len(letters) <= MOST_LETTERS else (None, None)
    if kind is op.SUBPATTERN:
        return _sequence(arg[-1])
    if kind is op.BRANCH:
        subs = [_sequence(b) for b in arg[1]]
        if all(s is not None for s, _ in subs):
            strings = set().union(*(s for s, _ in subs))
            if len(strings) <= MOST_STRINGS:
                return strings, None
        return None, _any_of([_of_strings(s) if s is not None else q for s, q in subs])
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, body = arg
        strings, query = _sequence(body)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, None
        return None, None if least == 0 else _of_strings(strings) if strings is not None else query
    return None, None


def _sequence(nodes) -> tuple[set[str] | None, tuple | None]:
    run, parts, exact = {""}, [], True
    for kind, arg in nodes:
        strings, query = _node(kind, arg)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        parts += [_of_strings(run), query]
        exact, run = False, {""} if strings is None else strings
    return (run, None) if exact else (None, _all_of([*parts, _of_strings(run)]))


def trigram_query(pattern: str) -> tuple | None:
    """The trigrams that a match of ``pattern`` must hold (lower-cased bytes); None if there are none."""
    strings, query = _sequence(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


def _grams(query) -> set[bytes]:
    if query is None:
        return set()
    return {query[1]} if query[0] == "tri" else set().union(*map(_grams, query[1]))


# -- one segment of the index ------------------------------------------------------------------------


@cache
def _compiled() -> tuple[dict, dict, np.ndarray]:
    patterns = {k: re.compile(p) for k, (p, _, _) in RULES.items()}
    queries = {k: trigram_query(p) for k, (p, _, _) in RULES.items()}
    known = np.zeros(1 << 24, np.uint16)
    for i, g in enumerate(sorted(set().union(*map(_grams, queries.values()))), 1):
        known[int.from_bytes(g, "big")] = i
    return patterns, queries, known


def _postings(texts: list[str], known: np.ndarray) -> Callable[[bytes], np.ndarray]:
    """From a trigram to the sorted rows that hold it."""
    data = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    starts = np.cumsum([0, *(len(d) + 1 for d in data)])
    flat = np.frombuffer(b"\0".join(data) + b"\0\0", np.uint8).astype(np.uint32)
    ids = known[(flat[:-2] << 16) | (flat[1:-1] << 8) | flat[2:]]
    at = np.flatnonzero(ids)
    rows = np.searchsorted(starts, at, "right") - 1
    pairs = np.unique(ids[at].astype(np.int64) * len(texts) + rows)
    gram, row = pairs // len(texts), pairs % len(texts)

    def rows_of(g: bytes) -> np.ndarray:
        i = int(known[int.from_bytes(g, "big")])
        return row[np.searchsorted(gram, i):np.searchsorted(gram, i + 1)]

    return rows_of


def _candidates(query, rows_of: Callable[[bytes], np.ndarray], n: int) -> np.ndarray:
    if query is None:
        return np.arange(n)
    if query[0] == "tri":
        return rows_of(query[1])
    sets = [_candidates(q, rows_of, n) for q in query[1]]
    merge = np.intersect1d if query[0] == "and" else np.union1d
    return reduce(lambda a, b: merge(a, b), sets)


def spans_of(texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
    """(kind, start, end) in code points, by start, then kind as listed; for each text of a segment."""
    patterns, queries, known = _compiled()
    found: list[list] = [[] for _ in texts]
    kept = [i for i, t in enumerate(texts) if t]
    if not kept:
        return found
    rows_of = _postings([texts[i] for i in kept], known)
    for order, (kind, (_, least, group)) in enumerate(RULES.items()):
        for r in _candidates(queries[kind], rows_of, len(kept)).tolist():
            i = kept[r]
            found[i] += [(m.start(), order, kind, m.end()) for m in patterns[kind].finditer(texts[i])
                         if m.end(group) - m.start(group) >= least]
    return [[(kind, start, end) for start, _, kind, end in sorted(f)] for f in found]


def _masked(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _digest() -> Callable[[list], list[tuple]]:
    def run(texts: list) -> list[tuple]:
        out = []
        for spans in spans_of(texts):
            base = [s for s in spans if s[0] in BASE]
            counts = [sum(s[0] == k for s in base) for k in BASE]
            out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        return out

    return run


def _redacted() -> Callable[[list], list[tuple]]:
    return lambda texts: [(_masked(t, s), len(s)) for t, s in zip(texts, spans_of(texts), strict=True)]


digest: Callable[[str | Column], Column] = per_batch(_digest, {
    "n_assign": "long", "n_access": "long", "n_hex": "long", "base_sha256": "string", "spans": "string"})
_redact = per_batch(_redacted, {"text": "string", "n_spans": "long"})


def scan(docs: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a struct of counts, the digest of the base spans, and all spans."""
    python_settings(docs.sparkSession)
    return docs.withColumn(into, digest(text))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each secret (or run of overlapping ones) replaced by ``[kind]``; no row is dropped."""
    python_settings(docs.sparkSession)
    return docs.withColumn(text, _redact(text)["text"])
