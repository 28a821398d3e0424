"""Personal data: weak labelers vote on candidate spans, and a classifier learned from their votes decides.

Each kind has a broad pattern whose matches are candidates, with a little text on both sides. Six labelers
vote for (1), against (-1) or not at all (0): the strict form of the kind (also check digits), gazetteers
(top-level domains, dialling codes, countries, issuers, given names), words before it that announce the kind,
words that announce something else (versions, orders, hashes), the letters beside it, and other finds nearby.
Expectation-maximisation over the counts of vote patterns estimates how each labeler votes on true and on
false spans, and each kind's share of true ones; candidates of base kinds, whose truth is known, anchor it. Its posteriors are the soft labels of a logistic classifier
on votes, length, neighbouring letters and the word before. Both are sums by feature over a table of distinct
patterns: documents are read once, and 100 sums a round reach the driver.

The four base kinds are exact: a match that passes its check is a span, whatever the classifier says, and one
that fails is none (it only teaches the labelers). The classifier adds spans of the other kinds. These are
searched where no base span stands, so none lies over a base span.

Patterns are written so that a search is linear in the text: a class that must be followed by something
outside it is possessive, and starts only where such a run starts (or the last match ended).

Defined results: null and empty texts have no spans; whole texts are searched; positions are code points;
spans of different kinds may overlap, those of one kind don't; equal rows get equal results; without
candidates nothing is learned or added; an empty table stays empty; an existing column of the result's
name is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.llm.decontaminate import let

# Kinds in the order of ties, with the linear form of each pattern; the first four are base.
_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
_LABEL = r"[A-Za-z0-9-]++"
KINDS: dict[str, str] = {
    "email": rf"{_LOCAL}@{_LABEL}(?:\.{_LABEL})++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "spelled_email": rf"{_LOCAL}(?:\x20?[\[(]at[\])]\x20?{_LABEL}(?:\x20?(?:[\[(]dot[\])]|\.)\x20?{_LABEL})++|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL})++)",
    "national_phone": r"(?<![0-9.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "mac": r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Fa-f:-])",
    "name": r"(?<![A-Za-z])[A-Z][a-z]++\x20[A-Z][a-z]++(?![A-Za-z0-9_])",
}
BASE = 4
# What a text must hold before a pattern is tried on it.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]", "spelled_email": r"[\[(]at[\])]|\x20dot\x20",
         "national_phone": "[0-9]{3}[.-][0-9]{4}", "ssn": "-[0-9]{2}-", "iban": "[A-Z]{2}[0-9]{2}", "mac": "[0-9A-Fa-f]{2}[:-][0-9A-Fa-f]{2}[:-]", "name": None}

# Gazetteers.
DOMAINS = "com org net edu gov info io ai co uk de fr es it nl be ch at pl se no fi dk pt ie eu us ca au nz jp cn in br mx ru".split()
DIALLING = "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 7 81 82 84 86 90 91 92 351 352 353 358 380 420 421".split()
IBAN_COUNTRIES = "AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MT NL NO PL PT RO SE SI SK".split()
GIVEN_NAMES = (
    "Alexander Alice Amelia Andrea Angela Anthony Barbara Benjamin Carlos Carmen Caroline Catherine Charles Charlotte Christine Christopher Claudia Daniel David "
    "Deborah Dorothy Edward Elizabeth Emily Fatima Fernando Florian Francisco Frank George Gabriel Hannah Heinrich Helen Henry Isabella Jacob James Jennifer "
    "Jessica Johanna John Jonathan Jorge Joseph Joshua Julia Katharina Kevin Klaus Laura Linda Lucas Manuel Margaret Maria Martin Mary Matthew Michael Michelle Mohammed "
    "Nancy Nicholas Nicole Olivia Pablo Patricia Patrick Paul Pierre Rachel Rebecca Richard Robert Sandra Samuel Sarah Sebastian Simon Sophie Stefan Steven Susan "
    "Thomas Victoria William Wolfgang Yusuf").split()
ROLE_ACCOUNTS = "abuse admin billing contact help info mail news noreply no-reply office postmaster root sales support webmaster".split()
# Words before a span that announce its kind, or something else.
CUES = {
    "email": "e-?mail|mail|contact|write to|reach", "ip": "ip|address|host|client|from|login", "card": "card|visa|mastercard|amex|credit|payment", "phone": "phone|tel|call|mobile|cell|fax|whatsapp|telefon",
    "spelled_email": "e-?mail|mail|contact|write to|reach", "national_phone": "phone|tel|call|mobile|cell|fax|whatsapp", "ssn": "ssn|social security|social|tax id", "iban": "iban|account|bank|konto",
    "mac": "mac|device|hardware|ethernet", "name": "name is|name:|mr\\.?|mrs\\.?|ms\\.?|dr\\.?|dear|signed|regards,|sincerely,|i am|patient|customer|herr|frau",
}
OTHERWISE = "version|release|build|ver|v|isbn|issn|sku|order|invoice|ticket|part|serial|section|chapter|figure|table|sha1|sha256|md5|hash|uuid|doi|rfc|token"
LABELERS = ("form", "gazetteer", "announced", "other_thing", "edges", "company")

#: Code points of text beside a candidate that labelers see (not beyond the next candidate of its kind).
BEFORE, AFTER = 48, 24
#: Rounds at most, and the change of a weight that ends them.
EM_ROUNDS, TRAIN_ROUNDS, STEADY = 12, 20, 1e-3
#: Of the classifier's weights: strength of the pull to zero.
RIDGE = 1.0
#: Matches whose places are summed one after another; longer lists are summed block by block.
BLOCK = 256
#: Sums are of whole numbers, so that they don't depend on the order of rows.
SCALE = 1_000_000

_K, _V = len(KINDS), 3 * len(LABELERS)
_LENGTH, _LEFT = _K + _V, _K + _V + 3 * _K
_RIGHT, _WORD, _WORDS = _LEFT + 5, _LEFT + 10, 32
N_FEATURES = _WORD + _WORDS
MASK = "\x01"

# -- matches and their places ------------------------------------------------------------------------------


def _running(lengths: Column) -> Column:
    """Of an array of (gap, match) lengths: where each match starts."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["g"] + x["m"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["g"])).alias("out"))

    def shift(acc: Column, x: Column) -> Column:
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(lengths, b * BLOCK + 1, BLOCK), start, add))
    return let(blocks, lambda parts: F.flatten(F.zip_with(
        parts, F.aggregate(parts, start, shift)["out"], lambda p, before: F.transform(p["out"], lambda at: at + before))))


def _all(text: Column, k: int, kind: str) -> Column:
    """(kind, ms, gaps): a kind's matches and the text between them; both null if there are none."""
    pattern = KINDS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    some = F.when(text.rlike(NEEDS[kind]), found) if NEEDS[kind] else found
    return let(some, lambda ms: F.when(F.size(ms) > 0, F.struct(F.lit(k).alias("kind"), ms.alias("ms"), F.split(text, pattern, -1).alias("gaps"))))


def _placed(own: Column) -> Column:
    """Of one kind's matches in order: kind, start, m (the match), before and after (the text beside it)."""
    gaps, ms = own["gaps"], own["ms"]
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(ms)), ms, lambda g, m: F.struct(F.char_length(g).alias("g"), F.char_length(m).alias("m")))
    return let(let(lengths, _running), lambda starts: F.transform(ms, lambda m, i: F.struct(
        own["kind"].alias("kind"), F.get(starts, i).alias("start"), m.alias("m"),
        F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"))))


def _masked(text: Column, kind: str) -> Column:
    """``text`` with each base span of this kind as a run of marks of the same length."""
    pattern = KINDS[kind]

    def fill(ms: Column) -> Column:
        marks = F.transform(ms, lambda m: F.when(passes(kind, m), F.repeat(F.lit(MASK), F.char_length(m))).otherwise(m))
        return F.array_join(F.flatten(F.zip_with(F.split(text, pattern, -1), marks, lambda g, m: F.array(g, F.coalesce(m, F.lit(""))))), "")

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), fill)


def _masking(kind: str) -> Callable[[Column], Column]:
    return lambda text: F.when(text.rlike(NEEDS[kind]), _masked(text, kind)).otherwise(text)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def passes(kind: str, m: Column) -> Column:
    """Whether a match of a base kind stands."""
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda d: (F.length(d) < 3) | ((F.length(d) == 3) & (d <= "255"))))
    if kind == "card":
        return let(_digits(m), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


# -- labelers ----------------------------------------------------------------------------------------------


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _remainder97(iban: Column) -> Column:
    s = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(s, 5, 64), F.left(s, F.lit(4)))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _one_of(words: list[str]) -> str:
    return rf"^(?:{'|'.join(words)})\z"


def _by_kind(c: Column, votes: dict[str, Column]) -> Column:
    """The vote that belongs to the candidate's kind; 0 for kinds without one."""
    out = F.lit(0)
    for kind, vote in votes.items():
        out = F.when(c["kind"] == list(KINDS).index(kind), vote).otherwise(out)
    return out


def _form(c: Column) -> Column:
    m, sure, never = c["m"], F.lit(True), F.lit(False)
    strict = {kind: c["base"] for kind in ("ip", "card", "phone")} | {
        "email": m.rlike(r"\.[A-Za-z]{2,24}\z"), "spelled_email": m.rlike(r"[.\x20\])][A-Za-z]{2,24}\z"),
        "ssn": ~m.rlike(r"^(?:000|666|9)|-00-|-0000\z"), "iban": _remainder97(m) == 1}
    return _by_kind(c, {kind: _vote(sure, ~ok) for kind, ok in strict.items()} | {
        "mac": _vote(~m.rlike(":.*-|-.*:"), m.rlike(r"^(?:00[:-])+00\z|^(?:(?i:ff)[:-])+(?i:ff)\z")),
        "national_phone": _vote(m.rlike(r"^\([0-9]{3}\)\x20[0-9]{3}-"), m.rlike(r"^\(?[01]")),
        "name": _vote(never, F.substring_index(m, " ", 1) == F.substring_index(m, " ", -1))})


def _gazetteer(c: Column) -> Column:
    m, never = c["m"], F.lit(False)
    domain, account = F.lower(F.regexp_extract(m, r"[A-Za-z0-9-]+\z", 0)), F.lower(F.regexp_extract(m, "^[A-Za-z0-9-]+", 0))
    of_mail = _vote(domain.rlike(_one_of(DOMAINS)), account.rlike(_one_of(ROLE_ACCOUNTS)))
    known = {"card": m.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), "iban": F.left(m, F.lit(2)).rlike(_one_of(IBAN_COUNTRIES)), "name": F.substring_index(m, " ", 1).rlike(_one_of(GIVEN_NAMES))}
    return _by_kind(c, {kind: F.when(ok, 1).otherwise(-1) for kind, ok in known.items()} | {
        "email": of_mail, "spelled_email": of_mail, "phone": _vote(m.rlike(rf"^\+(?:{'|'.join(DIALLING)})[^A-Za-z]"), never),
        "ip": _vote(never, m.rlike(r"^(?:0|10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|22[4-9]|23[0-9]|255)\."))})


def _votes(c: Column) -> list[Column]:
    before, after, never = F.lower(c["before"]), c["after"], F.lit(False)
    glued = c["before"].rlike(r"[\p{L}0-9_]\z") | after.rlike(r"^[\p{L}0-9_]")
    near = r"@[a-z0-9-]+\.|\+[0-9]{1,3}|[0-9]{3}|" + MASK
    cues = {kind: F.when(before.rlike(rf"(?:^|[^a-z])(?:{words})[^a-z]{{0,8}}\z"), 1).otherwise(0) for kind, words in CUES.items()}
    return [
        _form(c), _gazetteer(c), _by_kind(c, cues), _vote(never, before.rlike(rf"(?:^|[^a-z])(?:{OTHERWISE})[^a-z]{{0,4}}\z")),
        _vote(~glued, glued), _vote(before.rlike(near) | F.lower(after).rlike(near), never),
    ]


def _place(letter: Column) -> Column:
    """0 nothing, 1 white space, 2 letter or digit, 3 usual punctuation, 4 else."""
    return F.when(letter == "", 0).when(letter.rlike(r"\s"), 1).when(letter.rlike(r"[\p{L}0-9_]"), 2).when(letter.rlike(r"[.,;:!?()\"'\[\]<>]"), 3).otherwise(4)


def _features(c: Column) -> Column:
    votes = [v + (_K + 3 * j + 1) for j, v in enumerate(_votes(c))]
    n = F.char_length(c["m"])
    word = F.regexp_extract(F.lower(c["before"]), r"([a-z]+)[^a-z]*\z", 1)
    return F.array(
        c["kind"], *votes, F.when(n < 12, 0).when(n < 20, 1).otherwise(2) + c["kind"] * 3 + _LENGTH, _place(F.right(c["before"], F.lit(1))) + _LEFT,
        _place(F.left(c["after"], F.lit(1))) + _RIGHT, (F.crc32(F.encode(word, "utf-8")) % _WORDS).cast("int") + _WORD)


def _judged(c: Column) -> Column:
    base = F.lit(False)
    for kind in list(KINDS)[:BASE]:
        base = F.when(c["kind"] == list(KINDS).index(kind), passes(kind, c["m"])).otherwise(base)
    return let(c.withField("base", base), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), (c["start"] + F.char_length(c["m"])).alias("end"), c["base"].alias("base"), _features(c).alias("features")))


def propose(docs: DataFrame, text: str = "text", into: str = "candidates") -> DataFrame:
    """``docs`` with the candidate spans of each text: place, kind, whether it is a base span, features."""
    def found(rest: Column) -> Column:
        sets = F.array(*(_all(F.col(text) if k < BASE else rest, k, kind) for k, kind in enumerate(KINDS)))
        return F.transform(F.flatten(F.transform(F.array_compact(sets), _placed)), _judged)

    rest = F.coalesce(text, F.lit(""))
    for kind in list(KINDS)[:BASE]:  # one mask after another; a text without the kind stays as it is
        rest = let(rest, _masking(kind))
    return docs.withColumn(into, let(F.when(F.col(text).rlike("[@0-9]"), rest).otherwise(F.col(text)), found))


# -- learning ----------------------------------------------------------------------------------------------


def _score(features: Column, weights: list[float]) -> Column:
    table = F.expr(f"array({', '.join(f'{w!r}D' for w in weights)})")
    return F.aggregate(features, F.lit(0.0), lambda s, i: s + F.get(table, i))


def _sums(patterns: DataFrame, value: Column) -> dict[int, float]:
    """By feature: the sum of ``value`` over its candidates."""
    scaled = F.round(F.col("n") * value * SCALE).cast("bigint")
    each = patterns.select(scaled.alias("v"), F.explode("features").alias("f")).groupBy("f").agg(F.sum("v").alias("v"))
    return {r["f"]: r["v"] / SCALE for r in each.collect()}  # a row a feature


def _chance(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def _truth(features: Column, weights: list[float]) -> Column:
    """The chance that a candidate is true; candidates of base kinds are decided by their check."""
    stands_ = (F.get(features, 0) == 0) | (F.get(features, 1) == _K + 2)
    return F.when(F.get(features, 0) < BASE, F.when(stands_, 1.0).otherwise(0.0)).otherwise(_chance(_score(features, weights)))


def labeler_weights(patterns: DataFrame) -> list[float]:
    """Log-odds of truth that each kind and vote brings, by expectation-maximisation over vote patterns."""
    votes = stored(patterns.groupBy(F.slice("features", 1, 1 + len(LABELERS)).alias("features")).agg(F.sum("n").alias("n")), "personal-votes")
    count = _sums(votes, F.lit(1.0))
    weights = [0.0] * _K + [float(v) for _ in LABELERS for v in (-1, 0, 1)] + [0.0] * (N_FEATURES - _K - _V)
    for _ in range(EM_ROUNDS):
        true = _sums(votes, _truth(F.col("features"), weights))
        new = list(weights)
        for f in range(_K):
            yes = true.get(f, 0.0)
            new[f] = math.log((yes + 1) / (max(0.0, count.get(f, 0.0) - yes) + 1))
        for j in range(len(LABELERS)):
            places = range(_K + 3 * j, _K + 3 * j + 3)
            yes = [true.get(f, 0.0) + 1 for f in places]
            no = [max(0.0, count.get(f, 0.0) - true.get(f, 0.0)) + 1 for f in places]
            for f, y, n in zip(places, yes, no, strict=True):
                new[f] = math.log(y / sum(yes)) - math.log(n / sum(no))
            # A vote never counts against its meaning: labelers are better than chance, which also rules out swapped classes.
            new[places[0]], new[places[2]] = min(0.0, new[places[0]]), max(0.0, new[places[2]])
        change = max(abs(a - b) for a, b in zip(new, weights, strict=True))
        weights = new
        if change < STEADY:
            break
    return weights


def fit(proposed: DataFrame, candidates: str = "candidates") -> list[float]:
    """Weights of the span classifier, by feature."""
    each = proposed.select(F.explode(candidates).alias("c"))
    patterns = stored(each.groupBy("c.features").agg(F.count("*").alias("n")), "personal-patterns")
    labelers = labeler_weights(patterns)
    soft = _truth(F.slice("features", 1, 1 + len(LABELERS)), labelers)
    count = _sums(patterns, F.lit(1.0))
    active = 1 + len(LABELERS) + 4
    weights = last = [0.0] * N_FEATURES
    for k in range(TRAIN_ROUNDS):
        # Each step starts a little ahead on the way of the last one (accelerated descent). Its length is safe:
        # the curvature is at most a quarter of the active features times the count.
        ahead = [w + k / (k + 3) * (w - v) for w, v in zip(weights, last, strict=True)]
        slope = _sums(patterns, soft - _chance(_score(F.col("features"), ahead)))
        step = [(slope.get(f, 0.0) - RIDGE * w) / (active * count.get(f, 0.0) / 4 + RIDGE) for f, w in enumerate(ahead)]
        last, weights = weights, [w + s for w, s in zip(ahead, step, strict=True)]
        if max(map(abs, step)) < STEADY:
            break
    return weights


# -- results -----------------------------------------------------------------------------------------------


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def _is_of(k: int) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == k


def decide(proposed: DataFrame, weights: list[float], candidates: str = "candidates", into: str = "personal") -> DataFrame:
    """``proposed`` with a struct: counts and digest of the base spans, all spans, how many were added."""
    def digest(all_: Column) -> Column:
        base = F.filter(all_, lambda s: s["base"])
        counts = [F.size(F.filter(base, _is_of(k))).cast("bigint").alias(f"n_{kind}") for k, kind in enumerate(list(KINDS)[:BASE])]
        return F.struct(*counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(all_).alias("spans"), F.size(F.filter(all_, lambda s: ~s["base"])).cast("bigint").alias("n_added"))

    stands = F.filter(candidates, lambda s: s["base"] | ((s["kind"] >= BASE) & (_score(s["features"], weights) >= 0)))
    return proposed.withColumn(into, let(F.array_sort(stands), digest))


def find(docs: DataFrame, text: str = "text", into: str = "personal") -> DataFrame:
    """``docs`` with what ``decide`` says; labelers and classifier are fitted to all of ``docs``."""
    proposed = propose(docs, text, "_candidates")
    return decide(proposed, fit(proposed, "_candidates"), "_candidates", into).drop("_candidates")
