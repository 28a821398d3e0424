"""Quality rules: a decision list learned from labelled texts, applied as one conditional expression.

Each text gets counts (words, symbols, repeated lines and windows, ...), from which shares follow as
Spark columns. Sequential covering learns rules for bad texts: a rule grows by the threshold with the
best information gain until it covers no good text, is pruned on rows it did not grow on, and is taken
if it is still precise there; what it covers is put aside and the next one grows. The list becomes
``when(rule 1).when(rule 2)...otherwise(keep)``.

The learner sees a bounded sample of labelled rows (``MOST_LABELS``, lowest hashes first); copies with
the same counts are one example. All documents are measured and judged whole.

Defined results: a null or empty text has zero counts and fails the base rules; a null label or id
teaches nothing; without labels there are no rules and the base rules alone decide; contradicting labels
are examples of both; repeated rows are judged each; existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import per_batch, python_settings

#: Labelled rows that the learner may collect at most.
MOST_LABELS = 20_000
WINDOW = 5
#: Learner: thresholds tried for a column, conditions in a rule, rules, least precision on unseen rows,
#: least bad examples that a rule must cover.
THRESHOLDS, CONDITIONS, RULES, PRECISION, SUPPORT = 48, 3, 12, 0.95, 5

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct")

# -- counts of one text ------------------------------------------------------------------------------


def _exact_repeats(words: list[bytes]) -> int:
    windows = [tuple(words[i:i + WINDOW]) for i in range(len(words) - WINDOW + 1)]
    seen = Counter(windows)
    covered = np.zeros(len(words), bool)
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered[i:i + WINDOW] = True
    return int(covered.sum())


def repeated_words(words: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more.

    Equal windows have equal hashes, so a text without a repeated hash has no repeat; any other is
    counted on the words themselves.
    """
    if len(words) <= WINDOW:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64)
    key = np.zeros(len(words) - WINDOW + 1, np.uint64)
    for i in range(WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - WINDOW + 1 + i]
    key.sort()
    return _exact_repeats(words) if (key[1:] == key[:-1]).any() else 0


def counts_of(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` of one text."""
    if not text:
        return (0,) * len(COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: at the six ASCII white spaces only
    spaces = len(data) - len(data.translate(None, SPACE))
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in data.split(b"\n"):
        if line.strip(SPACE):
            lines += 1
            repeats += line in seen
            seen.add(line)
    capitals = len(data) - len(data.translate(None, bytes(range(65, 91))))
    return (len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), repeats,
            repeated_words(words), lines, capitals, len(set(words)))


def _counter() -> Callable[[list], list[tuple]]:
    return lambda texts: [counts_of(t) for t in texts]


_measure = per_batch(_counter, dict.fromkeys(COUNTS, "long"))


def measure(docs: DataFrame, text: str = "text", into: str = "counts") -> DataFrame:
    python_settings(docs.sparkSession)
    return docs.withColumn(into, _measure(text))


def features(counts: str = "counts") -> dict[str, Column]:
    c = {n: F.col(counts)[n].cast("double") for n in COUNTS}
    words, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))
    return {
        "n_words": c["n_words"], "symbols_per_word": c["n_symbols"] / words,
        "repeat_share": c["n_repeat_words"] / words, "dup_line_share": c["n_dup_lines"] / lines,
        "capitals_per_char": c["n_capitals"] / F.greatest(c["word_chars"], F.lit(1.0)),
        "distinct_share": c["n_distinct"] / words, "mean_word_chars": c["word_chars"] / words,
    }


# -- the learner -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        c = columns[self.feature]
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for c in rule:
        out &= c.holds(values)
    return out


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, inside: np.ndarray) -> tuple[float, Condition | None]:
    """The condition with the best gain of information about bad rows, among the rows inside."""
    p0, n0 = int((inside & bad).sum()), int((inside & ~bad).sum())
    base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
    for name, v in values.items():
        own = np.unique(v[inside])
        cuts = (own[1:] + own[:-1]) / 2 if len(own) <= THRESHOLDS else np.unique(np.quantile(own, np.linspace(0, 1, THRESHOLDS + 1)[1:-1]))
        pos, neg = np.sort(v[inside & bad]), np.sort(v[inside & ~bad])
        p_low, n_low = np.searchsorted(pos, cuts, "right"), np.searchsorted(neg, cuts, "right")
        for above in (True, False):
            p, n = (p0 - p_low, n0 - n_low) if above else (p_low, n_low)
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - base), 0.0)
            if len(gain) and (k := int(gain.argmax())) >= 0 and gain[k] > best[0]:
                best = float(gain[k]), Condition(name, above, float(cuts[k]))
    return best


def _grown(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < CONDITIONS and (inside & bad).any() and (inside & ~bad).any():
        _, condition = _best_condition(values, bad, inside)
        if condition is None:
            break
        rule, inside = (*rule, condition), inside & condition.holds(values)
    return rule


def _pruned(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Rule, float, int]:
    """The shortest prefix of the rule that is best on unseen rows; its precision and support there."""
    best: tuple[float, Rule, float, int] = (-2.0, (), 0.0, 0)
    for k in range(1, len(rule) + 1):
        hit = _covers(rule[:k], values, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best[0]:
            best = worth, rule[:k], p / (p + n) if p + n else 0.0, p
    return best[1:]


def learn(values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """An ordered list of rules for bad rows; every third row prunes, the others grow."""
    rules: list[Rule] = []
    fold = np.arange(len(bad)) % 3 == 2
    left = np.ones(len(bad), bool)
    while len(rules) < RULES and (left & bad & ~fold).any() and (left & ~bad & ~fold).any():
        of = lambda rows: ({k: v[rows] for k, v in values.items()}, bad[rows])
        rule = _grown(*of(left & ~fold))
        if not rule:
            break
        rule, precision, support = _pruned(rule, *of(left & fold))
        if precision < PRECISION or support < SUPPORT:
            break
        rules.append(rule)
        left &= ~_covers(rule, values, len(bad))
    return rules


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> list[Rule]:
    """Learns from at most ``most`` labelled rows: ``labels`` has doc_id and quality (0 is bad)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality").distinct()
    known = known.withColumn("_h", F.xxhash64("doc_id", F.lit("quality")))
    share = min(1.0, 2.0 * most / max(1, known.count()))
    # Ids by hash: first a share of all, so that the exact cut below is between few rows.
    drawn = known.where(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("_h", "doc_id", "quality").limit(most)
    measured = measure(docs.select("doc_id", "text").join(F.broadcast(drawn.select("doc_id", "quality")), "doc_id"))
    columns = features()
    distinct = measured.select("quality", *(c.alias(n) for n, c in columns.items())).distinct()
    rows = distinct.orderBy(F.xxhash64(*distinct.columns), *distinct.columns).limit(most).toPandas()
    return learn({n: rows[n].to_numpy(float) for n in columns}, rows["quality"].to_numpy() == 0)


def rule_number(rules: list[Rule], counts: str = "counts") -> Column:
    """1 for the first rule that holds, 2 for the second, ...; 0 if none does."""
    columns, out = features(counts), None
    for k, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(columns)
        out = F.when(holds, F.lit(k)) if out is None else out.when(holds, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with ``counts``, ``base_failed``, ``rule`` (0: none) and ``kept``."""
    words, repeats = F.col("counts.n_words"), F.col("counts.n_repeat_words")
    return (measure(docs, text)
            .withColumn("base_failed", (words < 10) | (100 * repeats > 20 * words))
            .withColumn("rule", rule_number(rules))
            .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)))
