"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds all substrings of its training text. A text is parsed
greedily into phrases: the longest match in the automaton, then the next from there. A phrase costs
log2 of the training text's length, so phrases times that, per letter, estimates the cross entropy; the
language with the fewest normalised phrases wins. The score is the posterior of the winner when the
costs are taken as code lengths, over equal priors.

Training is bounded: for each language the chunks of labelled texts with the lowest hashes, up to
``CHARS`` letters (fewer if there are many languages: ``MOST_CELLS``); copies of a chunk count once.
Predictions parse whole texts, cut into stretches of ``STRETCH`` letters that are parsed side by side.

Each letter of the training texts has a symbol of its own. Transitions by the ``DENSE`` most common ones
are a table, those by all others are sorted (state, symbol) keys.

Letters: text is lower-cased; runs of anything else (digits, signs, white space) are one gap.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with no labelled text
every prediction is ``und``; equal costs go to the language that sorts first; repeated rows are
predicted each; null labels and texts teach nothing; an existing column of the result's name is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import per_batch, python_settings

#: Training letters of a language; letters of a chunk; letters whose transitions are a table.
CHARS, CHUNK, DENSE = 120_000, 1_500, 60
#: Cells of the tables of all automata together (four bytes each), and letters that are parsed at once.
MOST_CELLS, STRETCH, AT_ONCE = 60_000_000, 512, 4_000_000
UNDETERMINED = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Of each code point, whether it is a letter (or a mark inside words)."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The suffix automaton of a symbol sequence: the transitions of each state."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p != -1:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(step[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Model:
    """Automata of all languages in one table: phrases of many stretches are counted in step."""

    def __init__(self, texts: tuple[tuple[str, str], ...]) -> None:
        self.languages = [name for name, _ in texts]
        seen: Counter[int] = Counter()
        for _, t in texts:
            own = Counter(_codes(t).tolist())  # by its share in each language
            total = sum(own.values())
            seen.update({c: n * 1_000_000 // total for c, n in own.items() if _letters()[c]})
        letters = [c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))]
        self.table = np.zeros(0x110000, np.int32)  # 0 is the gap
        self.table[_letters()] = 1  # a letter of no training text
        self.table[letters] = np.arange(2, 2 + len(letters))
        self.alphabet, self.width = 2 + len(letters), 2 + min(DENSE, len(letters))
        states, fresh, self.bits = [], [], []
        keys, targets = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        begins = np.zeros((len(texts), self.alphabet - self.width), np.int32)
        base = 0
        for nth, (_, t) in enumerate(texts):
            symbols = self.symbols(_codes(t))
            a = automaton(symbols.tolist())
            sizes = np.fromiter(map(len, a), np.int64, len(a))
            most = int(sizes.sum())
            at = np.repeat(np.arange(len(a)), sizes)
            by = np.fromiter((c for d in a for c in d), np.int64, most)
            to = np.fromiter((q for d in a for q in d.values()), np.int32, most)
            del a
            # One more state, where any symbol begins a phrase: at the start, and after an unknown
            # symbol, which is a phrase of its own. A step that begins a phrase is stored as the
            # bitwise complement of where it leads.
            fresh.append(base + len(sizes))
            begin = np.full(self.alphabet, fresh[-1], np.int32)
            begin[by[at == 0]] = to[at == 0] + base
            begins[nth] = ~begin[self.width:]
            own = np.broadcast_to(~begin[:self.width], (len(sizes) + 1, self.width)).copy()
            dense = by < self.width
            own[at[dense], by[dense]] = to[dense] + base
            states.append(own)
            # Keys are sorted within a language already but for the symbols of one state.
            key = (at[~dense] + base) * self.alphabet + by[~dense]
            order = np.argsort(key, kind="stable")
            keys.append(key[order])
            targets.append(to[~dense][order] + base)
            base += len(own)
            self.bits.append(np.log2(max(2, len(symbols))))
        self.fresh, self.bits = np.array(fresh, np.int64), np.array(self.bits)
        self.steps = np.concatenate(states).ravel() if states else np.zeros(0, np.int32)
        self.keys, self.targets = np.concatenate(keys), np.concatenate(targets)
        self.begins = np.ascontiguousarray(begins.T)  # of each sparse symbol, where it begins a phrase

    def sparse(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Steps of rows of states by symbols without a column of their own."""
        begin = self.begins[symbols - self.width]
        if not len(self.keys):
            return begin
        key = state * self.alphabet + symbols[:, None]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], begin)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Letters as symbols, runs of others as one gap."""
        s = self.table[codes]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
        return s[keep]

    def phrases(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Phrases of each sequence in each language."""
        out = np.zeros((len(sequences), len(self.languages)), np.int64)
        lengths = np.array([len(s) for s in sequences], np.int64)
        if not lengths.sum() or not len(self.languages):
            return out
        flat = np.concatenate(sequences).astype(np.int64)
        rare = flat >= self.width
        column = np.where(rare, 1, flat)
        rare = rare if rare.any() else None
        pieces = -(-lengths // STRETCH)
        owner = np.repeat(np.arange(len(sequences)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(lengths) - lengths, pieces) + nth * STRETCH
        size = np.minimum(STRETCH, np.repeat(lengths, pieces) - nth * STRETCH)
        order = np.argsort(-size, kind="stable")
        owner, begin, size = owner[order], begin[order], size[order]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # stretches that long
        state = np.repeat(self.fresh[None, :], len(owner), 0)
        count = np.zeros(state.shape, np.int32)
        for t, n in enumerate(active.tolist()):
            here = begin[:n] + t
            to = self.steps[state[:n] * self.width + column[here, None]]
            if rare is not None and len(rows := np.flatnonzero(rare[here])):
                to[rows] = self.sparse(state[rows], flat[here[rows]])
            begun = to >> 31
            count[:n] -= begun
            state[:n] = to ^ begun
        np.add.at(out, owner, count)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNDETERMINED, 0.0)] * len(texts)
        rows: list[int] = []
        sequences: list[np.ndarray] = []
        held = 0

        def settle() -> None:
            nonlocal held
            if rows:
                bits = self.phrases(sequences) * self.bits
                best = bits.argmin(1)
                odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000.0)).sum(1)
                for r, b, o in zip(rows, best.tolist(), odds.tolist(), strict=True):
                    out[r] = self.languages[b], 1.0 / o
            rows.clear()
            sequences.clear()
            held = 0

        for i, t in enumerate(texts):
            if t and self.languages and _letters()[codes := _codes(t)].any():
                rows.append(i)
                sequences.append(self.symbols(codes))
                held += len(sequences[-1])
                if held >= AT_ONCE:
                    settle()
        settle()
        return out


@lru_cache(1)
def _model(texts: tuple[tuple[str, str], ...]) -> Model:
    return Model(texts)


def training_texts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[tuple[str, str], ...]:
    """The bounded training text of each language, by language."""
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))
    counts = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.sum(F.ceil(F.length("t") / CHUNK)).alias("n")).collect()}
    if not counts:
        return ()
    chars = min(CHARS, MOST_CELLS // (2 * (DENSE + 2) * len(counts)))
    most = max(1, chars // CHUNK)
    # A share of all chunks by hash first, so that the exact choice is among few.
    share = F.create_map(*(F.lit(x) for l, n in counts.items() for x in (l, min(1.0, 8.0 * most / max(1, n)))))[F.col("l")]
    # One pass cuts a text; a substring for each chunk would walk it from its start each time.
    pieces = F.regexp_extract_all("t", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    chunks = rows.select("l", F.explode(pieces).alias("c")).withColumn("h", F.xxhash64("c"))
    drawn = chunks.where(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).distinct()
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "c"))
    kept = drawn.withColumn("k", rank).where(F.col("k") <= most).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(kept, key=lambda r: (r["l"], r["k"])):
        texts.setdefault(r["l"], []).append(r["c"])
    joined = {l: "\n".join(c)[:chars] for l, c in texts.items()}
    return tuple((l, t) for l, t in sorted(joined.items()) if any(map(str.isalpha, t)))


def predictor(texts: tuple[tuple[str, str], ...]) -> Callable[[str], Column]:
    """A column function from texts to a struct of lang_pred and score."""

    def make() -> Callable[[list], list[tuple]]:
        return _model(texts).predict

    return per_batch(make, {"lang_pred": "string", "score": "double"})


def identify(docs: DataFrame, texts: tuple[tuple[str, str], ...], text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct of the predicted language and its score."""
    python_settings(docs.sparkSession)
    return docs.withColumn(into, predictor(texts)(text))
