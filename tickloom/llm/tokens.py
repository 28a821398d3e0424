"""Token counts: the best unigram segmentation of a text, without building it.

The vocabulary's pieces and scores come from a SentencePiece file (its path is a parameter). As
SentencePiece does, one mark is put before the text and each space becomes a mark. Some pieces are runs
of marks, so the text is cut only before a mark that follows something else, where no piece crosses (if
one does, the text isn't cut). An Aho-Corasick automaton enumerates the pieces that end at each letter of a word; dynamic
programming keeps only the best score and its number of pieces. Rules of ties, as in unigram
tokenizers: of equal scores the piece that starts first wins; a letter without a piece of its own is
unknown at the least score less ten, and costs one token a byte where the vocabulary has bytes, else
one a run. Words repeat, so a worker remembers the results of the last words (bounded).

Defined results: null and empty texts have 0 tokens; texts are counted whole; repeated rows are counted
each; an existing column of the result's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from math import inf

import ahocorasick
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession

from tickloom.llm.common import per_batch, python_settings

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers.
MOST_WORDS = 200_000

Vocabulary = tuple[list[tuple[str, float]], float, bool]


def read_vocabulary(path: str) -> Vocabulary:
    """(pieces with scores, score of an unknown letter, whether unknown letters become bytes)."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in ids
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return pieces, min(s for _, s in pieces) - UNKNOWN_PENALTY, sum(map(sp.is_byte, ids)) == 256


#: A run of marks and what follows it, as far as the next mark.
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Counter:
    """Counts by one vocabulary; ``split`` cuts before every mark, as ``Metaspace(split=True)`` does."""

    def __init__(self, vocabulary: Vocabulary, split: bool = True) -> None:
        pieces, self.unknown, self.bytes = vocabulary
        self.split = split
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.letters = frozenset(p for p, _ in pieces if len(p) == 1)
        # A letter of no piece is unknown wherever it stands, so a word may be cut there.
        self.cut_lines = self.bytes and not any("\n" in p for p, _ in pieces)
        # A run of unknown letters, which costs one, may hold marks that are unknown themselves.
        self.cut_words = (self.bytes or MARK in self.letters) and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation of one marked word."""
        n = len(word)
        if self.letters.issuperset(word):  # no unknown letter: matches come by end, longest first
            best, pieces = [0.0, *[-inf] * n], [0] * (n + 1)
            for last, (length, score) in self.automaton.iter(word):
                start = last + 1 - length
                if (value := best[start] + score) > best[last + 1]:
                    best[last + 1], pieces[last + 1] = value, pieces[start] + 1
            return pieces[n], best[n]
        ending: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for last, match in self.automaton.iter(word):
            ending[last + 1].append(match)
        best, pieces, runs = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for e in range(1, n + 1):
            top = None
            matches = ending[e]
            matches.sort(reverse=True)  # the longest, which starts first, wins ties
            for length, score in matches:
                value = best[e - length] + score
                if top is None or value > top:
                    top, pieces[e] = value, pieces[e - length] + 1
            if not matches or matches[-1][0] != 1:
                value = best[e - 1] + self.unknown
                if top is None or value > top:
                    top, runs[e] = value, True
                    pieces[e] = pieces[e - 1] + (len(word[e - 1].encode("utf-8", "surrogatepass")) if self.bytes else not runs[e - 1])
            best[e] = top
        return pieces[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARK)
        lines = marked.count("\n") if self.cut_lines else 0
        if not self.split:
            parts = (MARK + marked).split("\n") if lines else [MARK + marked]
            words = [w for p in parts for w in _WORD.findall(p)] if self.cut_words else [p for p in parts if p]
        elif lines:
            parts = [w.split("\n") for w in marked.removeprefix(MARK).split(MARK)]
            words = [MARK + p[0] for p in parts] + [x for p in parts for x in p[1:] if x]
        else:
            words = [MARK + w for w in marked.removeprefix(MARK).split(MARK)]
        known, tokens, total = self.known, lines, lines * self.unknown
        for w in words:
            if (r := known.get(w)) is None:
                if len(known) >= MOST_WORDS:
                    known.clear()
                r = known[w] = self.word(w)
            tokens += r[0]
            total += r[1]
        return tokens, total


def token_counter(spark: SparkSession, path: str) -> Callable[[str], Column]:
    """A column function from texts to a struct of n_tokens and log_score."""
    python_settings(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(path))

    def make() -> Callable[[list], list[tuple]]:
        counter = Counter(vocabulary.value, split=False)
        return lambda texts: [counter.text(t) for t in texts]

    return per_batch(make, {"n_tokens": "long", "log_score": "double"})


def count_tokens(docs: DataFrame, path: str, text: str = "text", into: str = "tokens") -> DataFrame:
    return docs.withColumn(into, token_counter(docs.sparkSession, path)(text))
