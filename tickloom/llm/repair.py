"""Repair of conversations: the cheapest edits to turns of the form (system? (user assistant)+)?, or none.

A turn is one of nine symbols (to be deleted, or its role's initial and whether it is truncated); a
repair is a path through four states (nothing yet, after system, user, assistant). The costs of all
states from a turn to the end form a vector. Less its smallest entry, only a few vectors exist, so one
table holds, for each of them and each block of ``BLOCK`` symbols, the vector before the block and what
was taken off (Four Russians). A conversation is solved from its end by one lookup a block; the edits
are traced from its start, where each block is expanded backward to the vectors inside it, and of equally
cheap edits the first in ASCII order is taken: Delete, Insert, Keep, Rerole.

Spark orders the turns by range, so that a long conversation is spread; a turn is one letter by then, and
a conversation's letters, as many as its audit, are joined in one row. The hash of a repaired conversation
is a chain over all its text: turns are sorted by conversation, and a task streams them beside the audit.
Only a batch of turns is held at a time, so a conversation of any length takes bounded memory.

Defined results: conversations whose turns are all gone have zeros and an empty audit; null ids are one
conversation; turns of one number are ordered by a digest of role and text, equal rows are repeats; roles
of no known initial (also empty ones) can only be given a new role or deleted; null roles and texts are
one space; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import per_batch, python_settings
from tickloom.llm.turns import digest, in_order

#: Symbols of one block. The table has a row for each vector and 9 ** BLOCK columns.
BLOCK = 4
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# States 0 to 3: nothing yet, after system, after user, after assistant. What may be put in each state,
# and where that leads; where keeping a role of the given initial leads.
ROLE = ("user", "user", "assistant", "user")
GOES = (2, 2, 3, 2)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
INITIALS = "sua-"
FAULTS = ("", "blank", "duplicate", "truncated")
SPACE = " \t\n\x0b\f\r"

# A turn's letter is A + 4 * (place of its initial) + (place of its fault). Symbol 0 must be deleted.
LETTERS = [(r, f) for r in range(4) for f in range(4)]
SYMBOL = np.array([0 if f in (1, 2) else 1 + 2 * r + (f == 3) for r, f in LETTERS], np.int64)
N_SYMBOLS = 9
Vector = tuple[int, ...]


def _with_inserts(costs: list[float]) -> list[float]:
    for _ in GOES:
        costs = [min(c, INSERT + costs[to]) for c, to in zip(costs, GOES, strict=True)]
    return costs


def _ways(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) of what may be done with a turn, in ASCII order of the edits."""
    ways = [("D", DELETE, state)]
    if symbol:
        extra = TRUNCATED * ((symbol - 1) % 2)
        to = KEEPS.get((state, INITIALS[(symbol - 1) // 2]))
        ways += [("K", extra, to)] if to is not None else []
        ways.append(("R", REROLE + extra, GOES[state]))
    return ways


def _before(after: Vector, symbol: int) -> list[int]:
    return _with_inserts([min(c + after[to] for _, c, to in _ways(symbol, s)) for s in range(4)])


class Tables:
    """Vectors, and for one symbol and for a block: (vector after, symbols) -> vector before and what was taken off."""

    def __init__(self, length: int = BLOCK):
        end = tuple(int(c) for c in _with_inserts([0, np.inf, np.inf, 0]))
        ids, self.vectors, one = {end: 0}, [end], []
        for v in self.vectors:  # grows until no new vector is found
            row = []
            for symbol in range(N_SYMBOLS):
                costs = _before(v, symbol)
                least = min(costs)
                w = tuple(c - least for c in costs)
                if w not in ids:
                    ids[w] = len(ids)
                    self.vectors.append(w)
                row.append((ids[w], least))
            one.append(row)
        self.to, self.off = (np.array([[x[k] for x in row] for row in one], np.int64) for k in (0, 1))
        to, off = self.to, self.off
        for _ in range(length - 1):  # one more symbol in front
            n = len(self.vectors)
            off = (off[:, None, :] + self.off[to].transpose(0, 2, 1)).reshape(n, -1)
            to = self.to[to].transpose(0, 2, 1).reshape(n, -1)
        self.length, self.width = length, N_SYMBOLS ** length
        self.block_to, self.block_off = to.ravel().tolist(), off.ravel().tolist()
        self.powers = N_SYMBOLS ** np.arange(length - 1, -1, -1)
        self.expand = lru_cache(maxsize=1 << 16)(self._expand)

    def _expand(self, after: int, symbols: tuple[int, ...], state: int) -> tuple[str, int]:
        """The edits of a block that starts in ``state`` and has the vector ``after`` behind it; the last state."""
        inside = [after]
        for symbol in reversed(symbols):
            inside.append(int(self.to[inside[-1], symbol]))
        inside.reverse()
        edits = []
        for symbol, here, then in zip(symbols, inside, inside[1:], strict=False):
            now, later, off = self.vectors[here], self.vectors[then], int(self.off[then, symbol])
            while True:
                best = now[state] + off
                edit, cost, to = next((w for w in _ways(symbol, state) if w[1] + later[w[2]] == best), ("R", 0, 0))
                if now[state] == INSERT + now[GOES[state]] and edit > "I":
                    edits.append("I")
                    state = GOES[state]
                    continue
                edits.append(edit)
                state = to
                break
        return "".join(edits), state

    def solve(self, symbols: np.ndarray) -> tuple[int, str]:
        """Cost of the cheapest edits, and these (the first in ASCII order)."""
        first = len(symbols) % self.length
        codes = (symbols[first:].reshape(-1, self.length) @ self.powers).tolist()
        v, cost, after = 0, 0, [0] * len(codes)
        for i in range(len(codes) - 1, -1, -1):
            after[i] = v
            k = v * self.width + codes[i]
            v, cost = self.block_to[k], cost + self.block_off[k]
        head = [int(x) for x in symbols[:first]]
        behind_head = v
        for symbol in reversed(head):
            v, cost = int(self.to[v, symbol]), cost + int(self.off[v, symbol])
        cost += self.vectors[v][0]
        edits, state = self.expand(behind_head, tuple(head), 0)
        audit = [edits]
        for block, v in zip(symbols[first:].reshape(-1, self.length).tolist(), after, strict=True):
            edits, state = self.expand(v, tuple(block), state)
            audit.append(edits)
        end = self.vectors[0]
        while end[state]:
            audit.append("I")
            state = GOES[state]
        return cost, "".join(audit)


@cache
def tables() -> Tables:
    return Tables()


def _audits() -> Callable[[list], list[tuple]]:
    solver = tables()
    legal = np.zeros((4, 4), bool)
    for pair in ("su", "ua", "au"):
        legal[INITIALS.index(pair[0]), INITIALS.index(pair[1])] = True

    def audit(letters: str) -> tuple:
        codes = np.frombuffer(letters.encode(), np.uint8) - ord("A")
        role, fault = codes // 4, codes % 4
        cost, edits = solver.solve(SYMBOL[codes])
        return (*((fault == k).sum().item() for k in (1, 2, 3)), (~legal[role[:-1], role[1:]]).sum().item(), cost, edits)

    return lambda texts: [audit(t or "") for t in texts]


audits = per_batch(_audits, {"blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string"})


def _letters(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, role, blank, ended): what the order and the symbols need of each turn."""
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    initial = F.left("role", F.lit(1))
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return rows.select("conv_id", "turn", digest(F.col("role"), F.col("text")).alias("digest"),
                       place.alias("role"), (last == "").alias("blank"), last.isin(".", "!", "?").alias("ended"))


def audited(rows: DataFrame) -> DataFrame:
    """A row for each conversation of ``rows`` (conv_id, turn, role, text): gaps, faults, cost and audit."""
    python_settings(rows.sparkSession)
    light = in_order(_letters(rows), ["conv_id", "turn", "digest"], "turns")
    repeated = (light.groupBy("conv_id", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n"))
                .where("n > 1").select(F.col("conv_id").alias("_c"), F.col("digest").alias("_d"), "first"))
    marked = light.join(repeated, light.conv_id.eqNullSafe(repeated._c) & (light.digest == repeated._d), "left")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(~F.col("ended"), 3).otherwise(0)
    parts = (marked.select("conv_id", "part", "at", F.char(F.lit(ord("A")) + 4 * F.col("role") + fault).alias("letter"))
             .groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("at", "letter"))).alias("turns"))
             .select("conv_id", "part", F.array_join(F.col("turns.letter"), "").alias("letters")))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "letters"))).alias("parts"))
    solved = whole.select("conv_id", audits(F.array_join(F.col("parts.letters"), "")).alias("found"))
    numbers = (light.select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("_c"))
               .agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")))
    return (solved.join(numbers, solved.conv_id.eqNullSafe(numbers._c))
            .select("conv_id", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"), "found.*"))


_RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_FIGURES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


class _Rewriting:
    """Follows the audit of one conversation while its turns go by."""

    def __init__(self, figures: tuple):
        self.figures, self.audit, self.at, self.state = figures, figures[-1], 0, 0
        self.sha, self.some = hashlib.sha256(), False

    def _put(self, role: bytes, text: bytes) -> None:
        self.sha.update((b"\n" if self.some else b"") + role + b":")
        self.sha.update(text)
        self.some = True

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._put(ROLE[self.state].encode(), b"")
            self.state = GOES[self.state]
            self.at += 1

    def turn(self, role: bytes, text: bytes) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
            self.state = KEEPS[self.state, role[:1].decode()]
        elif edit == "R":
            self._put(ROLE[self.state].encode(), text)
            self.state = GOES[self.state]

    def done(self) -> tuple:
        self._inserts()
        return (*self.figures, self.sha.hexdigest())


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in (*_FIGURES, "repaired_sha256")])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(kinds)], schema=kinds)

    now = None
    for b in batches:
        out = []
        columns = {n: b.column(n) for n in b.schema.names}
        figures = [columns[n] for n in _FIGURES]
        for i, first in enumerate(columns["first"].to_pylist()):
            if first:
                if now is not None:
                    out.append(now.done())
                now = _Rewriting(tuple(c[i].as_py() for c in figures))
            else:
                now.turn(columns["role"][i].as_py(), columns["text"][i].as_py())
        if out:
            yield batch(out)
    if now is not None:
        yield batch([now.done()])


def repaired(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conv_id of ``convs``: figures, audit and the hash of the repaired turns in ``rows``."""
    python_settings(rows.sparkSession)
    rows = rows.select("conv_id", "turn", "role", "text")
    found = audited(rows).withColumnRenamed("conv_id", "_c")
    convs = convs.select("conv_id").distinct()
    heads = convs.join(found, convs.conv_id.eqNullSafe(found._c), "left").select(
        F.lit(True).alias("first"), "conv_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in _FIGURES[1:-1]), F.coalesce("audit", F.lit("")).alias("audit"))
    turns = rows.select(F.lit(False).alias("first"), "conv_id", "turn", digest(F.col("role"), F.col("text")).alias("digest"),
                        F.encode("role", "utf-8").alias("role"), F.encode("text", "utf-8").alias("text"))
    both = heads.unionByName(turns, allowMissingColumns=True)
    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("first"), "turn", "digest")
    return sorted_.mapInArrow(_rewritten, _RESULT)
