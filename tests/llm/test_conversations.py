"""Repair of conversations and their prefix trie against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries, repair, trie
from tickloom.llm.common import table

SCHEMA = "conv_id long, turn long, role string, text string"
WORDS = ["Yes.", "no", "What?", "", " \t\n", "So it is!", "So it is", "a. ", "é.　", "mit ß!"]


def odd_rows(seed, n_convs=300, same=0):
    r = random.Random(seed)
    rows = []
    for c in range(n_convs):
        c = c * r.choice([1, 3]) if c % 7 else c - 40
        for t in range(r.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, r.choice([t, t, t, t, t + 2, None, 3]), r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]), r.choice([*WORDS, None])))
    rows += [(5000 + k, t, "ua"[t % 2] + "x", f"copy {t}.") for k in range(same) for t in range(6)]
    rows += [(None, 1, "user", "x."), (None, None, None, None), (77_000, None, None, None)]
    rows += [(900, t // 2, "user" if t % 2 else "assistant", f"{t % 40} words." * (t % 3)) for t in range(700)]  # a long one
    return rows + rows[:9]


def key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, key(role, text))


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        code = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(c, t, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def cheapest(turns):
    """(cost, audit, repaired) by plain dynamic programming over whole audits."""
    go = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    put = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    after = {s: (0, "", ()) if s in ("", "a") else None for s in go}

    def inserts(best):
        for _ in range(3):
            for s in go:
                to = best[put[s][0]]
                if to is not None:
                    new = (to[0] + 2, "I" + to[1], ((put[s], ""), *to[2]))
                    best[s] = new if best[s] is None else min(best[s], new)
        return best

    after = inserts(after)
    for role, text, fault in reversed(turns):
        best = {}
        for s in go:
            ways = [(3 + after[s][0], "D" + after[s][1], after[s][2])]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in go[s]:
                    to = after[go[s][role[:1]]]
                    ways.append((extra + to[0], "K" + to[1], ((role, text), *to[2])))
                to = after[put[s][0]]
                ways.append((2 + extra + to[0], "R" + to[1], ((put[s], text), *to[2])))
            best[s] = min(ways)
        after = inserts(best)
    return after[""]


def plain_repair(rows):
    convs = {r[0]: [] for r in rows}
    for r in plain_damage(rows):
        convs[r[0]].append(r)
    out = []
    for c, own in convs.items():
        own.sort(key=order)
        seen, turns = set(), []
        for _, _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
            seen.add((role, text))
            turns.append((role, text, fault))
        numbers = [r[1] for r in own if r[1] is not None]
        initials = [t[0][:1] for t in turns]
        cost, audit, repaired = cheapest(turns)
        out.append((c, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(sum(t[2] == f for t in turns) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [1, 2, 4])
def test_blocks_give_the_cheapest_edits(length):
    r, solver = random.Random(length), repair.Tables(length)
    assert len(solver.vectors) < 60
    for _ in range(600):
        letters = [r.choice(repair.LETTERS) for _ in range(r.randrange(0, 15))]
        turns = [(repair.INITIALS[role], "x", repair.FAULTS[fault]) for role, fault in letters]
        symbols = repair.SYMBOL[np.array([4 * a + b for a, b in letters], int)] if letters else np.zeros(0, np.int64)
        assert solver.solve(symbols) == cheapest(turns)[:2]


def test_repair_of_odd_rows(spark):
    for seed in (1, 2):
        rows = odd_rows(seed)
        turns = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("own") for n in ("part", "at", "first", "audit", "digest", "found", "gaps")})
        assert sorted(map(tuple, repair.repaired(queries.damaged(turns), turns).collect()), key=str) == plain_repair(rows)


def test_repair_of_given_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    out = queries.op12_repair(spark, sf)
    assert out.columns[:9] == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain_repair(rows)


def test_empty_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.repaired(queries.damaged(none), none).collect() == []
    assert trie.prefix_trie(*trie.rebuilt(none)).collect() == []
    some = spark.createDataFrame([(1, 2, "user", "x")], SCHEMA)
    row = repair.repaired(some.limit(0), some).collect()
    assert [tuple(r) for r in row] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# -- trie --


def plain_trie(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((c, t, role or "", text or ""))
    paths = {}
    for c in own:
        own[c].sort(key=order)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        head = own.get(c - int(np.fmod(c, 100)), [])[:h]
        paths[c] = [r[2:] for r in head + own[c][h:]]
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
            if d:
                children[tuple(p[:d - 1])].add(tuple(p[:d]))
        ends[tuple(p)].append(c)
    leaves, saved, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        saved[node] = sum(saved[k] for k in kids) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids), leaves[node], saved[node],
                    hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretch,frequent", [(2, 10_000), (4096, 3)])
@pytest.mark.parametrize("parts", ["1", "9"])
def test_trie_of_odd_rows(spark, monkeypatch, stretch, frequent, parts):
    monkeypatch.setattr(trie, "MOST_FREQUENT", frequent)
    monkeypatch.setattr(trie, "STRETCH", stretch)
    rows = odd_rows(3, same=40)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("own") for n in ("part", "at", "first", "weight", "digest", "a", "length")})
        assert sorted(map(tuple, trie.prefix_trie(*trie.rebuilt(turns)).collect()), key=str) == plain_trie(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_trie_of_given_conversations(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    out = queries.op13_prefix_trie(spark, sf)
    assert out.columns == list(trie.COLUMNS)
    assert sorted(map(tuple, out.collect()), key=str) == plain_trie(rows)
