"""Prefix trie of conversations: which beginnings they share, and what a cache of these would save.

A node stands for the distinct sequence of the first turns of some conversations; its id is the exclusive
or of one 128-bit hash for each place and turn, so ids of any place of a long conversation are sums that
tasks can form from pieces. Turns that only one conversation reaches need no trie: their nodes are written
straight from the rows. What is shared (and one turn more) becomes a path, the ids one after another.

Paths are sorted by range into parts (shards). The skeleton is the trie of the paths at the borders of the
parts: only its nodes have members in more than one part. Each part is told how deep its first and last
path reach into the skeleton (two numbers a part are broadcast), finishes every other node by itself in one
walk over its sorted paths, and gives partial figures for its skeleton nodes: a node is counted for its
parent in the first part that has it, and judged a leaf in the last, so that a plain sum over parts is
right. Lists of members that end in a skeleton node are hashed chunk by chunk in the order of the parts.

A part holds the shared turns of its share of the conversations, so a very common beginning, and a large
group of equal conversations, lie in many parts. The largest thing in one task besides is the shared part
of one conversation, 24 bytes a turn.

Defined results: conversations without turns are members of the root; repeated rows are turns of their own,
ordered by digest within one turn number; null ids are left out; no conversation, no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import broadcast_if, python_settings, stored
from tickloom.llm.turns import digest, in_order

#: Turns of a conversation whose hashes are summed in one task.
STRETCH = 4096
#: Most skeleton nodes (three short columns) that are broadcast for their members' smallest id.
MOST_BROADCAST = 100_000
#: Ids of more than this part of all rows are frequent, so there are at most as many (16 bytes each).
MOST_FREQUENT = 10_000
ID = 16
NO_IDS = hashlib.sha256(b"").hexdigest()
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, depth from 1, digest, weight) with the id of the node that each ends in, as two longs."""
    hashed = turns.select("conv_id", "depth", "weight", F.expr(f"(depth - 1) DIV {STRETCH}").alias("stretch"),
                          F.xxhash64(F.lit(1), "depth", "digest").alias("a"), F.xxhash64(F.lit(2), "depth", "digest").alias("b"))
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = (hashed.groupBy("conv_id", "stretch").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
              .select("conv_id", "stretch", F.bit_xor("a").over(earlier).alias("a0"), F.bit_xor("b").over(earlier).alias("b0"))
              .where("stretch > 0"))
    so_far = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = {c: F.bit_xor(c).over(so_far).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0).cast("bigint"))) for c in "ab"}
    return hashed.join(before, ["conv_id", "stretch"], "left").withColumns(own).select("conv_id", "depth", "weight", "a", "b")


def _id(turn: Column) -> Column:
    return F.concat(F.lpad(F.hex(turn["a"]), 16, "0"), F.lpad(F.hex(turn["b"]), 16, "0"))


def _shared(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """``convs`` (conv_id, length) with ``shared``: the depth down to which others have the same turns."""
    common = stored(rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"), "trie-common")
    # The rows of a very common beginning stay where they are; any other id has few enough for one task.
    frequent = F.broadcast(common.where(F.col("n") * MOST_FREQUENT > rows.count()).select("a", "b"))
    rest = rows.join(frequent, ["a", "b"], "left_anti").join(common, ["a", "b"], "left_semi")
    both = rows.join(frequent, ["a", "b"], "left_semi").unionByName(rest)
    deep = both.groupBy("conv_id").agg(F.max("depth").alias("shared"))
    return convs.join(deep, "conv_id", "left").select("conv_id", "length", F.coalesce("shared", F.lit(0)).cast("bigint").alias("shared"))


def _paths(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each conversation: ids of its shared turns and the next as one binary, and their weights."""
    near = rows.join(convs.select("conv_id", "shared"), "conv_id").where("depth <= shared + 1")
    each = near.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "a", "b", "weight"))).alias("turns"))
    return convs.join(each, "conv_id", "left").select(
        "conv_id", "length", F.coalesce(F.unhex(F.array_join(F.transform("turns", _id), "")), F.lit(b"")).alias("path"),
        F.coalesce("turns.weight", F.array().cast("array<bigint>")).alias("weights"))


def alike(a: bytes, b: bytes) -> int:
    """Ids that two paths begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // ID
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // ID


def _reaches(pairs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pairs:
        ends = zip(batch.column("last").to_pylist(), batch.column("next").to_pylist(), strict=True)
        deep = [-1 if b is None else alike(a, b) for a, b in ends]
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("after"), pa.array(deep, pa.int64())], ["part", "after", "deep"])


def _skeleton(paths: DataFrame) -> DataFrame:
    """(part, left, right): how deep the first and last path of each part reach into the parts beside it."""
    borders = paths.groupBy("part").agg(F.min_by("path", "at").alias("first"), F.max_by("path", "at").alias("last"))
    order = Window.orderBy("part")  # one row a part
    pairs = borders.select("part", "last", F.lead("first").over(order).alias("next"), F.lead("part").over(order).alias("after"))
    deep = stored(pairs.mapInArrow(_reaches, "part int, after int, deep bigint"), "trie-borders")
    left = deep.where("after IS NOT NULL").select(F.col("after").alias("part"), F.col("deep").alias("left"))
    return deep.select("part", F.col("deep").alias("right")).join(left, "part", "left").select("part", "right", F.coalesce("left", F.lit(-1).cast("bigint")).alias("left"))


NODE = (
    "id binary, depth bigint, parent binary, part int, open boolean, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, ends string")
_NODE = pa.schema([
    ("id", pa.binary()), ("depth", pa.int64()), ("parent", pa.binary()), ("part", pa.int32()), ("open", pa.bool_()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()), ("ends", pa.string())])


class _Node:
    __slots__ = ("id", "depth", "parent", "weight", "seen_before", "open", "conv", "n", "children", "inner", "leaves", "saved", "ends")

    def __init__(self, ident: bytes, depth: int, parent: _Node | None, weight: int, seen_before: bool):
        self.id, self.depth, self.parent, self.weight, self.seen_before = ident, depth, parent, weight, seen_before
        self.open, self.inner, self.conv, self.ends = seen_before, False, None, []
        self.n = self.children = self.leaves = self.saved = 0

    def close(self, goes_on: bool) -> None:
        """All members of this part are known: adds its figures to its parent's."""
        self.open |= goes_on
        self.leaves += not self.inner and not goes_on
        self.saved += self.n * self.weight - (0 if self.seen_before else self.weight)
        if (p := self.parent) is not None:
            p.inner = True
            p.children += not self.seen_before
            p.n, p.leaves, p.saved = p.n + self.n, p.leaves + self.leaves, p.saved + self.saved
            p.conv = self.conv if p.conv is None else min(p.conv, self.conv)

    def row(self, part: int) -> tuple:
        ids = ",".join(map(str, self.ends))
        up = self.parent
        return (self.id, self.depth, up.id if up else None, part, self.open, self.conv, up.conv if up and not up.open else None, self.n, self.children,
                self.leaves, self.saved, None if self.open else hashlib.sha256(ids.encode()).hexdigest() if ids else NO_IDS, ids if self.open else None)


def shard(rows: Iterator[tuple[int, int, bytes, list[int]]], left: int, right: int) -> list[_Node]:
    """All nodes of one part, from its sorted (conv_id, length, path, weights)."""
    nodes = [_Node(b"", 0, None, 0, left >= 0)]
    stack, before = list(nodes), None
    for conv, length, path, weights in rows:
        common = 0 if before is None else alike(before, path)
        while len(stack) > common + 1:
            stack.pop().close(False)
        for d in range(common + 1, len(weights) + 1):
            # Only the first path's nodes can have members in earlier parts.
            node = _Node(path[(d - 1) * ID:d * ID], d, stack[-1], weights[d - 1], before is None and d <= left)
            nodes.append(node)
            stack.append(node)
        top = stack[-1]
        top.n += 1
        top.conv = conv if top.conv is None else min(top.conv, conv)
        if length == len(weights):
            top.ends.append(conv)
        else:  # goes on alone below its path
            top.inner, top.children, top.leaves = True, top.children + 1, top.leaves + 1
        before = path
    while stack:
        node = stack.pop()
        node.close(node.depth <= right)
    return nodes


def _sharded(key: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("at")
    first = {n: table.column(n)[0].as_py() for n in ("left", "right")}
    columns = [table.column(n).to_pylist() for n in ("conv_id", "length", "path", "weights")]
    nodes = shard(zip(*columns, strict=True), **first)
    rows = [n.row(key[0].as_py()) for n in nodes]
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_NODE)], schema=_NODE)


_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_REDUCED = "id binary, depth bigint, parent binary, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each skeleton node's parts, which come one after another and in their order."""
    kinds = pa.schema([_NODE.field(n) for n in ("id", "depth", "parent", "conv_id", *_SUMS, "ends_sha256")])
    now, sums, sha, some = None, [], None, False

    def done() -> pa.RecordBatch:
        row = (*now, *sums, sha.hexdigest())
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, kinds, strict=True)], schema=kinds)

    for batch in batches:
        for r in batch.to_pylist():
            if now is None or now[0] != r["id"]:
                if now is not None:
                    yield done()
                now, sums, sha, some = [r["id"], r["depth"], r["parent"], r["conv_id"]], [0] * len(_SUMS), hashlib.sha256(), False
            now[3] = min(now[3], r["conv_id"])
            sums = [s + r[n] for s, n in zip(sums, _SUMS, strict=True)]
            if r["ends"]:
                sha.update(("," * some + r["ends"]).encode())
                some = True
    if now is not None:
        yield done()


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes (``COLUMNS``) of ``turns`` (conv_id, depth from 1 to length, digest, weight) and ``convs`` (conv_id, length)."""
    python_settings(turns.sparkSession)
    rows = stored(prefixes(turns), "trie-prefixes")
    known = stored(_shared(rows, convs), "trie-shared")
    paths = in_order(_paths(rows, known), ["path", "conv_id"], "trie-paths")
    parts = paths.join(F.broadcast(_skeleton(paths)), "part")  # a row a part
    nodes = stored(parts.groupBy("part").applyInArrow(_sharded, NODE), "trie-nodes")
    pieces = nodes.where("open").repartition("id").sortWithinPartitions("id", "part")
    skeleton = stored(pieces.mapInArrow(_reduced, _REDUCED), "trie-skeleton")
    above = broadcast_if(skeleton.select(F.col("id").alias("parent"), F.col("conv_id").alias("of_parent")), MOST_BROADCAST)
    own = nodes.where("NOT open").drop("ends", "open", "part")
    inner = own.unionByName(skeleton, allowMissingColumns=True).join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_parent"))
    last = F.col("depth") == F.col("length")
    one = F.lit(1).cast("bigint")
    alone = rows.join(known, "conv_id").where("depth > shared + 1").select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(NO_IDS).alias("ends_sha256"))
    return inner.select(*COLUMNS).unionByName(alone)


def rebuilt(conversations: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) of conversations whose first h turns are those of the first one of their ``group`` ids.

    h is the unsigned crc32 of the decimal id modulo ``most``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    light = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", digest(role, text).alias("digest"), F.char_length(text).cast("bigint").alias("weight"))
    placed = in_order(light, ["conv_id", "turn", "digest"], "trie-turns")
    by_part = placed.groupBy("conv_id", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_part = stored(by_part.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("bigint"))), "trie-parts")
    place = F.col("at") - F.col("low") + 1 + F.col("before")
    first = F.col("conv_id") % group == 0
    heads = (placed.where(first).join(by_part.where(first).where(F.col("before") < most - 1), ["conv_id", "part"])
             .where(place < most).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(place.alias("place"), "digest", "weight"))).alias("head"))
             .withColumnRenamed("conv_id", "head_id"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = by_part.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumns({"h": h, "head_id": F.col("conv_id") - F.col("conv_id") % group})
    convs = stored(own.join(heads, "head_id", "left").select(
        "conv_id", "h", F.slice(F.coalesce("head", F.array()), F.lit(1), F.col("h").cast("int")).alias("head"), "n")
        .withColumn("k", F.size("head").cast("bigint"))
        .withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    lent = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.place").alias("depth"), "t.digest", "t.weight")
    kept = (placed.join(by_part.join(convs.select("conv_id", "h", "k"), "conv_id"), ["conv_id", "part"])
            .where(place > F.col("h")).select("conv_id", (F.col("k") + place - F.col("h")).alias("depth"), "digest", "weight"))
    return lent.unionByName(kept), convs.select("conv_id", "length")
