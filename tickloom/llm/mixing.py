"""Mixing sources to target weights by hierarchical budgeting.

A token budget flows down a tree of domain, language and source. At each node it is shared among the
children by weight; a child takes at most what its subtree can give (its tokens times the most epochs),
and what it cannot take goes to its siblings by weight. A node passes on no more than its subtree holds,
so a shortage is met by siblings before it reaches the ancestors. A leaf gives whole epochs, then the
prefix of one more, in an order that the seed and the epoch fix: the longest prefix within its quota.

No leaf is gathered in one place: sums over two, then four hexadecimal digits of the order's hash narrow
the end of the prefix down to one part in 65,536 of the leaf, and only that part is ordered.

Defined results: null domain, language and source are leaves named by the empty string; weights that are
not given are ``DEFAULT_WEIGHT``, those of 0 take nothing; documents without words have 0 tokens and
cost nothing; rows that share an id (or, without one, the text) are taken or left together; an empty
table gives an empty mix; existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

DEFAULT_WEIGHT = 1.0
WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "language", "origin")
#: Digits of the hash by which the end of a prefix is narrowed down; the last are all it has.
DIGITS = (2, 4, 32)


def _weight(level: str, weights: Mapping[str, float]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.items():
        out = F.when(F.col(level) == name, F.lit(float(w))).otherwise(out)
    return out


def _leaf() -> Column:
    return F.concat_ws("\x01", *LEVELS)


def shared(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``children`` (``weight`` over 0, ``room``, ``parent_budget``) with the part that each gets.

    Children in the order of room by weight are full up to some point; the level to which the others
    are served is the highest of what remains for them by weight.
    """
    w = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), name)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rest = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("parent_budget") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    served = F.max("_level").over(Window.partitionBy(*parent))
    return (children.withColumn("_level", level)
            .withColumn("budget", F.greatest(F.lit(0.0), F.least("room", F.col("weight") * served))).drop("_level"))


def quotas(leaves: DataFrame, weights: Mapping[str, Mapping[str, float]], share: float, epochs: int) -> DataFrame:
    """(leaf, tokens, quota) from one row a leaf; the budget is ``share`` of all tokens."""
    for level in LEVELS:
        leaves = leaves.withColumn(f"w_{level}", _weight(level, weights.get(level, {})))
    open_ = leaves.where(" AND ".join(f"w_{x} > 0" for x in LEVELS)).withColumn("room", F.col("tokens").cast("double") * epochs)
    budget = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * F.lit(float(share))).alias("parent_budget"))
    nodes = budget.withColumn("root", F.lit(0))
    keys: list[str] = ["root"]
    for depth, level in enumerate(LEVELS, 1):
        own = [*LEVELS[:depth]]
        children = (open_.withColumn("root", F.lit(0)).groupBy("root", *own)
                    .agg(F.sum("room").alias("room"), F.max(f"w_{level}").alias("weight")))
        children = shared(children.join(nodes, keys), keys, level)
        keys = ["root", *own]
        nodes = children.select(*keys, F.col("budget").alias("parent_budget"))
    given = nodes.select(_leaf().alias("leaf"), F.floor(F.col("parent_budget") + 1e-6).cast("bigint").alias("quota"))
    return leaves.select(_leaf().alias("leaf"), "tokens").join(given, "leaf", "left").fillna(0, ["quota"])


def _order(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key))


def cuts(narrow: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """(leaf, cut): the hash up to which the last epoch of a leaf reaches.

    What lies before ``prefix`` fits into the quota (``before`` tokens of it); what begins with it is
    looked at by more digits, until hashes are looked at whole.
    """
    ends = stored(plan.where("quota % nullif(tokens, 0) > 0").selectExpr(
        "leaf", "quota div tokens AS full", "quota % tokens AS left", "'' AS prefix", "0L AS before"), "mix-ends")
    for digits in DIGITS:
        area = narrow.join(ends, "leaf").withColumn("h", _order(seed, F.col("full") + 1, F.col("key"))).where("startswith(h, prefix)")
        sums = area.groupBy("leaf", F.substring("h", 1, digits).alias("part")).agg(F.sum("tokens").alias("t"))
        running = F.sum("t").over(Window.partitionBy("leaf").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        upto = sums.withColumn("t", running).join(ends, "leaf").withColumn("upto", F.col("before") + F.col("t"))
        fits = F.col("upto") <= F.col("left")
        if digits == DIGITS[-1]:
            return upto.groupBy("leaf").agg(F.coalesce(F.max(F.when(fits, F.col("part"))), F.max("prefix")).alias("cut"))
        ends = stored(upto.groupBy("leaf", "full", "left").agg(
            F.min(F.when(~fits, F.col("part"))).alias("prefix"),
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.max("before")).alias("before")), "mix-ends")
    raise AssertionError("DIGITS ends with whole hashes")


def mix(docs: DataFrame, domain: Column, weights: Mapping[str, Mapping[str, float]], share: float,
        epochs: int = 2, seed: int = 17) -> DataFrame:
    """The mix: a row for each document and epoch that takes it, with domain, n_tokens and epoch (from 1)."""
    blank = F.lit("")
    leaf = F.concat_ws("\x01", F.coalesce(domain, blank), F.coalesce(F.col("lang").cast("string"), blank),
                       F.coalesce(F.col("source").cast("string"), blank))
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5("text"), blank)
    tokens = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    narrow = stored(docs.select(leaf.alias("leaf"), key.alias("key"), tokens.alias("tokens")), "mix-tokens")
    parts = F.split("leaf", "\x01")
    leaves = stored(narrow.groupBy("leaf").agg(F.sum("tokens").alias("tokens")), "mix-leaves").select(
        *(parts[i].alias(x) for i, x in enumerate(LEVELS)), "tokens")
    plan = stored(quotas(leaves, weights, share, epochs), "mix-plan")
    ends = plan.join(cuts(narrow.select("leaf", "key", "tokens"), plan, seed), "leaf", "left").select(
        F.col("leaf").alias("_leaf"),
        F.coalesce(F.expr("quota div nullif(tokens, 0)"), F.lit(0)).cast("int").alias("_full"), F.col("cut").alias("_cut"))
    joined = docs.withColumn("_leaf", leaf).join(stored(ends, "mix-cuts"), "_leaf")
    last = F.col("_cut").isNotNull() & (_order(seed, F.col("_full") + 1, key) <= F.col("_cut"))
    taken = F.col("_full") + F.when(last, 1).otherwise(0)
    return (joined.withColumns({"domain": F.coalesce(domain, blank), "n_tokens": tokens, "_taken": taken})
            .where("_taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("_taken"))))
            .drop("_leaf", "_full", "_cut", "_taken"))
