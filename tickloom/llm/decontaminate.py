"""Benchmark decontamination: a prefix-filtered set join of document words with item windows.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter one). It occurs in a document
only if every shingle of ``WIDTH`` words does, so one necessary shingle finds all its places: the rarest
one in the documents, the prefix of the window's shingles by rarity. The join is of that shingle only;
the place of a match fixes where the window would begin, which must fit within the document (positional
and length bound), and what is left is verified over the whole window.

One pass over the documents hashes their shingles (64 bits) and keeps those that any item has;
frequencies, prefixes, candidates and verification come from that small table: a window occurs where all
its shingles stand, each at its place. Texts are never shuffled. Item tables are broadcast if they have
at most ``MOST_BROADCAST`` rows, else shuffled.

Defined results: null and empty texts have no words and are clean; items without words are skipped;
items that share an id are one item, a null id counts as the empty one; rows with the same id and text
get the same result each; an empty table gives an empty result; an existing column of the result's
name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import broadcast_if, stored

WINDOW, WIDTH = 10, 3
#: Rows of an item table that may be broadcast (under 200 bytes each).
MOST_BROADCAST = 100_000

# What separates words once A-Z are lower-cased, and what words are made of before that.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), lambda w: w != "")


def _shingles(words: Column, width: int) -> Column:
    """Hashes of all runs of ``width`` words, by place."""
    return F.when(F.size(words) >= width, F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(width))),
    )).otherwise(F.array().cast("array<bigint>"))


def _hashed(width: int) -> Column:
    """The number of a text's words, and its shingles."""
    return let(words_of(F.col("text")), lambda w: F.named_struct(F.lit("n"), F.size(w), F.lit("h"), _shingles(w, width)))


def windows_of(items: DataFrame) -> DataFrame:
    """Distinct windows: words, their number, width of their shingles, shingle hashes, the items' ids."""
    words = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("w"))
    size = F.least(F.size("w"), F.lit(WINDOW))
    each = words.where(F.size("w") > 0).select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("w") - size), lambda i: F.slice("w", i + 1, size))).alias("words"))
    grouped = each.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))
    shingles = F.lit(None).cast("array<bigint>")
    for width in range(1, WIDTH + 1):
        shingles = F.when(F.col("width") == width, _shingles(F.col("words"), width)).otherwise(shingles)
    return (grouped.withColumn("size", F.size("words")).withColumn("width", F.least("size", F.lit(WIDTH)))
            .withColumn("shingles", shingles).withColumn("window", F.xxhash64("words")))


def _keys() -> list[Column]:
    """Two hashes that tell rows apart by id and text, never null."""
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit("text"), "text", "doc_id").alias("_k2")]


def hits(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """(_k1, _k2, _hit, _items) of the documents in which windows occur: words inside them, and the items'
    ids; None if there are no windows."""
    windows = stored(windows_of(items), "windows")
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())
    if not widths:
        return None
    own = stored(windows.select("width", F.explode("shingles").alias("h")).distinct(), "item-shingles")
    found = None
    for width in widths:
        rows = docs.select(*_keys(), _hashed(width).alias("d")).select("_k1", "_k2", F.col("d.n").alias("n"), F.posexplode("d.h").alias("at", "h"))
        hit = rows.join(broadcast_if(own.where(F.col("width") == width).drop("width"), MOST_BROADCAST), "h")
        hit = hit.select("_k1", "_k2", "n", "at", "h", F.lit(width).alias("width"))
        found = hit if found is None else found.unionByName(hit)
    postings = stored(found.distinct(), "postings")
    frequency = postings.groupBy("width", "h").agg(F.count("*").alias("df"))
    prefix = (windows.select("window", "size", "width", F.posexplode("shingles").alias("offset", "h"))
              .join(frequency, ["width", "h"], "left")
              .groupBy("window", "size", "width")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "h", "offset")).alias("rarest"))
              .where("rarest.df > 0")
              .select("window", "size", "width", "rarest.h", "rarest.offset"))
    start = F.col("at") - F.col("offset")
    places = (postings.join(broadcast_if(stored(prefix, "prefixes"), MOST_BROADCAST), ["width", "h"])
              .where((start >= 0) & (start + F.col("size") <= F.col("n")))
              .select("_k1", "_k2", "window", start.alias("start")).distinct())
    needed = places.join(broadcast_if(windows.select("window", "width", "shingles"), MOST_BROADCAST), "window").select(
        "_k1", "_k2", "window", "start", "width", F.size("shingles").alias("all"), F.posexplode("shingles").alias("offset", "h"))
    standing = (needed.withColumn("at", F.col("start") + F.col("offset"))
                .join(postings, ["_k1", "_k2", "width", "at", "h"])
                .groupBy("_k1", "_k2", "window", "start", "all").agg(F.count("*").alias("stand")).where("stand = all"))
    named = standing.join(broadcast_if(windows.select("window", "size", "items"), MOST_BROADCAST), "window")
    grouped = named.groupBy("_k1", "_k2").agg(F.collect_list(F.struct("start", "size", "items")).alias("ps"))
    return grouped.select(
        "_k1", "_k2",
        F.size(F.array_distinct(F.flatten(F.transform(
            "ps", lambda p: F.sequence(p["start"], p["start"] + p["size"] - 1))))).cast("bigint").alias("_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("ps", lambda p: p["items"])))).alias("_items"))


def decontaminate(docs: DataFrame, items: DataFrame, into: str = "contamination") -> DataFrame:
    """``docs`` with a struct: n_words, n_hit (words inside windows that occur), n_items, items_sha256,
    contaminated."""
    n_words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    own = docs.withColumns({"_k1": _keys()[0], "_k2": _keys()[1], "_n": n_words})
    found = hits(docs, items)
    if found is None:
        own = own.withColumns({"_hit": F.lit(0).cast("bigint"), "_items": F.array().cast("array<string>")})
    else:
        own = own.join(broadcast_if(stored(found, "hits"), MOST_BROADCAST), ["_k1", "_k2"], "left")
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    result = F.struct(
        F.col("_n").alias("n_words"), F.coalesce("_hit", F.lit(0)).alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("_hit", F.lit(0)) > 0).alias("contaminated"))
    return own.withColumn(into, result).drop("_k1", "_k2", "_n", "_hit", "_items")
