"""N-gram Jaccard join by PartEnum signatures, and its components.

A document's set holds the hashes of its distinct shingles. Sizes fall into bands; linked sets have the
same band, or neighbouring ones, and a set near its band's lower end signs for the lower band too. Linked
sets of a band differ in at most k elements, so when the domain of hashes is cut into more than k parts,
some part holds the same elements in both: a signature is the band, a part and what the set has there.
Where k is small the domain is cut into k + 2 parts and every pair of parts is a signature, which two
linked sets must share too. Only the first k + 1 non-empty parts need to be signed: before the first
part on which both agree there are only parts on which they differ. Sets with at most k non-empty parts
also sign each element of their prefix (the first elements in one order of all, more than two linked sets
can differ by); two such sets are found by that.

Frequent elements (passages that many documents share) are left out of the parts and come last in the
order of prefixes. That is exact for any choice of them: two sets differ no more without them. They are
counted over all documents, by buckets of their hashes, which need no shuffle of elements.

Candidates whose sketches (numbers of elements by part of the domain) differ by more than linked sets can are
dropped before any text travels. The others are compared exactly, without listing all pairs of a group. The documents of a signature are
first compared with its lead, the one that shares signatures with most others; what is then in one
component needs no further comparison. Documents that are not linked with their lead are compared with
the others: in small groups all of these, in larger ones those that a prefix join of their differences
from the lead cannot rule out (``by_differences``; exact as well). Copies of one set are one class before
all that. Components are found by passing on smallest ids and jumping to the label's label, each round
written to the shared folder.

Sets are of 64-bit hashes, classes of 128 bits.

Defined results: null, empty and word-free texts have no shingles and link with nothing; fewer words than
a shingle are one; rows that share a doc_id are one document (a link of any is a link of all); a null
doc_id has a size and no component; an empty table gives an empty result; existing columns of the added
names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import broadcast_if, per_batch, per_pair, python_settings, stored

#: Highest ratio of sizes in a band; parts for each part that must agree (more parts leave few empty).
BAND, SPARE = 1.8, 1.25
#: Up to this k all pairs of k + 2 parts are signed.
PAIRS_UP_TO = 3
#: Highest bits of an element that are its bucket; the share of all texts, at least FREQUENT_LEAST, that makes a
#: bucket frequent, if it also has so many times the elements of an average bucket.
BUCKET_BITS, FREQUENT, FREQUENT_LEAST, FREQUENT_TIMES = 22, 0.0007, 5, 4
#: Documents of a counting task, where the input's parts are not larger; texts that it remembers as counted.
COUNTED, REMEMBERED = 16_384, 100_000
#: Up to so many documents under one signature are compared by listing their pairs.
FEW = 16
#: Share of a lead's documents whose difference has an element, from which that is put last.
COMMON = 0.2
#: Parts of a sketch, a power of two.
SKETCH = 512
#: Ids of documents (eight bytes each) that may be broadcast.
MOST_BROADCAST = 400_000

_ONE, _TWO, _THREE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray | np.uint64) -> np.ndarray | np.uint64:
    """Spreads 64-bit values (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _TWO
        x = (x ^ (x >> np.uint64(27))) * _THREE
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text: words are lower-cased (A-Z) runs without white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    n = min(width, len(words))
    key = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        key = _mixed(key * _ONE + h[i:len(words) - n + 1 + i])
    return np.unique(key)


class Signer:
    """Signatures for one threshold, in percent; ``frequent`` are elements without their lowest ``shift`` bits."""

    def __init__(self, percent: int, frequent: np.ndarray, shift: int = 0) -> None:
        self.percent, self.frequent, self.shift = percent, np.sort(frequent.astype(np.uint64)), np.uint64(shift)
        self.ratio = max(BAND, 110 / percent)
        self.starts = [1]

    def differ(self, a: int, b: int) -> int:
        """Most elements that linked sets of these sizes don't share."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def band(self, size: int) -> int:
        while self.starts[-1] <= size:
            self.starts.append(int(self.starts[-1] * self.ratio) + 1)
        return int(np.searchsorted(self.starts, size, "right")) - 1

    def signatures(self, s: np.ndarray) -> list[int]:
        size = len(s)
        if not size:
            return []
        rare = np.ones(size, bool)
        if len(self.frequent):
            bucket = s >> self.shift
            at = np.minimum(np.searchsorted(self.frequent, bucket), len(self.frequent) - 1)
            rare = self.frequent[at] != bucket
        band = self.band(size)
        out = self._of_band(s, rare, band, 100 * size // self.percent)
        if -(-self.percent * size // 100) < self.starts[band]:  # a smaller partner may be a band below
            out += self._of_band(s, rare, band - 1, self.starts[band] - 1)
        return np.array(out, np.uint64).astype(np.int64).tolist()

    def _of_band(self, s: np.ndarray, rare: np.ndarray, band: int, largest: int) -> list[np.uint64]:
        """``largest``: size of the largest partner."""
        top = self.starts[band + 1] - 1
        most, own = self.differ(top, 100 * top // self.percent), self.differ(len(s), largest)
        tag = np.uint64(xxhash.xxh3_64_intdigest(str(band)))
        pairs = most <= PAIRS_UP_TO
        parts = most + 2 if pairs else int(SPARE * (most + 1)) + 1
        e = s[rare]
        part = ((e & np.uint64(0xFFFFFFFF)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(part, kind="stable")
        part, e = part[order], _mixed(e[order] ^ tag)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(e) else np.empty(0, int)
        held = part[first]  # the non-empty parts
        sums = np.add.reduceat(e, first) if len(e) else e
        out: list[np.uint64] = []
        if pairs:
            whole = np.zeros(parts, np.uint64)
            whole[held.astype(int)] = _mixed(sums + (held + _ONE))
            i, j = np.triu_indices(parts, 1)
            full = (whole[i] != 0) | (whole[j] != 0)
            out += list(_mixed(whole[i] * _TWO + whole[j] * _THREE + (i * parts + j).astype(np.uint64) + tag)[full])
        else:
            out += list(_mixed(sums ^ _mixed(held + _ONE) ^ tag)[: own + 1])
        if len(held) <= (most if pairs else own):
            prefix = len(s) - -(-self.percent * len(s) // 100) + 1
            chosen = s[np.lexsort((s, ~rare))][:prefix]
            out += list(_mixed(chosen ^ ~tag))
        return out


@lru_cache(4)
def _signer(percent: int, frequent: bytes) -> Signer:
    return Signer(percent, np.frombuffer(frequent, np.uint64), 64 - BUCKET_BITS)


def _signed(width: int, percent: int, frequent: bytes):
    """A column function: size of the set, its fingerprint and its signatures."""

    def make() -> Callable[[list], list[tuple]]:
        signer = _signer(percent, frequent)

        def one(text: str | None) -> tuple:
            s = shingles(text, width)
            both = xxhash.xxh3_128_intdigest(s.tobytes())
            f1, f2 = (int(np.uint64(x).astype(np.int64)) for x in (both >> 64, both & (1 << 64) - 1))
            return len(s), f1, f2, signer.signatures(s)

        return lambda texts: [one(t) for t in texts]

    return per_batch(make, {"n": "long", "f1": "long", "f2": "long", "sigs": "longs"})


def _counted(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts the elements of a task's distinct texts by bucket, and sends those that have half a task's share of
    what is frequent: a bucket that is so over all is so in some task. Bucket -1 has the texts, -2 the elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, texts, seen = np.zeros(1 << BUCKET_BITS, np.int64), 0, set()
        for batch in batches:
            sets = []
            for text in batch.column(0).to_pylist():
                key = xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass"))
                if key not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    sets.append(shingles(text, width) >> np.uint64(64 - BUCKET_BITS))
            if sets:
                texts += len(sets)
                bucket, n = np.unique(np.concatenate(sets), return_counts=True)
                counts[bucket.astype(np.int64)] += n
        whole = int(counts.sum())
        some = np.flatnonzero(counts >= max(1.0, _least(texts, whole) / 2))
        out = {"bucket": np.concatenate([[-1, -2], some]), "n": np.concatenate([[texts, whole], counts[some]])}
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return run


def _least(texts: int, elements: int) -> float:
    """From how many elements of so many texts a bucket is frequent."""
    return max(FREQUENT * texts, FREQUENT_TIMES * elements / (1 << BUCKET_BITS))


def frequent_elements(docs: DataFrame, width: int) -> bytes:
    """Buckets of the elements that many of all texts have.

    A bucket in ``FREQUENT`` of the texts may miss up to half of these, from tasks where it is rarer; none below
    half is taken. Copies count once a task, of about ``COUNTED`` documents, so they alone are never frequent.
    """
    tasks = max(1, -(-docs.count() // COUNTED))
    found = docs.select("text").coalesce(tasks).mapInArrow(_counted(width), "bucket long, n long")
    sums = stored(found.groupBy("bucket").agg(F.sum("n").alias("n")), "jaccard-frequent")
    whole = {r["bucket"]: r["n"] for r in sums.where("bucket < 0").collect()}
    least = max(FREQUENT_LEAST, _least(whole.get(-1, 0), whole.get(-2, 0)) / 2)
    rows = sums.where((F.col("bucket") >= 0) & (F.col("n") >= least)).select("bucket").collect()
    return np.sort(np.array([r["bucket"] for r in rows], np.uint64)).tobytes()


def _sketched(width: int):
    """A column function: size of the set, and how many of its elements fall into each of ``SKETCH`` parts."""

    def make() -> Callable[[list], list[tuple]]:
        def one(text: str | None) -> tuple:
            s = shingles(text, width)
            parts = np.bincount((s & np.uint64(SKETCH - 1)).astype(np.int64), minlength=SKETCH)
            return len(s), np.minimum(parts, 255).astype(np.uint8).tobytes()

        return lambda texts: [one(t) for t in texts]

    return per_batch(make, {"n": "long", "parts": "binary"})


def _apart():
    """A column function of two sketches: at least so many elements are in only one of the sets."""

    def make() -> Callable[[bytes, bytes], tuple]:
        def least(a: bytes, b: bytes) -> tuple:
            x, y = (np.frombuffer(v, np.uint8).astype(np.int64) for v in (a, b))
            return (int(np.abs(x - y).sum()),)

        return least

    return per_pair(make, {"least": "long"})


def texts_of(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(doc_id, text) of the documents asked for, with the sketch of their sets, s."""
    asked = docs.select("doc_id", "text").join(broadcast_if(ids, MOST_BROADCAST), "doc_id", "left_semi")
    return stored(asked.dropDuplicates(["doc_id", "text"]).withColumn("s", _sketched(width)("text")), "jaccard-texts")


def possible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their sketches don't rule out, exactly: sets differ by no less than their sketches.

    Sketches are far smaller than texts, and most candidates end here. Where rows share a doc_id, any of them may.
    """
    def side(c: str) -> DataFrame:
        return texts.select(F.col("doc_id").alias(c), F.col("s.n").alias(f"n{c}"), F.col("s.parts").alias(f"s{c}"))

    both = pairs.select("a", "b").distinct().join(side("b"), "b").join(side("a"), "a").withColumn("d", _apart()("sa", "sb"))
    fits = (100 + percent) * F.col("d.least") <= (100 - percent) * (F.col("na") + F.col("nb"))
    return stored(both.where(fits).select("a", "b").distinct(), "jaccard-possible")


def _compared(width: int):
    """A column function of two texts: sizes of their sets, and what only the second has, then what it lacks."""

    def make() -> Callable[[str, str], tuple]:
        recent: dict[str, np.ndarray] = {}  # a lead stands beside many documents

        def set_of(text: str) -> np.ndarray:
            if text not in recent:
                if len(recent) >= 8:
                    del recent[next(iter(recent))]
                recent[text] = shingles(text, width)
            return recent[text]

        def compare(a: str, b: str) -> tuple:
            x, y = set_of(a), shingles(b, width)
            added, missing = (np.setdiff1d(*v, assume_unique=True) for v in ((y, x), (x, y)))
            return len(x), len(y), np.concatenate([added, missing]).astype(np.int64)

        return compare

    return per_pair(make, {"na": "long", "nb": "long", "d": "longs"})


def compared(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``pairs`` (a, b, ...) with the sizes of both sets, na and nb, and the elements d of only one.

    Texts travel, not sets: they compress, and hashes don't. Of each side only those in a pair do.
    """
    def side(c: str) -> DataFrame:
        ids = broadcast_if(pairs.select(F.col(c).alias("doc_id")).distinct(), MOST_BROADCAST)
        return texts.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias(c), F.col("text").alias(f"t{c}"))

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.withColumn("c", _compared(width)("ta", "tb")).select(*pairs.columns, "c.na", "c.nb", "c.d")


def linked(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    both = compared(possible(pairs, texts, percent), texts, width).withColumn("n", F.size("d"))
    return both.where(100 * (F.col("na") + F.col("nb") - F.col("n")) >= percent * (F.col("na") + F.col("nb") + F.col("n"))).select("a", "b").distinct()


def _most(size: Column, other: Column, percent: int) -> Column:
    """Most elements that linked sets of these sizes don't share."""
    return F.floor((100 - percent) * (size + other) / (100 + percent))


def by_differences(group: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Candidate pairs (a, b) among the documents of each lead, by what sets them off from it.

    ``group`` has lead, id and label of its documents; those with another label than the lead (not linked
    with it) are the seekers. With the differences d(x) from the lead, two sets differ in
    |d(x)| + |d(y)| - 2 |d(x) and d(y)| elements. Linked sets differ in at most k, so their differences
    share at least t = (|d(x)| + |d(y)| - k) / 2 elements: in one order within the group, one of the first
    |d| - t + 1 of each. Where t is not over 0, sizes alone decide.
    """
    wide = compared(group.select(F.col("lead").alias("a"), F.col("id").alias("b"), "label", "seeks"), texts, width)
    rows = stored(wide.select(
        F.col("a").alias("lead"), F.col("b").alias("id"), "label", "seeks",
        _most(F.col("nb"), F.floor(100 * F.col("nb") / percent), percent).alias("k"),
        # A seeker that may be linked with this document differs from the lead by more than that.
        _most(F.ceil(percent * F.col("nb") / 100), F.col("na"), percent).alias("near"), "d"), "jaccard-differences")
    rows = rows.withColumn("n", F.size("d"))

    def prefix(partner: Column) -> Column:
        """Of a document whose partner's difference has at least that many elements."""
        share = F.ceil((F.col("n") + F.greatest(partner, F.col("n") - F.col("k")) - F.col("k")) / 2)
        return F.col("n") - F.greatest(share, F.lit(1)) + 1

    # The order: what a document adds, which is rarely shared, then what it lacks. Where the lead is a changed
    # copy itself, all others have the same differences from it: these last.
    near = rows.where(F.col("n") <= 2 * F.col("k"))
    counted = near.select("lead", F.explode("d").alias("e")).groupBy("lead", "e").agg(F.count("*").alias("c"))
    common = (counted.join(near.groupBy("lead").agg(F.count("*").alias("m")), "lead")
              .where((F.col("c") >= 3) & (F.col("c") >= COMMON * F.col("m")))
              .groupBy("lead").agg(F.collect_list("e").alias("common")))
    shared = F.coalesce("common", F.array().cast("array<bigint>"))
    ordered = F.concat(F.array_except("d", shared), F.array_intersect("d", shared))
    longest = F.greatest(prefix(F.col("near") + 1), F.when(F.col("seeks"), prefix(F.lit(0))).otherwise(0), F.lit(0))
    kept = rows.join(common, "lead", "left").withColumn("d", F.slice(ordered, 1, longest.cast("int")))
    kept = stored(kept.select("lead", "id", "label", "seeks", "k", "near", "n", F.posexplode("d").alias("at", "e"))
                  .withColumn("at", F.col("at") + 1), "jaccard-prefixes")
    names = ["id", "label", "k", "n", "at"]
    seekers = kept.where(F.col("seeks") & (F.col("at") <= prefix(F.lit(0)))).select("lead", "e", *names)
    others = kept.where(F.col("at") <= prefix(F.col("near") + 1)).select("lead", "e", *(F.col(c).alias(f"{c}2") for c in names))
    k, n = F.least("k", "k2"), F.col("n") + F.col("n2")
    rest = 1 + F.least(F.col("n") - F.col("at"), F.col("n2") - F.col("at2"))  # shared elements at most
    met = seekers.join(others, ["lead", "e"]).where((F.col("label") != F.col("label2")) & (2 * rest >= n - k))
    # Differences so small that they need share nothing.
    small = rows.where(F.col("seeks") & (F.col("n") <= F.col("k"))).select("lead", *names[:-1])
    close = rows.where(F.col("n") + F.col("near") < F.col("k")).select("lead", *(F.col(c).alias(f"{c}2") for c in names[:-1]))
    apart = small.join(close, "lead").where((F.col("label") != F.col("label2")) & (n <= k))
    both = met.select("id", "id2").union(apart.select("id", "id2"))
    return both.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id that each id of an edge reaches."""
    edges = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = edges.join(labels, edges["b"] == labels["id"]).select(F.col("a").alias("id"), "label")
        lower = stored(near.union(labels).groupBy("id").agg(F.min("label").alias("label")), "labels")
        parents = lower.select(F.col("id").alias("label"), F.col("label").alias("top"))
        jumped = stored(lower.join(parents, "label").select("id", F.col("top").alias("label")), "labels")
        before = labels.select("id", F.col("label").alias("old"))
        if jumped.join(before, "id").where("label < old").isEmpty():
            return jumped
        labels = jumped


def classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs``."""
    python_settings(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    frequent = frequent_elements(docs, width)
    rows = stored(docs.select("doc_id", _signed(width, percent, frequent)("text").alias("d")).select("doc_id", "d.*"), "jaccard-rows")
    usable = rows.where("n > 0 AND doc_id IS NOT NULL")
    copies = stored(usable.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
                    .where("rep < last").select("f1", "f2", "rep"), "jaccard-copies")
    named = usable.join(copies, ["f1", "f2"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))

    # Documents that share a signature, and among them the one that shares most: the lead.
    signed = named.where("doc_id = rep").select(F.explode("sigs").alias("sig"), F.col("rep").alias("id"))
    under = Window.partitionBy("sig")  # one shuffle of all signatures; most are of one document
    shared = signed.withColumn("alone", F.min("id").over(under) == F.max("id").over(under)).where("NOT alone")
    members = stored(shared.select("sig", "id").distinct(), "jaccard-members")
    members = members.join(members.groupBy("sig").agg(F.count("*").alias("size")), "sig")
    weight = stored(members.groupBy("id").agg(F.sum("size").alias("w")), "jaccard-weights")
    leads = members.join(weight, "id").groupBy("sig").agg(F.max(F.struct("w", (-F.col("id")).alias("id"))).alias("l"))
    members = stored(members.join(leads.select("sig", (-F.col("l.id")).alias("lead")), "sig").where("id <> lead"), "jaccard-members")
    pairs = stored(members.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "jaccard-pairs")
    texts = texts_of(docs, weight.select(F.col("id").alias("doc_id")), width)
    edges = stored(linked(pairs, texts, width, percent), "jaccard-links")
    # Rows that share a doc_id are one document.
    several = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").select("doc_id", "a")
    same = named.select("doc_id", F.col("rep").alias("b")).join(several, "doc_id").where("a < b").select("a", "b")
    edges = stored(edges.union(same).distinct(), "jaccard-links")
    labels = components(edges)

    # Under one signature, documents of other components than the lead: they are compared with the rest.
    led = members.join(labels, "id", "left").join(labels.withColumnsRenamed({"id": "lead", "label": "lead_label"}), "lead", "left")
    led = led.select("sig", "lead", "id", "size", F.coalesce("label", "id").alias("label"), F.coalesce("lead_label", "lead").alias("lead_label"))
    led = led.withColumn("seeks", F.col("label") != F.col("lead_label"))
    open_ = led.where("seeks").select("sig").distinct()
    led = stored(led.join(open_, "sig", "left_semi"), "jaccard-led")
    few = led.where(F.col("size") <= FEW)
    mate = few.select("sig", F.col("id").alias("id2"), F.col("label").alias("label2"))
    listed = few.where("seeks").join(mate, "sig").where("label <> label2").select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b"))
    many = led.where(F.col("size") > FEW).select("lead", "id", "label", "seeks").distinct()
    more = listed.union(by_differences(many, texts, width, percent)).distinct()
    more = stored(linked(stored(more, "jaccard-pairs"), texts, width, percent), "jaccard-links")
    if not more.isEmpty():
        labels = components(edges.union(more))

    found = rows.select("doc_id", "n", "f1", "f2").join(copies, ["f1", "f2"], "left")
    node = F.when(F.col("n") > 0, F.coalesce("rep", "doc_id"))
    return (found.withColumn("id", node).join(labels, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "id", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id.

    Of rows that share a doc_id one stays; those without one, or without words, are kept.
    """
    found = stored(classes(docs, width, percent).where("doc_id IS NOT NULL"), "jaccard-classes")
    dropped = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-dropped")
    kept = docs.join(broadcast_if(dropped, MOST_BROADCAST), "doc_id", "left_anti")
    repeated = stored(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "jaccard-repeated")
    if not repeated.isEmpty():
        repeated = broadcast_if(repeated, MOST_BROADCAST)
        one = (kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id")
               .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("r")).select("r.*"))
        kept = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    return kept.select(*docs.columns)
