"""Operators on Spark: odd rows, empty tables, clashing names, and whole results against brute force."""

import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import decontaminate, jaccard, langid, licences, main_text, mixing, quality, queries, secret_scan, tokens, urls
from tickloom.llm.common import stored, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BODY = " ".join(f"w{i}" for i in range(60))
ODD = [
    (1, BODY, "en", "src0", 1), (2, BODY, "en", "src0", 1), (2, BODY, "en", "src0", 1), (3, BODY + " tail", None, None, None),
    (4, None, "en", "src1", None), (5, "", "de", "src1", 0), (6, " \n\t", "de", "src2", 3), (None, BODY, "fr", "src3", 2),
    (None, None, None, None, None), (7, "one two", "en", "src0", 7), (8, "one two", "fr", "src0", 7),
    (9, BODY + " password=abcdefgh", "en", "src4", 9), (10, "x " * 30_000, "en", "src0", 60_000),
]
# Names that the operators use inside or add.
CLASHES = ["counts", "kept", "rule", "secrets", "licence", "tokens", "language", "main", "contamination", "epoch", "domain",
           "n_tokens", "verdict", "host", "a", "b", "id", "label", "size", "words", "h", "n", "rep", "sig"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, " ".join(f"W{i}" for i in range(5, 30))), (2, "One, two!"), (3, None), (4, ""), (None, " ".join(f"w{i}" for i in range(40, 52))),
         (5, "nowhere to be found in any of these texts at all"), (1, " ".join(f"w{i}" for i in range(5, 30)))], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (10, None, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


def operators(spark, items, labels):
    texts = (("de", "der die und das " * 30), ("en", "the and of that " * 30))
    path = queries.VOCABULARY
    return {
        "language": lambda d: langid.identify(d, texts), "secrets": secret_scan.scan, "redact": secret_scan.redact,
        "quality": lambda d: quality.judge(d, quality.fit(d, labels)), "tokens": lambda d: tokens.count_tokens(d, path),
        "html": lambda d: main_text.main_text(d, html="text"), "urls": lambda d: urls.judge(d, url="text"),
        "licences": licences.scan, "decontaminate": lambda d: decontaminate.decontaminate(d, items),
    }


def test_every_row_stays_with_odd_rows_and_clashing_names(spark, odd, items, labels):
    wide = odd.withColumns({c: F.lit("own") for c in CLASHES})
    for name, f in operators(spark, items, labels).items():
        out = f(wide)
        rows = out.collect()
        assert len(rows) == len(ODD), name
        assert sorted((r["doc_id"] or 0) for r in rows) == sorted((r[0] or 0) for r in ODD), name
        assert set(wide.columns) <= set(out.columns), name
        assert len(out.columns) == len(set(out.columns)), name


def test_empty_tables(spark, odd, items, labels):
    none = odd.limit(0)
    for name, f in operators(spark, items.limit(0), labels.limit(0)).items():
        assert f(none).collect() == [], name
        assert f(odd).count() == len(ODD), name
    assert jaccard.classes(none, 4, 85).collect() == [] == jaccard.keep_one(none, 4, 85).collect()
    assert mixing.mix(none, F.lit("x"), {}, 0.5).collect() == []
    assert langid.training_texts(none) == ()


def test_base_rules_and_labels_without_contrast(spark, odd, labels):
    rows = {r["doc_id"]: r for r in quality.judge(odd, quality.fit(odd, labels)).collect()}
    assert [rows[i]["base_failed"] for i in (1, 4, 5, 6, 7, 10)] == [False, True, True, True, True, True]
    assert rows[1]["kept"] and not rows[10]["kept"]


def test_languages_learn_from_bounded_chunks(spark, sf):
    docs = table(spark, sf, "documents")
    texts = langid.training_texts(docs)
    assert texts == langid.training_texts(docs.repartition(7)) and {len(t) <= langid.CHARS for _, t in texts} == {True}
    assert langid.training_texts(docs.limit(20).withColumn("lang", F.lit(None).cast("string"))) == ()


def test_language_of_held_out_texts(spark):
    out = queries.op1_language(spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_learned_rules_on_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.op3_quality_rules(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in out if r["quality"] == 1], [r for r in out if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) and sum(not r["kept"] for r in bad) >= 0.8 * len(bad)


# -- urls --


def test_rules_win_by_length_and_reach_subdomains(spark):
    given = [
        ("http://a.org/x", "allow", "org/"), ("http://Example.ORG/es/1", "block", "example.org/es/"), ("https://w.example.org/en/12?q", "block", "example.org/en/1"),
        ("https://w.example.org/en/21#x", "allow", "org/"), ("http://x.com/fr/", "allow", "com/fr/"), ("http://x.com/de/?a", "block", "com/de/"),
        ("http://notexample.org/es/1", "allow", "org/"), ("http://x.com/de", "allow", None), ("http://a.org", "allow", None), (None, "allow", None), ("a.org/x", "allow", None),
    ]
    rows = urls.judge(spark.createDataFrame([(i, g[0]) for i, g in enumerate(given)], "page_id long, url string")).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"] if r["rule"] else "allow") for r in rows] == [(g[2], g[1]) for g in given]
    assert (rows[2]["host"], rows[2]["path"]) == ("w.example.org", "/en/12") and (rows[9]["host"], rows[10]["path"]) == ("", "")


def test_impure_templates_block_what_no_rule_fits(spark):
    rules = [("block", "s.net/a/1"), ("allow", "s.net/b/1")]
    rows = [(f"http://s.net/{b}/{d}{i}.html",) for b in "ab" for d in (1, 2) for i in range(40)]
    out = urls.judge(spark.createDataFrame(rows, "url string"), rules=rules).where("rule IS NULL").groupBy(F.substring("path", 1, 3).alias("p"), "verdict", "template").count().collect()
    assert {(r["p"], r["verdict"], r["count"]) for r in out} == {("/a/", "block", 40), ("/b/", "allow", 40)}
    assert {r["template"] for r in out} == {"s.net/a/*", "s.net/b/*"}


def test_similar_branches_are_merged(spark):
    rules = [("block", "s.net/a/"), ("block", "s.net/b/"), ("allow", "s.net/c/")]
    rows = [(f"http://s.net/{b}/{i}",) for b in "abc" for i in range(50)]
    out = urls.judge(spark.createDataFrame(rows, "url string"), rules=rules)
    assert {r["template"] for r in out.select("template").collect()} == {"s.net/{a,b}/*", "s.net/c/*"}


# -- Jaccard join --

LOWER = str.maketrans(decontaminate.UPPER, decontaminate.LOWER)


def plain_classes(rows, width, percent):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        n = min(width, len(words))
        sets.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is None:
            continue
        shared = defaultdict(int)
        for s in sets[i]:
            for j in inverted[s]:
                shared[j] += 1
            inverted[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and doc_id in first:
            parent[find(i)] = find(first[doc_id])
        first.setdefault(doc_id, i)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[find(i)] = min(lowest.get(find(i), doc_id), doc_id)
    return sorted((d if d is not None else -1, len(s), lowest[find(i)] if d is not None else -1) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def spark_classes(frame, width, percent):
    return sorted((r[0] if r[0] is not None else -1, r[1], r[2] if r[2] is not None else -1) for r in jaccard.classes(frame, width, percent).collect())


def test_jaccard_components_of_odd_rows(odd):
    rows = [(r[0], r[1]) for r in ODD]
    assert spark_classes(odd, 4, 85) == plain_classes(rows, 4, 85)
    kept = jaccard.keep_one(odd, 4, 85)
    assert kept.columns == odd.columns
    # 1 and 2 are copies, 3 and 9 near copies, 7 and 8 copies; rows without an id stay.
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 4, 5, 6, 7, 10]


@pytest.mark.parametrize("width,percent,few", [(4, 85, 24), (5, 80, 1)])
def test_jaccard_components_of_documents(spark, sf, monkeypatch, width, percent, few):
    monkeypatch.setattr(jaccard, "FEW", few)  # small groups list their pairs; larger ones join differences
    docs = table(spark, sf, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert spark_classes(docs, width, percent) == plain_classes(rows, width, percent)


@pytest.mark.parametrize("few", [1, 24])
def test_jaccard_of_chains_common_passages_and_repeated_ids(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard, "FEW", few)
    passage = [f"p{i}" for i in range(60)]
    base = [f"c{i}" for i in range(90)]
    rows = []
    for k in range(12):  # a chain: each is near its neighbours only
        rows.append((100 + k, " ".join(base[4 * k:] + [f"n{i}" for i in range(4 * k)])))
    for k in range(40):  # one passage, otherwise unlike; some with little of their own
        rows.append((200 + k, " ".join(passage + [f"o{k}x{i}" for i in range(2 + 3 * (k % 20))])))
    group = [f"g{i}" for i in range(150)]
    for k in range(30):  # one original, copies with few changes and copies with many
        words = list(group)
        for i in range(1 + 4 * (k % 3)):
            words[(13 * k + 29 * i) % 150] = f"e{k}x{i}"
        rows.append((500 + k, " ".join(words)))
    rows += [(300, "q " * 50), (300, rows[0][1]), (301, "q " * 50), (7, "q " * 50 + "z"), (400, rows[15][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for width, percent in ((4, 85), (5, 80)):
        assert spark_classes(frame, width, percent) == plain_classes(rows, width, percent)


def test_signatures_are_shared_by_all_linked_sets():
    import numpy as np
    rng = np.random.default_rng(5)
    checked = 0
    for trial in range(3000):
        size = int(rng.integers(1, 40 if trial % 2 else 600))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        drop = int(rng.integers(0, size // 8 + 1))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[: len(a) - drop]], rng.integers(0, 2**63, int(rng.integers(0, size // 8 + 1))).astype(np.uint64)]))
        frequent = a[: int(len(a) * rng.random() ** 3)]
        both = len(np.intersect1d(a, b))
        for percent in (80, 85):
            if 100 * both >= percent * (len(a) + len(b) - both) and both:
                s = jaccard.Signer(percent, frequent)
                assert set(s.signatures(a)) & set(s.signatures(b))
                checked += 1
    assert checked > 1500


# -- decontamination and mix against SQL --


def by_sql(name, **tables):
    con = duckdb.connect()
    for t, frame in tables.items():
        con.register(t, frame.toArrow())
    return sorted(map(str, con.execute(queries.SQL[name]).fetchall()))


def test_decontamination_of_odd_rows(odd, items):
    mine = decontaminate.decontaminate(odd, items)
    rows = {(r["doc_id"], r["text"]): r["contamination"] for r in mine.collect()}
    c = rows[1, BODY]
    assert (c["n_words"], c["n_hit"], c["n_items"], c["contaminated"]) == (60, 37, 2, True)
    assert rows[7, "one two"]["n_hit"] == 2 and rows[4, None] == rows[4, None].asDict() or rows[4, None]["n_words"] == 0
    assert rows[None, BODY]["n_hit"] == 37 and not rows[10, "x " * 30_000]["contaminated"]


@pytest.mark.parametrize("shuffled", [False, True])
def test_decontamination_against_sql(spark, sf, monkeypatch, shuffled):
    if shuffled:  # the way of item tables that are too large to broadcast
        monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 1)
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    mine = decontaminate.decontaminate(docs, bench).select("doc_id", "contamination.*")
    assert sorted(str(tuple(r)) for r in mine.collect()) == by_sql("op10_decontaminate", documents=docs, benchmark=bench)


def plain_mix(rows, domain_of, weights, share, epochs, seed):
    """Budgets by serving one unit level after another, then prefixes in the order of hashes."""
    import hashlib
    leaf_docs = defaultdict(list)
    for doc_id, text, lang, source in rows:
        leaf_docs[domain_of(source), lang or "", source or ""].append((doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))))
    room = {leaf: epochs * sum(n for _, n in d) for leaf, d in leaf_docs.items()}
    weight = lambda level, name: weights.get(level, {}).get(name, 1.0)

    def serve(budget, children):  # children: name -> (room, weight)
        given, open_ = dict.fromkeys(children, 0.0), {c for c, (r, w) in children.items() if w > 0}
        left = budget
        while open_ and left > 1e-9:
            total = sum(children[c][1] for c in open_)
            step = min([left / total] + [(children[c][0] - given[c]) / children[c][1] for c in open_])
            for c in open_:
                given[c] += step * children[c][1]
            left -= step * total
            open_ = {c for c in open_ if children[c][0] - given[c] > 1e-9}
        return given

    out = []
    total = sum(room.values()) / epochs
    of = lambda *key: sum(r for leaf, r in room.items() if leaf[:len(key)] == key)
    domains = sorted({x[0] for x in room})
    for d, b1 in serve(total * share, {x: (of(x), weight("domain", x)) for x in domains}).items():
        langs = sorted({x[1] for x in room if x[0] == d})
        for la, b2 in serve(b1, {x: (of(d, x), weight("language", x)) for x in langs}).items():
            sources = sorted({x[2] for x in room if x[:2] == (d, la)})
            for s, quota in serve(b2, {x: (room[d, la, x], weight("origin", x)) for x in sources}).items():
                docs, quota = leaf_docs[d, la, s], int(quota + 1e-6)
                tokens_ = sum(n for _, n in docs)
                if not tokens_:
                    continue
                full, rest = divmod(quota, tokens_)
                ordered = sorted((hashlib.md5(f"{seed}:{full + 1}:{i}".encode()).hexdigest(), i, n) for i, n in docs)
                sums = defaultdict(int)
                for h, _, n in ordered:
                    sums[h] += n
                upto, last = 0, set()
                for h in sorted(sums):
                    upto += sums[h]
                    if rest and upto <= rest:
                        last.add(h)
                for h, i, n in ordered:
                    out += [(i, d, n, e) for e in range(1, full + 1 + (h in last))]
    return sorted(out)


def test_mix_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents").withColumn("source", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("source")))
    domain = F.when(F.col("source").isin("src0", "src1"), "a").when(F.col("source").isin("src2"), "b").otherwise("c")
    domain_of = lambda s: "a" if s in ("src0", "src1") else "b" if s == "src2" else "c"
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    for weights, share, epochs in (({"domain": {"b": 9.0}}, 0.7, 2), ({"domain": {"a": 0.0}, "language": {"en": 0.5}}, 0.3, 3), ({}, 5.0, 2)):
        mine = mixing.mix(docs, domain, weights, share, epochs, 3).select("doc_id", "domain", "n_tokens", "epoch")
        assert sorted(map(tuple, mine.collect())) == plain_mix(rows, domain_of, weights, share, epochs, 3)


def test_mix_of_odd_rows(odd):
    out = mixing.mix(odd.withColumn("epoch", F.lit("own")), F.lit(None).cast("string"), {}, 1.0, 1, 1)
    assert {r["domain"] for r in out.collect()} == {""} and sum(r["n_tokens"] for r in out.collect()) <= 30_500


def test_queries_equal_their_sql(spark, sf):
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    mine = queries.op9_mix(spark, sf)
    assert sorted(str(tuple(r)) for r in mine.collect()) == by_sql("op9_mix", documents=docs, benchmark=bench)
    assert set(queries.SQL) <= set(queries.REGISTRY) and len(queries.REGISTRY) == 10


# -- pipeline --


def test_pipeline_stages_take_effect(spark, sf):
    docs = table(spark, sf, "documents")
    kept, rows = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept
        kept = stored(stage(spark, before, sf), name)
        rows[name] = kept
        if name != "source_mix":
            assert kept.columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scans", "source_mix"]
    quality_kept = [(r["doc_id"], r["text"]) for r in rows["quality_rules"].collect()]
    judged = {r["doc_id"] for r in queries.op3_quality_rules(spark, sf).where("kept").collect()}
    assert {i for i, _ in quality_kept} == judged
    lowest = {d for d, _, c in plain_classes(quality_kept, 5, 80) if d == c}
    assert {r["doc_id"] for r in rows["near_duplicates"].collect()} == lowest
    dirty = {r["doc_id"] for r in queries.op10_decontaminate(spark, sf).where("contaminated").collect()}
    assert {r["doc_id"] for r in rows["decontamination"].collect()} == lowest - dirty
    masked = rows["secret_scans"].collect()
    assert {r["doc_id"] for r in masked} == lowest - dirty
    assert not any(secret_scan.spans_of([r["text"] for r in masked])) and all(r["n_chars"] == len(r["text"]) for r in masked)
    assert {r["doc_id"] for r in rows["source_mix"].collect()} <= lowest - dirty
    whole = corpus_pipeline.run(spark, sf)
    assert sorted((r["doc_id"], r["epoch"]) for r in whole.collect()) == sorted((r["doc_id"], r["epoch"]) for r in rows["source_mix"].collect())


def test_token_counts_of_runs_of_spaces(spark):
    texts = spark.createDataFrame([(" a",), ("a     b",), ("",), (None,)], "text string").coalesce(1)
    assert [r["n"] for r in tokens.count_tokens(texts, queries.VOCABULARY).select(F.col("tokens.n_tokens").alias("n")).collect()] == [2, 3, 0, 0]


def test_paths_longer_than_the_tree_are_a_step_of_their_own(spark):
    rules = [("allow", "x.org/a/b/c"), ("block", "x.org/a/b/c/d")]
    paths = ["/a/b/c"] * 40 + ["/a/b/c/d/e"] * 40 + ["/a/b/z"] * 10
    rows = spark.createDataFrame([(i, f"http://x.org{p}") for i, p in enumerate(paths)], "id long, url string")
    got = {(r["path"], r["template"], r["purity"]) for r in urls.judge(rows, rules=rules).collect()}
    by = {p: (t, x) for p, t, x in got}
    assert len(got) == 3 and by["/a/b/c/d/e"][0] == by["/a/b/c"][0] + "/**"
    assert by["/a/b/c/d/e"][1] > 0.9 and by["/a/b/c"][1] < 0.1


def test_stages_with_odd_rows(spark, sf, odd):
    """Nulls, empty and very long texts, repeated rows and an empty table go through all five stages."""
    for docs in (odd, odd.limit(0)):
        before = docs
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            after = stage(spark, before, sf)
            rows = after.collect()
            if k + 1 < len(corpus_pipeline.STAGES):
                assert after.columns == docs.columns, name
                texts = [r["text"] for r in before.collect()]
                assert len(rows) <= len(texts), name
                if name != "secret_scans":
                    assert all(r["text"] in texts for r in rows), name
                else:
                    assert len(rows) == len(texts) and not any("abcdefgh" in (r["text"] or "") for r in rows)
            if not docs.head(1):
                assert rows == [], name
            before = stored(after, f"odd-{name}")
    kept = corpus_pipeline.near_duplicates(spark, odd, sf).collect()  # on its own: what the rules would have dropped
    assert sum(r["doc_id"] is None for r in kept) == 2 and sum(r["text"] is None for r in kept) == 2
    masked = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(spark, odd, sf).collect()}
    assert masked[4]["text"] is None and masked[4]["n_chars"] is None and masked[9]["text"].endswith("[assign]")


def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch):
    import numpy as np
    passage = "these eight words stand in some few documents"
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(7)) + (f" {passage}" if i % 1000 == 1 else "")) for i in range(9000)]
    rows += [(10_000 + i, "one text that comes many times over and over") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for counted in (jaccard.COUNTED, 1_500):  # one task, several
        monkeypatch.setattr(jaccard, "COUNTED", counted)
        found = np.frombuffer(jaccard.frequent_elements(frame, 4), np.uint64)
        expected = np.unique(jaccard.shingles(passage, 4) >> np.uint64(64 - jaccard.BUCKET_BITS))
        assert set(expected.tolist()) <= set(found.tolist()) and len(found) <= len(expected) + (counted < 9000) * 6


def test_only_texts_of_a_pair_travel(spark):
    rows = [(i, f"a b c d e{i}") for i in range(50)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.compared(spark.createDataFrame([(1, 2)], "a long, b long"), texts, 4)
    assert [(r.a, r.b, r.na, r.nb, len(r.d)) for r in found.collect()] == [(1, 2, 2, 2, 2)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2


def test_texts_travel_only_for_pairs_whose_sketches_may_link(spark, monkeypatch):
    import numpy as np

    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(f"u{i}x{k}" if random.random() < share else w for k, w in enumerate(base)))
            for i, share in enumerate([0.0, 0.005, 0.01, 0.02, 0.05, 0.2, 0.5, 1.0])]
    rows += [(9, " ".join(base)), (9, "one more text of the same document"), (10, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = sorted({i for i, _ in rows})
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if a < b], "a long, b long")
    texts = jaccard.texts_of(docs, docs.select("doc_id").distinct(), 4)
    sets = defaultdict(list)
    for i, text in rows:
        sets[i].append(set(jaccard.shingles(text, 4).tolist()))

    def links(a, b):
        return any(100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b])

    expected = {(a, b) for a in ids for b in ids if a < b and links(a, b)}
    kept = {tuple(r) for r in jaccard.possible(pairs, texts, 85).collect()}
    assert expected <= kept and not kept & {(0, 7), (6, 7), (5, 6), (0, 6)} and len(expected) > 3
    asked = []
    compared = jaccard.compared
    monkeypatch.setattr(jaccard, "compared", lambda p, *rest: asked.append(p.count()) or compared(p, *rest))
    assert {tuple(r) for r in jaccard.linked(pairs, texts, 4, 85).collect()} == expected
    assert asked == [len(kept)]
