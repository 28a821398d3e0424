"""Personal data: base spans against plain patterns, added spans on planted cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from tickloom.llm import personal, queries
from tickloom.llm.common import table

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def stands(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [(m.start(), i, f"{k}:{m.start()}:{m.end()}", k) for i, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text or "") if stands(k, m.group())]
    spans.sort()
    return (*(sum(s[3] == k for s in spans) for k in BASE), hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest(), [s[2] for s in spans])


def same_as_plain(frame):
    for r in frame.select("text", "personal.*").collect():
        *counts, sha, spans = plain(r["text"])
        assert ([r[f"n_{k}"] for k in BASE], r["base_sha256"]) == (counts, sha), r["text"]
        assert [s for s in r["spans"].split(",") if s.split(":")[0] in BASE] == spans


def test_base_spans_of_random_texts(spark):
    r = random.Random(5)
    alphabets = ["a1.@+- ()5_", "0123456789 -", "1.25 ", "ab@.%_ é", "+1() .-9a", "😀1@a.b+ "]
    texts = ["".join(r.choice(a) for _ in range(r.randrange(0, 60))) for a in alphabets for _ in range(400)]
    texts += [None, "", " ", "x@y.z_w@v.u a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1", "4111 1111 1111 1111, 4111111111111112 +1 (487) 555-7209", "a@b.c\n"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = personal.find(docs.withColumns({n: F.lit("own") for n in ("personal", "features", "kind", "n", "c", "f", "v", "start")}))
    assert out.count() == len(texts)
    same_as_plain(out)


def test_base_spans_of_given_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = queries.op11_personal(spark, sf)
    assert out.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    same_as_plain(docs.join(out.select("doc_id", F.struct(*out.columns[1:]).alias("personal")), "doc_id"))


def test_very_long_texts(spark):
    """Whole texts of 300,000 letters in linear time; plain patterns are quadratic on some of them."""
    units = ["1.", "a@b.c ", "1 ", "+1 ", "4111111111111111 ", "@a", "Thomas Meyer. ", "+(", "Aa Bb "]
    same_as_plain(personal.find(spark.createDataFrame([(i, (u * 9_000)[:9_000]) for i, u in enumerate(units)], "doc_id long, text string")))
    units += ["x", "a.", "A1", "a@b.c"]
    rows = personal.find(spark.createDataFrame([(u, (u * 300_000)[:300_000]) for u in units], "unit string, text string")).collect()
    assert {r["unit"]: n for r in rows if (n := r["personal"]["n_email"])} == {"a@b.c": 30_000, "a@b.c ": 50_000}
    assert [r["personal"]["n_ip"] for r in rows if r["unit"] == "1."] == [37_500]


def test_empty_tables_and_texts_without_candidates(spark):
    schema = "doc_id long, text string"
    assert personal.find(spark.createDataFrame([], schema)).collect() == []
    rows = personal.find(spark.createDataFrame([(1, "nothing here"), (1, "nothing here"), (None, None)], schema)).collect()
    assert {r["personal"]["spans"] for r in rows} == {""} and len(rows) == 3
    assert {r["personal"]["base_sha256"] for r in rows} == {hashlib.sha256(b"").hexdigest()}


def test_added_spans_follow_the_labelers(spark):
    r = random.Random(9)
    filler = "the of and to in is that for it as was with be by on".split()

    def prose(n):
        return " ".join(r.choice(filler) for _ in range(n))

    rows = []
    for i in range(150):
        name = f"{r.choice(personal.GIVEN_NAMES)} {r.choice(['Miller', 'Okafor', 'Svensson', 'Rossi'])}"
        rows.append((f"{prose(6)} contact me: user{i}@mail{i % 7}.com or call +1 (41{i % 10}) 555-{1000 + i} {prose(4)}", None))
        rows.append((f"{prose(5)} my name is {name}, phone +44 20 7946 {1000 + i} {prose(4)}", f"name:{name}"))
        rows.append((f"{prose(5)} email user{i} [at] example [dot] org {prose(4)}", f"spelled_email:user{i} [at] example [dot] org"))
        rows.append((f"{prose(4)} ssn 21{i % 10}-4{i % 10}-{1234 + i} {prose(4)}", f"ssn:21{i % 10}-4{i % 10}-{1234 + i}"))
        rows.append((f"{prose(4)} my iban DE89370400440532013000 {prose(4)}", "iban:DE89370400440532013000"))
        rows.append((f"{prose(4)} Thention Ofthing {prose(3)} The Order {prose(3)} Grand Hotel {prose(3)}", ""))  # no one's name
        rows.append((f"{prose(4)} order DE{i % 90 + 10}370400440532013000 version 1.2.3.{300 + i} {prose(4)}", ""))
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], "doc_id long, text string, planted string")
    out = personal.find(docs).collect()
    same_as_plain(spark.createDataFrame(out))
    added = {row["doc_id"]: [f"{k}:{row['text'][int(a):int(b)]}" for k, a, b in (s.split(":") for s in row["personal"]["spans"].split(",") if s) if k not in BASE] for row in out}
    caught = [row["planted"] in added[row["doc_id"]] for row in out if row["planted"]]
    assert sum(caught) >= 0.95 * len(caught)
    wrong = [added[row["doc_id"]] for row in out if row["planted"] == "" and added[row["doc_id"]]]
    assert len(wrong) <= 0.01 * len(rows), wrong[:5]
