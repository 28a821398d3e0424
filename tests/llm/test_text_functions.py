"""Per-text functions against plain brute force, without Spark."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

from tickloom.llm import langid, licences, main_text, quality, secret_scan, tokens

ODD = ["", " ", "\n\n", "é", "a", "ꙮ x y", "word " * 40_000, "\t\x0b\x0c\r x", "日本語 テスト"]


# -- secrets --


def full_scan(text):
    found = []
    for order, (kind, (pattern, least, group)) in enumerate(secret_scan.RULES.items()):
        if kind == "hex":
            pattern, least, group = r"[0-9a-f]+", 32, 0
        for m in re.finditer(pattern, text or ""):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), order, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(found)]


SECRETS = [
    'x Password = "abcd1234" y', "API-KEY=zzzzzzzz", "apikey:abcdefgh api_key='abcdefgh'", "token=short", "tokentoken = 12345678",
    "AKIA" + "A" * 11, "AKIA" + "A" * 12, "AKIAKIA" + "B" * 20, "f" * 31, "f" * 32, "F" * 40, "0" * 64 + " " + "a" * 33,
    "é" * 10 + "secret:é secret: abcdefgh", "ſecret=abcdefgh", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----",
    "ghp_" + "a" * 36, "xoxb-1234567890", "AIza" + "x" * 35, "sk_live_" + "1" * 16, "eyJabcdefgh.eyJabcdefgh.abcdefgh", "password==12345678",
]


def test_index_finds_what_a_full_scan_finds():
    texts = [None, *ODD, *SECRETS, " ".join(SECRETS), "\n".join(SECRETS) * 3]
    assert secret_scan.spans_of(texts) == [full_scan(t) for t in texts]
    assert [len(s) for s in secret_scan.spans_of(["token=abcdefgh", "token=abcdefg"])] == [1, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*SECRETS, "a", " ", "\n", "=", "é", "AKIA", "0123456789abcdef"]), max_size=6).map("".join), max_size=5))
def test_index_finds_all_in_mixtures(texts):
    assert secret_scan.spans_of(texts) == [full_scan(t) for t in texts]


@pytest.mark.parametrize("pattern,query", [
    ("abcd", ("and", [("tri", b"abc"), ("tri", b"bcd")])), ("[0-9a-f]+", None), ("ab", None), ("(abc|xy)", None),
    ("(?:abc|bcd)e*", ("or", [("tri", b"abc"), ("tri", b"bcd")])), ("x*abc", ("tri", b"abc")), ("(abc)+", ("tri", b"abc")), ("(abc)*", None),
])
def test_trigram_queries(pattern, query):
    assert secret_scan.trigram_query(pattern) == query


def test_masking_joins_overlaps():
    text = "a password=0123456789abcdef0123456789abcdef b"
    (spans,) = secret_scan.spans_of([text])
    assert [k for k, _, _ in spans] == ["assign", "hex"]
    assert secret_scan._masked(text, spans) == "a [assign] b"


LINES = ["MIIEowIBAAKCAQEAx" + c * 47 for c in "QVZ"] + ["qL9+/w=="]
LABELS = ["RSA PRIVATE KEY", "PRIVATE KEY", "OPENSSH PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "PGP PRIVATE KEY BLOCK"]


@pytest.mark.parametrize("label", LABELS)
@pytest.mark.parametrize("sep", ["\n", "\r\n", "\\n", "\n    ", "\n> ", '\\n"\n"', " "])
@pytest.mark.parametrize("headers", [[], ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", ""], ["Version: X 1", ""]])
def test_no_letter_of_a_private_key_survives(label, sep, headers):
    begin, end = f"-----BEGIN {label}-----", f"-----END {label}-----"
    key = sep.join([begin, *headers, *LINES, end])
    (out,) = secret_scan._redacted()([f"before\n{key}\nafter that"])
    assert out[0] == "before\n[pem]\nafter that"
    if sep != " ":  # without its END line; on one line a header has no end and a short run may be a word
        (out,) = secret_scan._redacted()([f"before\n{sep.join([begin, *headers, *LINES])}\n\nafter that"])
        assert out[0].startswith("before\n[pem]") and out[0].endswith("\n\nafter that")
        assert not any(line in out[0] for line in LINES)


def test_private_keys_end_where_they_end():
    rsa, ec = "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----"
    body, rsa_end, ec_end = "\n".join(LINES), "-----END RSA PRIVATE KEY-----", "-----END EC PRIVATE KEY-----"
    texts = [
        f"{rsa}\n{body}\n{rsa_end} and {ec}\n{body}\n{ec_end}.", f"{rsa}\n{body}\nplain words here {ec}\n{body}\n{ec_end}.",
        f"{rsa} is a header", f"{rsa}\n{body}", f"-----BEGIN CERTIFICATE-----\n{body}\n-----END CERTIFICATE-----",
        f"{rsa}\n{LINES[0]}...", f"{rsa}{LINES[0]}", f"{rsa}\n{body}\n\nPlain words\n\n-- x", f"token={rsa}\n{body}\n{rsa_end}",
    ]
    assert [t for t, _ in secret_scan._redacted()(texts)] == [
        "[pem] and [pem].", "[pem]\nplain words here [pem].", "[pem] is a header", "[pem]", texts[4],
        "[pem]...", "[pem]", "[pem]\n\nPlain words\n\n-- x", "[assign]",
    ]
    query = secret_scan.trigram_query(secret_scan.RULES["pem"][0])  # both parts are mandatory
    assert query[0] == "and" and {b"beg", b"pri", b"key"} <= secret_scan._grams(query)


def test_many_open_private_keys_are_fast():
    header = "-----BEGIN RSA PRIVATE KEY-----"
    for filler in ("", "\n", "\n\n  ", " - ", "\nab cd\n", "\n" + "A" * 64):
        text = (header + filler) * 5_000
        assert secret_scan.spans_of([text])[0][0][0] == "pem"
    for filler in ("\n", " \n", ' "', "-", "a\n", "\\", "\\n", "A" * 15 + " \n"):
        assert secret_scan.spans_of([header + filler * 100_000 + "!"])[0][0][0] == "pem"


# -- quality counts --


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside |= set(range(i, i + 5))
    lines, dup, earlier = (text or "").split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in earlier
            earlier.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t\x1c é#|<", max_size=80))
def test_counts(text):
    assert quality.counts_of(text)[:5] == plain_counts(text)


def test_counts_of_odd_texts():
    for t in [None, *ODD, "a b c d e a b c d e", "a b c d e f " * 3, "x\nx\nx \n x"]:
        assert quality.counts_of(t)[:5] == plain_counts(t), t


def test_learner_finds_planted_rules_and_spares_good_rows():
    rng = np.random.default_rng(3)
    values = {"x": rng.random(3000), "y": rng.random(3000), "z": rng.random(3000)}
    bad = (values["x"] > 0.9) | ((values["y"] < 0.2) & (values["z"] > 0.7))
    rules = quality.learn(values, bad)
    hit = np.zeros(3000, bool)
    for r in rules:
        hit |= quality._covers(r, values, 3000)
    assert (hit & bad).sum() > 0.9 * bad.sum() and (hit & ~bad).sum() <= 0.02 * (~bad).sum()
    assert quality.learn(values, np.zeros(3000, bool)) == [] == quality.learn(values, np.ones(3000, bool))
    assert quality.learn({k: v[:0] for k, v in values.items()}, bad[:0]) == []


def test_learner_takes_no_rule_from_noise():
    rng = np.random.default_rng(4)
    assert quality.learn({"x": rng.random(2000)}, rng.random(2000) < 0.1) == []


# -- licences --


def plain_licence(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at, labels = [], set()
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        at += own
        labels |= {label} if own else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


@pytest.mark.parametrize("text", [
    None, *ODD, "MIT License", "mit-license MIT/LICENSE", "the gnu GENERAL public license; CC BY CC-BY cc by", "cc bylaw", "xmit license",
    "Licensed under CC BY-NC 4.0.", "mit\n\nlicense " * 3, "apache licenseé", "école cc by",
])
def test_licence_base(text):
    assert licences.scan_text(text)[:5] == plain_licence(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["mit", "License", "cc", "BY", "gnu", "general", "public", "license", "-", "\n", "é"]), max_size=20))
def test_licence_base_of_mixtures(parts):
    for sep in (" ", ""):
        assert licences.scan_text(sep.join(parts))[:5] == plain_licence(sep.join(parts))


@pytest.mark.parametrize("expression,freedom,labels", [
    ("MIT", 0.95, {"mit"}), ("MIT OR GPL-3.0", 0.95, {"mit", "gpl-3.0"}), ("MIT AND GPL-3.0", 0.4, {"mit", "gpl-3.0"}),
    ("MIT OR Apache-2.0 AND GPL-2.0", 0.95, {"mit", "apache-2.0", "gpl-2.0"}), ("(MIT OR Apache-2.0) AND GPL-2.0", 0.4, {"mit", "apache-2.0", "gpl-2.0"}),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR Foo", 0.5, {"gpl-2.0", "foo"}), ("MIT */", 0.95, {"mit"}), ("MIT is", 0.95, {"mit"}), ("((MIT))", 0.95, {"mit"}),
])
def test_licence_expressions(expression, freedom, labels):
    value = licences.evaluate(expression)
    assert value[0] == pytest.approx(freedom) and value[1] == labels


@pytest.mark.parametrize("text, labels", [
    ("Licensed under the BSD 3-Clause License. Apache-2.0. GPLv3. Creative Commons Attribution 4.0 International.",
     "apache,bsd,cc-by,gpl"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "cc-by-nc-sa"),
    ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"), ("CC BY-NC-ND", "cc-by,cc-by-nc-nd"),
    ("under the MIT licence or LGPLv3", "lgpl,mit"), ("GNU General Public Licence", "gpl"),
    ("GNU Lesser General Public License", "lgpl"), ("apache 2, gplv, bsd clause, attribution", ""),
    ("SPDX-License-Identifier: MIT OR GPL. All rights reserved, LGPLv3", "gpl,lgpl,mit,reserved"),
    ("creative commons attribution. creative commons attribution share alike", "cc-by,cc-by-sa"),
])
def test_licence_names(text, labels):
    found = licences.scan_text(text)
    assert found[5] == labels
    assert found[:5] == plain_licence(text)
    assert found[6] == min((licences.freedom(name) for name in labels.split(",") if name), default=0.0)


def test_names_in_a_tags_expression_are_no_notices():
    found = licences.scan_text("# SPDX-License-Identifier: (MIT OR GPLv3)\nfree of charge")
    assert found[5:] == ("gplv3,mit", licences.freedom("mit"))
    assert licences.scan_text("SPDX-License-Identifier: OR GPLv3")[5] == "gpl"  # nothing well formed to read


def test_licence_expressions_without_a_value():
    assert [licences.evaluate(e) for e in ("", "(MIT", ") MIT", "AND MIT", "*")] == [None] * 5
    found = licences.scan_text("x\n# SPDX-License-Identifier: MIT OR GPL-3.0\nMIT license")
    assert found[4:6] == ("mit", "gpl-3.0,mit") and found[6] == pytest.approx(0.95)
    assert licences.scan_text("all rights reserved")[4:] == ("", "reserved", 0.0)


# -- tokens --

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    pieces, unknown, _ = tokens.read_vocabulary(PATH)
    low = unknown + tokens.UNKNOWN_PENALTY
    vocabulary = [("<unk>", low), *((f"<0x{i:02X}>", low) for i in range(256)), *pieces]
    t = Tokenizer(models.Unigram(vocabulary, 0, True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.read_vocabulary(PATH))


def test_token_counts_of_odd_texts(tokenizer, counter):
    for t in [*ODD, "  two  spaces ", "a\nb\n\n c", "▁", "ꙮꙮ", "Hello, world! 123", "x" * 3000]:
        assert counter.text(t)[0] == len(tokenizer.encode(t).ids), t
    assert counter.text(None) == (0, 0.0)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abcdeth noi\n▁éßꙮ日,.", max_size=40))
def test_token_counts(tokenizer, counter, text):
    assert counter.text(text)[0] == len(tokenizer.encode(text).ids)


def test_unknown_letters_without_bytes_count_by_runs():
    c = tokens.Counter(([("▁", -1.0), ("▁a", -1.5), ("a", -1.0), ("aa", -2.0)], -12.0, False))
    assert [c.text(t)[0] for t in ("a", "aaa", "xx", "axxa", "a x")] == [1, 2, 2, 3, 3]
    c.known.clear()
    assert c.word("▁aa") == (2, -2.5)


@pytest.fixture(scope="module")
def unsplit():
    """The whole text as one stretch: a mark before it, each space a mark."""
    pieces, unknown, _ = tokens.read_vocabulary(PATH)
    low = unknown + tokens.UNKNOWN_PENALTY
    t = Tokenizer(models.Unigram([("<unk>", low), *((f"<0x{i:02X}>", low) for i in range(256)), *pieces], 0, True))
    t.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    return t


@pytest.fixture(scope="module")
def whole():
    return tokens.Counter(tokens.read_vocabulary(PATH), split=False)


def test_runs_of_spaces_count_by_their_pieces(unsplit, whole):
    code = "def f(x):\n    if x:\n        return   x\n\n\t  y  =    1\n"
    for t in [*ODD, " a", "  a", "a   b", "a" + " " * 16 + "b", "a" + " " * 40 + "b ", code, "| a   |    b |\n" * 20, "▁ ▁", " \n  \n   a", " " * 3000]:
        assert whole.text(t)[0] == len(unsplit.encode(t).ids), t
    assert [whole.text(t)[0] for t in (" a", "a     b", "")] == [2, 3, 0]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="   abcdeth noi\n▁éßꙮ日,.", max_size=60))
def test_token_counts_of_whole_texts(unsplit, whole, text):
    assert whole.text(text)[0] == len(unsplit.encode(text).ids)


def test_pieces_across_words_are_not_cut():
    c = tokens.Counter(([("▁", -1.0), ("a", -1.0), ("a▁a", -1.0), ("▁a", -1.5)], -12.0, False), split=False)
    assert c.text("a a") == (2, -2.0)
    c = tokens.Counter(([("a", -1.0)], -12.0, False), split=False)  # the mark is unknown too
    assert [c.text(t)[0] for t in ("x x", "a a")] == [1, 4]


# -- main text --

LONG = "word " * 60


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<", "<"), ("<p>One", "One"), ("<p>a &lt; b<br>c &amp;&nbsp;d", "a < b c & d"), ("<!-- x --><p>y<!-- open", "y"),
    ("<p>x<script>var a = '<p>no</p>';</script>y</p><style>p{}</style>", "x y"), ("<script>never closed", ""),
    ("<article><h1>A</h1><p><b>b<br><p>c</p></article><footer>&copy; f</footer>", "A\nb\nc"),
    ("<nav><a href=x>m</a></nav><main><p>t</p><div class='comments'><p>no</p></div><p>u</p></main><aside>s</aside>", "t\nu"),
    ("<article><p>t</p><section id=\"comment-list\"><article><p>no</p></article></section></article>", "t"),
    (f"<div id=menu><ul><li><a href=x>m</a></ul></div><div><h1>T</h1><p>{LONG}</p><p>End.</p></div><div class=cookie-notice>ok</div>", f"T\n{LONG.strip()}\nEnd."),
    (f"<div><p>{LONG}</p></div><form><p>{LONG}no</p></form><div role='banner'>no</div><p hidden>no</p>", LONG.strip()),
    ("<a href='a>b'>x</a>", ""), ("<article><header><h1>T</h1></header><p>x</p></article><header>no</header>", "T\nx"),
    ("<p>\n a \t b c </p><p> </p>", "a b c"), ("<article></article><p>x</p>", "x"),
])
def test_main_text(html, text):
    assert main_text.extract(html) == text


MENU = "<div><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>"


@pytest.mark.parametrize("html,text", [
    (f"{MENU}<h1>Title</h1><p>By X</p><p>1 May</p><p>{LONG}</p>", f"Title\nBy X\n1 May\n{LONG.strip()}"),
    (f"<body>{MENU}<div><h1>Title</h1><p>By X</p><p>1 May</p><p>{LONG}</p></div></body>", f"Title\nBy X\n1 May\n{LONG.strip()}"),
    (f"<div><p>{LONG}</p><div class=ad>a</div><div class=ad>b</div><p class=promo>c</p><p>So.</p><p>End.</p></div><div><p>no</p></div>",
     f"{LONG.strip()}\nSo.\nEnd."),
    (f"<div><p>{LONG}</p><p><a href=x>See the list of all</a></p><ul><li>One<li><a href=x>Two</a></ul><p>End.</p></div>",
     f"{LONG.strip()}\nSee the list of all\nOne\nTwo\nEnd."),
    (f"<div><h1>T</h1><p>A</p><p>B</p><p>C</p><p>{LONG}</p><nav><a href=x>m</a></nav><footer>f</footer></div>{MENU}", f"T\nA\nB\nC\n{LONG.strip()}"),
    (f"<div><p>{LONG}</p><div><div><p><a href=x>inner</a></p></div></div></div><div><a href=x>outer</a></div>", f"{LONG.strip()}\ninner"),
])
def test_unmarked_pages_keep_all_of_the_text_s_container(html, text):
    assert main_text.extract(html) == text


def test_main_text_of_broken_markup_is_fast():
    main_text.extract("<a \"" * 20_000 + "<p>x" + "<div>" * 20_000)


# -- languages --


def longest(text, at, training):
    n = 0
    while at + n < len(text) and text[at:at + n + 1] in training:
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc ", min_size=1, max_size=40), st.text(alphabet="abcd ", min_size=1, max_size=60))
def test_cross_parsing(training, text):
    if not any(map(str.isalpha, training)):
        return
    model = langid.Model((("x", training),))
    squeeze = lambda t: re.sub(" +", " ", t)
    # Letters outside the training text are one symbol, as "d" is here.
    plain, known = squeeze(text), squeeze(training)
    at = count = 0
    while at < len(plain):
        at += max(1, longest(plain, at, known))
        count += 1
    assert model.phrases([model.symbols(langid._codes(text))])[0, 0] == count


def test_prediction_of_odd_texts():
    model = langid.Model((("de", "der die und nicht " * 50), ("en", "the and with that " * 50)))
    texts = [None, "", "123 !?", "the", "DIE UND", "the and " * 20_000, "ꙮ"]
    out = model.predict(texts)
    assert [o[0] for o in out[:6]] == ["und", "und", "und", "en", "de", "en"] and out[6][0] in ("de", "en")
    assert all(0 <= s <= 1 for _, s in out) and model.predict([]) == []
    assert langid.Model(()).predict(["the"]) == [("und", 0.0)]


@settings(max_examples=40, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(1, 400))
def test_cross_parsing_over_many_letters(random, letters):
    draw = lambda n: "".join(chr(0x4E00 + random.randrange(letters)) for _ in range(n))
    trained = [(name, draw(random.randrange(1, 300))) for name in "xyz"]
    model = langid.Model(tuple(trained))
    texts = [draw(random.randrange(1, 300)) + random.choice(["", "a"]) + trained[0][1][5:40] for _ in range(3)]
    got = model.phrases([model.symbols(langid._codes(t)) for t in texts])
    for i, text in enumerate(texts):
        for j, (_, known) in enumerate(trained):
            at = count = 0
            while at < len(text):
                if at % langid.STRETCH == 0 and at:
                    break
                at += max(1, longest(text[:langid.STRETCH], at, known))
                count += 1
            assert got[i, j] == count


def test_languages_of_large_and_several_alphabets():
    rng = np.random.default_rng(5)

    def language(first, letters):  # words of one script, the common ones often
        words = ["".join(chr(first + int(c)) for c in rng.integers(0, letters, rng.integers(1, 4))) for _ in range(600)]
        return lambda n: " ".join(words[int(599 * x ** 2)] for x in rng.random(n))

    # Two languages over the same 3,000 ideographs, two over the same syllables, then alphabets beside Latin.
    spoken = {
        "zh": language(0x4E00, 3000), "yue": language(0x4E00, 3000), "ko": language(0xAC00, 1500), "ko2": language(0xAC00, 1500),
        "ru": language(0x430, 32), "el": language(0x3B1, 24), "ar": language(0x627, 26), "he": language(0x5D0, 26), "hi": language(0x905, 50),
        "ka": language(0x10D0, 33), "hy": language(0x561, 38), "th": language(0xE01, 46), "am": language(0x1200, 250), "en": language(0x61, 26),
    }
    model = langid.Model(tuple((name, f(4_000)) for name, f in sorted(spoken.items())))
    for name, f in spoken.items():
        assert [p for p, _ in model.predict([f(8) for _ in range(25)])].count(name) >= 24, name


# -- main text of ordinary layouts --

LONG = "Plenty of words make this paragraph long enough to surge over the threshold of the windows, says its author."
SIX = "".join(f"<p>{LONG} {i}</p>" for i in range(6))
WHOLE = "\n".join(["Title", *(f"{LONG} {i}" for i in range(6))])


@pytest.mark.parametrize("page", [
    f'<body><article class="post has-sidebar related"><h1>Title</h1>{SIX}</article></body>',
    f'<body><div id="page" class="no-sidebar search-enabled"><article><h1>Title</h1>{SIX}</article></div></body>',
    f'<body><div class="content"><h1>Title</h1>{SIX}</div><article><a href="1">Teaser one</a></article><article><a href="2">Teaser two</a></article></body>',
    f'<body class="comments-open sidebar-left"><div class="related"><h1>Title</h1>{SIX}</div></body>',
    f'<body><nav class="menu">{SIX}</nav><article><h1>Title</h1>{SIX}<div class="user-comments">{SIX}{SIX}</div></article><div class="related-posts">{SIX}</div></body>',
    f'<body><div class="siteHeader"><p>{LONG}</p></div><div><h1>Title</h1>{SIX}</div><div class="cookie-notice"><p>{LONG}</p></div><div class="footer2">{SIX[:99]}</div></body>',
])
def test_pages_keep_their_article(page):
    assert main_text.extract(page) == WHOLE


def test_names_that_say_something_else():
    page = f'<article><h1>Title</h1>{SIX}<div class="social-history"><p>Of old {LONG}</p></div><p class="notice-of-copyright">By {LONG}</p></article>'
    assert main_text.extract(page) == f"{WHOLE}\nOf old {LONG}\nBy {LONG}"


def test_broken_markup_takes_linear_time():
    import time

    for page in ("<div>" * 100_000 + "</td>" * 100_000 + "x", '<div class="related">' * 50_000 + "x", "<div><td>" * 60_000 + "</div>" * 60_000):
        since = time.process_time()
        main_text.extract(page)
        assert time.process_time() - since < 10, page[:30]


class PlainPage(__import__("html.parser").parser.HTMLParser):
    """Blocks of a well-formed page that lie in its article and not beside the text, the plain way."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.path, self.blocks, self.now = [], [], []
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.now).split())
        if text and any(t in main_text.CORE for t, _ in self.path) and not any(b for _, b in self.path):
            self.blocks.append(text)
        self.now = []

    def handle_starttag(self, tag, attributes):
        if tag in main_text.BLOCKS:
            self.flush()
        if tag in ("br", "img", "wbr", "hr", "meta", "link", "input"):
            self.now.append("\n" * (tag != "hr"))
            return
        core = any(t in main_text.CORE for t, _ in self.path)
        names = " ".join(v or "" for k, v in attributes if k in ("class", "id"))
        roles = [v for k, v in attributes if k == "role"]
        beside = (tag in main_text.SKIPPED or tag in main_text.ASIDE or (tag == "header" and not core) or "hidden" in dict(attributes)
                  or any(r in main_text.ROLES for r in roles) or "display:none" in (dict(attributes).get("style") or "").replace(" ", "")
                  or (tag not in main_text.CORE and tag not in main_text.PAGE and main_text._named(names, core) > 0))
        self.path.append((tag, beside))

    def handle_endtag(self, tag):
        if tag in main_text.BLOCKS:
            self.flush()
        if any(t == tag for t, _ in self.path):
            while self.path.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(t in main_text.SKIPPED for t, _ in self.path):
            self.now.append(data)


def test_given_pages_equal_a_plain_reading(spark):
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    same = [main_text.extract(p) == "\n".join(PlainPage(p).blocks) for p in pages if p]
    assert len(same) > 200 and sum(same) >= 0.98 * len(same), sum(same) / len(same)


def test_training_on_a_very_long_text_takes_linear_time(spark):
    import time

    words = "die der und in zu den das nicht von sie ist des sich mit dem dass er es ein ich auf so eine auch als an nach wie im für".split()
    text = " ".join(f"{words[i % 30]} {words[i * 7 % 30]}{i % 977}" for i in range(3_000))
    docs = spark.createDataFrame([(text[:300], "en")], "text string, lang string").union(
        spark.range(1).selectExpr(f"repeat('{text[:20_000]}', 600) as text", "'de' as lang"))
    since = time.time()
    texts = langid.training_texts(docs)  # 12 MB in one row
    assert [l for l, _ in texts] == ["de", "en"] and time.time() - since < 40
