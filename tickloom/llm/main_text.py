"""HTML extraction by the distribution of text over line blocks.

Markup is stripped: each block element begins a line, inline elements don't. A line weighs the letters
that it has outside links; lines inside menus, headers, footers, side bars, notices, adverts, forms and
reader comments weigh nothing, by their element, role or names; a name does not stand for a wrapper of the
page or a marked article. Where a page marks its article and this holds at least half of all weight, the
marks decide: all lines inside are kept and none outside. Elsewhere sums of the weights over sliding windows of lines rise where the main
text begins (surge) and fall to nothing where it ends (dive). The weighing lines between are kept, and
the text reaches back and forward to all lines of the containers in which it surges, links and short
lines included, but not what is beside it. A container is the innermost element that is no list or table,
with what it holds; the page itself (``body``) only with the lines that are in no other container.

Defined results: null, empty and text-free pages give an empty text; broken markup never fails: an
unclosed element reaches to the end of what holds it; a page's own order and repetitions are kept;
repeated rows are extracted each; an existing column of the result's name is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from html import unescape

from pyspark.sql import DataFrame

from tickloom.llm.common import per_batch, python_settings

#: Lines of a window; weight over which a window surges at most (half the highest window if that is less).
WINDOW, SURGE = 3, 80
#: Share of a line's letters that may be links.
LINKS = 0.6

# Elements by role.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p
pre search section summary table tbody td tfoot th thead tr ul option optgroup""".split())
SKIPPED = frozenset("""script style noscript template title textarea iframe object svg math canvas audio video select
button datalist applet noframes""".split())
ASIDE = frozenset("nav footer aside form dialog menu fieldset search".split())
#: Elements whose end is looked for; others only separate lines.
HOLDERS = frozenset("""article aside body details dialog div dl fieldset footer form header html main menu nav ol
search section table td tr ul""".split())
CORE = frozenset("article main".split())
#: Holders that are part of the container around them; holders of the whole page.
PARTS = frozenset("details dl ol table td tr ul".split())
PAGE = frozenset("body html".split())
# Words of class names and ids that put an element beside the main text, and words that may
# stand beside these in one name. A name with any other word (``no-sidebar``, ``search-enabled``,
# ``social-history``) says something else.
COMMENTS = re.compile(r"comments?|commentlist|replies|respond|disqus\w*")
NAMES = re.compile(r"""ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|sidenav|nav|navbar|navigation|
menu|footer|cookies?|consent|gdpr|notices?|notification|alert|popup|modal|newsletter|subscribe|subscription|
shar(?:e|ing)|social|related|recommended|breadcrumbs?|widgets?|masthead|toolbar|pagination|pager|skiplink|
login|signup|search""", re.X)
HEADER_NAMES = re.compile("header|topbar")
NEUTRAL = frozenset("""site page main global primary secondary tertiary top bottom left right inner outer wrap wrapper container
content contents area block box bar section panel group row col column unit slot zone item items list links link
buttons button icons icon media posts post articles article entry stories story news user reader blog thread tree
form text title heading google dfp js mobile desktop sticky fixed floating the and by x""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar alertdialog".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)
|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*(?:>|\Z))""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in SKIPPED}


@lru_cache(maxsize=4096)
def _named(names: str, in_core: bool) -> int:
    """2 for names beside the main text, 3 for those of reader comments, else 0."""
    found = 0
    for name in names.split():
        split = re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower().replace("side-bar", "sidebar").replace("skip-link", "skiplink")
        beside = 0
        for word in re.findall("[a-z]+", split):
            if COMMENTS.fullmatch(word):
                beside = 3
            elif NAMES.fullmatch(word) or (not in_core and HEADER_NAMES.fullmatch(word)):
                beside = max(beside, 2)
            elif word not in NEUTRAL:
                beside = 0
                break
        found = max(found, beside)
    return found


def _beside(tag: str, attributes: str, in_core: bool) -> int:
    """Why an element is beside the main text: 1 by its kind or role, 2 or 3 by its names, 0 it isn't."""
    if tag in ASIDE or tag == "header" and not in_core:
        return 1
    if "=" not in attributes and "hidden" not in attributes:
        return 0
    of = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if tag in PAGE:
        return 0
    if "hidden" in of or of.get("aria-hidden") == "true" or "display:none" in of.get("style", "").replace(" ", "").lower():
        return 1
    if of.get("role", "").lower() in ROLES:
        return 1
    return 0 if tag in CORE else _named(f"{of.get('class', '')} {of.get('id', '')}", in_core)


def _judged(lines: list[list], named: list[tuple[int, int]]) -> list[tuple[str, int, bool, tuple]]:
    """Lines (text, weight, core, containers, number of the innermost named element) after judging the names.

    A name does not stand for an element that holds over two thirds of the page's weight, unless it is of
    comments or the page marks an article elsewhere: that is a wrapper of the page.
    """
    weight, core = [0] * len(named), [0] * len(named)
    for _, w, c, _, k in lines:
        weight[k] += max(w, 0)
        core[k] += max(w, 0) * c
    for k in range(len(named) - 1, 0, -1):
        outer = named[k][0]
        weight[outer] += weight[k]
        core[outer] += core[k]
    aside = [False] * len(named)
    for k in range(1, len(named)):
        outer, why = named[k]
        wraps = why == 2 and 3 * weight[k] > 2 * weight[0] and core[k] == core[0]
        aside[k] = aside[outer] or not wraps
    return [(text, -1 if aside[k] else w, c, inner) for text, w, c, inner, k in lines]


def lines_of(html: str) -> list[tuple[str, int, bool, tuple]]:
    """(text, letters outside links; -1 beside the main text, in a marked article, containers) of each line.

    The containers are a chain (number, the next outer container), as ``extract`` follows it.
    """
    lines: list[list] = []
    parts: list[str] = []
    linked = 0
    # Open holders: tag, and of it with all around it: beside, core, container, innermost named element.
    held: list[tuple[str, bool, bool, tuple, int]] = []
    open_tags: Counter[str] = Counter()
    named = [(0, 0)]  # (next outer one, why); the first stands for the page
    name = own_name = 0
    inner: tuple = (0, None)
    opened = 0
    beside = core = False
    alone = False  # the line's own element is beside the main text
    link = False
    at = 0

    def end_line() -> None:
        nonlocal linked, alone, own_name
        text = " ".join(unescape("".join(parts)).split())
        if text:
            own = len(text) - linked if linked <= LINKS * len(text) else 0
            lines.append([text, -1 if beside or alone else max(own, 0), core, inner, own_name or name])
        parts.clear()
        linked, alone, own_name = 0, False, 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if link:
                linked += len(text.strip())

    while m := _TAG.search(html, at):
        add(html[at:m.start()])
        at = m.end()
        if m[0].startswith("<![CDATA["):
            continue
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                link = False
            if tag in BLOCKS or tag in HOLDERS:
                end_line()
            if open_tags[tag]:
                while True:
                    closed = held.pop()[0]
                    open_tags[closed] -= 1
                    if closed == tag:
                        break
                _, beside, core, inner, name = held[-1] if held else ("", False, False, (0, None), 0)
            continue
        attributes = m[3] or ""
        if tag in SKIPPED:
            parts.append(" ")
            if not attributes.endswith("/>") and (end := _ENDS[tag].search(html, at)):
                at = end.end()
            elif not attributes.endswith("/>") and tag in ("script", "style"):
                at = len(html)
            continue
        if tag == "a":
            link = True
        elif tag in ("br", "wbr", "img"):
            parts.append("\n")
        if tag in BLOCKS or tag in HOLDERS:
            end_line()
            link = False
            if tag in HOLDERS and not attributes.endswith("/>"):
                why = _beside(tag, attributes, core)
                if tag not in PARTS and tag not in PAGE:
                    opened += 1
                    inner = (opened, inner)
                if why > 1:
                    named.append((name, why))
                    name = len(named) - 1
                beside, core = beside or why == 1, core or (tag in CORE and why != 1)
                held.append((tag, beside, core, inner, name))
                open_tags[tag] += 1
            elif tag not in HOLDERS:
                why = _beside(tag, attributes, core)
                alone = why == 1
                if why > 1:
                    named.append((name, why))
                    own_name = len(named) - 1
    add(html[at:])
    end_line()
    return _judged(lines, named)


def _marked(lines: list[tuple[str, int, bool, tuple]]) -> str | None:
    """The text of the marked article, if it holds at least half of the page's weight."""
    total = sum(max(w, 0) for _, w, _, _ in lines)
    inside = [(text, w) for text, w, c, _ in lines if c and w >= 0]
    return "\n".join(text for text, _ in inside) if inside and 2 * sum(w for _, w in inside) >= total else None


def extract(html: str | None) -> str:
    """The main text of one page, a block a line."""
    lines = lines_of(html or "")
    if (marked := _marked(lines)) is not None:
        return marked
    weights = [max(w, 0) for _, w, _, _ in lines]
    sums = [sum(weights[i:i + WINDOW]) for i in range(len(weights))]
    surge = min(SURGE, max(sums, default=0) / 2)
    # The containers of the text: of each surging window, that of its heaviest line.
    full = {lines[max(range(i, min(i + WINDOW, len(lines))), key=weights.__getitem__)][3][0]
            for i, total in enumerate(sums) if total > surge}
    within: dict[int, bool] = {}

    def reached(container: tuple) -> bool:
        path = []
        while container[0] not in within:
            number, outer = container
            if number in full or outer is None:
                within[number] = number in full
            elif outer[1] is None:  # the page itself has only its own lines
                within[number] = False
            else:
                path.append(number)
                container = outer
        for number in path:
            within[number] = within[container[0]]
        return within[container[0]]

    kept, inside = [], False
    for (text, own, _, container), weight, total in zip(lines, weights, sums, strict=True):
        inside = total > 0 if inside else total > surge
        if (inside and weight) or (own >= 0 and reached(container)):
            kept.append(text)
    return "\n".join(kept)


def _extractor() -> Callable[[list], list[tuple]]:
    def run(pages: list) -> list[tuple]:
        texts = map(extract, pages)
        return [(t, len(t)) for t in texts]

    return run


_extract = per_batch(_extractor, {"text": "string", "n_chars": "long"})


def main_text(pages: DataFrame, html: str = "html", into: str = "main") -> DataFrame:
    """``pages`` with a struct of the main text and its code points."""
    python_settings(pages.sparkSession)
    return pages.withColumn(into, _extract(html))
