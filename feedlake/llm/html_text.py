"""Operator 7: main text of HTML pages by tree scoring.

A page is parsed into a flat element table (parents before children).
Elements that never hold article text (scripts, menus, forms, notices, ...)
are left out with all they contain, but a form, or an element that is left out for its
class, id or role, stays if it holds the article itself. Every block with text gets points for its
length and commas and passes them to its nearest ``LEVELS`` ancestors, less with each level.
A container's points are discounted by its link density. The best container
and those of its siblings that look like the same article are kept; inside an
``article`` element the whole element counts as the container. The kept text
is written block by block in page order.

Rows are parsed one by one in Arrow batches; nothing is held beyond a batch.

Defined cases: null or empty html, and pages without text, give the empty
text and 0; unclosed or stray tags are accepted as browsers do, a tag that meets ``<`` outside of quotes before its end is text;
very long pages, deep nesting and unclosed quotes take time in proportion to the page's length; repeated rows
give repeated results; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import small_arrow_batches

#: HTML element names by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset(
    "head nav footer aside button select option datalist dialog menu svg math object canvas audio video map "
    "search".split()) | RAW
#: A start tag closes an open element of these kinds (nearest one inside the given scope).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"},
          "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = frozenset("ul ol dl table select body html article div".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BONUS = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0}
#: Levels of ancestors that a block pays points to (the last ones get about a hundredth).
LEVELS = 32
#: Fixed value: share of an element's text from which articles outside of it are the page's article.
BESIDE = 0.2

#: Words in class, id or role that mark what is not the article.
_AWAY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|complementary|consent|contentinfo|cookies?|disqus|"
    r"footer|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|pager|pagination|popup|promo\w*|"
    r"related|replies|respond|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar|widget|"
    r"(?:site|page|top|global)[_-]?header)"
    r"(?:$|[\s_-])", re.I)
_NAMES = ("class", "id", "role")
_KEEP_TAGS = frozenset(("html", "body", "article", "main"))
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|</([a-zA-Z][^\s/<>]*+)[^<>]*+>?"""
    r"""|<([a-zA-Z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""", re.S)
_ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _attributes(attrs: str) -> dict[str, str]:
    """Values by full lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(attrs):
        out.setdefault(name.lower(), value.strip("\"'"))
    return out


def _is_hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(_HIDDEN.search(attrs.get("style", "")))


def _is_named_away(tag: str, attrs: dict[str, str]) -> bool:
    return tag not in _KEEP_TAGS and any(_AWAY.search(attrs[k]) for k in _NAMES if k in attrs)


def _is_header(tag: str, attrs: dict[str, str]) -> bool:
    return tag == "header" or any(attrs[k].lower().split(None, 1)[:1] in (["header"], ["banner"]) for k in _NAMES if k in attrs)


class _Page:
    """Elements as parallel lists; text as (element, string), with None between blocks."""

    def __init__(self) -> None:
        self.tag, self.parent, self.away, self.block, self.link = ["#"], [0], [False], [0], [False]
        self.out: list[tuple[int, str] | None] = []
        self.headers: list[int] = []
        self.named: list[int] = []

    def add(self, tag: str, parent: int, away: bool) -> int:
        n = len(self.tag)
        self.tag.append(tag)
        self.parent.append(parent)
        self.away.append(away or self.away[parent])
        self.block.append(n if tag in BLOCK else self.block[parent])
        self.link.append(tag == "a" or self.link[parent])
        return n


class _Stack:
    """Open elements, with the places of each name and of the blocks, so the nearest one is found without a walk."""

    def __init__(self, tags: list[str]) -> None:
        self.tags, self.open, self.blocks = tags, [0], []
        self.places: dict[str, list[int]] = {}

    def push(self, node: int) -> None:
        name = self.tags[node]
        self.places.setdefault(name, []).append(len(self.open))
        if name in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def nearest(self, names) -> int:
        """Place of the nearest open element with one of the names (0: none)."""
        return max((self.places[t][-1] for t in names if self.places.get(t)), default=0)

    def cut(self, place: int) -> bool:
        """Close all elements from ``place`` on; true if a block was among them."""
        for node in reversed(self.open[place:]):
            self.places[self.tags[node]].pop()
        del self.open[place:]
        block = bool(self.blocks) and self.blocks[-1] >= place
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()
        return block


def _parse(html: str) -> _Page:
    page, at, end = _Page(), 0, len(html)
    tags, out = page.tag, page.out
    stack = _Stack(tags)
    while at < end:
        m = _TOKEN.match(html, at)
        at = m.end()
        closing, tag, attrs = m.group(1, 2, 3)
        if closing is not None:
            closing = closing.lower()
            place = stack.nearest((closing,))
            if (stack.cut(place) if place else closing in BLOCK):
                out.append(None)
        elif tag is not None:
            tag = tag.lower()
            if tag == "br":
                out.append((stack.open[-1], " "))
                continue
            if tag in BLOCK:
                out.append(None)
                if stack.blocks and tags[stack.open[stack.blocks[-1]]] == "p":  # a block ends an open paragraph
                    stack.cut(stack.blocks[-1])
            if tag in CLOSES:
                scope = stack.nearest(SCOPES)
                while (place := stack.nearest(CLOSES[tag])) > scope:
                    last = tags[stack.open[place]] == tag
                    stack.cut(place)
                    if last:
                        break
            if tag in VOID:
                continue
            values = _attributes(attrs) if attrs else {}
            away = tag in LEFT_OUT or _is_hidden(values)
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = close.end() if close else end
                continue
            node = page.add(tag, stack.open[-1], away)
            stack.push(node)
            if _is_header(tag, values):
                page.headers.append(node)
            if tag == "form" or _is_named_away(tag, values):
                page.named.append(node)
            if attrs.endswith("/") and tag in ("svg", "math"):
                stack.cut(len(stack.open) - 1)
        else:
            text = m.group()
            if text[0] != "<" or text == "<":
                node = stack.open[-1]
                if not page.away[node]:
                    out.append((node, text))
    return page


def _leave_out_named(page: _Page) -> None:
    """Leave out forms and what its class, id or role says, but not what is the article itself.

    An element stays if it holds an article or main element and none stands outside, or if it holds most of the
    page's unlinked text, unless article elements outside hold a good part (``BESIDE``) of as much.
    """
    n, parent, tags, away = len(page.tag), page.parent, page.tag, page.away
    named = set(page.named)
    owner, in_article = [0] * n, [False] * n  # nearest named element
    for i in range(1, n):
        owner[i] = i if i in named else owner[parent[i]]
        in_article[i] = tags[i] == "article" or in_article[parent[i]]
    plain, beside = [0] * n, [0] * n
    for e in page.out:
        if e is not None and not away[e[0]] and not page.link[e[0]]:
            length = len(e[1].strip())
            plain[e[0]] += length
            if in_article[e[0]]:
                beside[owner[e[0]]] += length
    kinds = ("article", "main")
    held = {k: [int(t == k and not gone) for t, gone in zip(tags, away)] for k in kinds}
    outside = {k: [0] * n for k in kinds}
    for k in kinds:
        for i in range(n):
            outside[k][owner[i]] += held[k][i]
    for i in range(n - 1, 0, -1):
        plain[parent[i]] += plain[i]
        for k in kinds:
            held[k][parent[i]] += held[k][i]
    for i in range(1, n):  # from here on beside and outside are what stays out of a named element, handed down
        p = parent[i]
        away[i] = away[i] or away[p]
        if i in named and not away[i]:
            most = 2 * plain[i] > plain[0] and beside[p] < BESIDE * plain[i]
            away[i] = not (most or any(held[k][i] and not outside[k][p] for k in kinds))
            beside[i] += beside[p]
            for k in kinds:
                outside[k][i] += outside[k][p]
        else:
            beside[i] = beside[p]
            for k in kinds:
                outside[k][i] = outside[k][p]


def main_text(html: str | None) -> str:
    """The article of one page as blocks joined by newlines."""
    if not html:
        return ""
    page = _parse(html)
    n, parent, tags = len(page.tag), page.parent, page.tag
    away = page.away
    in_article = [False] * n
    for i in range(1, n):
        in_article[i] = tags[parent[i]] in ("article", "main") or in_article[parent[i]]
    for i in page.headers:  # a page's header is left out, an article's own header stays
        away[i] = away[i] or not in_article[i]
    for i in range(1, n):
        away[i] = away[i] or away[parent[i]]
    if page.named:
        _leave_out_named(page)
    size, linked, commas = [0] * n, [0] * n, [0] * n
    for e in page.out:
        if e is not None and not away[e[0]]:
            length = len(e[1].strip())
            b = page.block[e[0]]
            size[b] += length
            commas[b] += e[1].count(",")
            if page.link[e[0]]:
                linked[b] += length
    points = [0.0] * n
    for i in range(n):
        if size[i] > 0:
            own = (1.0 + commas[i] + min(size[i] / 100.0, 3.0)) * (1.0 - min(linked[i] / size[i], 1.0))
            up, level = parent[i], 1
            if i == 0 or tags[i] in BONUS:  # text that stands in a container itself
                points[i] += own
            while own > 0 and i and level <= LEVELS:
                points[up] += own / (1 if level == 1 else 2 if level == 2 else 3 * level)
                if up == 0:
                    break
                up, level = parent[up], level + 1
    total, links = size[:], linked[:]
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
        links[parent[i]] += links[i]
    if total[0] == 0:
        return ""
    score = [(p + BONUS.get(t, 0.0)) * (1.0 - k / s) if p > 0 and s else 0.0
             for p, t, s, k in zip(points, tags, total, links)]
    best = max(range(n), key=lambda i: (score[i], -i))
    if score[best] == 0:
        best = 0  # nothing but links: the whole page
    inside = [False] * n
    node = best
    while node and tags[node] not in ("article", "main"):
        node = parent[node]
    best = node or best
    inside[best] = True
    if best and tags[best] != "main":
        for i in range(1, n):
            if parent[i] == parent[best] and i != best and not away[i] and total[i]:
                density = links[i] / total[i]
                if score[i] >= max(10.0, 0.2 * score[best]) or tags[i] in HEADINGS or (
                        tags[i] == "p" and density < 0.25 and (total[i] > 80 or density == 0)):
                    inside[i] = True
    for i in range(best + 1, n):
        inside[i] = inside[i] or inside[parent[i]]
    for i in range(1, best):
        inside[i] = inside[i] or (inside[parent[i]] and parent[i] != 0)
    blocks: list[str] = []
    run: list[str] = []
    for e in [*page.out, None]:
        if e is None:
            if run:
                text = " ".join("".join(map(unescape, run)).split())
                if text:
                    blocks.append(text)
                run = []
        elif inside[e[0]] and not away[e[0]]:
            run.append(e[1])
    return "\n".join(blocks)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    small_arrow_batches(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(_extract, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars bigint")
