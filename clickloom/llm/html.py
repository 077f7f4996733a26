"""Main text of web pages by composite text density.

A page is parsed into its DOM nodes. Elements that never hold article text (navigation, forms,
scripts, adverts, comments and the like) are cut off by their tag, role or class. A class or id never
cuts headings, paragraphs, or what encloses an article or main, or most of the unlinked text of a page
that has neither.
For every other node the density is its characters per tag, adjusted for links: text inside links
counts against it. The density sum of a node is the sum over its children; the node with the largest
sum is the core of the article. An enclosing ``article`` or ``main`` is taken whole. Without one, the least density on
the path from the core to the body is the threshold: what stands beside that path on any level is part of the
article if it is not mostly links and as dense as that, or holds a paragraph; headings and
the text that stands in the enclosing nodes themselves belong to it too.

Defined results: missing or empty html and pages without text give an empty text; broken markup is
read as far as it goes (open elements end with the page); very long pages are read whole; rows are
independent, so repeated rows get equal results. An existing result column is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"\s+")

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg select object annotation annotation-xml".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav
    ol p pre section summary table tbody td tfoot th thead tr ul""".split())
FOREIGN = set("svg annotation annotation-xml".split())  # may end in their start tag
UNPARSED = set("script style textarea title iframe".split())  # without an end they take the rest of the page
NEVER = set("nav footer aside form button dialog menu label head option optgroup".split())
ROLES = set("""navigation banner contentinfo complementary search dialog alert alertdialog menu
    menubar form""".split())
# Words in a class or id that mark something beside the article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu|"
    r"breadcrumbs?|sidebar|aside|footer|header|masthead|topbar|cookies?|consent|gdpr|notice|alert|"
    r"popup|modal|overlay|comments?|commentlist|disqus|replies|discussion|share|sharing|social|"
    r"related|recommend\w*|newsletter|subscribe|signup|login|search|widget|toolbar|pagination|"
    r"pager|legal|copyright)(?:$|[\s_-]|\d)", re.I)
# Names that say something about the article or its page and not about a part beside it.
MODIFIER = re.compile(r"(?:with|without|no|not|has|entry|post|article|story|content)[_-]", re.I)
STORY = re.compile(r"(?:^|[\s_-])(?:h?entry|post|article|story|content)(?:$|[\s_-])", re.I)
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ANCHORED = HEADINGS | {"section"}  # their ids are targets of links
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Nodes in document order, so the nodes below ``i`` are ``i`` to ``last[i]``."""

    def __init__(self, html: str) -> None:
        self.tag, self.parent = ["html"], [-1]
        self.beside, self.link = [False], [False]
        self.story = [False]  # named like an article
        self.in_article = [False]
        self.open: Counter[str] = Counter()  # the open elements, so that none is looked for in vain
        self.named = [False]  # by a class or id
        self.own, self.own_linked, self.own_tags, self.own_link_tags = [0], [0], [0], [0]
        self.pieces: list[tuple[int, str | None]] = []  # text, or None where a block begins or ends
        self._read(html)
        self._sum_up()
        if self._cut_named():
            self._sum_up()

    def _open(self, tag: str, attributes: str, at: int) -> int:
        beside = self.beside[at] or tag in NEVER
        if not beside and tag == "header":
            beside = not (self.open["article"] or self.open["main"] or self.story[at])
        named = False
        if attributes and tag not in ("html", "body", "article", "main"):
            beside = beside or _is_beside(attributes)
            named = tag not in HEADINGS and tag != "p" and _is_named(attributes, tag in ANCHORED)
        self.story.append(bool(attributes) and _is_story(attributes))
        self.in_article.append(self.in_article[at] or self.tag[at] == "article")
        self.open[tag] += 1
        self.tag.append(tag)
        self.parent.append(at)
        self.beside.append(beside)
        self.named.append(named)
        self.link.append(self.link[at] or tag == "a")
        for counts in (self.own, self.own_linked, self.own_tags, self.own_link_tags):
            counts.append(0)
        return len(self.tag) - 1

    def _up_to(self, node: int, at: int) -> int:
        """End all that is open from ``at`` up to and with ``node``."""
        while at != node:
            self.open[self.tag[at]] -= 1
            at = self.parent[at]
        self.open[self.tag[node]] -= 1
        return self.parent[node]

    def _close(self, tag: str, at: int) -> int:
        """The node that is open once the nearest open ``tag`` has ended."""
        if not self.open[tag]:
            return at
        node = at
        while self.tag[node] != tag:
            node = self.parent[node]
        return self._up_to(node, at)

    def _close_within(self, tags: tuple[str, ...], until: tuple[str, ...], at: int) -> int:
        if not any(self.open[t] for t in tags):
            return at
        node = at
        while node > 0 and self.tag[node] not in until:
            if self.tag[node] in tags:
                return self._up_to(node, at)
            node = self.parent[node]
        return at

    def _read(self, html: str) -> None:
        at, pos, size = 0, 0, len(html)
        ends: dict = {}  # the next end tag by name: text without one is searched once
        while pos < size:
            m = TOKEN.search(html, pos)
            if m is None:
                self._text(at, html[pos:])
                return
            if m.start() > pos:
                self._text(at, html[pos:m.start()])
            pos = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag in BLOCK:
                    self.pieces.append((at, None))
                at = self._close(tag, at)
                continue
            if tag in RAW:
                if tag in FOREIGN and m[3].endswith("/"):
                    continue
                if tag not in ends or ends[tag] is not None and ends[tag].start() < pos:
                    ends[tag] = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, pos)
                if ends[tag]:
                    pos = ends[tag].end()
                elif tag in UNPARSED:
                    pos = size
                continue
            if tag in ("html", "body"):
                at = 0
                self.open.clear()
            if tag in BLOCK:
                at = self._close_within(("p",), ("td", "th", "li", "article", "div", "section", "body"), at)
                self.pieces.append((at, None))
            if tag == "li":
                at = self._close_within(("li",), ("ul", "ol", "menu"), at)
            elif tag in ("dt", "dd"):
                at = self._close_within(("dt", "dd"), ("dl",), at)
            elif tag in ("td", "th"):
                at = self._close_within(("td", "th"), ("tr", "table"), at)
            elif tag == "tr":
                at = self._close_within(("tr",), ("table",), at)
            if tag in VOID:
                if tag == "br":
                    self.pieces.append((at, " "))
                self.own_tags[at] += 1
                self.own_link_tags[at] += self.link[at]
                continue
            at = self._open(tag, m[3], at)

    def _text(self, at: int, text: str) -> None:
        if self.beside[at]:
            return
        if "&" in text:
            text = unescape(text)
        self.pieces.append((at, text))
        n = len(SPACE.sub("", text))
        self.own[at] += n
        if self.link[at]:
            self.own_linked[at] += n

    def _cut_named(self) -> bool:
        """Mark what a class or id puts beside the article; whether anything was.

        A node stays if it encloses an article or main (other than those within an article, which
        are its comments). On a page without those, it stays if it encloses more than half of the
        unlinked text.
        """
        if not any(self.named):
            return False
        holds = [False] * len(self.tag)
        for i in range(len(self.tag) - 1, 0, -1):
            up = self.parent[i]
            if self.tag[i] in ("article", "main") and self.chars[i] and not self.in_article[i]:
                holds[up] = True
            holds[up] |= holds[i]
        plain = self.chars[0] - self.link_chars[0]
        for i in range(1, len(self.tag)):
            if self.beside[self.parent[i]]:
                self.beside[i] = True
            elif self.named[i] and not holds[i]:
                self.beside[i] |= holds[0] or 2 * (self.chars[i] - self.link_chars[i]) <= plain
        return True

    def _sum_up(self) -> None:
        self.chars, self.link_chars = self.own.copy(), self.own_linked.copy()
        self.tags, self.link_tags = self.own_tags.copy(), self.own_link_tags.copy()
        self.last = [0] * len(self.tag)
        for i in range(len(self.tag) - 1, 0, -1):
            up = self.parent[i]
            self.last[i] = max(self.last[i], i)
            self.last[up] = max(self.last[up], self.last[i])
            if self.beside[i]:
                continue
            self.chars[up] += self.chars[i]
            self.link_chars[up] += self.link_chars[i]
            self.tags[up] += self.tags[i] + 1
            self.link_tags[up] += self.link_tags[i] + (self.tag[i] == "a")

    def density(self, i: int) -> float:
        """Composite text density: characters per tag, less where links hold much of the text."""
        chars, tags = self.chars[i], max(self.tags[i], 1)
        if not chars:
            return 0.0
        linked, link_tags = max(self.link_chars[i], 1), max(self.link_tags[i], 1)
        plain = max(chars - self.link_chars[i], 1)
        share = self.link_chars[0] / max(self.chars[0], 1)
        base = math.log(chars / plain * linked + share * chars + math.e)
        return chars / tags * max(math.log(chars / linked * tags / link_tags), 0.0) / math.log(base + 1)

    def article(self) -> list[tuple[int, int]]:
        """Ranges of nodes that make up the article."""
        nodes = [i for i in range(len(self.tag)) if not self.beside[i]]
        density = {i: self.density(i) for i in nodes}
        sums = dict.fromkeys(nodes, 0.0)
        for i in nodes[1:]:
            sums[self.parent[i]] += density[i]
        # text that stands in a node beside its children counts like one more child
        best = max(nodes, key=lambda i: (sums[i] or density[i], -i))
        if not self.chars[best]:
            return []
        path, whole = [best], None
        while self.parent[path[-1]] >= 0:
            path.append(self.parent[path[-1]])
        for i in path:
            if self.tag[i] in ("article", "main"):
                whole = i
        if whole is not None:
            return [(whole, self.last[whole])]
        # on every level up to the page, what stands beside the path and is not mostly links
        threshold = min(density[i] for i in path if density[i] > 0)
        steps, ranges = set(path), [(best, self.last[best])]
        ranges += [(i, i) for i in path[1:]]
        ranges += [(i, self.last[i]) for i in nodes[1:] if i not in steps and self.parent[i] in steps
                   and self.parent[i] != best
                   and (self.tag[i] in HEADINGS or 2 * self.link_chars[i] < self.chars[i]
                        and (density[i] >= threshold or self._has_paragraph(i)))]
        return ranges

    def _has_paragraph(self, node: int) -> bool:
        return any(self.tag[i] == "p" and 2 * self.link_chars[i] < self.chars[i] for i in range(node, self.last[node] + 1))

    def text(self) -> str:
        inside = bytearray(len(self.tag))
        for a, b in self.article():
            inside[a:b + 1] = b"\1" * (b + 1 - a)
        blocks, run = [], []
        for i, piece in [*self.pieces, (0, None)]:
            if piece is None:
                if line := SPACE.sub(" ", "".join(run)).strip():
                    blocks.append(line)
                run = []
            elif not self.beside[i] and inside[i]:
                run.append(piece)
        return "\n".join(blocks)


def _is_beside(attributes: str) -> bool:
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if (name == "role" and value.lower() in ROLES
                or name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and HIDDEN.search(value)):
            return True
    return False


def _is_story(attributes: str) -> bool:
    """Whether class or id name an article."""
    return any(m[1].lower() in ("class", "id") and STORY.search(m[2] or m[3] or m[4] or "")
               for m in ATTRIBUTE.finditer(attributes))


def _is_named(attributes: str, anchored: bool) -> bool:
    """Whether a word of class or id marks something beside the article."""
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "class" or name == "id" and not anchored:
            if any(BESIDE.search(w) and not MODIFIER.match(w) for w in value.split()):
                return True
    return False


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(main_text)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text``, the main text of ``html``, and ``n_chars``, its code points."""
    out = pages.drop("text", "n_chars") if html not in ("text", "n_chars") else pages
    out = out.withColumn("text", _main_text(F.coalesce(F.col(html), F.lit(""))))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
