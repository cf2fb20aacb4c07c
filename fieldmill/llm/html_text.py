"""The main text of web pages by composite text density.

Every DOM node gets the density of its text: characters per tag, lowered the more of its text and
tags are links, on a scale set by the link share of the whole body.  The sum of its children's
densities marks a node that holds many dense parts; the node with the greatest sum is the core of the
page.  The least density on its path up to the body is the threshold: any node that reaches it
contributes the node of greatest sum below it.  Where such a node stands in an article or main element,
the whole element counts, as the threshold alone loses headings over a single dense paragraph.  Boxes of
links below the threshold stay out of what is gained that way, and of a core around articles.  Parts that
name themselves as menus, footers, adverts and the like are left out before; a class or id says so only as a whole, and not
where the element holds most of the text or a heading of an article.
"""

from __future__ import annotations

import html as entities
import re
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead title tr ul caption".split()
)
_BOXES = frozenset("center details dir div dl fieldset ol section table ul".split())
_ENDS_P = _BLOCK - frozenset("body html head option optgroup dd dt li td th tr tbody".split())
#: a start tag ends these open elements, but not beyond the second ones
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
    "tbody": (("thead", "tbody"), ("table",)),
    "body": (("head",), ("html",)),
}
_ASIDE_TAGS = frozenset(
    "head nav footer aside form script style noscript iframe button select textarea svg canvas "
    "template dialog menu object embed input title".split()
)
_ADVERT = r"ads?|advert[^\W_]*|adsense|sponsor[^\W_]*|promo[^\W_]*|cookie[^\W_]*|consent|gdpr|comments?|disqus[^\W_]*|respond"
_FRAME = (
    r"banner[^\W_]*|side-?bar[^\W_]*|menu[^\W_]*|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|notices?|"
    r"alert|newsletter|subscribe|subscription|signup|login|popup|modal|share|sharing|social|related|"
    r"recommend[^\W_]*|widget[^\W_]*|pagination|pager|toolbar|search"
)
_PLACE = (
    "site|page|main|global|top|bottom|left|right|upper|lower|primary|secondary|mobile|desktop|fixed|sticky|"
    "box|bar|area|block|wrap|wrapper|container|inner|outer|list|item|items|links?|buttons?|icons?|form|"
    "unit|slot|slots|text|message|thread|section|posts?|articles?|stories|media|web|article|[0-9]+"
)
#: a whole class or id of listed words, and others only for where or what kind of box it is
_ASIDE_NAME = re.compile(
    rf"(?:(?:{_PLACE})[_-]+)*(?:{_ADVERT}|{_FRAME})(?:[_-]+(?:{_ADVERT}|{_FRAME}|{_PLACE}))*", re.IGNORECASE
)
#: such a word makes it no part of the core, however much it holds
_NEVER_CORE = re.compile(rf"(?:^|[_-])(?:{_ADVERT})(?:$|[_-])", re.IGNORECASE)
#: names of headings of a part
_HEADER_NAME = re.compile(r"(?:^|[_-])(?:header|masthead|banner)(?:$|[_-])", re.IGNORECASE)
#: that are headings of a part also with these words before
_PART = re.compile(r"section[_-]+header", re.IGNORECASE)
_ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert form menu".split()
)
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_REST = re.compile(r"""(?:[^>"']|"[^"]*"|'[^']*')*+>""")
_MARKS = re.compile(
    r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE
)


class Page:
    """The nodes of a page in document order, each with its range of text pieces."""

    def __init__(self, source: str):
        self.tag, self.parent, self.first, self.last, self.aside = [], [], [], [], []
        #: text pieces, and "\n" for the edges of blocks; the innermost node of each
        self.pieces: list[str] = []
        self.owner: list[int] = []
        self._open: list[int] = []
        self._places: dict[str, list[int]] = {}  # by tag: where in the stack its open elements are
        self._articles = 0
        #: elements that are asides by class or id alone: the names that say so
        self.named: dict[int, list[str]] = {}
        self._start("#page", "")
        self._read(source)
        while self._open:
            self._end()
        self._judge_names()

    def _judge_names(self) -> None:
        """Make the elements of ``named`` asides, except for what the core stands in or is headed by."""
        if not self.named:
            return
        n = len(self.tag)
        chars, root, heads = [0] * n, [-1] * n, [False] * n
        linked = [tag == "a" for tag in self.tag]
        for node in range(1, n):
            up = self.parent[node]
            linked[node] = linked[node] or linked[up]
            root[node] = node if root[up] < 0 and self.tag[node] in ("article", "main") else root[up]
        for node, piece in zip(self.owner, self.pieces, strict=True):
            if not (linked[node] or self.aside[node]):
                chars[node] += len("".join(piece.split()))
        for node in range(n - 1, 0, -1):
            up = self.parent[node]
            chars[up] += chars[node]
            title = self.tag[node] == "h1"
            heads[up] = heads[up] or heads[node] or title
            heads[node] = heads[node] or title
        articles = [k for k in range(1, n) if root[k] == k and chars[k]]
        for node in range(1, n):
            up = self.parent[node]
            names = self.named.get(node)
            if names and not self.aside[up]:
                whole = chars[max(0, root[up])]
                never = any(_NEVER_CORE.search(x) for x in names)
                # an article elsewhere is the core, not a side part longer than it
                beside = root[up] < 0 and any(not self._below(k, node) for k in articles)
                core = 2 * chars[node] > whole and not beside
                title = root[up] >= 0 and (heads[node] or self._headed(node, names))
                self.aside[node] = never or not (core or title)
            self.aside[node] = self.aside[node] or self.aside[up]

    def _below(self, node: int, top: int) -> bool:
        return self.first[top] <= self.first[node] and self.last[node] <= self.last[top] and node > top

    def _headed(self, node: int, names: list[str]) -> bool:
        """Whether ``node`` is named a header and holds a heading."""
        if not any(_HEADER_NAME.search(x) for x in names):
            return False
        k = node
        while k < len(self.tag) and (k == node or self._below(k, node)):
            if self.tag[k] in ("h1", "h2", "h3", "h4", "h5", "h6"):
                return True
            k += 1
        return False

    def _add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.owner.append(self._open[-1] if self._open else 0)

    def _start(self, tag: str, marks: str) -> None:
        if tag in _BLOCK:
            self._add("\n")
        aside = tag in _ASIDE_TAGS or (tag == "header" and not self._articles)
        self._articles += tag in ("article", "main")
        names: list[str] = []
        if not aside and marks and tag not in ("html", "body"):
            for name, a, b, c in _MARKS.findall(marks):
                value = a or b or c
                if name.lower() == "role":
                    aside = aside or value.strip().lower() in _ASIDE_ROLES
                else:
                    names += [
                        x
                        for x in value.split()
                        if (tag not in ("article", "main") or "comment" in x.lower())
                        and _ASIDE_NAME.fullmatch(x)
                        and not _PART.fullmatch(x)
                    ]
        parent = self._open[-1] if self._open else -1
        self.tag.append(tag)
        self.parent.append(parent)
        self.first.append(len(self.pieces))
        self.last.append(0)
        self.aside.append(aside or (parent >= 0 and self.aside[parent]))
        if names and not aside:
            self.named[len(self.tag) - 1] = names
        self._places.setdefault(tag, []).append(len(self._open))
        self._open.append(len(self.tag) - 1)

    def _end(self) -> None:
        node = self._open.pop()
        self._places[self.tag[node]].pop()
        self.last[node] = len(self.pieces)
        self._articles -= self.tag[node] in ("article", "main")
        if self.tag[node] in _BLOCK:
            self._add("\n")

    def _end_through(self, tags, barriers=()) -> None:
        """End the nearest open element of ``tags`` and all inside it, unless a barrier is nearer."""
        nearest = self._nearest(tags)
        if nearest > 0 and (nearest == len(self._open) - 1 or nearest >= self._nearest(barriers)):
            while len(self._open) > nearest:
                self._end()

    def _nearest(self, tags) -> int:
        """Place in the stack of the innermost open element of ``tags``, 0 without one."""
        return max((places[-1] for tag in tags if (places := self._places.get(tag))), default=0)

    def _text(self, text: str) -> None:
        self._add(entities.unescape(text) if "&" in text else text)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            mark = source.find("<", at)
            if mark < 0:
                self._text(source[at:])
                return
            if mark > at:
                self._text(source[at:mark])
            after = source[mark + 1 : mark + 2]
            if source.startswith("<!--", mark):
                end = source.find("-->", mark + 4)
                at = size if end < 0 else end + 3
                continue
            if after in ("!", "?") and after:
                end = source.find(">", mark)
                at = size if end < 0 else end + 1
                continue
            name = _NAME.match(source, mark + 1 + (after == "/"))
            if not name:
                if after == "/":  # a bogus comment
                    end = source.find(">", mark)
                    at = size if end < 0 else end + 1
                else:
                    self._text("<")
                    at = mark + 1
                continue
            rest = _REST.match(source, name.end())
            end = rest.end() if rest else source.find(">", name.end()) + 1
            if end <= 0:
                return  # the page breaks off inside a tag
            tag, at = name[0].lower(), end
            if after == "/":
                if tag == "br":
                    self._add("\n")
                else:
                    self._end_through((tag,), () if tag in _BLOCK else _BLOCK)
                continue
            if tag in _ENDS_P:
                self._end_through(("p",), ("table", "td", "th", "button", "object"))
            if tag in _ENDS:
                self._end_through(*_ENDS[tag])
            if tag in _VOID:
                self._start(tag, "")
                if tag == "br":
                    self._add("\n")
                self._end()
                continue
            self._start(tag, source[name.end() : end - 1])
            if tag in _RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                at = close.start() if close else size

    def text(self, nodes: list[int]) -> str:
        """The text below ``nodes`` (none inside another, in order) without asides."""
        gaps = sorted(
            {
                (self.first[k], self.last[k])
                for k, aside in enumerate(self.aside)
                if aside and not self.aside[self.parent[k]]
            }
        )
        out, k = [], 0
        for node in nodes:
            at, end = self.first[node], self.last[node]
            while k < len(gaps) and gaps[k][0] < end:
                low, high = gaps[k]
                if low >= at:
                    out += self.pieces[at:low]
                    at = max(at, high)
                k += 1
            out += [*self.pieces[at:end], "\n"]
        return " ".join("".join(out).split())


def _densities(page: Page) -> tuple[list[float], list[float], list[bool]]:
    """Composite text density and density sum of each node, and whether it is a box of links, with
    several of them for most of its text; asides count as absent."""
    n = len(page.tag)
    own = [0] * n
    for node, piece in zip(page.owner, page.pieces, strict=True):
        own[node] += len("".join(piece.split()))
    chars, tags, link_chars, link_tags = own, [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):
        if page.aside[node]:
            chars[node] = tags[node] = link_chars[node] = link_tags[node] = 0
            continue
        if page.tag[node] == "a":
            link_chars[node] = chars[node]
        parent = page.parent[node]
        if parent >= 0:
            chars[parent] += chars[node]
            tags[parent] += tags[node] + 1
            link_chars[parent] += link_chars[node]
            link_tags[parent] += link_tags[node] + (page.tag[node] == "a")
    body = chars[0] and link_chars[0] / chars[0]
    density = [0.0] * n
    for node in range(n):
        c, t = chars[node], max(1, tags[node])
        if c and not page.aside[node]:
            lc, lt = link_chars[node], link_tags[node]
            plain = max(1, c - lc)
            base = log(c / plain * lc + body * c + e)
            density[node] = c / t * log(c / max(1, lc) * t / max(1, lt), max(base, 1.0001))
            density[node] = max(0.0, density[node]) if c > lc else 0.0
    sums = [0.0] * n
    inner = [False] * n
    for node in range(1, n):
        sums[page.parent[node]] += density[node]
        inner[page.parent[node]] = inner[page.parent[node]] or not page.aside[node]
    sums = [s if k else d for s, k, d in zip(sums, inner, density, strict=True)]
    links = [
        page.tag[k] in _BOXES and link_tags[k] > 1 and 2 * link_chars[k] > chars[k] for k in range(n)
    ]
    return density, sums, links


def main_text(source: str | None) -> str:
    """The article of a page; empty for a null, empty or textless page."""
    page = Page(source or "")
    density, sums, links = _densities(page)
    n = len(page.tag)
    core = max(range(n), key=lambda k: (sums[k], -k))
    if not sums[core]:
        return page.text([0])
    path, node = [], core
    while node >= 0:
        path.append(node)
        if page.tag[node] == "body":
            break
        node = page.parent[node]
    threshold = min(density[k] for k in path)
    # of each node, the node of greatest sum at or below it
    best = list(range(n))
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        if sums[best[node]] > sums[best[up]]:
            best[up] = best[node]
    dense = {best[k] for k in range(n) if density[k] >= threshold and density[k] > 0}
    # the outermost article or main element around each node, whether a dense node or such an element
    # is at or below it, and whether it is in a dense node that is no frame around these
    root, inside = [-1] * n, [False] * n
    holds, frame = [k in dense for k in range(n)], [tag in ("#page", "html", "body") for tag in page.tag]
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        holds[up] = holds[up] or holds[node]
        frame[up] = frame[up] or frame[node] or page.tag[node] in ("article", "main")
    for node in range(1, n):
        up = page.parent[node]
        root[node] = root[up]
        if root[node] < 0 and page.tag[node] in ("article", "main"):
            root[node] = node
        inside[node] = inside[up] or (node in dense and not frame[node])
    chosen = {k if root[k] < 0 else root[k] for k in dense}
    for node in range(1, n):
        if links[node] and density[node] < threshold and not (inside[node] or holds[node]):
            page.aside[node] = True
        page.aside[node] = page.aside[node] or page.aside[page.parent[node]]
    outer = []
    for node in sorted(chosen):
        up = page.parent[node]
        while up >= 0 and up not in chosen:
            up = page.parent[up]
        if up < 0:
            outer.append(node)
    return page.text(outer)


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, url, text and n_chars (code points).

    Character references are decoded, white space inside a block becomes one space, and blocks are
    joined by one space.  A null, empty or textless page has an empty text; null ids and urls stay;
    repeated rows are rows like others; broken and cut-off markup is read as far as it goes; an empty
    input gives no rows; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
