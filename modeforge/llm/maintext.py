"""Main text of web pages by tree scoring.

A page becomes a tree. Every paragraph earns points, one and one more for each comma and each hundred
characters, less the share of its letters that are links. Its container gets them all, each
container further up half of what the one below has. A container's score is that sum, again less its share of links. The best container
is kept, grown to the ``article`` or ``main`` it lies in, with those siblings that read like it: headings,
paragraphs of text, and containers with a fair part of the best score. Menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments earn no points and are left out, wherever they stand.

Pages are independent rows, so they are worked on where Spark reads them, without a shuffle; memory is
that of one page's tree.

Defined cases: null, empty and markup-only pages give an empty text and 0; unclosed elements end where HTML
ends them, at the latest with the page; an unfinished tag at the end is left out; white space is that of
``str.split``, so a no-break space counts; repeated rows and ids are pages of their own; an empty table
gives an empty result; other columns are never read. All passes are linear in the page and free of recursion.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sibling is kept from this share of the best score on.
SIBLING_SHARE = 0.2
#: A list or box of at least two links whose letters are links to this part is a menu.
LINK_SHARE = 0.8
#: Points for a class, id or element that names the article.
NAMED = 25.0

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_OTHER = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)", re.S)
_RAW = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript")}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_COMMAS = re.compile("[,،、，]")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CONTAINERS = frozenset("article main section div td th body html center details hgroup header".split())
_BLOCKS = _CONTAINERS | _HEADINGS | frozenset(
    "address aside blockquote br caption dd dialog dl dt fieldset figcaption figure footer form hr legend li menu nav ol optgroup option p pre search summary table tbody tfoot thead tr ul".split()
)
_CLOSES_P = _BLOCKS - frozenset("br td th tr tbody thead tfoot caption option optgroup legend".split())
#: An opening element ends an open one of these names, but not beyond the elements behind the bar.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}), "a": ({"a"}, _CONTAINERS), **{h: (_HEADINGS, _CONTAINERS) for h in _HEADINGS},
}
_WALLS = frozenset("td th caption table html".split())
_TABLE = frozenset("table thead tbody tfoot tr td th caption".split())

_OUT = frozenset(
    "head script style template noscript noframes noembed iframe object embed svg canvas audio video nav footer aside form dialog menu search button select datalist textarea".split()
)
_ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar form banner".split())
_ALWAYS_OUT = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot adbox banner sponsor sponsored promo promotion outbrain taboola "
    "cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup paywall "
    "comment comments disqus replies respond".split()
)
_COMMENTS = frozenset("comment comments disqus replies respond".split())
_MOSTLY_OUT = frozenset(
    "sidebar aside rail widget widgets related recommended trending nav navbar navigation menu menus breadcrumb breadcrumbs "
    "pagination pager toolbar topbar header masthead footer colophon copyright share sharing social login".split()
)
_ABOUT = frozenset("has with no without show hide enable is".split())
_NAMES = frozenset("article content entry post story body text main".split())


def _names(value: str) -> Iterator[list[str]]:
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in _ABOUT:
            yield words


class Page:
    """The tree of a page: nodes in the order they open, and the texts and breaks in the order of the page."""

    def __init__(self, source: str):
        self.tags, self.parents, self.first, self.end = ["html"], [-1], [0], [0]
        self.attributes = [""]
        #: (text, node); a text of None breaks the block.
        self.pieces: list[tuple[str | None, int]] = []
        self._stack, self._open = [0], Counter({"html": 1})
        self._read(source)
        self._pop(0)
        self.end[0] = len(self.pieces)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        while at < size:
            mark = source.find("<", at)
            if mark < 0:
                mark = size
            if mark > at:
                self._text(source[at:mark])
                at = mark
                continue
            tag = _TAG.match(source, at)
            if tag is None:
                other = _OTHER.match(source, at)
                if other is None:  # a bare <
                    self._text("<")
                    at += 1
                else:
                    at = other.end()
                continue
            at = tag.end()
            name = tag[2].lower()
            if tag[1]:
                self._close(name)
                continue
            self._start(name, tag[3])
            raw = _RAW.get(name)
            if raw is not None:
                found = raw.search(source, at)
                if name == "xmp":
                    self._text(source[at : found.start() if found else size], decode=False)
                at = found.start() if found else size

    def _text(self, text: str, decode: bool = True) -> None:
        self.pieces.append((html.unescape(text) if decode and "&" in text else text, self._stack[-1]))

    def _pop(self, depth: int) -> None:
        while len(self._stack) > max(depth, 1):
            node = self._stack.pop()
            self._open[self.tags[node]] -= 1
            if self.tags[node] in _BLOCKS:
                self.pieces.append((None, node))
            self.end[node] = len(self.pieces)

    def _ends(self, names: frozenset | set, walls: frozenset | set) -> None:
        if any(self._open[n] for n in names):
            for depth in range(len(self._stack) - 1, 0, -1):
                tag = self.tags[self._stack[depth]]
                if tag in names:
                    self._pop(depth)
                    return
                if tag in walls:
                    return

    def _start(self, name: str, attributes: str) -> None:
        if name in ("html", "body") and self._open[name]:
            return
        if name in _CLOSES_P:
            self._ends({"p"}, _WALLS)
        if name in _ENDS:
            self._ends(*_ENDS[name])
        node = len(self.tags)
        self.tags.append(name)
        self.parents.append(self._stack[-1])
        self.attributes.append(attributes)
        if name in _BLOCKS:
            self.pieces.append((None, self._stack[-1]))
        self.first.append(len(self.pieces))
        self.end.append(len(self.pieces))
        if name not in _VOID and not (attributes.endswith("/") and name in ("path", "use")):
            self._stack.append(node)
            self._open[name] += 1

    def _close(self, name: str) -> None:
        if not self._open[name] or name == "html":
            self.pieces.append((None if name in _BLOCKS else "", self._stack[-1]))
            return
        block = name in _BLOCKS or name in _OUT
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag == name:
                self._pop(depth)
                return
            # A phrase does not end the blocks inside it, nor a block the cell it stands in.
            if (not block and tag in _BLOCKS) or (tag in _WALLS and name not in _TABLE and name != "body"):
                return


def _described(attributes: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), a or b or c)
    return found


class Scores:
    """What is left out of a page, and the score of every node."""

    def __init__(self, page: Page):
        self.page = page
        n = len(page.tags)
        self.in_link = [False] * n
        self.block, self.container = [0] * n, [0] * n
        for k in range(1, n):
            up, tag = page.parents[k], page.tags[k]
            self.in_link[k] = self.in_link[up] or tag == "a"
            self.block[k] = k if tag in _BLOCKS else self.block[up]
            self.container[k] = k if tag in _CONTAINERS else self.container[up]
        self.chars, self.linked, self.commas = [0] * n, [0] * n, [0] * n
        for text, node in page.pieces:
            if text and not text.isspace():
                own = self.block[node]
                size = sum(map(len, text.split()))
                self.chars[own] += size
                self.commas[own] += len(_COMMAS.findall(text))
                if self.in_link[node]:
                    self.linked[own] += size
        self.points = [self._points(k) for k in range(n)]
        self.named = [0.0] * n
        self.out = self._left_out()
        self._pass_up()

    def _points(self, node: int) -> float:
        chars = self.chars[node]
        if not chars or self.page.tags[node] in _HEADINGS:
            return 0.0
        return (1 + self.commas[node] + chars / 100) * (1 - self.linked[node] / chars)

    def _summed(self, own: list) -> list:
        """Sums over subtrees; parents have the smaller numbers."""
        total = list(own)
        for k in range(len(total) - 1, 0, -1):
            total[self.page.parents[k]] += total[k]
        return total

    def _left_out(self) -> list[bool]:
        tags, parents = self.page.tags, self.page.parents
        n = len(tags)
        certain, likely, top = [False] * n, [False] * n, [False] * n
        for k in range(1, n):
            tag = tags[k]
            certain[k] = tag in _OUT
            top[k] = tag == "header"
            if not self.page.attributes[k] or tag in ("html", "body"):
                continue
            given = _described(self.page.attributes[k])
            words = [w for value in (given.get("class", ""), given.get("id", "")) for name in _names(value) for w in name]
            self.named[k] = NAMED if any(w in _NAMES for w in words) else 0.0
            if "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", "")):
                certain[k] = True
            if tag in ("article", "main"):
                certain[k] = certain[k] or any(w in _COMMENTS for w in words)
            else:
                certain[k] = certain[k] or given.get("role") in _ROLES or any(w in _ALWAYS_OUT for w in words)
                likely[k] = any(w in _MOSTLY_OUT for w in words)
                top[k] = top[k] or any(w in ("header", "masthead") for w in words)
        article = self._summed([int(tags[k] in ("article", "main") and not certain[k]) for k in range(n)])
        points = self._summed(self.points)
        out, inside = [False] * n, [False] * n
        for k in range(1, n):
            up = parents[k]
            inside[k] = inside[up] or tags[k] in ("article", "main")
            drop = certain[k]
            if drop and tags[k] == "form" and (article[k] or 2 * points[k] > points[0]):
                drop = False  # a form around the whole page
            if likely[k] or top[k]:
                # A name alone does not outweigh the article, nor most of the page's text.
                drop = drop or not (article[k] or (2 * points[k] > points[0] and not article[0]))
            if top[k] and inside[k] and not certain[k]:
                drop = False  # an article's own header: only its headings stay
            out[k] = drop or out[up]
        self.header = [top[k] and inside[k] and not certain[k] for k in range(n)]
        return out

    def _pass_up(self) -> None:
        page, n = self.page, len(self.page.tags)
        got = [0.0] * n
        for k in range(1, n):
            if not self.out[k] and self.points[k] > 0:
                # The container's own text is a paragraph in it.
                got[self.container[k]] += self.points[k]
        for k in range(n - 1, 0, -1):
            if self.container[k] == k and not self.out[k]:
                got[self.container[page.parents[k]]] += got[k] / 2
        kept = [not x for x in self.out]
        self.all_chars = self._summed([c if kept[k] else 0 for k, c in enumerate(self.chars)])
        self.all_linked = self._summed([c if kept[k] else 0 for k, c in enumerate(self.linked)])
        self.links = self._summed([int(t == "a" and kept[k]) for k, t in enumerate(page.tags)])
        self.score = [0.0] * n
        for k in range(n):
            if self.container[k] == k and got[k] > 0:
                bonus = NAMED if page.tags[k] in ("article", "main") else self.named[k]
                self.score[k] = (got[k] + bonus) * (1 - self.link_share(k))

    def link_share(self, node: int) -> float:
        return self.all_linked[node] / self.all_chars[node] if self.all_chars[node] else 0.0


def _chosen(page: Page, scores: Scores) -> list[int]:
    """The nodes whose subtrees are the main text, in the order of the page."""
    n = len(page.tags)
    best = max(range(n), key=lambda k: (scores.score[k], -k))
    if scores.score[best] <= 0:
        marked = [k for k in range(n) if page.tags[k] in ("article", "main") and not scores.out[k] and scores.all_chars[k]]
        return marked[:1] or [0]
    up, main = best, None
    while up > 0:
        if page.tags[up] == "article":
            best = up
        elif page.tags[up] == "main":
            main = up
        up = page.parents[up]
    if main is not None and page.tags[best] != "article":
        best = main
    if best == 0:
        return [0]
    least = SIBLING_SHARE * scores.score[best]
    kept = []
    for k in range(1, n):
        if page.parents[k] != page.parents[best] or scores.out[k]:
            continue
        tag = page.tags[k]
        wanted = k == best or tag in ("h1", "h2")
        if not wanted and scores.container[k] == k:
            wanted = 0 < least <= scores.score[k]
        elif not wanted and tag == "p" and scores.all_chars[k]:
            wanted = scores.link_share(k) < 0.25
        if wanted:
            kept.append(k)
    return kept


def main_text(source: str | None) -> str:
    """The main text of a page: blocks with single spaces, joined by one space."""
    if not source:
        return ""
    page = Page(source)
    scores = Scores(page)
    n = len(page.tags)
    skipped = list(scores.out)
    chosen = _chosen(page, scores)
    for k in range(1, n):
        if page.tags[k] in ("ul", "ol", "dl", "div", "section", "table") and k not in chosen:
            skipped[k] = skipped[k] or (scores.links[k] > 1 and scores.link_share(k) >= LINK_SHARE)
    # Under an article's own header only headings stay.
    loud = [False] * n
    in_header = [False] * n
    for k in range(1, n):
        up = page.parents[k]
        in_header[k] = in_header[up] or scores.header[k]
        loud[k] = loud[up] or page.tags[k] in _HEADINGS
        skipped[k] = skipped[k] or skipped[up]
    said: list[str] = []
    for top in chosen:
        said.append(" ")
        for text, node in page.pieces[page.first[top] : page.end[top]]:
            if text is None:
                said.append(" ")
            elif not skipped[node] and (loud[node] or not in_header[node]):
                said.append(text)
    return " ".join("".join(said).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py()) for source in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = narrow.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars")).schema
    for field in schema.fields:
        field.nullable = True
    return narrow.mapInArrow(read, schema)
