"""Main text of web pages by tag-path ratios.

A page is parsed into text nodes, each with the path of tags from the root. For every path, text length and
punctuation are aggregated over its nodes (length per node, marks per node); the ratios are smoothed along the page,
fused, and paths above a threshold are content. The article is the <article> and <main> elements, the outermost ones, if
they hold half of the content or more, else the smallest container that holds all content nodes. Its text is returned
whole, so short paragraphs and headings between content nodes stay, without the parts that the page marks as something else:
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments, however long they are. A <header> belongs
to the article only inside <article>, or inside <main> of a page without <article>.

Marks are words in class and id, and roles. Some (``LAYOUT``) and <form> also stand on wrappers of whole pages: they say nothing beside a class that
names content, and nothing on an element that holds over half of the content while no prose stands outside it. If a page has no text
outside its marks, the marks around its largest part say nothing, and those further in still do.

White space inside a block becomes one space, blocks are joined in page order by one space, character references are
decoded. Null html counts as empty; a page without text has the empty string. Broken markup (unclosed, cut off, stray
end tags) is read as far as it goes, in one pass: nothing is scanned twice, so time is in proportion to the page. Repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeromart.llm.common import map_texts

#: Smoothing kernel over neighbouring nodes, share of the mean fused ratio that makes a path content.
KERNEL = np.array([0.1, 0.2, 0.4, 0.2, 0.1])
THRESHOLD = 0.5

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("head title script style noscript template iframe object svg math canvas audio video select option".split())
ASIDE = set("nav aside footer button fieldset dialog menu label input textarea datalist".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var".split()
)
CONTAINERS = set("html body main article section div td center".split())
#: A start tag on the left ends an open element on the right.
PARAGRAPH_ENDERS = set(
    "address article aside blockquote center details dialog div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre "
    "section table ul".split()
)
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLES = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words in class and id that mark a part as something other than the article.
MARKS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "aside related recommended footer footnav copyright masthead topbar toolbar pagination pager cookie "
    "cookies consent notice notices popup modal overlay newsletter subscribe signup login comment comments commentlist "
    "replies disqus respond skip".split()
)
#: Such words that wrappers of whole pages carry as well, classes that outweigh them, and beginnings that turn them round.
LAYOUT = set("sidebar widget banner form search social share sharing".split())
CONTENT = set("content article post entry story main result results page text body".split())
ABOUT = ("has-", "no-", "with-", "without-", "has_", "no_", "with_", "without_")
#: Text of this many characters with punctuation is prose.
PROSE = 40
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，；：！？]")
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
ATTRIBUTE = re.compile(r"""[\s/]*+([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
BLANKS = re.compile(r"[\s/]*+")
#: Elements whose content is text up to their end tag.
RAW = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in "script style textarea title xmp iframe noembed noframes".split()}


class Page:
    """Text nodes in page order: text, path, element, whether a block begins before it."""

    def __init__(self, html: str):
        # per element; ``other``: in a side part by tags or marks, ``other_tag``: by tags alone
        self.tags, self.parents, self.other, self.other_tag = ["#"], [-1], [False], [False]
        self.mark, self.layout = [False], [False]  # per element: has a mark itself, has one that may mean nothing
        self.article = [False]  # per element: an <article> or <main> without marks
        self.headers: list[int] = []  # <header> in <main> outside <article>
        self.cleared = [True]  # per element: known to hold an article
        self.paths: dict[tuple[int, str], int] = {}
        self.path = [0]  # per element
        self.stack, self.open = [0], {}  # elements; of each open tag the places in the stack
        self.nodes: list[tuple[str, int, int]] = []  # text, element, block
        self.block = 0
        self._read(html)
        if "article" in self.tags:
            for e in self.headers:
                self.other_tag[e] = True
        self.other_tag = self._within(self.other_tag)
        self._find_other()

    def _read(self, html: str) -> None:
        """One pass: every step goes on from where the last one ended."""
        at, size, last = 0, len(html), html.rfind(">")
        while at < size:
            sign = html.find("<", at)
            if sign < 0 or sign > last:  # no tag ends after this
                self._text(html[at:])
                return
            if sign > at:
                self._text(html[at:sign])
            after = html[sign + 1 : sign + 2]
            if after.isascii() and after.isalpha():
                at = self._tag(html, sign)
            elif html.startswith("<!--", sign):
                end = html.find("-->", sign + 2)
                at = size if end < 0 else end + 3
            elif after in ("!", "?") or html.startswith("</", sign):
                name = TAG_NAME.match(html, sign + 2) if after == "/" else None
                at = html.index(">", sign) + 1
                if name:
                    self.end_tag(name[0].lower())
            else:
                self._text("<")
                at = sign + 1

    def _tag(self, html: str, sign: int) -> int:
        """A start tag; returns where it ends. One that is cut off by the end of the page is text."""
        name = TAG_NAME.match(html, sign + 1)
        at, attrs = name.end(), []
        while found := ATTRIBUTE.match(html, at):
            attrs.append((found[1].lower(), found[2]))
            at = found.end()
        at = BLANKS.match(html, at).end()
        if at >= len(html):
            self._text(html[sign:])
            return at
        tag = name[0].lower()
        self.start_tag(tag, [(n, unescape(v.strip("\"'")) if v else "") for n, v in attrs if n in ("class", "id", "role", "hidden")])
        at += 1
        if tag in RAW and tag not in VOID:
            end = RAW[tag].search(html, at)
            self._text(html[at : end.start() if end else len(html)])
            at = end.start() if end else len(html)
        return at

    def _text(self, text: str) -> None:
        self.nodes.append((unescape(text), self.stack[-1], self.block))

    def start_tag(self, tag: str, attrs: list[tuple[str, str]]) -> None:
        if tag in VOID:
            if tag == "br":
                self.nodes.append((" ", self.stack[-1], self.block))
            elif tag == "hr":
                self.block += 1
            return
        if tag in PARAGRAPH_ENDERS:
            self._end("p", PARAGRAPH_ENDERS - {"p"})
        for name in ENDS.get(tag, ()):
            self._end(name, {"ul", "ol", "dl", "table", "select", "div"})
        if tag not in INLINE:
            self.block += 1
        parent = self.stack[-1]
        number = len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.path.append(self.paths.setdefault((self.path[parent], tag), len(self.paths) + 1))
        self.other_tag.append(tag in SKIPPED or tag in ASIDE or (tag == "header" and not self._in_article()))
        if tag == "header" and self.open.get("main") and not self.open.get("article"):
            self.headers.append(number)
        strong, layout = self._marked(attrs)
        self.article.append(tag in ("article", "main") and not strong and not layout)
        if tag in ("html", "body", "main") or (tag == "article" and not self._in_article()):
            strong = layout = False  # the outermost parts of a page carry marks of all that they hold
        self.mark.append(strong)
        self.layout.append(layout or tag == "form")
        self.cleared.append(self.article[number])
        if self.article[number]:  # whatever holds an article is no side part
            e = number
            while e == number or not self.cleared[e]:
                self.other_tag[e] = self.mark[e] = self.layout[e] = False
                self.cleared[e] = True
                e = self.parents[e]
        self.stack.append(number)
        self.open.setdefault(tag, []).append(len(self.stack) - 1)

    def _in_article(self) -> bool:
        return bool(self.open.get("article") or self.open.get("main"))

    @staticmethod
    def _marked(attrs: list[tuple[str, str]]) -> tuple[bool, bool]:
        """Whether the element is marked, and whether by words that wrappers have as well."""
        strong = layout = content = False
        for name, value in attrs:
            if name == "hidden" or (name == "role" and value.lower() in ROLES):
                strong = True
            elif name in ("class", "id"):
                for token in value.lower().split():
                    if token in CONTENT:
                        content = True
                    elif not token.startswith(ABOUT):
                        said = WORD.findall(token)
                        strong = strong or not MARKS.isdisjoint(said)
                        layout = layout or not LAYOUT.isdisjoint(said)
        return strong, layout and not content

    def end_tag(self, tag: str) -> None:
        if tag not in INLINE:
            self.block += 1
        self._end(tag, {"table", "td"} if tag not in ("table", "td", "tr", "tbody", "body", "html") else set())

    def _end(self, tag: str, walls: set[str]) -> None:
        """Closes the innermost open ``tag``, unless an element of ``walls`` is inside it."""
        if not self.open.get(tag):
            return
        place = self.open[tag][-1]
        if any(wall in self.open and self.open[wall] and self.open[wall][-1] > place for wall in walls if wall != tag):
            return
        for e in self.stack[place:]:
            self.open[self.tags[e]].pop()
        del self.stack[place:]

    def _find_other(self) -> None:
        """Sets ``other``, once marks are gone that say nothing."""
        for _ in range(NESTED):
            marked = self._within(self.mark)
            self.other = [a or b for a, b in zip(self.other_tag, marked)]
            if any(t.strip() and not self.other[e] for t, e, _ in self.nodes) or not any(self.mark):
                break
            # all text is marked: what is around the largest part says nothing
            live = [i for i, (t, e, _) in enumerate(self.nodes) if t.strip() and not self.other_tag[e]]
            weight = weights(self, live)
            outer = [e for e, m in enumerate(self.mark) if m and not (self.parents[e] >= 0 and marked[self.parents[e]])]
            largest = max(outer, key=lambda e: weight.get(e, 0))
            self.mark[largest] = False
        if any(self.layout):
            chosen = content_nodes(self)
            marked = self._within(self.layout)
            prose = any(not marked[self.nodes[i][1]] and is_prose(self.nodes[i][0]) for i in chosen)
            if chosen and not prose:
                articles = self._within(self.article)
                weight = weights(self, [i for i in chosen if articles[self.nodes[i][1]]] or chosen)
                self.layout = [m and 2 * weight.get(e, 0) <= weight[0] for e, m in enumerate(self.layout)]
            marked = self._within(self.layout)
            self.other = [a or b for a, b in zip(self.other, marked)]

    def _within(self, own: list[bool]) -> list[bool]:
        """Per element whether it or one around it is in ``own``."""
        held = list(own)
        for e in range(1, len(held)):  # children come after their parents
            held[e] = held[e] or held[self.parents[e]]
        return held


#: Marks around marks that are looked through at most, on a page without any other text.
NESTED = 8


def is_prose(text: str) -> bool:
    return len(text.strip()) >= PROSE and PUNCTUATION.search(text) is not None


def content_nodes(page: Page) -> list[int]:
    """Numbers of the nodes whose path is content, by smoothed and fused tag-path ratios."""
    live = [i for i, (t, e, _) in enumerate(page.nodes) if not page.other[e] and t.strip()]
    if not live:
        return []
    path = np.unique([page.path[page.nodes[i][1]] for i in live], return_inverse=True)[1]
    length = np.array([len(page.nodes[i][0].strip()) for i in live], float)
    marks = np.array([len(PUNCTUATION.findall(page.nodes[i][0])) for i in live], float)
    count = np.bincount(path)
    ratios = [(np.bincount(path, values) / count)[path] for values in (length, marks + 1)]
    smooth = [np.convolve(np.pad(r, 2, mode="edge"), KERNEL, mode="valid") for r in ratios]
    fused = np.sqrt(smooth[0] * smooth[1])
    best = np.zeros(len(count))
    np.maximum.at(best, path, fused)
    chosen = best >= THRESHOLD * np.average(fused, weights=length)
    return [i for i, p in zip(live, path) if chosen[p]]


def weights(page: Page, chosen: list[int]) -> dict[int, int]:
    """Characters of the chosen nodes in each element that holds any."""
    weight: dict[int, int] = {}
    for i in chosen:
        e, n = page.nodes[i][1], len(page.nodes[i][0].strip())
        weight[e] = weight.get(e, 0) + n
    for e in range(len(page.tags) - 1, 0, -1):  # children come after their parents
        if e in weight:
            weight[page.parents[e]] = weight.get(page.parents[e], 0) + weight[e]
    return weight


def container(page: Page, chosen: list[int]) -> set[int]:
    """Elements whose text is the article's: articles with half of the content, or the smallest container that holds all of it."""
    weight = weights(page, chosen)
    total = weight[0]
    inside, outer = [False] * len(page.tags), set()
    for e in range(1, len(page.tags)):  # children come after their parents
        own = page.tags[e] in ("article", "main")
        inside[e] = inside[page.parents[e]] or own
        if own and e in weight and not inside[page.parents[e]]:
            outer.add(e)
    if outer and sum(weight[e] for e in outer) >= 0.5 * total:
        return outer
    return {max(e for e in weight if (page.tags[e] in CONTAINERS or e == 0) and weight[e] == total)}


def main_text(html: str | None) -> str:
    """The article of one page."""
    page = Page(html or "")
    chosen = content_nodes(page)
    if not chosen:  # a page whose whole text is marked: only tags tell its parts apart
        page.other = page.other_tag
        chosen = content_nodes(page)
    if not chosen:
        return ""
    roots = container(page, chosen)
    held = [False] * len(page.tags)
    for e in range(len(page.tags)):
        held[e] = e in roots or (page.parents[e] >= 0 and held[page.parents[e]])
    blocks: dict[int, list[str]] = {}
    for text, e, block in page.nodes:
        if held[e] and not page.other[e]:
            blocks.setdefault(block, []).append(text)
    clean = (" ".join("".join(parts).split()) for parts in blocks.values())
    return " ".join(b for b in clean if b)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(2).to_pylist()]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "html")
    return map_texts(rows, per_batch, "page_id bigint, url string, text string, n_chars bigint")
