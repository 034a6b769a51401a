"""Main text of web pages by tag-path ratios.

Text is summed per root-to-leaf tag path: how much text and how much
punctuation a node on that path holds on average.  Both ratios are smoothed
over paths in page order, fused and held against a threshold.  Blocks on chosen
paths are content wherever they stand, and so are the short blocks among them;
what is marked as page furniture is none.

Furniture is told by element name, role, and whole class or id names that say
nothing else (``cookie-notice``, ``comments``, not ``share-price``).  The title
in an article's own header is part of the article.

A page is one pass over its markup; a path is a number for (path of the parent,
tag and class), so memory and time grow with the page, however deep it nests.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from formweave.llm.arrays import text_column, with_id

#: HTML element names and the usual words of class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search "
                  "section summary table tbody td tfoot th thead tr ul caption option optgroup select".split())
FURNITURE = frozenset("head script style textarea title noscript template iframe noembed noframes svg math nav header "
                      "footer aside form button select option input menu dialog object canvas audio video search "
                      "fieldset datalist".split())
FURNITURE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices notification alert popup popover modal overlay newsletter subscribe subscription signup "
    "sidebar aside related recommended recommendations share sharing social menu nav navbar navigation breadcrumb "
    "breadcrumbs footer header masthead topbar comment comments reply replies respond responses disqus login search "
    "widget widgets toolbar pagination pager skip hidden disclaimer copyright navigation banner contentinfo "
    "complementary dialog toc byline metadata feedback".split())
#: Words that add nothing to a furniture word in a class name.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card column container content entry fixed form global group icon "
    "inline inner item items js left link links list main module outer page panel post primary reader right row section "
    "secondary site slot sticky text title top unit user wrap wrapper zone".split())
WHOLE = frozenset("html body main article".split())       # never furniture by a word in their class
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}, "option": {"select"}, "tbody": {"table"}}

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<name>/?[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)", re.S)
MARK = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
WORDS = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。，、؟¿¡]")


class Element:
    __slots__ = ("tag", "path", "parent", "place", "furniture", "title_only", "in_article")

    def __init__(self, tag: str, path: int, parent: Element | None, place: int, furniture: bool, title_only: bool, in_article: bool):
        self.tag, self.path, self.parent, self.place = tag, path, parent, place
        self.furniture, self.title_only, self.in_article = furniture, title_only, in_article


def furniture_name(name: str) -> bool:
    """Whether a class or id name says that an element is furniture: one of its
    words does, and the others add nothing."""
    parts = WORDS.findall(name)
    return any(w in FURNITURE_WORDS for w in parts) and all(w in FURNITURE_WORDS or w in PLAIN_WORDS for w in parts)


def is_furniture(tag: str, attrs: str) -> tuple[bool, str]:
    """Whether the element is page furniture; and its class, for the path."""
    kind, mark = tag in FURNITURE, ""
    for name, a, b, c in MARK.findall(attrs) if attrs else ():
        name, value = name.lower(), (a or b or c).lower()
        if name == "class":
            mark = "." + ".".join(value.split())
        if name in ("class", "id", "role"):
            kind = kind or tag not in WHOLE and any(map(furniture_name, value.split()))
        elif name == "style":
            kind = kind or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        elif tag not in WHOLE and (name == "hidden" or value == "true"):
            kind = True
    return kind, mark


class Page:
    """The elements of a page in the order they open, and its text nodes:
    ``(text, element, block)``."""

    def __init__(self, page: str):
        self.elements = [Element("", 0, None, 0, False, False, False)]
        self.names: list[tuple[int, str]] = [(-1, "")]          # of each path: its parent and last step
        self._paths: dict[tuple[int, str], int] = {}
        self._open: Counter[str] = Counter()
        self._stack = [self.elements[0]]
        self.nodes: list[tuple[str, Element, int]] = []
        self._read(page)

    def path(self, number: int) -> str:
        steps = []
        while number > 0:
            number, step = self.names[number]
            steps.append(step)
        return "/".join(reversed(steps))

    def _close(self, depth: int) -> None:
        for e in self._stack[depth:]:
            self._open[e.tag] -= 1
        del self._stack[depth:]

    def _push(self, name: str, attrs: str) -> None:
        kind, mark = is_furniture(name, attrs)
        above = self._stack[-1]
        key = (above.path, name + mark)
        if key not in self._paths:
            self._paths[key] = len(self.names)
            self.names.append(key)
        own_header = name == "header" and above.in_article and not above.furniture
        title = above.title_only and name in HEADINGS and not kind
        self._stack.append(Element(name, self._paths[key], above, len(self.elements),
                                   not title and (above.furniture or kind),
                                   not title and (own_header or above.title_only and not kind),
                                   above.in_article or name in ("article", "main")))
        self.elements.append(self._stack[-1])
        self._open[name] += 1

    def _read(self, page: str) -> None:
        stack, at, block, end = self._stack, 0, 0, len(page)
        while at < end:
            found = TOKEN.search(page, at)
            if found is None or found.start() > at:
                self.nodes.append((page[at:found.start() if found else end], stack[-1], block))
            if found is None:
                break
            at = found.end()
            name = (found["name"] or "").lower()
            if not name:
                continue
            if name[0] == "/":
                name = name[1:]
                if self._open[name]:
                    self._close(next(d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == name))
                block += name in BLOCK
                continue
            if name in BLOCK:
                block += 1
                if self._open["p"]:                            # a block ends an open paragraph
                    self._close_nearest({"p"}, BLOCK)
            if any(self._open[t] for t in CLOSED_BY.get(name, ())):
                self._close_nearest(CLOSED_BY[name], SCOPE[name])
            if name == "br":
                self.nodes.append((" ", stack[-1], block))
            if name in VOID:
                continue
            if name in RAW:        # its content is no markup; none of it is main text
                closing = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = closing.end() if closing else (end if name in ("script", "style", "textarea", "title") else at)
                continue
            self._push(name, found["attrs"] or "")

    def _close_nearest(self, tags: set[str], scope: set[str] | frozenset[str]) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self._stack[depth].tag in tags:
                self._close(depth)
                return
            if self._stack[depth].tag in scope:
                return


def path_ratios(nodes: list[tuple[str, Element, int]]) -> tuple[list[int], np.ndarray]:
    """The tag paths that hold text, in page order, and their fused ratios:
    smoothed text length by smoothed punctuation, both per element."""
    sums: dict[int, list] = {}
    for text, element, _ in nodes:
        if text.strip():
            s = sums.setdefault(element.path, [0, 0, set()])
            s[0] += len(text)
            s[1] += len(PUNCTUATION.findall(text))
            s[2].add(element.place)
    length, marks = (np.array([s[i] / len(s[2]) for s in sums.values()]) for i in (0, 1))

    def smooth(x: np.ndarray) -> np.ndarray:
        near = np.pad(x, 1, mode="edge")
        return (near[:-2] + 2 * near[1:-1] + near[2:]) / 4

    return list(sums), smooth(length) * (1 + smooth(marks)) if sums else length


def content_paths(nodes: list[tuple[str, Element, int]]) -> set[int]:
    """The tag paths whose ratio passes the threshold."""
    paths, fused = path_ratios(nodes)
    return {path for path, value in zip(paths, fused) if value >= fused.std()} or set(paths)


def content_blocks(page: Page) -> set[int]:
    """The blocks of main text: those on chosen paths, and the other blocks
    among them that are no furniture.

    Where article or main elements hold at least half of the chosen text, their
    blocks are content, and of the rest of a main element that holds them what
    lies from the first to the last chosen block.  Elsewhere it is what lies
    from the first to the last chosen block in the deepest element around all
    of them, and all of the deepest element that holds nine tenths.
    """
    free = [n for n in page.nodes if not n[1].furniture and n[0].strip()]
    paths = content_paths(free)
    chosen = [n for n in free if n[1].path in paths]
    if not chosen:
        return set()
    amount = [0] * len(page.elements)
    for text, element, _ in chosen:
        amount[element.place] += len(text.strip())
    for e in reversed(page.elements[1:]):                     # parents open before their children
        amount[e.parent.place] += amount[e.place]
    total = amount[0]

    def inside(tops: set[int]) -> list[bool]:
        out = [False] * len(page.elements)
        for e in page.elements:
            out[e.place] = e.place in tops or e.parent is not None and out[e.parent.place]
        return out

    def blocks_in(tops: set[int], low: int = 0, high: int | None = None) -> set[int]:
        within = inside(tops)
        return {b for _, e, b in free if within[e.place] and low <= b and (high is None or b <= high)}

    def span(tops: set[int]) -> set[int]:
        within = inside(tops)
        found = [b for _, e, b in chosen if within[e.place]]
        return blocks_in(tops, min(found), max(found)) if found else set()

    def named(tag: str) -> set[int]:
        return {e.place for e in page.elements if e.tag == tag and not e.furniture and amount[e.place]}

    def top_amount(tops: set[int]) -> int:
        within = inside(tops)
        return sum(len(t.strip()) for t, e, _ in chosen if within[e.place])

    articles, mains = named("article"), named("main")
    if 2 * top_amount(articles) >= total:
        return blocks_in(articles) | span(mains)
    if 2 * top_amount(mains) >= total:
        return blocks_in(mains)
    deepest = {share: max((e.place for e in page.elements if 10 * amount[e.place] >= share * total)) for share in (9, 10)}
    return blocks_in({deepest[9]}) | span({deepest[10]})


def main_text(page: str) -> str:
    """The main text of one page; empty if it has none."""
    parsed = Page(page)
    kept = content_blocks(parsed)
    blocks: dict[int, list[str]] = {}
    for text, element, block in parsed.nodes:
        if block in kept and not element.furniture:
            blocks.setdefault(block, []).append(html.unescape(text))
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            texts = [main_text(page) for page in text_column(rows, "html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (``page_id``, ``url``, ``html``):
    ``page_id, url, text, n_chars`` (code points).

    Character references are decoded, white space inside a block becomes one
    space, blocks are joined by one line feed.  Every page is read whole; an
    article keeps its short blocks (headings, list items, the heading in its own
    header) too, and several articles of a page are all kept.  Null and
    empty pages, and pages of nothing but furniture, have the empty text.
    Broken markup (unclosed elements, comments and tags) is read on.  Ids and
    urls may be null or repeat; other columns are ignored; an empty table
    gives no rows."""
    return with_id(pages, "url", "html", name="page_id").mapInArrow(
        _extract, "page_id bigint, url string, text string, n_chars bigint")
