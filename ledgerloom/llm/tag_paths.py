"""Main text of pages by tag-path ratios: statistics of root-to-leaf paths select content nodes."""

from __future__ import annotations

import html as entities
import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import table
from ledgerloom.plans.registry import register

# Element names of the markup language by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|select|canvas|title"
# Raw elements that run to the page's end without an end tag; the others end with their parent.
RAW_TO_END = frozenset("script style textarea title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
CLOSES_SELF = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
BOILERPLATE = frozenset("head nav header footer aside dialog menu button".split())
CONTENT = frozenset(("article", "main"))
# Elements that are a part of what holds them, however long they are.
PARTS = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 ul ol li dl dt dd figure figcaption".split())
# Words of class and id names that tell what a container is for.
NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies copyright disclaimer discussion footer gdpr header login masthead menu menubar modal nav "
    "navbar navigation newsletter notice notices notification outbrain pager pagination popup promo promotion related "
    "replies responses search share sharing sidebar signup social sponsor sponsored subscribe subscription taboola "
    "toolbar widget widgets".split()
)
#: Names that hold whatever the container's share of the page; other named containers with more than
#: MOST_SHARE of the page's text are the page itself.
SURE_NAMES = frozenset("ad ads advert adverts advertisement comment comments commentlist discussion replies responses".split())
MOST_SHARE = 0.7
#: Paths whose fused ratio falls below this share of the ratios' standard deviation are not content.
THRESHOLD = 0.5
#: Factor of the ratios of nodes inside article or main elements.
CONTENT_PRIOR = 2.0
#: Share of links from which neighbours of one path are a list, and a block of short texts is teasers.
LIST_SHARE, TEASER_SHARE = 0.5, 0.3
#: Times that a text of a path below the threshold occurs before it is a repeated notice. Cells, items
#: and headlines repeat for other reasons.
NOTICE_TIMES = 3
NOTICE_TAGS = frozenset(("div", "p", "section"))
#: Weights of a node's neighbours and itself when ratios are smoothed in page order.
KERNEL = (0.25, 0.5, 0.25)

# Quotes hold attribute values after an equals sign only; one without an end is plain.
_ATTRS = r"""(?:[^>=]++|=\s*(?:"[^"]*"|'[^']*')|=)*+"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?P<given>{_ATTRS})>"
    rf"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<attrs>{_ATTRS})>"
    r"|<[/!?a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？¿¡]")


@dataclass(slots=True)
class Element:
    tag: str
    path: str
    parent: Element | None
    flagged: str = ""  # Why its text is no content: "sure", "named", or nothing.
    content: bool = False
    chars: int = 0


@dataclass(slots=True)
class Node:
    """A block's text: its element, its parts, and how much of it is links."""

    element: Element
    parts: list[str] = field(default_factory=list)
    links: int = 0
    text: str = ""


def _opened(tag: str, attrs: str, parent: Element) -> Element:
    names = []
    if attrs and tag not in ("html", "body", "article", "main"):
        found = " ".join(a or b or c for a, b, c in _NAMED.findall(attrs))
        names = [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", found).lower()) if w in NAMES]
    label = f"{tag}.{'.'.join(sorted(set(names)))}" if names else tag
    flagged = parent.flagged
    own_header = tag == "header" and parent.content  # An article's header holds its headline.
    if (tag in BOILERPLATE and not own_header) or SURE_NAMES.intersection(names):
        flagged = "sure"
    elif names and not flagged:
        flagged = "named"
    return Element(tag, f"{parent.path}/{label}", parent, flagged, parent.content or tag in CONTENT)


def _nodes(page: str) -> list[Node]:
    """The page's blocks of text in order, each with the element that holds it."""
    root = Element("", "", None)
    stack, nodes = [root], []
    node: Node | None = None

    def close(names, limits) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return
            if stack[i].tag in limits:
                return

    at, unclosed = 0, set()
    while at < len(page):
        found = _TOKEN.match(page, at)
        at = found.end()
        if found["raw"] is not None:
            raw = found["raw"].lower()
            if raw in ("svg", "math") and found["given"].endswith("/"):
                continue
            end = None if raw in unclosed else _RAW_END[raw].search(page, at)
            if end is not None:
                at = end.end()
            elif raw in RAW_TO_END:
                break
            else:
                unclosed.add(raw)
                stack.append(Element(raw, f"{stack[-1].path}/{raw}", stack[-1], "sure"))
                node = None
            continue
        text = found["text"]
        if text is not None:
            holder = next(e for e in reversed(stack) if e.tag not in INLINE)
            if node is None or node.element is not holder:
                node = Node(holder)
                nodes.append(node)
            text = entities.unescape(text) if "&" in text else text
            node.parts.append(text)
            if any(e.tag == "a" for e in stack[-4:]):
                node.links += len(text.strip())
            continue
        tag = found["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if node is not None:
                node.parts.append(" ")
            continue
        if tag not in INLINE:
            node = None
        if found["end"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break  # An inline end tag doesn't close a block.
            continue
        if tag in CLOSES_PARAGRAPH:
            close({"p"}, CLOSES_PARAGRAPH - {"p"} | {"td", "th", "li"})
        elif tag in CLOSES_SELF:
            close(*CLOSES_SELF[tag])
        if tag not in VOID and not (found["attrs"] or "").endswith("/"):
            stack.append(_opened(tag, found["attrs"], stack[-1]))
    for one in nodes:
        one.text = " ".join("".join(one.parts).split())
    return [x for x in nodes if x.text]


def _fused_ratios(nodes: list[Node]) -> tuple[list[float], list[float]]:
    """Each node's text ratio and punctuation ratio of its path, multiplied: smoothed, and as they are."""
    paths: dict[str, list[float]] = {}
    for x in nodes:
        sums = paths.setdefault(x.element.path, [0.0, 0.0, 0.0])
        sums[0] += 1
        sums[1] += max(0, len(x.text) - x.links)
        sums[2] += len(_PUNCTUATION.findall(x.text)) if x.links * 2 < len(x.text) else 0
    text = [paths[x.element.path][1] / paths[x.element.path][0] for x in nodes]
    marks = [paths[x.element.path][2] / paths[x.element.path][0] for x in nodes]

    def smooth(values: list[float]) -> list[float]:
        padded = [values[0], *values, values[-1]]
        return [sum(w * v for w, v in zip(KERNEL, padded[i : i + 3], strict=True)) for i in range(len(values))]

    def fuse(text: list[float], marks: list[float]) -> list[float]:
        return [math.sqrt(t * (1 + m)) for t, m in zip(text, marks, strict=True)]

    return fuse(smooth(text), smooth(marks)), fuse(text, marks)


def _above(element: Element, inside: set[int]) -> Element | None:
    """The child, among ``element`` and those around it, of an element whose id is in ``inside``."""
    e: Element | None = element
    while e is not None and e.parent is not None:
        if id(e.parent) in inside:
            return e
        e = e.parent
    return None


def _lists(nodes: list[Node], low: list[bool], inside: set[int]) -> list[bool]:
    """Which nodes the statistics take for lists of links, teasers or repeated notices.

    Neighbours of one path that are mostly links are a list; a linked headline between paragraphs is
    none. A block of a container with several nodes, all of paths below the threshold, is teasers if
    TEASER_SHARE of it are links. A text that stands NOTICE_TIMES in such paths is a notice.
    """
    blocks: dict[int, list[int]] = {}
    times: dict[str, int] = {}
    of = [_above(x.element, inside) for x in nodes]
    for x, block, small in zip(nodes, of, low, strict=True):
        if block is not None:
            sums = blocks.setdefault(id(block), [0, 0, 0, 0])
            for i, n in enumerate((1, not small, x.links, len(x.text))):
                sums[i] += n
        if small and x.element.tag in NOTICE_TAGS:
            times[x.text] = times.get(x.text, 0) + 1
    linked = [x.element.path if x.links >= LIST_SHARE * len(x.text) else None for x in nodes]

    def listed(i: int) -> bool:
        if linked[i] is not None and linked[i] in (linked[i - 1] if i else None, *linked[i + 1 : i + 2]):
            return True
        if of[i] is not None:
            n, good, links, chars = blocks[id(of[i])]
            if n > 1 and not good and links >= TEASER_SHARE * chars:
                return True
        return low[i] and nodes[i].element.tag in NOTICE_TAGS and times[nodes[i].text] >= NOTICE_TIMES

    return [listed(i) for i in range(len(nodes))]


def main_text(page: str) -> str:
    """The article's text of one page.

    Ratios of text and punctuation by tag path, smoothed in page order and fused, are held against
    a share of their standard deviation; nodes inside article or main elements have theirs raised by
    CONTENT_PRIOR. What reaches it, is in no container for other purposes and no list of links is
    chosen. The content's containers are the outermost article or main elements with chosen nodes,
    or all of them where none has any; without such elements, the deepest element with most of the
    text of nodes that reach it unsmoothed too.
    All text of the containers belongs to the article, short lines included, but for what is in
    containers for other purposes, lists of links, teasers and repeated notices.
    """
    nodes = _nodes(page)
    if not nodes:
        return ""
    total = sum(len(x.text) for x in nodes)
    for x in nodes:
        e: Element | None = x.element
        while e is not None:
            e.chars += len(x.text)
            e = e.parent

    def boilerplate(e: Element | None) -> bool:
        while e is not None:
            if e.flagged == "sure" or (e.tag == "form" and e.chars <= MOST_SHARE * total):
                return True
            parent = e.parent.flagged if e.parent is not None else ""
            if e.flagged == "named" and not parent and e.chars <= MOST_SHARE * total:
                return True
            e = e.parent
        return False

    judged = [not boilerplate(x.element) for x in nodes]
    smoothed, plain = _fused_ratios(nodes)
    prior = [CONTENT_PRIOR if x.element.content else 1.0 for x in nodes]
    ratios = [p * r for p, r in zip(prior, smoothed, strict=True)]
    mean = sum(ratios) / len(ratios)
    least = THRESHOLD * math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    low = [p * r < least for p, r in zip(prior, plain, strict=True)]
    chosen = [ok and r >= least for ok, r in zip(judged, ratios, strict=True)]
    listed = _lists(nodes, low, set())
    chosen = [ok and not out for ok, out in zip(chosen, listed, strict=True)]
    if not any(chosen):
        chosen = judged
    roots: dict[int, bool] = {}
    outer: list[int | None] = []
    for x, ok, good in zip(nodes, judged, chosen, strict=True):
        e: Element | None = x.element
        while e is not None and e.parent is not None and e.parent.content:
            e = e.parent
        outer.append(id(e) if ok and e.content else None)
        if outer[-1] is not None:
            roots[id(e)] = roots.get(id(e), False) or good
    if roots:
        inside = {i for i, good in roots.items() if good} or set(roots)
        listed = _lists(nodes, low, inside)
        held = [i in inside for i in outer]
        kept = [ok and not out for ok, out in zip(held, listed, strict=True)]
        # Containers of lists alone: the lists are the content.
        return " ".join(x.text for x, ok in zip(nodes, kept if any(kept) else held, strict=True) if ok)
    # What only its neighbours' ratios raise is content inside the container, not what sets it.
    strong = [good and not small for good, small in zip(chosen, low, strict=True)]
    if not any(strong):
        strong = chosen
    sums: dict[int, tuple[int, Element]] = {}
    size = 0
    for x, ok in zip(nodes, strong, strict=True):
        if ok:
            size += len(x.text)
            e = x.element
            while e.tag in PARTS:
                e = e.parent
            while e is not None:
                sums[id(e)] = (sums.get(id(e), (0, e))[0] + len(x.text), e)
                e = e.parent
    if not size:
        return ""
    most = [e for n, e in sums.values() if n >= 0.9 * size]
    container = max(most, key=lambda e: e.path.count("/"))

    def within(e: Element | None) -> bool:
        while e is not None:
            if e is container:
                return True
            e = e.parent
        return False

    listed = _lists(nodes, low, {id(container)})
    return " ".join(
        x.text for x, ok, good, out in zip(nodes, judged, strong, listed, strict=True)
        if ok and (good or (within(x.element) and not out and x.links * 2 < len(x.text)))
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    Each page is worked out by itself, whole; nothing is shuffled. Null and empty pages, and pages
    without content, have an empty text. Repeated rows and null ids stay; other columns are
    ignored; no rows give no rows.
    """
    def run(batches):
        for batch in batches:
            # One page at a time: a batch of long pages isn't held twice.
            texts = [main_text(batch.column(2)[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", F.coalesce("html", F.lit(""))).mapInArrow(
        run, "page_id long, url string, text string, n_chars long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


register("op4_tag_path_ratios", query)
