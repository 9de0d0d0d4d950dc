"""HTML extraction by minimum cut: which blocks of a page are its main text.

A page is cut into blocks at its block-level tags. What a block stands in and how it reads gives a cost
for calling it content or boilerplate; these become capacities from the source and to the sink. Blocks
that follow each other, and blocks with the same parent, are tied by smoothness edges. The minimum cut
is the labelling of least total cost.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "option p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset(
    "script style noscript template iframe textarea svg object canvas audio video head annotation "
    "annotation-xml".split()
)
CLOSES_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
#: A new one of these ends an open one of the same set inside the same list or table.
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"},
}
SCOPES = frozenset("ul ol menu dl table select div section article body html".split())
BOILERPLATE = frozenset("nav footer aside menu dialog select button fieldset search".split())
CONTENT = frozenset("article main".split())

# Words of class, id and role values that tell what an element is for.
BAD_WORDS = frozenset(
    "ad ads adv advert advertisement advertisements advertising sponsor sponsored promo promotion "
    "banner nav navbar navigation menu menus submenu sidebar sidebars breadcrumb breadcrumbs header "
    "masthead footer colophon cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login form search share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond "
    "widget widgets toolbar pagination pager copyright complementary contentinfo dialog "
    "alertdialog outbrain taboola teaser paywall disclaimer skip".split()
)
GOOD_WORDS = frozenset("article post entry story content maincontent main articlebody".split())
# Words that name any part of a page. A class name of these and bad words tells of boilerplate; one
# with another word, such as social-science, tells of a topic.
PART_WORDS = GOOD_WORDS | frozenset(
    "area bar block body bottom box button buttons card cards center col column container desktop "
    "feed fixed global group holder icon icons image inner item items left link links list message "
    "mobile module outer page pages panel popular posts primary region results right row secondary "
    "section site slot small sticky text title toggle top unit view wrap wrapper zone".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.DOTALL,
)
#: One attribute, its name and value; all are read in order, so no value is taken for a name.
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
TELLING = frozenset("class id role hidden aria-hidden".split())
#: First words of a class name that say what the page has or lacks, or what a post is about.
OF_THE_PAGE = frozenset(
    "has have with no non without tag category cat type format status topic term lang author".split()
)
#: A form, or an article inside a marked element, with this share of the page's unlinked text is no
#: part of the boilerplate: such a form holds the page, such an article is the page's.
OWN_SHARE = 0.5
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

#: Weights of the costs and of the ties between blocks.
INSIDE_BAD = -9.0
INSIDE_GOOD = 7.0
HIDDEN = -99.0
NEXT_TO = 0.6
SAME_PARENT = 0.9


#: An open element: its name and number, what it says of its text, what it says as seen from the
#: innermost article around it, and the numbers of that article and of the form around it, or 0.
Place = tuple[str, int, float, float, int, int]


class Block:
    __slots__ = ("text", "parent", "mark", "linked", "heading", "inner", "article", "form")

    def __init__(self, text: str, parent: int, linked: int, heading: bool, place: Place) -> None:
        self.text, self.parent, self.linked, self.heading = text, parent, linked, heading
        self.mark, self.inner, self.article, self.form = place[2:]


def _tells_bad(token: str) -> tuple[bool, bool]:
    """Whether a class name, id or role tells of boilerplate, and whether of content."""
    parts = [w.lower() for w in NAME_PART.findall(token)]
    if not parts or parts[0] in OF_THE_PAGE:
        return False, False
    bad = [w for w in parts if w in BAD_WORDS]
    good = any(w in GOOD_WORDS for w in parts)
    if not bad:
        return False, good
    # the header of an entry has its headline
    of_entry = good and "main" not in parts and bad == ["header"]
    return not of_entry and all(
        w in BAD_WORDS or w in PART_WORDS or len(w) <= 2 for w in parts), False


def _mark(tag: str, attributes: str, inherited: float) -> float:
    """What an element says about all that is in it; an element says more than those around it."""
    if inherited == HIDDEN:
        return HIDDEN
    bad, good = tag in BOILERPLATE or tag == "header" and inherited <= 0, tag in CONTENT
    if attributes and tag not in ("html", "body"):
        for name, value in ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name not in TELLING:
                continue
            if name == "hidden" or name == "aria-hidden" and "true" in value.lower():
                return HIDDEN
            for token in value.strip("\"'").split():
                tells_bad, tells_good = _tells_bad(token)
                bad, good = bad or tells_bad and tag not in CONTENT, good or tells_good
    if bad:
        return INSIDE_BAD
    return INSIDE_GOOD if good and inherited >= 0 else inherited


def blocks(html: str) -> list[Block]:
    """The page's blocks of text in order, white space turned into single spaces."""
    out: list[Block] = []
    stack: list[Place] = [("", 0, 0.0, 0.0, 0, 0)]
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked, in_link, elements, at = 0, 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = " ".join(unescape("".join(text)).split())
            if words:
                tag, parent = stack[-1][:2]
                # the block's own element is no tie; the one around it is
                around = stack[-2][1] if len(stack) > 1 and tag in ("p", "li", "h1", "h2", "h3", "h4",
                                                                   "h5", "h6") else parent
                out.append(Block(words, around, linked, tag[:1] == "h" and tag[1:].isdigit(), stack[-1]))
            text.clear()
        linked = 0

    def close(k: int) -> None:
        flush()
        opened.subtract([place[0] for place in stack[k:]])
        del stack[k:]

    def open_element(tag: str, attributes: str) -> None:
        _, _, mark, inner, article, form = stack[-1]
        mark = _mark(tag, attributes, mark)
        if tag in CONTENT:
            inner, article = _mark(tag, attributes, HIDDEN if mark == HIDDEN else 0.0), elements
        else:
            inner = _mark(tag, attributes, inner)
        stack.append((tag, elements, mark, inner, article, elements if tag == "form" else form))
        opened[tag] += 1

    while True:
        m = TOKEN.search(html, at)
        piece = html[at:m.start()] if m else html[at:]
        if piece:
            text.append(piece)
            if in_link:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        ending, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            if html.startswith("<![CDATA[", m.start()):
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if ending:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag in BLOCK:
                if not opened[tag]:
                    flush()
                    continue
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
            continue
        if tag in RAW:
            if not attributes.rstrip().endswith("/") or tag in ("script", "style", "head"):
                end = ENDS[tag].search(html, at)
                if tag == "head":  # it may lack its end tag
                    body = re.compile(r"<body(?=[\s>])", re.IGNORECASE).search(html, at)
                    if body and (not end or body.start() < end.start()):
                        at = body.start()
                        continue
                if end:
                    at = end.start()
                elif tag in ("script", "style", "head", "textarea"):
                    at = len(html)
            continue
        if tag == "a":
            in_link = 1
        elif tag == "br" or tag == "img" or tag == "input" or tag == "wbr":
            if tag == "br":
                text.append(" ")
        elif tag in BLOCK:
            flush()
            if tag in CLOSES_P and opened["p"]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in ("div", "section", "article", "td", "li", "body"):
                        break
            same = SIBLINGS.get(tag)
            if same and any(opened[name] for name in same):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in same:
                        close(k)
                        break
                    if stack[k][0] in SCOPES:
                        break
            if tag not in VOID:
                elements += 1
                open_element(tag, attributes)
        elif tag == "button":
            end = re.compile(r"</button(?=[\s/>])", re.IGNORECASE).search(html, at)
            if end:
                at = end.start()
    flush()
    return _settled(out)


def _settled(page: list[Block]) -> list[Block]:
    """Sets the marks of blocks in forms, and of those in an article that most of the page is."""
    own: Counter[int] = Counter()
    for block in page:
        if block.mark != HIDDEN:
            n = max(0, len(block.text) - block.linked)
            own[0] += n
            own.update({k: n for k in (block.article, block.form) if k})
    most = OWN_SHARE * own[0]
    for block in page:
        if block.article and own[block.article] >= most:
            block.mark = block.inner
        if block.form and own[block.form] < most:
            block.mark = min(block.mark, INSIDE_BAD)
    return page


LEGAL = re.compile(r"^\s*(?:©|\(c\)\s|copyright\b)|all rights reserved", re.IGNORECASE)


def leaning(block: Block) -> float:
    """The cost of calling the block boilerplate, less that of calling it content."""
    n = len(block.text)
    in_links = min(1.0, block.linked / n)
    score = block.mark + 0.2 + min(2.0, n / 80)
    if in_links > 0.5 and block.mark <= 0:
        score -= 4.0 * in_links
    if LEGAL.search(block.text) and n < 200 and block.mark <= 0:
        score -= 4.0
    if block.heading:
        score += 0.5
    return score


def minimum_cut(gain: list[float], ties: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut, by Dinic's maximum flow.

    A positive gain is a capacity from the source, a negative one to the sink; a tie is a capacity
    both ways. Of several minimum cuts, the one with the most nodes on the source's side.
    """
    n = len(gain)
    if all(g >= 0 for g in gain) or all(g < 0 for g in gain):
        return [g >= 0 for g in gain]
    source, sink = n, n + 1
    heads: list[int] = []
    room: list[float] = []
    edges: list[list[int]] = [[] for _ in range(n + 2)]

    def add(a: int, b: int, there: float, back: float) -> None:
        edges[a].append(len(heads))
        edges[b].append(len(heads) + 1)
        heads.extend((b, a))
        room.extend((there, back))

    for v, g in enumerate(gain):
        if g >= 0:
            add(source, v, g, 0.0)
        else:
            add(v, sink, -g, 0.0)
    for a, b, w in ties:
        add(a, b, w, w)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in edges[v]:
                if room[e] > tiny and level[heads[e]] < 0:
                    level[heads[e]] = level[v] + 1
                    queue.append(heads[e])
        if level[sink] < 0:
            break
        at = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(i for i, e in enumerate(path) if room[e] <= tiny)
                v = heads[path[cut] ^ 1]
                del path[cut:]
                continue
            while at[v] < len(edges[v]):
                e = edges[v][at[v]]
                if room[e] > tiny and level[heads[e]] == level[v] + 1:
                    break
                at[v] += 1
            if at[v] < len(edges[v]):
                path.append(edges[v][at[v]])
                v = heads[path[-1]]
            elif path:
                v = heads[path.pop() ^ 1]
                at[v] += 1
            else:
                break
    # what can still reach the sink is on its side
    reaches = [False] * (n + 2)
    reaches[sink] = True
    queue = deque([sink])
    while queue:
        v = queue.popleft()
        for e in edges[v]:
            if room[e ^ 1] > tiny and not reaches[heads[e]]:
                reaches[heads[e]] = True
                queue.append(heads[e])
    return [not r for r in reaches[:n]]


def ties(page: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: to the block before, and to the last block with the same parent."""
    out, last = [], {}
    for i, block in enumerate(page):
        if i:
            same = page[i - 1].parent == block.parent
            out.append((i - 1, i, NEXT_TO + SAME_PARENT * same))
        j = last.get(block.parent)
        if j is not None and j < i - 1:
            out.append((j, i, SAME_PARENT))
        last[block.parent] = i
    return out


def main_text(html: str | None) -> str:
    page = blocks(html or "")
    chosen = minimum_cut([leaning(b) for b in page], ties(page))
    return "\n".join(b.text for b, keep in zip(page, chosen, strict=True) if keep)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """The rows of ``pages`` with one more column, ``main_text``, the blocks of content joined by \\n.

    Null and empty pages, and pages without content, give an empty text; repeated rows are treated
    alike; an empty table gives an empty one; a column ``main_text`` of the input is replaced. One
    narrow pass, whole pages, without a shuffle.
    """
    @F.pandas_udf("string")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(main_text, na_action=None)

    return pages.withColumn("main_text", texts(F.coalesce(F.col(f"`{html}`"), F.lit(""))))
