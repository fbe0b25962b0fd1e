"""HTML to a tree of blocks with features, and back to the text of chosen blocks.

A node is a block element, an inline element with a class, id or role, or a run
of text that stands directly in a container. Node 0 is the document; a parent
comes before its children.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# HTML elements by the way they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
HIDDEN = frozenset("template svg math select button datalist object canvas audio video map dialog".split())
CONTAINERS = frozenset("html body main article section div aside header footer nav form center details fieldset hgroup search td th".split())
BLOCKS = CONTAINERS | frozenset(
    "head p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr blockquote pre figure figcaption address summary legend menu dir".split()
)
# What an opening tag closes, if open: a paragraph, or the element before it up to its own container.
CLOSES_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "thead", "tbody", "tfoot", "caption", "legend", "summary"}
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
TAGS = (
    "body main article section div aside header footer nav form p h1 h2 h3 ul ol li dl table tr td blockquote pre figure span a address run".split()
)
TAG_OF = {name: n for n, name in enumerate(TAGS)} | {"h4": TAGS.index("h3"), "h5": TAGS.index("h3"), "h6": TAGS.index("h3")}
TAG_OF |= {"th": TAGS.index("td"), "dt": TAGS.index("dl"), "dd": TAGS.index("dl"), "menu": TAGS.index("ul"), "search": TAGS.index("form")}
# Words in class, id and role attributes, by what they hint at.
HINTS = {
    "content": "article content entry main body post story text prose blog copy page richtext",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs tabs toolbar pager pagination paging toc links skip sitemap",
    "header": "header head masthead topbar top logo branding brand site hero tagline",
    "footer": "footer foot bottom copyright legal colophon credits contentinfo",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular more secondary complementary teaser teasers",
    "advert": "ad ads adv advert adverts advertisement advertising adsense adsbygoogle dfp sponsor sponsored sponsors promo promotion banner outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notices alert alerts popup modal overlay paywall warning toast announcement message privacy",
    "form": "form forms search searchbox login signin signup register contact newsletter subscribe subscription field",
    "comment": "comment comments commentlist commentary reply replies respond disqus discussion feedback reviews review thread responses",
    "share": "share sharing social follow buttons tools tags tagged meta actions print",
}
HINT_OF = {word: 1 << n for n, words in enumerate(HINTS.values()) for word in words.split()}
LONG_HINTS = sorted((word for word in HINT_OF if len(word) >= 6), key=len, reverse=True)
ABOVE = "article main section aside header footer nav form ul table".split()
ABOVE_OF = {name: 1 << n for n, name in enumerate(ABOVE)} | {"ol": 1 << ABOVE.index("ul")}

_TOKEN = re.compile(r"""<(?:!--|(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|[^>=])*+)>|[!?/][^>]*+>)""")
_ATTRIBUTE = re.compile(r"""([A-Za-z][A-Za-z0-9-]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.IGNORECASE) for name in RAW}


@dataclass
class Page:
    """The nodes of a page as columns, and its text as (node, text) with None between blocks."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    hints: list[int] = field(default_factory=list)
    hints_above: list[int] = field(default_factory=list)
    tags_above: list[int] = field(default_factory=list)
    hidden: list[bool] = field(default_factory=list)
    mark: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    link_chars: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    links: list[int] = field(default_factory=list)
    signs: list[int] = field(default_factory=list)
    start: list[int] = field(default_factory=list)
    pieces: list[tuple[int, str] | None] = field(default_factory=list)

    def node(self, name: str, parent: int, hints: int, hidden: bool, mark: int, start: int) -> int:
        above = parent >= 0
        self.tag.append(TAG_OF.get(name, TAG_OF["div"] if name in BLOCKS else TAG_OF["span"]))
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if above else 0)
        self.hints.append(hints)
        self.hints_above.append(self.hints[parent] | self.hints_above[parent] if above else 0)
        self.tags_above.append(self.tags_above[parent] | ABOVE_OF.get(TAGS[self.tag[parent]], 0) if above else 0)
        self.hidden.append(hidden)
        self.mark.append(mark)
        for column in (self.chars, self.link_chars, self.stops, self.links, self.signs):
            column.append(0)
        self.start.append(start)
        return len(self.tag) - 1


@lru_cache(100_000)
def _hint(word: str) -> int:
    """What a word hints at; a longer word counts as the long word it begins with."""
    known = HINT_OF.get(word)
    return known if known is not None else next((HINT_OF[hint] for hint in LONG_HINTS if word.startswith(hint)), 0)


def _attributes(source: str) -> tuple[int, bool, int | None, bool]:
    """Hints, whether it is hidden, the mark of a training page, and whether it has a class, id or role."""
    hints, hidden, mark, named = 0, False, None, False
    for name, a, b, c in _ATTRIBUTE.findall(source):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            named = True
            for word in _WORD.findall(value):
                hints |= _hint(word.lower()[:40])
        elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE)):
            hidden = True
        elif name == "data-main":
            mark = int(value)
    return hints, hidden, mark, named


def parse(source: str) -> Page:
    """The page of any HTML, closed properly or not; never fails."""
    page = Page()
    root = page.node("html", -1, 0, False, 0, 0)
    # Open elements: name, node, whether it made the node, whether in a link.
    stack: list[tuple[str, int, bool, bool]] = [("", root, True, False)]
    run = -1  # the run of text that is still open in the innermost container
    at, seen = 0, 0
    limit = source.rfind(">") + 1

    def add(text: str) -> None:
        nonlocal run, seen
        if not text:
            return
        name, node, _, linked = stack[-1]
        size = len(text) - text.count(" ") - text.count("\n")
        if TAGS[page.tag[node]] in CONTAINERS or node == root:
            if run < 0:
                if not size:
                    return
                run = page.node("run", node, 0, False, page.mark[node], seen)
            node = run
        page.pieces.append((node, text))
        page.chars[node] += size
        page.stops[node] += text.count(". ") + text.count(",") + text.endswith(".")
        page.signs[node] += text.count("©") + text.count("&copy;") + text.count("|") + text.count("·") + text.count("&middot;")
        if linked:
            page.link_chars[node] += size
        seen += size

    def cut() -> None:
        nonlocal run
        run = -1
        if page.pieces and page.pieces[-1] is not None:
            page.pieces.append(None)

    def close(depth: int) -> None:
        if any(made and TAGS[page.tag[node]] not in ("span", "a") for _, node, made, _ in stack[depth:]):
            cut()
        del stack[depth:]

    def close_open(names: set[str], up_to: set[str] | frozenset[str]) -> None:
        found = None
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in names:
                found = depth
            elif stack[depth][0] in up_to:
                break
        if found:
            close(found)

    while at < limit:
        match = _TOKEN.search(source, at, limit)
        if not match:
            break
        add(source[at : match.start()])
        at = match.end()
        if match[2] is None:
            if match[0] == "<!--":
                end = source.find("-->", match.start() + 2)
                at = len(source) if end < 0 else end + 3
            continue
        name = match[2].lower()
        if match[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
                if name not in BLOCKS and stack[depth][0] in BLOCKS:
                    break
            continue
        if name in VOID:
            if name == "br":
                add(" ")
            elif name == "hr":
                cut()
            continue
        if name in RAW:
            end = _RAW_END[name].search(source, at)
            at = end.end() if end else len(source)
            continue
        block = name in BLOCKS or "-" in name
        if name in CLOSES_P:
            close_open({"p"}, CONTAINERS | {"li", "blockquote", "table"})
        if name in CLOSES:
            close_open(*CLOSES[name])
        hints, hidden, mark, named = _attributes(match[3]) if match[3] else (0, False, None, False)
        _, above, _, linked = stack[-1]
        if match[3].endswith("/") and not block:
            continue
        if block or named or name in HIDDEN or hidden:
            # Inline nodes hang on the open run, so that they stay part of its text.
            if block:
                cut()
            parent = above
            if not block and (TAGS[page.tag[above]] in CONTAINERS or above == root):
                if run < 0:
                    run = page.node("run", above, 0, False, page.mark[above], seen)
                parent = run
            kind = "div" if block and name not in BLOCKS else name
            node = page.node(kind, parent, hints, hidden or name in HIDDEN, page.mark[parent] if mark is None else mark, seen)
            made = True
        else:
            node, made = above, False
        if name == "a":
            page.links[node] += 1
        stack.append((name, node, made, linked or name == "a"))
    tail = source[max(at, limit) :]
    add(re.split(r"<[A-Za-z/!?]", tail, maxsplit=1)[0])
    return page


FEATURES = [
    *(f"is {name}" for name in TAGS),
    *(f"{name} in its attributes" for name in HINTS),
    *(f"{name} in attributes above" for name in HINTS),
    *(f"in {name}" for name in ABOVE),
    "depth",
    "place among siblings",
    "siblings",
    "siblings of its tag",
    "children",
    "text",
    "own text",
    "share of links in the text",
    "links by text",
    "text by element",
    "stops by text",
    "signs",
    "share of the page",
    "where it starts",
    "share of the parent",
    "text of the siblings",
    "share of links in the parent",
]


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray]:
    """One row of features per node of all pages, and whether the node holds text."""
    n = sum(len(page.tag) for page in pages)
    columns: dict[str, list] = {name: [] for name in ("tag", "hints", "hints_above", "tags_above", "depth", "chars", "start")}
    parent, place, same, total, chars, links, link_chars, stops, signs, size, children, whole = ([] for _ in range(12))
    first = 0
    for page in pages:
        count = len(page.tag)
        sums = [list(column) for column in (page.chars, page.link_chars, page.stops, page.links, page.signs)]
        elements, below, here = [1] * count, [0] * count, [0] * count
        alike: Counter[tuple[int, int]] = Counter()
        for i in range(1, count):
            up = page.parent[i]
            here[i] = below[up]
            below[up] += 1
            alike[up, page.tag[i]] += 1
        for i in range(count - 1, 0, -1):
            up = page.parent[i]
            for column in sums:
                column[up] += column[i]
            elements[up] += elements[i]
        for name, column in columns.items():
            column += getattr(page, name)
        parent += [first + max(up, 0) for up in page.parent]
        place += here
        same += [alike[up, tag] for up, tag in zip(page.parent, page.tag)]
        for column, values in zip((chars, link_chars, stops, links, signs), sums):
            column += values
        size += elements
        children += below
        whole += [max(sums[0][0], 1)] * count
        first += count
    if not n:
        return np.zeros((0, len(FEATURES))), np.zeros(0, dtype=bool)
    tag, hints, above, tags_above, depth, own, start = (np.array(columns[name]) for name in columns)
    up, place, same, chars, links, link_chars, stops, signs, size, children, whole = (
        np.array(x, dtype=np.float64 if x is not parent else np.int64) for x in (parent, place, same, chars, links, link_chars, stops, signs, size, children, whole)
    )
    text = np.maximum(chars, 1)
    siblings = children[up]
    bits = lambda column, count: ((column[:, None] >> np.arange(count)) & 1)
    matrix = np.column_stack(
        [
            tag[:, None] == np.arange(len(TAGS)),
            bits(hints, len(HINTS)),
            bits(above, len(HINTS)),
            bits(tags_above, len(ABOVE)),
            depth,
            place / np.maximum(siblings, 1),
            siblings,
            same,
            children,
            np.log1p(chars),
            np.log1p(own),
            link_chars / text,
            links / text,
            np.log1p(chars / size),
            stops / text,
            signs,
            chars / whole,
            start / whole,
            chars / np.maximum(chars[up], 1),
            np.log1p((chars[up] - chars) / np.maximum(siblings - 1, 1)),
            link_chars[up] / np.maximum(chars[up], 1),
        ]
    ).astype(np.float64)
    return matrix, chars > 0


def decode(page: Page, score: np.ndarray) -> list[bool]:
    """Which nodes hold main text, jointly most likely given that nothing below a rejected node is kept.

    ``score`` is the probability of each node. The best labelling of a subtree
    is found bottom up, once with its root kept and once with all of it rejected.
    """
    kept = np.log(np.clip(score, 1e-6, 1 - 1e-6))
    rejected = np.log1p(-np.clip(score, 1e-6, 1 - 1e-6))
    with_root, without = kept.tolist(), rejected.tolist()
    for i in range(len(with_root) - 1, -1, -1):
        if page.hidden[i]:
            with_root[i] = -np.inf
        if i:
            up = page.parent[i]
            with_root[up] += max(with_root[i], without[i])
            without[up] += without[i]
    chosen = [with_root[0] > without[0]]
    for i in range(1, len(with_root)):
        chosen.append(chosen[page.parent[i]] and with_root[i] > without[i])
    return chosen


def text_of(page: Page, chosen: list[bool]) -> str:
    """The blocks of the chosen nodes: references decoded, white space as one blank, joined by an empty line."""
    blocks, block = [], []
    for piece in [*page.pieces, None]:
        if piece is None:
            text = " ".join("".join(block).split())
            if text:
                blocks.append(text)
            block = []
        elif chosen[piece[0]]:
            block.append(entities.unescape(piece[1]))
    return "\n\n".join(blocks)
