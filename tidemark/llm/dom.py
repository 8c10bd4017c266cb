"""Block trees of HTML pages and the features of their nodes."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|aria-label|name)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)""", re.I)  # the attribute, with values blanked out
UNSEEN = re.compile(r"""style\s*=\s*(?:"[^"]*|'[^']*|\S*)(?:display\s*:\s*none|visibility\s*:\s*hidden)|aria-hidden\s*=\s*["']?true""", re.I)
# their content is no text of the page, or no prose; a head holds nothing but some of these
RAW = frozenset("script style title textarea iframe noscript template".split())
SKIPPED = RAW | frozenset("select button object svg math canvas audio video datalist".split())
# an element of SKIPPED without its end tag, or whose end tag stands behind one of these, ends where one of these begins
OUTSIDE = re.compile(r"<(?=/?(?:article|aside|blockquote|body|footer|form|h[1-6]|header|main|nav|ol|p|section|table|ul)[\s>])", re.I)
BREAKS = frozenset("br hr wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# fixed order: a node's own bits, then those of its ancestors
TAGS = ("p", "heading", "list", "item", "table", "cell", "article", "section", "nav", "header", "footer", "aside", "form", "div", "quote", "figure")
TAG_BITS = {name: TAGS.index(kind) for kind, names in {
    "p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "item": "li dt dd", "table": "table thead tbody tfoot tr caption",
    "cell": "td th", "article": "article main", "section": "section details summary", "nav": "nav", "header": "header", "footer": "footer",
    "aside": "aside dialog", "form": "form fieldset legend label search", "div": "div center address body html", "quote": "blockquote pre",
    "figure": "figure figcaption"}.items() for name in names.split()}
TOKENS = (
    ("nav", r"nav|menu|breadcrumb|crumb|pagination|pager|toc|skip|tabs"), ("header", r"header|masthead|topbar|site-?title|logo|branding"),
    ("footer", r"footer|copyright|colophon|legal|imprint"), ("aside", r"side-?bar|aside|widget|rail|complementary"),
    ("ad", r"(?:^|[^a-z])ads?(?:$|[^a-z])|advert|sponsor|promo|banner|commercial|affiliate"),
    ("notice", r"cookie|consent|notice|alert|popup|modal|overlay|gdpr|dialog|warning|toast|disclaimer"),
    ("form", r"form|search|login|sign-?up|subscri|newsletter|register|contact"), ("comment", r"comment|respon[sd]|reply|replies|discuss|disqus|review|guestbook"),
    ("share", r"share|social|follow|twitter|facebook|tags?(?:$|[^a-z])|print|toolbar|button"),
    ("related", r"relat|recommend|more-|teaser|trending|popular|read-?next|also|latest"),
    ("content", r"content|article|post|entry|story|body|text|main|prose|page"),
    ("hidden", r"(?!)"))  # set by attributes and whole classes
TOKEN_PATTERNS = [re.compile(pattern, re.I) for _, pattern in TOKENS]
# a class that says what a page or box has, lacks or does is none that says what it is: with-sidebar, no-comments, overflow-hidden
MANNER = re.compile(r"(?:^|\s)(?:(?:no|not|has|have|with|without|is|hide|hides|show|shows|overflow|js|u)[-_]\S*|"
                    r"\S*[-_](?:free|offset|enabled|disabled|visible|open|opened|closed|active|inactive|left|right|padding|margin|spacing|above|below|on|off))(?=\s|$)", re.I)
UNSEEN_CLASS = re.compile(r"(?:^|\s)(?:hidden|sr-only|visually-?hidden|screen-reader-text)(?=\s|$)", re.I)
WIDTH = len(TAGS) + len(TOKENS)
AROUND = sum(1 << TAGS.index(t) for t in ("nav", "header", "footer", "aside", "form")) + sum(
    1 << (len(TAGS) + k) for k, (t, _) in enumerate(TOKENS) if t != "content")
WRAPS = 0.9  # of a page's text
INLINE_CLOSED_BY = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
PUNCTUATION = re.compile(r"[.,;:!?]")
MARK = "\ue000"  # stands before the main text in training pages

_BITS: dict[tuple[str, str], int] = {}


def _bits(tag: str, attributes: str) -> int:
    """Bits of a tag and of the words in its class, id, role and label; remembered up to a bound."""
    key = (tag, attributes)
    if key not in _BITS:
        if len(_BITS) > 50_000:
            _BITS.clear()
        bits = 1 << TAG_BITS.get(tag, TAG_BITS["div"])
        words = " ".join(a or b or c for _, a, b, c in ATTRIBUTE.findall(attributes))
        told = MANNER.sub(" ", words)
        for k, pattern in enumerate(TOKEN_PATTERNS):
            if pattern.search(told):
                bits |= 1 << (len(TAGS) + k)
        if HIDDEN.search(QUOTED.sub("''", attributes)) or UNSEEN.search(attributes) or UNSEEN_CLASS.search(words):
            bits |= 1 << (WIDTH - 1)
        _BITS[key] = bits
    return _BITS[key]


@dataclass
class Tree:
    """Nodes of one page in order: elements that form blocks, and the text runs in them as leaves."""

    parent: list[int] = field(default_factory=lambda: [-1])
    end: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])
    bits: list[int] = field(default_factory=lambda: [0])
    above: list[int] = field(default_factory=lambda: [0])
    tags: list[int] = field(default_factory=lambda: [0])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])


def parse(page: str) -> Tree:
    """The block tree of a page; broken markup gives some tree, never an error.

    Inline elements only delimit link text. A head needs no end tag, as its elements are skipped one by one; an unclosed button, list of options
    or drawing ends where a block begins. A paragraph, item, row or cell is closed by the next one; an end tag closes what is open inside
    its element, and one without an element is ignored. Character references are decoded, white space in a run becomes one space.
    """
    tree = Tree()
    stack = [(0, "")]  # open blocks: node, tag
    run: list[str] = []
    link, linked, tags = False, 0, 0

    def flush() -> None:
        nonlocal linked, tags
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                node = stack[-1][0]
                for column, value in ((tree.parent, node), (tree.end, len(tree.parent) + 1), (tree.depth, tree.depth[node] + 1),
                                      (tree.bits, 0), (tree.above, tree.above[node] | tree.bits[node]), (tree.tags, tags), (tree.text, text),
                                      (tree.linked, min(linked, len(text)))):
                    column.append(value)
        linked = tags = 0

    def close() -> None:
        node, _ = stack.pop()
        tree.end[node] = len(tree.parent)

    at, size = 0, len(page)
    while at < size:
        token = TOKEN.match(page, at)
        at = token.end()
        name = token[2]
        if name is None:
            raw = token[0]
            if raw[0] != "<" or raw == "<":
                raw = html.unescape(raw) if "&" in raw else raw
                run.append(raw)
                if link:
                    linked += len(raw)
            continue
        name = name.lower()
        if token[1]:
            if name in TAG_BITS:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][1] == name:
                        flush()
                        while len(stack) > depth:
                            close()
                        break
                link = False
            elif name == "a":
                link = False
            elif name == "br":
                run.append(" ")
            continue
        if name in SKIPPED:
            ending = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            again = name not in RAW and ending and re.compile(rf"<{name}(?=[\s/>])", re.I).search(page, at, ending.start())
            if name not in RAW and (ending is None or again or name in ("button", "select", "datalist")):
                outside = OUTSIDE.search(page, at, ending.start() if ending else size)
                if outside:
                    at = outside.start()
                    continue
            if not token[3].endswith("/") or name in ("script", "style"):
                at = ending.end() if ending else size
                after = TOKEN.match(page, ending.start()) if ending else None
                at = after.end() if after else at
            continue
        if name in BREAKS:
            run.append(" ")
            if name == "hr":
                flush()
            continue
        if name not in TAG_BITS:
            tags += 1
            link = link or name == "a"
            continue
        flush()
        link = False
        if name in INLINE_CLOSED_BY:
            group = ("td", "th") if name in ("td", "th") else ("dt", "dd") if name in ("dt", "dd") else (name,)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][1] in INLINE_CLOSED_BY[name]:
                    break
                if stack[depth][1] in group:
                    while len(stack) > depth:
                        close()
                    break
        elif stack[-1][1] == "p":
            close()
        if stack[-1][1] == "p":
            close()
        node, up = len(tree.parent), stack[-1][0]
        for column, value in ((tree.parent, up), (tree.end, 0), (tree.depth, tree.depth[up] + 1), (tree.bits, _bits(name, token[3])),
                              (tree.above, tree.above[up] | tree.bits[up]), (tree.tags, 1), (tree.text, ""), (tree.linked, 0)):
            column.append(value)
        stack.append((node, name))
    flush()
    while stack:
        close()
    # what a wrapper of nearly the whole page is called says nothing about what it holds
    size = np.concatenate([[0], np.cumsum([len(x) for x in tree.text])])
    within = (size[tree.end] - size[:-1]).tolist()
    for k in range(1, len(tree.parent)):
        if not tree.text[k] and within[k] >= WRAPS * size[-1]:
            tree.bits[k] &= ~AROUND
        p = tree.parent[k]
        tree.above[k] = tree.above[p] | tree.bits[p]
    return tree


NUMBERS = 22
ARTICLE = 1 << TAGS.index("article") | 1 << (len(TAGS) + [t for t, _ in TOKENS].index("content"))
FEATURES = NUMBERS + 2 * WIDTH


def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, parent, end) of the nodes of all trees; parents and ends count over all of them.

    Subtree sums are differences of running sums, as a subtree is a stretch of nodes: characters, link characters, tags, texts and
    punctuation. Further the depth, place among siblings, sibling means, share and place in the page, the number of
    tags and attribute words that speak for and against an article, and the bits of tag and attribute words
    of the node (of a text: of its parent) and of all above it.
    """
    sizes = np.array([len(t.parent) for t in trees])
    base = np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = lambda name, kind=np.int64: np.fromiter((v for t in trees for v in getattr(t, name)), kind, int(sizes.sum()))
    parent, end, depth, bits, above, tags, linked = map(flat, ("parent", "end", "depth", "bits", "above", "tags", "linked"))
    root = parent < 0
    parent, end = np.where(root, np.arange(len(parent)), parent + base), end + base
    texts = [x for t in trees for x in t.text]
    chars = np.fromiter(map(len, texts), np.int64, len(texts))
    stops = np.fromiter((len(PUNCTUATION.findall(x)) if x else 0 for x in texts), np.int64, len(texts))
    words = np.fromiter((x.count(" ") + 1 if x else 0 for x in texts), np.int64, len(texts))
    leaf = chars > 0
    here = np.arange(len(parent))

    def within(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return (total[end] - total[here]).astype(float)

    size, links, inside, leaves, marks, count = map(within, (chars, linked, tags, leaf, stops, words))
    page = size[base]
    before = np.concatenate([[0], np.cumsum(chars)])
    place = (before[here] - before[base]) / np.maximum(page, 1)
    child = np.flatnonzero(~root)
    order = child[np.argsort(parent[child], kind="stable")]
    rank = np.zeros(len(parent))
    new = np.ones(len(order), bool)
    new[1:] = parent[order[1:]] != parent[order[:-1]]
    rank[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else 0
    brothers = np.bincount(parent[child], minlength=len(parent))[parent].astype(float)
    brothers[root] = 1
    mean = (np.bincount(parent[child], weights=size[child], minlength=len(parent))[parent]) / np.maximum(brothers, 1)
    kind = parent * 64 + np.where(leaf, 63, np.log2(np.maximum(bits & ((1 << len(TAGS)) - 1), 1)).astype(np.int64))
    _, same, number = np.unique(kind, return_inverse=True, return_counts=True)
    longest = leaf & (chars >= 200)
    own = np.where(leaf, bits[parent], bits)
    over = np.where(leaf, above[parent], above)
    signs = [np.bitwise_count(b & mask) for b in (own, over) for mask in (AROUND, ARTICLE)]
    numbers = np.column_stack([
        depth, leaf, np.log1p(size), np.log1p(inside), size / (inside + 1), links / np.maximum(size, 1), size / np.maximum(page, 1), place, rank,
        brothers, np.log1p(mean), size / np.maximum(mean, 1), number[same] / np.maximum(brothers, 1), marks / np.maximum(size, 1),
        leaves, size / np.maximum(leaves, 1), count / np.maximum(leaves, 1), within(longest), *signs])
    bit = np.arange(WIDTH)
    return np.column_stack([numbers, (own[:, None] >> bit) & 1, (over[:, None] >> bit) & 1]), np.where(root, -1, parent), end
