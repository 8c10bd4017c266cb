"""Main text of HTML pages: boosted trees judge DOM nodes, a decoding over the tree keeps the judgements consistent."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .boosting import BoostedTrees
from .common import slices
from .dom import MARK, features, parse

TRAINING_PAGES = 600  # pages made by rule, whatever the size of the corpus
LIMIT = 6.0  # log odds beyond it count as this

BOXES = {  # what stands around an article: opening tags by kind
    "nav": ['<nav{}>', '<nav{}>', '<div class="{}menu">', '<ul id="{}nav">', '<div class="breadcrumbs{}">', '<div role="navigation"{}>', '<div{}>'],
    "header": ['<header{}>', '<header{}>', '<div id="header"{}>', '<div class="site-header {}">', '<div class="masthead {}">', '<div{}>'],
    "footer": ['<footer{}>', '<footer{}>', '<footer class="page-footer {}">', '<div class="footer {}">', '<div id="footer"{}>', '<div role="contentinfo"{}>', '<div{}>'],
    "aside": ['<aside{}>', '<div class="sidebar {}">', '<div id="sidebar"{}>', '<div class="widget {}">', '<section class="related {}">'],
    "ad": ['<div class="ad"{}>', '<div class="ads {}">', '<div id="advert"{}>', '<aside class="sponsored {}">', '<div class="promo {}">', '<div class="banner-ad {}">'],
    "notice": ['<div class="cookie-notice {}">', '<div class="notice {}">', '<div role="dialog"{}>', '<div id="consent"{}>', '<section class="alert {}">', '<div class="gdpr {}">'],
    "form": ['<form{}>', '<form class="search {}">', '<div class="newsletter {}"><form>', '<form id="login"{}>'],
    "comments": ['<section class="comments {}">', '<div id="comments"{}>', '<ol class="commentlist {}">', '<div class="discussion comments {}">', '<section id="responses"{}>'],
    "share": ['<div class="share {}">', '<ul class="social {}">', '<div class="toolbar share-buttons {}">'],
}
# classes that real pages set on the body, wrappers and articles without meaning these boxes
MANNERS = ["with-sidebar", "has-sidebar", "no-comments", "overflow-hidden", "page-header-offset", "advertorial-free", "nav-open", "sidebar-left", "is-single",
           "no-js", "theme-light", "hentry", "single-post"]
ARTICLES = ['<article{}>', '<article{}>', '<main{}>', '<article class="post {}">', '<div class="content {}">', '<div id="content"{}>', '<div class="entry-content {}">',
            '<div class="article-body {}">', '<section class="story {}">', '<main><article{}>', '<main><div{}>', '<div{}>', '<td{}>']


def made_page(seed: int) -> tuple[str, str]:
    """(html, main text) of an invented page: a grammar of articles and of the boxes around and inside them.

    In the html the main text's runs begin with ``MARK``, which is how training finds them; without it the page is plain.
    """
    r = random.Random(seed)
    odd = lambda p: r.random() < p
    main: list[str] = []

    def word() -> str:
        return "".join(r.choice("bcdfghlmnprstvw") + r.choice("aeiouéä") for _ in range(r.choice((1, 1, 2, 2, 3, 4))))

    def words(low: int, high: int, stop: str = "") -> str:
        return " ".join(word() for _ in range(r.randint(low, high))).capitalize() + stop

    def prose(low: int = 1, high: int = 6) -> str:
        out = " ".join(words(3, 18, r.choice("...!?")) for _ in range(r.randint(low, high)))
        if odd(0.1):
            out = " ".join(w + r.choice(("###", "$$$", "%%%", "!!")) for w in out.split(" "))
        return out

    def opened(kind: str | list[str], inner: str) -> str:
        head = r.choice(BOXES[kind] if isinstance(kind, str) else kind).format("")
        if not isinstance(kind, str) and odd(0.15):
            manner = r.choice(MANNERS)
            head = head.replace('class="', f'class="{manner} ', 1) if 'class="' in head else head.replace(">", f' class="{manner}">', 1)
        tags = [t.split()[0].strip("<>") for t in head.split("><")]
        return head + inner + "".join(f"</{t}>" for t in reversed(tags))

    def links(low: int, high: int) -> str:
        tag = r.choice(("li", "li", "span", ""))
        item = lambda: f'<a href="/{word()}">{words(1, 4)}</a>'
        out = "".join(f"<{tag}>{item()}</{tag}>" if tag else item() + r.choice((" ", " | ")) for _ in range(r.randint(low, high)))
        return f"<ul>{out}</ul>" if tag == "li" else out

    def box(kind: str) -> str:
        if kind == "nav":
            inner = links(3, 9)
        elif kind == "header":
            inner = (f"<h1>{words(1, 3)}</h1>" if odd(0.3) else f"<a href='/'>{words(1, 3)}</a>") + (f"<p>{words(3, 8)}</p>" if odd(0.4) else "") + (links(3, 6) if odd(0.5) else "")
        elif kind == "footer":
            inner = r.choice((f"&copy; {word()}.example {words(2, 9, '.')}", f"<p>&copy; 2020 {words(2, 12, '.')}</p>" + links(2, 5), prose(1, 2)))
        elif kind == "aside":
            inner = f"<h{(h := r.randint(2, 4))}>{words(1, 4)}</h{h}>" + r.choice((links(3, 8), f"<p>{prose(1, 3)}</p>", links(2, 4) + f"<p>{prose(1, 2)}</p>"))
        elif kind == "ad":
            inner = r.choice((words(4, 12, "."), f"<p>{prose(1, 2)}</p>", f'<a href="/{word()}">{words(3, 8)}</a>', f"<p>{words(3, 9, '!')}</p><a href='#'>{words(1, 3)}</a>"))
        elif kind == "notice":
            inner = f"<p>{prose(1, 2)}</p>" + r.choice(("", "<button>OK</button>", f"<a href='#'>{words(1, 2)}</a>")) if odd(0.7) else prose(1, 2)
        elif kind == "form":
            inner = f"<label>{words(1, 4)}</label><input type='text'>" + (f"<p>{words(4, 12, '.')}</p>" if odd(0.5) else "") + f"<button>{words(1, 2)}</button>"
            inner += "<select><option>" + words(1, 2) + "</option></select>" if odd(0.3) else ""
        elif kind == "comments":
            how = r.choice(('<div class="comment">{}</div>', "<li>{}</li>", '<article class="comment">{}</article>', '<div class="reply">{}</div>', "<div>{}</div>"))
            inner = (f"<h3>{words(1, 3)}</h3>" if odd(0.6) else "") + "".join(how.format(r.choice((f"<b>{words(1, 2)}</b><p>{prose(1, 4)}</p>", f"<p>{prose(1, 4)}</p>", prose(1, 3))))
                                                                              for _ in range(r.randint(1, 6)))
        else:
            inner = links(2, 5)
        return opened(kind, inner)

    def kept(text: str) -> str:
        main.append(text)
        return MARK + text

    def paragraph() -> str:
        text = prose(1, r.choice((1, 3, 6, 12)))
        if odd(0.1):
            inside = text.split(" ")
            k = r.randrange(len(inside))
            inside[k] = f"<{(t := r.choice(('b', 'i', 'em', 'span')))}>{inside[k]}</{t}>"
            main.append(text)
            return f"<p>{MARK}{' '.join(inside)}</p>"
        if odd(0.1):
            inside = text.split(" ")
            k = r.randrange(len(inside))
            inside[k] = f'<a href="/{word()}">{inside[k]}</a>'
            main.append(text)
            return f"<p>{MARK}{' '.join(inside)}</p>"
        if odd(0.12):
            return f"<p><b>{kept(text)}<br>"
        return r.choice(("<p>{}</p>",) * 6 + ("<div>{}</div>", "<p>{}")).format(kept(text))

    def block() -> str:
        if odd(0.82):
            return paragraph()
        if odd(0.3):
            return f"<h{(h := r.randint(2, 4))}>{kept(words(1, 7))}</h{h}>"
        if odd(0.4):
            return (t := r.choice(("ul", "ol"))) and f"<{t}>" + "".join(f"<li>{kept(words(2, 14))}</li>" for _ in range(r.randint(2, 5))) + f"</{t}>"
        if odd(0.5):
            return f"<blockquote><p>{kept(prose(1, 3))}</p></blockquote>"
        return "<table>" + "".join("<tr>" + "".join(f"<td>{kept(words(1, 4))}</td>" for _ in range(2)) + "</tr>" for _ in range(r.randint(1, 3))) + "</table>"

    inner = ""
    if odd(0.75):
        title = f"<h1>{kept(words(1, 9))}</h1>"
        inner += f"<header>{title}</header>" if odd(0.1) else title
    for _ in range(r.choice((1, 1, 1, 2, 3, 5, 8, 13, 25))):
        inner += block()
        if odd(0.06):
            inner += box(r.choice(("ad", "share", "aside", "notice", "form")))
    if odd(0.1):
        inner += box(r.choice(("share", "comments", "form", "nav")))
    around = lambda kinds, p: "".join(box(k) for k in kinds if odd(p))
    first, last = ["notice", "header", "nav", "ad", "form"], ["share", "aside", "ad", "comments", "form", "nav", "notice"]
    r.shuffle(first)
    r.shuffle(last)
    body = around(first, 0.45) + (box("aside") if odd(0.2) else "")
    article = opened(ARTICLES, inner)
    if article.startswith("<td"):
        article = f"<table><tr><td>{links(3, 6)}</td>{article}</tr></table>" if odd(0.6) else f"<table><tr>{article}</tr></table>"
    if odd(0.25):
        article = f"<div class='{r.choice(('wrap', 'container', 'page', 'row', 'layout'))}'>{article}{around(last, 0.3)}</div>"
    body += article + around(last, 0.3) + (box("footer") if odd(0.85) else "")
    page = f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{words(1, 8)}</title><style>p{{margin:0}}</style>{'</head>' if odd(0.9) else ''}"
    if odd(0.95):
        page += f"<body class='{' '.join(r.sample(MANNERS, 2))}'>" if odd(0.2) else "<body>"
    page += body
    return page + ("</body></html>" if odd(0.8) else ""), " ".join(" ".join(main).split())


def fitted(pages: int = TRAINING_PAGES) -> BoostedTrees:
    """Trees fitted to the nodes of invented pages: a node is kept if its subtree holds main text."""
    trees = [parse(made_page(seed)[0]) for seed in range(pages)]
    marked = np.array([MARK in x for t in trees for x in t.text])
    for t in trees:
        t.text = [x.replace(MARK, "") for x in t.text]
    x, _, end = features(trees)
    total = np.concatenate([[0], np.cumsum(marked)])
    return BoostedTrees().fit(x, (total[end] > total[np.arange(len(end))]).astype(float))


def decoded(score: np.ndarray, parent: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Mask of kept nodes with the largest sum of scores, where a node is kept only if its parent is and an element only with a child.

    The gain of an element is its score and the gains of those children that gain anything or, if none does, of the child that loses least:
    its own score may outweigh that. The root is kept in any case and needs no child.
    """
    score = np.clip(score, -LIMIT, LIMIT)
    gain, up, is_leaf = score.tolist(), parent.tolist(), leaf.tolist()
    held = [False] * len(gain)  # whether a child gains
    least, spare = [-np.inf] * len(gain), [-1] * len(gain)  # the best of the children that lose
    for k in range(len(gain) - 1, 0, -1):
        p = up[k]
        if not is_leaf[k] and not held[k]:
            gain[k] += least[k]
        if p < 0:
            continue
        if gain[k] > 0:
            gain[p] += gain[k]
            held[p] = True
        elif gain[k] >= least[p]:
            least[p], spare[p] = gain[k], k
    kept = [False] * len(gain)
    for k, p in enumerate(up):
        kept[k] = p < 0 or (kept[p] and (gain[k] > 0 or (up[p] >= 0 and not held[p] and spare[p] == k)))
    return np.array(kept)


def main_texts(pages: list[str], model: BoostedTrees) -> list[str]:
    """The kept texts of each page in order, joined by one space."""
    trees = [parse(p) for p in pages]
    x, parent, _ = features(trees)
    texts = [t for tree in trees for t in tree.text]
    leaf = np.fromiter(map(bool, texts), bool, len(texts))
    kept = decoded(model.score(x), parent, leaf) & leaf
    out, at = [], 0
    for tree in trees:
        size = len(tree.text)
        out.append(" ".join(tree.text[k] for k in np.flatnonzero(kept[at:at + size]).tolist()))
        at += size
    return out


_MODEL: list[BoostedTrees] = []


def model() -> BoostedTrees:
    if not _MODEL:
        _MODEL.append(fitted())
    return _MODEL[0]


def extract(pages: DataFrame, id: str = "page_id", html: str = "html", keep: tuple[str, ...] = (), trees: BoostedTrees | None = None) -> DataFrame:
    """One row per page: ``id``, ``keep`` columns, text (never null) and n_chars, its code points.

    Null or empty pages and pages without main text have an empty text. Whole pages are read, rows one by one; repeated rows give
    equal results. The model is fitted on the driver to invented pages, as many for any input, and sent to the workers.
    """
    known = dict(pages.dtypes)
    judge = pages.sparkSession.sparkContext.broadcast(trees or model())
    kept = [c for c in keep if c not in (id, html)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "__html", 2 << 20):
            found = main_texts([p or "" for p in part["__html"].to_pylist()], judge.value)
            yield pa.RecordBatch.from_arrays(
                [*(part[c] for c in (id, *kept)), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
                names=[id, *kept, "text", "n_chars"])

    fields = ", ".join(f"`{c}` {known[c]}" for c in (id, *kept))
    return pages.select(pages[id], *(pages[c] for c in kept), pages[html].alias("__html")).mapInArrow(run, f"{fields}, text string, n_chars long")
