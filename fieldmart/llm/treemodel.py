"""HTML extraction: a tree-structured graphical model over DOM nodes, with sum-product messages for content marginals."""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: element sets of HTML
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul option select button script style noscript iframe template textarea".split())
CLOSES_P = BLOCK - frozenset("option select button script style noscript iframe template textarea title head body html".split())
SAME_CLOSES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
SECTIONS = frozenset("html body article main nav header footer aside section table form".split())
NEVER = frozenset("script style noscript iframe template textarea title head button select option".split())

_TAG = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE_MARK = re.compile("[>\"']")
_MOST_MISSES = 8
"""Tags of a page whose quotes may stay open; after these, quotes hide no '>' any more."""
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class Dom:
    """Nodes in page order, parents before children: tag ('#text' for a text), parent, attributes, text; block numbers of the texts."""

    __slots__ = ("attributes", "block", "parent", "tag", "text")

    def __init__(self) -> None:
        self.tag, self.parent, self.attributes, self.text, self.block = ["#root"], [-1], [""], [""], [0]

    def add(self, tag: str, parent: int, attributes: str = "", text: str = "", block: int = 0) -> int:
        for values, x in ((self.tag, tag), (self.parent, parent), (self.attributes, attributes), (self.text, text), (self.block, block)):
            values.append(x)
        return len(self.tag) - 1


class _Open:
    """The open elements, with the depths of each name, so that an end tag is found, or found to be stray, without a walk."""

    def __init__(self) -> None:
        self.nodes, self.tags = [0], ["#root"]
        self.depths: dict[str, list[int]] = defaultdict(list)

    def push(self, node: int, tag: str) -> None:
        self.depths[tag].append(len(self.nodes))
        self.nodes.append(node)
        self.tags.append(tag)

    def depth(self, *tags: str) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths[t]), default=0)

    def cut(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.nodes.pop()
            self.depths[self.tags.pop()].pop()


def _tag_end(page: str, at: int, misses: list[int]) -> int:
    """Place of the '>' that closes a tag; one inside quotes doesn't, unless they stay open. -1: there is none."""
    first = page.find(">", at)
    if first < 0 or misses[0] >= _MOST_MISSES:
        return first
    place = at
    while m := _ATTRIBUTE_MARK.search(page, place):
        if m[0] == ">":
            return m.start()
        closed = page.find(m[0], m.end())
        if closed < 0:
            break
        place = closed + 1
    misses[0] += 1
    return first


def parse(page: str) -> Dom:
    """The DOM of a page, with implied ends of p, li, table parts; stray end tags are skipped; linear in the page."""
    dom, open_, at, look, block, misses, last = Dom(), _Open(), 0, 0, 0, [0], page.rfind(">")

    def text(start: int, end: int) -> None:
        if end > start and (found := page[start:end]).strip():
            dom.add("#text", open_.nodes[-1], "", entities.unescape(found), block)
        elif end > start and dom.tag[-1] == "#text" and dom.block[-1] == block:
            dom.text[-1] += " "

    def close(tags: tuple[str, ...], until: tuple[str, ...]) -> None:
        if (depth := open_.depth(*tags)) > open_.depth(*until):
            open_.cut(depth)

    while (start := page.find("<", look)) >= 0:
        look = start + 1
        found = None
        if page.startswith("<!--", start) or page.startswith("<![CDATA[", start):
            ending = "-->" if page[start + 2] == "-" else "]]>"
            stop = page.find(ending, start + (4 if ending == "-->" else 9))
            stop = len(page) if stop < 0 else stop + 3
        elif start > last:
            continue
        elif page.startswith(("<!", "<?"), start):
            stop = page.find(">", start) + 1
        elif found := _TAG.match(page, start + 1):
            stop = _tag_end(page, found.end(), misses) + 1
        else:
            continue
        text(at, start)
        at = look = stop
        if not found:
            continue
        tag, attributes = found[2].lower(), page[found.end() : stop - 1]
        if tag == "br":
            if dom.tag[-1] == "#text" and dom.block[-1] == block:
                dom.text[-1] += " "
            continue
        block += tag in BLOCK
        if found[1]:
            depth = open_.depth(tag)
            if depth and (tag in BLOCK or tag in ("table", "body") or depth > open_.depth("table", "body")):
                open_.cut(depth)
            continue
        if tag in CLOSES_P:
            close(("p",), ("table", "button", "article", "div", "section", "li", "td"))
        if tag in SAME_CLOSES:
            close(("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,), SAME_CLOSES[tag])
        node = dom.add(tag, open_.nodes[-1], attributes, "", block)
        if tag in RAW:
            end = _RAW_ENDS[tag].search(page, at)
            stop = end.start() if end else len(page)
            if page[at:stop].strip():
                dom.add("#text", node, "", page[at:stop], block)
            at = look = end.end() if end else len(page)
            block += tag in BLOCK
        elif tag not in VOID and not attributes.endswith("/"):
            open_.push(node, tag)
    text(at, len(page))
    return dom


def _size(n: int) -> int:
    return min(9, n.bit_length())


def features(dom: Dom) -> list[list[str]]:
    """Names of the unary features of each node: tag, names in class, id and role, sizes, share of links, length of its texts, parent.

    What holds the whole page (the root, html, body) also has the page's sectioning tags and names, which tell whether an
    article of its own is to be expected below.
    """
    n = len(dom.tag)
    chars, linked, texts = [0] * n, [0] * n, [0] * n
    page = sorted({f"page {t}" for t in dom.tag if t in SECTIONS} | {f"page {w}" for attributes in dom.attributes if attributes for m in _NAMES.finditer(attributes) for w in _WORD.findall(m[1].lower())})
    inside_link = [False] * n
    for i in range(1, n):
        inside_link[i] = inside_link[dom.parent[i]] or dom.tag[i] == "a"
        if dom.tag[i] == "#text":
            chars[i] = len(dom.text[i])
            linked[i] = chars[i] * inside_link[i]
            texts[i] = 1
    for i in range(n - 1, 0, -1):
        texts[dom.parent[i]] += texts[i]
        chars[dom.parent[i]] += chars[i]
        linked[dom.parent[i]] += linked[i]
    out: list[list[str]] = []
    for i in range(n):
        tag, parent = dom.tag[i], dom.parent[i]
        names = [f"tag {tag}", "bias"]
        if parent >= 0:
            names.append(f"under {dom.tag[parent]}")
            if tag == "a":  # among other links, or in a sentence
                names.append(f"in links {4 * linked[parent] // max(1, chars[parent])}")
        if tag != "#text":
            names += [f"chars {_size(chars[i])}", f"links {4 * linked[i] // max(1, chars[i])}", f"mean {_size(chars[i] // max(1, texts[i]))}"]
            if tag in ("#root", "html", "body"):
                names += page
            if dom.attributes[i]:
                for m in _NAMES.finditer(dom.attributes[i]):
                    names += [f"name {w}" for w in _WORD.findall(m[1].lower())]
                if _HIDDEN.search(dom.attributes[i]):
                    names.append("hidden")
        out.append(names)
    return out


class TreeModel:
    """p(labels) ~ exp(sum of unary scores of content nodes + a potential for each parent and child). Labels: 0 and 1, content."""

    def __init__(self) -> None:
        self.unary: dict[str, float] = defaultdict(float)
        self.pair: dict[tuple[int, int, bool], float] = defaultdict(float)

    def marginals(self, dom: Dom, names: list[list[str]]):
        """p(node is content) of every node and p(parent, child) of every edge: messages go up from the leaves, then down from the root."""
        n, w = len(dom.tag), self.unary
        unary = [sum([w.get(x, 0.0) for x in own]) for own in names]
        edges = {t: [[math.exp(self.pair.get((a, b, t), 0.0)) for b in (0, 1)] for a in (0, 1)] for t in (False, True)}
        up = [[1.0, 1.0] for _ in range(n)]  # belief of the subtree, by the node's label
        sent: list = [None] * n
        for i in range(n - 1, -1, -1):
            score = min(30.0, max(-30.0, unary[i]))
            b0, b1 = up[i][0], up[i][1] * math.exp(score)
            total = b0 + b1
            up[i] = [b0 / total, b1 / total]
            if i:
                e = edges[dom.tag[i] == "#text"]
                m = (e[0][0] * up[i][0] + e[0][1] * up[i][1], e[1][0] * up[i][0] + e[1][1] * up[i][1])
                sent[i] = m
                parent = up[dom.parent[i]]
                p0, p1 = parent[0] * m[0], parent[1] * m[1]
                total = p0 + p1
                parent[0], parent[1] = p0 / total, p1 / total
        belief: list = [None] * n
        joint: list = [None] * n
        belief[0] = (up[0][0], up[0][1])
        for i in range(1, n):
            e, above, m = edges[dom.tag[i] == "#text"], belief[dom.parent[i]], sent[i]
            out = (above[0] / m[0], above[1] / m[1])  # the parent without this child's message
            p = [[out[a] * e[a][b] * up[i][b] for b in (0, 1)] for a in (0, 1)]
            total = p[0][0] + p[0][1] + p[1][0] + p[1][1]
            joint[i] = [[x / total for x in row] for row in p]
            belief[i] = (joint[i][0][0] + joint[i][1][0], joint[i][0][1] + joint[i][1][1])
        return [b[1] for b in belief], joint

    def fit(self, pages: list[tuple[Dom, list[int]]], epochs: int = 12, rate: float = 0.3) -> "TreeModel":
        """Gradient ascent on the likelihood of labelled pages: observed less expected features, both of nodes and edges."""
        squared: dict = defaultdict(lambda: 1e-4)
        prepared = [(dom, labels, features(dom)) for dom, labels in pages]
        for _ in range(epochs):
            for dom, labels, names in prepared:
                p, joint = self.marginals(dom, names)
                slope: dict = defaultdict(float)
                for i, own in enumerate(names):
                    for x in own:
                        slope[x] += labels[i] - p[i]
                for i in range(1, len(names)):
                    text = dom.tag[i] == "#text"
                    for a in (0, 1):
                        for b in (0, 1):
                            slope[a, b, text] += ((labels[dom.parent[i]], labels[i]) == (a, b)) - joint[i][a][b]
                for k, g in slope.items():
                    squared[k] += g * g
                    target = self.unary if isinstance(k, str) else self.pair
                    target[k] += rate * g / math.sqrt(squared[k]) - 1e-3 * target[k]
        return self


def main_text(page: str | None, model: TreeModel, least: float = 0.5) -> str:
    """Blocks of the texts whose content marginal is `least` or more, white space as one space, joined by newlines."""
    if not page:
        return ""
    dom = parse(page)
    p, _ = model.marginals(dom, features(dom))
    blocks: dict[int, list[str]] = {}
    for i, tag in enumerate(dom.tag):
        if tag == "#text" and p[i] >= least and dom.tag[dom.parent[i]] not in NEVER:
            blocks.setdefault(dom.block[i], []).append(dom.text[i])
    joined = (_SPACE.sub(" ", "".join(parts)).strip() for parts in blocks.values())
    return "\n".join(b for b in joined if b)


def labelled_pages(n: int = 400, seed: int = 3) -> list[tuple[Dom, list[int]]]:
    """Invented pages of many layouts with each node's label: 1 inside the article, but for what stands in it without belonging to it."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice(("th", "er", "on", "an", "la", "de", "ou", "st", "mi", "ka")) for _ in range(r.randint(1, 3)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    mark = lambda tag, label, names="", inner="": f'<{tag} data-label="{label}"{f" class={chr(34)}{names}{chr(34)}" if names else ""}>{inner}</{tag}>'
    links = lambda: "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(r.randint(2, 8)))

    def paragraph() -> str:
        kind = r.random()
        if kind < 0.55:
            return f"<p>{words(1, 60)}</p>"
        if kind < 0.7:
            return f"<p><b>{words(1, 40)}.<br>"
        if kind < 0.78:
            return f"<p>{words(3, 20)} <a href='/{word()}'>{words(1, 3)}</a> {words(3, 20)} <em>{words(1, 4)}</em></p>"
        if kind < 0.84:
            return f"<h{r.randint(2, 4)}>{words(1, 6)}</h2>"
        if kind < 0.9:
            return "<ul>" + "".join(f"<li>{words(2, 14)}</li>" for _ in range(r.randint(1, 5))) + "</ul>"
        if kind < 0.94:
            return f"<blockquote><p>{words(4, 30)}</p></blockquote>"
        if kind < 0.97:
            return f"<pre>{words(3, 20)}</pre>"
        return "<table>" + "".join(f"<tr><td>{words(1, 4)}</td><td>{words(1, 4)}</td></tr>" for _ in range(r.randint(1, 3))) + "</table>"

    def noise(inside: bool) -> str:
        return r.choice((
            lambda: mark("aside", 0, r.choice(("", "sidebar", "related")), f"<h3>{words(1, 3)}</h3><ul>{links()}</ul>"),
            lambda: mark("div", 0, r.choice(("ad", "ads", "advert", "banner ad", "promo sponsored")), r.choice((words(1, 20), f"<p>{words(2, 20)}</p>"))),
            lambda: mark("div", 0, r.choice(("cookie", "cookie-notice", "notice", "newsletter", "popup consent")), f"<p>{words(4, 25)}</p><button>{word()}</button>"),
            lambda: mark("form", 0, r.choice(("", "search", "subscribe")), f"<label>{words(1, 4)}</label><input name=q><button>{word()}</button><p>{words(2, 8)}</p>"),
            lambda: mark(r.choice(("div", "section")), 0, r.choice(("comments", "comment-list", "reader comments", "replies")), f"<h3>{words(1, 3)}</h3>" + "".join(f'<div class="comment"><p>{words(3, 40)}</p></div>' for _ in range(r.randint(1, 4)))),
            lambda: mark(r.choice(("div", "section")), 0, r.choice(("commentlist", "comments-area", "respond", "discussion", "disqus thread", "feedback")), f"<h2>{words(1, 4)}</h2><ol{r.choice(('', ' class=commentlist', ' class=comment-list'))}>" + "".join(f"<li><div class='comment-body'><cite>{word()}</cite><p>{words(3, 40)}</p><a href='#'>{word()}</a></div></li>" for _ in range(r.randint(1, 4))) + "</ol>"),
            lambda: mark(r.choice(("ul", "ol")), 0, r.choice(("share", "social", "tags", "related", "pager", "breadcrumb", "meta")), links()),
            lambda: mark("div", 0, r.choice(("share", "social share", "breadcrumb", "tags", "pager", "menu", "sidebar", "widget")), f"<ul>{links()}</ul>"),
            lambda: mark("nav", 0, "" if inside else r.choice(("", "menu", "toc")), f"<ul>{links()}</ul>"),
            lambda: f"<script>{word()}('</p>')</script>",
            lambda: f"<style>p{{margin:{r.randint(0, 9)}}}</style>",
        ))()

    def named(label: int, *names: str) -> str:
        """Class or id of a div, sometimes none."""
        return f'<div data-label="{label}" {r.choice(("class", "id"))}="{r.choice(names)}">'

    def block() -> str:
        return r.choice((f"<p>{words(4, 60)}</p>", f"<p>{words(4, 60)}</p>", f"<div>{words(4, 60)}</div>", f"<h{r.randint(2, 3)}>{words(1, 6)}</h3>", f"<ul><li>{words(2, 9)}</li><li>{words(2, 9)}</li></ul>"))

    def menu(label: str = ' data-label="0"') -> str:
        return r.choice((f"<ul{label}>{links()}</ul>", " ".join(f'<a{label} href="/{word()}">{words(1, 2)}</a>' for _ in range(r.randint(2, 6))), f"<div{label}>" + " | ".join(f'<a href="/{word()}">{words(1, 2)}</a>' for _ in range(r.randint(3, 8))) + "</div>", f"<p{label}>" + " ".join(f'<a href="/{word()}">{words(1, 2)}</a>' for _ in range(r.randint(3, 8))) + "</p>"))

    def simple() -> str:
        """Pages without an element for the article, bare fragments, and tables that lay out a page."""
        title, blocks = words(2, 9), [block() for _ in range(r.choice((1, 2, 2, 3, 5, 9)))]
        body = "".join(blocks)
        heading = r.choice(("", f"<h1>{title}</h1>", f"<h1>{title}</h1>"))
        kind = r.choice((0, 0, 0, 1, 1, 1, 2, 3, 4, 5))
        if kind == 0:  # a fragment, or text alone
            depth = r.choice((0, 0, 1, 1, 2, 3, 4))
            return r.choice((f'<p>{words(3, 50)}</p>', words(3, 60), f"{words(3, 30)}<br>{words(3, 30)}", "<div>" * depth + heading + body + "</div>" * depth, "<div>" * depth + heading + body + "</div>" * depth))
        if kind == 1:  # plain divs, some of which don't belong
            inner = "".join(r.choice((f"<div>{x}</div>", x)) for x in [heading, *r.choice(([body], blocks))] if x)
            beside = lambda: r.choice(("", menu(), noise(False), named(0, "menu", "nav", "header", "top", "banner") + menu("") + "</div>", f'<ul data-label="0" {r.choice(("class", "id"))}={r.choice(("menu", "nav", "links"))}>{links()}</ul>'))
            after = r.choice(("", mark("div", 0, "", menu("")), mark("footer", 0, "", words(2, 12)), noise(False), named(0, "footer", "bottom", "copyright") + words(1, 8) + "</div>"))
            return f'<html>{r.choice(("", f"<head><title>{title}</title></head>"))}<body data-label="1">{beside()}{inner}{r.choice(("", beside()))}{after}</body></html>'
        if kind == 2:  # one plain div around everything
            return f'<html><body data-label="0">{r.choice(("", menu(), noise(False)))}<div data-label="1">{heading}{body}{r.choice(("", noise(True)))}</div>{r.choice(("", menu(), noise(False)))}</body></html>'
        if kind in (3, 4):  # a table with a menu, the article, a bar
            cells = [f'<td data-label="1"{r.choice(("", " valign=top", " width=600"))}>{heading}{body}</td>']
            cells.insert(r.choice((0, 1)), f'<td data-label="0"{r.choice(("", " width=150"))}>{menu("")}</td>')
            if r.random() < 0.4:
                cells.append(f'<td data-label="0">{menu("")}<p>{words(1, 4)}</p></td>')
            bar = f'<tr><td data-label="0" colspan=3>{r.choice((words(1, 3), menu("")))}</td></tr>'
            foot = f'<tr><td data-label="0" colspan=3>&copy; {words(1, 8)}</td></tr>'
            return f'<html><head><title>{title}</title></head><body data-label="0"><table>{r.choice(("", bar))}<tr>{"".join(cells)}</tr>{r.choice(("", foot))}</table></body></html>'
        wrap = named(0, "wrapper", "page", "container", "site", "layout")
        content = named(1, "content", "post", "article", "entry", "story", "body text", "main", "primary", "article_body", "post-body")
        side = named(0, "sidebar", "nav", "menu", "left", "topbar", "footer", "header", "secondary", "widget-area")
        return f"<html><head><title>{title}</title></head><body>{wrap}{side}{menu('')}</div>{content}{heading}{body}{r.choice(('', noise(True)))}</div>{r.choice(('', noise(False), side + menu('') + '</div>'))}</div></body></html>"

    def labels_of(dom: Dom) -> list[int]:
        """A fragment's root is content, as is what no mark says otherwise of."""
        labels = [int("html" not in dom.tag)] + [0] * (len(dom.tag) - 1)
        for i in range(1, len(labels)):
            own = re.search(r'data-label="(\d)"', dom.attributes[i])
            labels[i] = int(own[1]) if own else 0 if dom.tag[i] in NEVER else labels[dom.parent[i]]
        return labels

    out = []
    for at in range(n):
        if at % 2:
            dom = parse(simple())
            out.append((dom, labels_of(dom)))
            continue
        title = words(2, 9)
        head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body>'
        top = [mark("nav", 0, r.choice(("", "menu")), f"<ul>{links()}</ul>")] if r.random() < 0.8 else []
        if r.random() < 0.4:
            top.append(mark(r.choice(("header", "div")), 0, r.choice(("header", "site-header", "masthead")), f"<h1>{words(1, 3)}</h1><p>{words(2, 9)}</p>"))
        top += [noise(False) for _ in range(r.randint(0, 3))]
        body = [f"<h1>{title}</h1>"] if r.random() < 0.8 else []
        body += [paragraph() for _ in range(r.choice((1, 1, 2, 3, 5, 8, 14)))]
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            body.insert(r.randint(1, len(body)), noise(True))
        kind = r.random()
        inner = "".join(body)
        if kind < 0.5:
            article = mark("article", 1, r.choice(("", "", "post", "entry")), inner)
        elif kind < 0.62:
            article = mark("main", 1, "", inner)
        elif kind < 0.74:
            article = f"<main>{mark('article', 1, '', inner)}</main>"
        else:
            article = mark(r.choice(("div", "section")), 1, r.choice(("content", "article-body", "entry-content", "post-content", "story body", "main text")), inner)
        tail = [noise(False) for _ in range(r.randint(0, 2))]
        if r.random() < 0.85:
            tail.append(mark(r.choice(("footer", "footer", "div")), 0, r.choice(("footer", "site-footer")), f"&copy; {word()} &middot; {words(2, 16)}" if r.random() < 0.6 else f"<p>{words(3, 12)}</p><ul>{links()}</ul>"))
        dom = parse(head + "".join(top) + article + "".join(tail) + ("</body></html>" if r.random() < 0.8 else ""))
        out.append((dom, labels_of(dom)))
    return out


@lru_cache(maxsize=2)
def trained(n: int = 400, seed: int = 3) -> tuple[dict, dict]:
    model = TreeModel().fit(labelled_pages(n, seed))
    return dict(model.unary), dict(model.pair)


def _extracted(weights: tuple[dict, dict]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = TreeModel()
        model.unary, model.pair = weights
        for batch in batches:
            texts = [main_text(page, model) for page in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return run


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (the article, empty if none), n_chars (code points).

    Null or empty html has no text; whole pages are read, in time linear in their length whatever their markup. Rows are
    independent, so repeated rows and null ids stay; an empty table gives an empty table; other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInPandas(_extracted(trained()), "page_id long, url string, text string, n_chars long")
