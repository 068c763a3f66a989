"""Main text of web pages by a tree-structured graphical model (operator 4).

A page becomes its tree of elements. Each node is content (1) or not (0). A
node's potential comes from features of the element (tag, words of class, id and
role, length and link share of its text, place); a potential on each edge from
parent to child depends on the child's kind of element. Sum-product messages,
upward from the leaves and downward from the root, give every node's exact
marginal; the messages of a whole batch of pages pass depth by depth in numpy.
A block's text is kept if the marginal of the element that holds it is at least
one half.

The weights are trained on labelled pages by gradient ascent on the likelihood,
whose gradient the same messages give. The library brings labelled pages of its
own, built by rule from common layouts; ``train`` takes any others.

Text: character references are decoded, white space inside a block becomes one
space, blocks stand in page order, one a line. ``br`` is white space. Comments,
scripts, styles, the title and what stands between the tags of the elements in
``UNSEEN`` are never text, formulas are; menus, headers, footers, sidebars,
notices, adverts, forms and reader comments are for the model to leave out.

Each page is parsed and scored by itself, in batches of bounded size: no shuffle.

Defined results: null or empty html, or a page without content: empty text, 0
characters. Broken markup is read as far as it goes; a tag cut off at the page's
end is dropped. Repeated rows are extracted one by one. Extra columns are
ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C

SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long"
_ATTRS = r"(?>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*+)"
_CODE = rf"<(script|style)(?=[\s/>]){_ATTRS}(?<!/)>(?:.*?</\1(?:[\s/][^>]*+)?+>|.*\Z)"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|{_CODE}"
    rf"|<(textarea|title)(?=[\s/>]){_ATTRS}(?<!/)>(?:.*?</\2(?:[\s/][^>]*+)?+>|.*\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)({_ATTRS})>"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z/][^<>]*+\Z",
    re.S | re.I,
)
# left out with what they hold; one that closes at once or is never closed holds nothing
UNSEEN = {n: re.compile(rf"<!--.*?(?:-->|\Z)|{_CODE}|<(/?){n}(?=[\s/>])({_ATTRS})>", re.S | re.I) for n in "noscript template svg iframe canvas object annotation annotation-xml".split()}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
    "math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
CONTAINER = frozenset("html body div main article section aside nav header footer form table tbody thead tfoot tr ul ol dl menu figure details dialog fieldset center".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
OWN_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
# words of class, id and role attributes that tell what an element is for
WORDS = (
    "article content post entry story body text main headline title lead intro comment discuss respons reply review nav menu breadcrumb tab toolbar header masthead banner logo footer copyright legal "
    "sidebar aside widget related recommend more popular trending share social follow promo sponsor advert ads adv cookie consent gdpr notice alert popup modal overlay newsletter subscri signup login "
    "form search filter pagination pager tag category author byline meta caption gallery skip hidden print disclaimer"
).split()
SHORT = frozenset("ad ads adv nav tab top bar box toc".split())
ATTR = re.compile(r"([a-zA-Z_:-]+)\s*+(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
N_FEATURES = 1 << 12


class Page:
    """Elements of one page in document order: parents, tags, features of their attributes; text by block."""

    __slots__ = ("parent", "depth", "tag", "attrs", "runs")

    def __init__(self, html: str):
        self.parent, self.depth, self.tag, self.attrs = [-1], [0], ["html"], [()]
        self.runs: list[tuple[int, int, str]] = []  # (element, block number, text) in page order
        stack, block, at = [0], 0, 0
        ends: dict[str, dict[int, int]] = {}
        while m := TOKEN.search(html, at):
            if m.start() > at:
                self.runs.append((stack[-1], block, html[at : m.start()]))
            at = m.end()
            name = m[4]
            if name is None:
                continue
            name = name.lower()
            if name in UNSEEN:
                if not m[3]:
                    if name not in ends:
                        ends[name] = _ends(html, name)
                    at = ends[name].get(m.start(), at)
                continue
            if m[3]:
                block += name not in INLINE
                self._close(stack, name)
                continue
            if name == "br":
                self.runs.append((stack[-1], block, " "))
                continue
            if name in VOID:
                block += name == "hr"
                continue
            if name in ("html", "head"):
                continue
            block += name not in INLINE
            if name in CLOSES_P:
                self._until(stack, {"p"}, CONTAINER | {"li", "td", "th", "blockquote"})
            if name in OWN_KIND:
                self._until(stack, OWN_KIND[name], SCOPE.get(name, CONTAINER))
            self.parent.append(stack[-1])
            self.depth.append(self.depth[stack[-1]] + 1)
            self.tag.append(name)
            self.attrs.append(_attributes(m[5].strip()) if m[5] else ())
            if not (m[5] or "").endswith("/") or name in CONTAINER:
                stack.append(len(self.parent) - 1)
        if at < len(html):
            self.runs.append((stack[-1], block, html[at:]))

    def _until(self, stack: list[int], names, scope) -> None:
        """Close the nearest open element among ``names``, unless an element of ``scope`` stands between."""
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] in names:
                del stack[i:]
                return
            if self.tag[stack[i]] in scope:
                return

    def _close(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if self.tag[stack[i]] == name:
                del stack[i:]
                return
            if name in INLINE and self.tag[stack[i]] not in INLINE:
                return


def _ends(html: str, name: str) -> dict[int, int]:
    """Where the elements ``name`` that start at some place and are closed end, nested ones each with its own tag."""
    out, opened = {}, []
    for m in UNSEEN[name].finditer(html):
        if m[2]:
            if opened:
                out[opened.pop()] = m.end()
        elif m[2] is not None and not m[3].endswith("/"):
            opened.append(m.start())
    return out


@lru_cache(maxsize=50_000)
def _attributes(raw: str) -> tuple[str, ...]:
    """What class, id, role and visibility say, as feature names."""
    out = set()
    for m in ATTR.finditer(raw):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key in ("class", "id", "role", "itemprop", "aria-label"):
            parts = set(re.split(r"[^a-z]+", value))
            out |= {f"{w}" for w in WORDS if w not in SHORT and w in value}
            out |= {f"{w}" for w in SHORT & parts}
        if key in ("hidden", "aria-hidden") and value != "false" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.add("unseen")
    return tuple(sorted(out))


@lru_cache(maxsize=100_000)
def feature(name: str) -> int:
    return C.xxh3_64_intdigest(name) % N_FEATURES


@lru_cache(maxsize=100_000)
def _static(tag: str, attrs: tuple[str, ...], parent: str) -> tuple[int, ...]:
    return tuple(feature(x) for x in (f"tag {tag}", f"in {parent}", "any attr" if attrs else "no attr", *(f"is {a}" for a in attrs), *(f"is {a} {tag}" for a in attrs)))


def kind(tag: str) -> int:
    """0 container, 1 block, 2 inline: the edge potential's index."""
    return 2 if tag in INLINE else 0 if tag in CONTAINER else 1


@dataclass
class Forest:
    """The elements of many pages as one forest, with sparse features."""

    parent: np.ndarray
    kind: np.ndarray
    levels: list[np.ndarray]  # nodes by depth
    feat: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, pages: list[Page]) -> Forest:
        sizes = np.array([len(p.parent) for p in pages])
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(pages) else np.zeros(0, np.int64)
        parent = np.concatenate([np.array(p.parent) + np.where(np.array(p.parent) >= 0, b, 0) for p, b in zip(pages, base)])
        depth = np.concatenate([p.depth for p in pages])
        kinds = np.fromiter((kind(t) for p in pages for t in p.tag), np.int64, len(parent))
        own, links, words, stops = (np.zeros(len(parent)) for _ in range(4))
        feat, owner = [], []
        for p, b in zip(pages, base.tolist()):
            linked = [False] * len(p.tag)
            for i, (t, up) in enumerate(zip(p.tag, p.parent)):
                linked[i] = t == "a" or (up >= 0 and linked[up])
                s = _static(t, p.attrs[i], p.tag[up] if up >= 0 else "")
                feat.extend(s)
                owner.extend([b + i] * len(s))
            for i, _, text in p.runs:
                n = len(text.strip())
                if n:
                    own[b + i] += n
                    links[b + i] += n * linked[i]
                    words[b + i] += text.count(" ")
                    stops[b + i] += text.count(". ") + text.count(", ") + text.endswith((".", "!", "?"))
        levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)] if len(depth) else []
        total, linked_total = own.copy(), links.copy()
        for level in levels[:0:-1]:
            np.add.at(total, parent[level], total[level])
            np.add.at(linked_total, parent[level], linked_total[level])
        page = np.repeat(np.arange(len(pages)), sizes)
        whole = np.maximum(total[base][page], 1)

        def bucket(x: np.ndarray, edges: list[float], name: str) -> np.ndarray:
            ids = np.array([feature(f"{name} {k}") for k in range(len(edges) + 1)])
            return ids[np.searchsorted(edges, x, "right")]

        dense = [
            bucket(own, [1, 25, 80, 250], "own"),
            bucket(total, [1, 25, 80, 250, 1000], "total") ,
            bucket(np.where(total > 0, linked_total / np.maximum(total, 1), 2), [0.01, 0.3, 0.7, 1.5], "links"),
            bucket(total / whole, [0.02, 0.1, 0.4, 0.7], "share"),
            bucket(stops, [1, 3], "stops"),
            bucket(depth, [1, 2, 3, 5, 8], "depth"),
            np.full(len(parent), feature("bias")),
        ]
        n = np.arange(len(parent))
        return cls(parent, kinds, levels, np.concatenate([np.array(feat, np.int64), *dense]), np.concatenate([np.array(owner, np.int64), *[n] * len(dense)]))


@dataclass
class Model:
    weight: np.ndarray  # per feature: log potential of content over not
    edge: np.ndarray  # [kind, parent's label, child's label] log potentials

    def messages(self, f: Forest) -> tuple[np.ndarray, np.ndarray, float]:
        """Node marginals of content, edge marginals [node, parent's label, its label], and the log partition sum."""
        n = len(f.parent)
        score = np.zeros((n, 2))
        score[:, 1] = np.bincount(f.owner, self.weight[f.feat], n)
        up = score.copy()  # potential and messages from the children
        to_parent = np.zeros((n, 2))
        for level in f.levels[:0:-1]:
            x = self.edge[f.kind[level]] + up[level][:, None, :]
            to_parent[level] = np.logaddexp(x[:, :, 0], x[:, :, 1])
            np.add.at(up, f.parent[level], to_parent[level])
        belief = up.copy()  # with the message from the parent
        pair = np.full((n, 2, 2), -np.inf)
        log_z = float(np.logaddexp(up[f.levels[0], 0], up[f.levels[0], 1]).sum()) if n else 0.0
        for level in f.levels[1:]:
            cavity = belief[f.parent[level]] - to_parent[level]
            x = self.edge[f.kind[level]] + cavity[:, :, None]
            belief[level] = up[level] + np.logaddexp(x[:, 0], x[:, 1])
            pair[level] = x + up[level][:, None, :]
        marginal = np.exp(belief - np.logaddexp(belief[:, 0], belief[:, 1])[:, None])
        top = pair.max((1, 2), keepdims=True)
        pair = np.exp(pair - np.where(np.isfinite(top), top, 0))
        pair /= np.maximum(pair.sum((1, 2), keepdims=True), 1e-300)
        return marginal[:, 1], pair, log_z


def train(pages: list[Page], labels: list[list[int]], steps: int = 150, rate: float = 0.1, decay: float = 0.02) -> Model:
    """Weights and edge potentials by gradient ascent (Adam) on the labels' log-likelihood."""
    f = Forest.of(pages)
    y = np.concatenate([np.array(x) for x in labels])
    model = Model(np.zeros(N_FEATURES), np.zeros((3, 2, 2)))
    params = [model.weight, model.edge]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    child = np.flatnonzero(f.parent >= 0)
    seen = np.zeros_like(model.edge)
    np.add.at(seen, (f.kind[child], y[f.parent[child]], y[child]), 1)
    for step in range(1, steps + 1):
        p, pair, _ = model.messages(f)
        g_w = np.bincount(f.feat, (y - p)[f.owner], N_FEATURES) - decay * model.weight
        expected = np.zeros_like(model.edge)
        np.add.at(expected, f.kind[child], pair[child])
        for q, g, a, b in zip(params, (g_w, seen - expected - decay * model.edge), m, v):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            q += rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


# --- labelled pages built by rule


class _Builder:
    """Writes a page and its elements' labels together."""

    def __init__(self, rng: random.Random):
        self.rng, self.html, self.labels = rng, [], [0]
        self.vocabulary = ["".join(rng.choice("aeioubcdfglmnprstvz") for _ in range(rng.randint(2, 9))) for _ in range(300)]

    def words(self, lo: int, hi: int, stop: bool = True) -> str:
        ws = [self.rng.choice(self.vocabulary) for _ in range(self.rng.randint(lo, hi))]
        text = " ".join(w + (", " if stop and self.rng.random() < 0.06 else "") for w in ws).replace("  ", " ")
        return text.capitalize() + ("." if stop else "")

    def open(self, tag: str, y: int, attrs: str = "") -> None:
        self.html.append(f"<{tag}{' ' + attrs if attrs else ''}>")
        self.labels.append(y)

    def leaf(self, tag: str, y: int, text: str, attrs: str = "") -> None:
        self.open(tag, y, attrs)
        self.html.append(f"{text}</{tag}>")

    def end(self, tag: str) -> None:
        self.html.append(f"</{tag}>")


def _attr(rng: random.Random, names: str) -> str:
    if rng.random() < 0.1:
        return ""
    name = rng.choice(names.split())
    name += rng.choice(["", "", "-box", "-wrap", "_inner", "-area", " c1", "-list", "s"])
    return f'{rng.choice(["class", "class", "class", "id"])}="{rng.choice(["", "", "site-", "page-", "x_"])}{name}"'


def _boilerplate(b: _Builder, inside: bool, what: str = "") -> None:
    """One piece that is not part of the article."""
    r = b.rng
    what = what or r.choice("links ad comments form aside notice share byline footer header related".split())
    if what == "links":
        tag = r.choice(["nav", "div", "ul"]) if not inside else r.choice(["nav", "div"])
        b.open(tag, 0, "" if tag == "nav" and r.random() < 0.6 else _attr(r, "nav menu breadcrumb tabs toolbar topnav pagination"))
        if tag != "ul":
            b.open("ul", 0)
        for _ in range(r.randint(2, 8)):
            b.open("li", 0)
            b.leaf("a", 0, b.words(1, 3, False), 'href="/x"')
            b.end("li")
        if tag != "ul":
            b.end("ul")
        b.end(tag)
    elif what == "ad":
        b.open("div", 0, _attr(r, "ad ads advert advertisement sponsored promo banner adv ad-slot"))
        if r.random() < 0.5:
            b.leaf(r.choice(["p", "span", "a"]), 0, b.words(4, 25))
        else:
            b.html.append(b.words(4, 30))
        b.end("div")
    elif what == "comments":
        tag = r.choice(["section", "div", "ol"])
        b.open(tag, 0, _attr(r, "comments comment-list discussion responses replies reviews user-comments disqus") or "class=comments")
        if tag != "ol" and r.random() < 0.6:
            b.leaf(r.choice(["h2", "h3", "h4"]), 0, b.words(1, 3, False))
        for _ in range(r.randint(1, 4)):
            own = "li" if tag == "ol" else r.choice(["div", "article", "p"])
            b.open(own, 0, "" if r.random() < 0.4 else _attr(r, "comment reply comment-body response"))
            if own != "p" and r.random() < 0.7:
                b.leaf("p", 0, b.words(4, 60))
            else:
                b.html.append(b.words(4, 60))
            b.end(own)
        b.end(tag)
    elif what == "form":
        b.open("form", 0, _attr(r, "search login newsletter signup subscribe contact"))
        b.leaf("label", 0, b.words(1, 4, False))
        if r.random() < 0.5:
            b.leaf("p", 0, b.words(4, 20))
        b.html.append('<input type="text">')
        b.leaf("button", 0, b.words(1, 2, False))
        b.end("form")
    elif what in ("aside", "related"):
        tag = "aside" if r.random() < 0.6 else "div"
        b.open(tag, 0, "" if tag == "aside" and r.random() < 0.6 else _attr(r, "sidebar widget related recommended popular trending more-stories"))
        b.leaf(r.choice(["h3", "h4", "p"]), 0, b.words(1, 4, False))
        for _ in range(r.randint(0, 4)):
            if r.random() < 0.6:
                b.open(r.choice(["p"]), 0)
                b.leaf("a", 0, b.words(2, 9, False), 'href="/y"')
                b.end("p")
            else:
                b.leaf("p", 0, b.words(3, 40))
        b.end(tag)
    elif what == "notice":
        b.open("div", 0, _attr(r, "cookie-notice cookie consent gdpr notice alert popup modal overlay newsletter"))
        b.leaf("p", 0, b.words(6, 45))
        if r.random() < 0.5:
            b.leaf("button", 0, b.words(1, 2, False))
        b.end("div")
    elif what == "share":
        b.open("div", 0, _attr(r, "share social follow share-buttons tags"))
        for _ in range(r.randint(1, 4)):
            b.leaf(r.choice(["a", "span"]), 0, b.words(1, 2, False))
        b.end("div")
    elif what == "byline":
        b.leaf("div", 0, b.words(2, 6, False), _attr(r, "meta share-count tags print pagination"))
    elif what == "footer":
        b.open("footer" if r.random() < 0.7 else "div", 0, _attr(r, "footer copyright legal footer-links"))
        tag = b.html[-1][1:].split(" ")[0].strip(">")
        b.html.append("&copy; " + b.words(2, 30))
        if r.random() < 0.4:
            b.leaf("p", 0, b.words(3, 30))
        b.end(tag)
    else:
        tag = "header" if r.random() < 0.7 else "div"
        b.open(tag, 0, _attr(r, "header masthead logo banner site-header topbar"))
        if r.random() < 0.5:
            b.leaf(r.choice(["h1", "h2", "p", "a"]), 0, b.words(1, 6, False))
        else:
            b.html.append(b.words(1, 8, False))
        b.end(tag)


def _article(b: _Builder, title: bool = True, comments: bool = False) -> None:
    """An article; ``comments``: with those of readers right behind its text."""
    r = b.rng
    tag = r.choice(["article", "article", "article", "main", "div", "section"])
    attrs = "" if tag in ("article", "main") and r.random() < 0.6 else _attr(r, "article content post entry story article-body main-content post-content text body")
    wrap = r.random() < 0.3
    if wrap:
        b.open("main" if tag != "main" and r.random() < 0.5 else "div", 0, _attr(r, "main wrapper container page content"))
    b.open(tag, 1, attrs)
    if title and r.random() < 0.8:
        b.leaf("h1", 1, b.words(1, 12, False) if r.random() < 0.8 else b.words(1, 3))
    deep = r.random() < 0.25
    if deep:
        b.open("div", 1, _attr(r, "content body text entry post"))
    for _ in range(r.randint(0 if title else 1, 9)):
        x = r.random()
        if x < 0.62:
            b.open("p", 1)
            if r.random() < 0.25:
                b.open(r.choice(["b", "i", "em", "strong"]), 1)
                b.html.append(b.words(1, 60) + r.choice(["<br>", "", "</b>"]))  # often left open
            else:
                b.html.append(b.words(1, 90))
                if r.random() < 0.15:
                    b.leaf("a", 1, b.words(1, 5, False), 'href="/z"')
                    b.html.append(" " + b.words(1, 20))
            if r.random() < 0.85:
                b.end("p")
        elif x < 0.72:
            b.leaf(r.choice(["h2", "h3"]), 1, b.words(1, 6, False))
        elif x < 0.78:
            b.open(r.choice(["ul"]), 1)
            for _ in range(r.randint(1, 4)):
                b.leaf("li", 1, b.words(1, 20))
            b.end("ul")
        elif x < 0.83:
            b.open("blockquote", 1)
            b.leaf("p", 1, b.words(4, 40))
            b.end("blockquote")
        elif x < 0.87:
            b.leaf("pre", 1, b.words(3, 30, False))
        elif x < 0.9:
            b.open("table", 1)
            for _ in range(2):
                b.open("tr", 1)
                for _ in range(2):
                    b.leaf("td", 1, b.words(1, 4, False))
                b.end("tr")
            b.end("table")
        else:
            _boilerplate(b, True)
    if deep:
        b.end("div")
    if comments and (within := r.random() < 0.6):
        _boilerplate(b, True, "comments")
    b.end(tag)
    if comments and not within:
        _boilerplate(b, False, "comments")
    if wrap:
        b.html.append("</div></main>")


def labelled_pages(n: int = 700, seed: int = 11) -> list[tuple[str, list[int]]]:
    """Pages in common layouts with a label for each element the parser makes."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        b = _Builder(rng)
        if rng.random() < 0.3:  # an article and nothing around it, or bare paragraphs
            if rng.random() < 0.5:
                b.open("body", 0)
            if rng.random() < 0.3:
                if rng.random() < 0.5:
                    b.open("div", 0)
                for _ in range(rng.randint(1, 5)):
                    b.leaf("p", 1, b.words(8, 80))
            else:
                _article(b, rng.random() < 0.4, rng.random() < 0.4)
            out.append(("".join(b.html), b.labels))
            continue
        b.html.append("<!DOCTYPE html><html><head><meta charset=utf-8><title>t</title><script>var t='</p>';</script></head>")
        b.open("body", 0)
        shell = rng.random() < 0.4
        if shell:
            b.open("div", 0, _attr(rng, "wrapper page container site"))
        for _ in range(rng.randint(0, 4)):
            _boilerplate(b, False)
        _article(b)
        for _ in range(rng.randint(0, 4)):
            _boilerplate(b, False)
        if shell:
            b.end("div")
        if rng.random() < 0.85:
            b.html.append("</body></html>")
        html = "".join(b.html)
        out.append((html, b.labels))
    return [(h, y) for h, y in out if len(Page(h).parent) == len(y)]  # markup the parser reads as it was meant


def default_model() -> Model:
    pages = labelled_pages()
    return train([Page(h) for h, _ in pages], [y for _, y in pages])


# --- extraction


def texts(pages: list[Page], model: Model) -> list[list[str]]:
    """Content blocks of each page."""
    if not pages:
        return []
    content = model.messages(Forest.of(pages))[0] >= 0.5
    out, base = [], 0
    for p in pages:
        blocks: dict[int, list[str]] = {}
        for i, block, text in p.runs:
            if content[base + i]:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join(unescape("".join(x)).split()) for _, x in sorted(blocks.items()))
        out.append([x for x in joined if x])
        base += len(p.parent)
    return out


def _extract(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for part, html in C.slices(batches, "html"):
        blocks = texts([Page(h) for h in html], model)
        out = ["\n".join(x) for x in blocks]
        cols = [part.column(0), part.column(1), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64()), pa.array([len(x) for x in blocks], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, [c.split()[0] for c in SCHEMA.split(", ")])


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Model | None = None) -> DataFrame:
    """Main text of every page."""
    model = model or default_model()
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").alias("html"))
    return rows.mapInArrow(lambda it: _extract(it, model), SCHEMA)
