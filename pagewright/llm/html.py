"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

A page is parsed into a tree (unclosed tags, raw text of scripts and styles, comments and quoted attributes included).
Every node gets features: its tag and attribute tokens, those of its ancestors and of its subtree, text and link density
of the subtree, depth, and how it compares with its siblings. The trees give the log-odds that a node holds main text.
Decoding maximises the sum over all nodes under one condition: below a node that holds none, no node holds any. Text is
kept where its own node is.

The model is trained on the driver on PAGES made-up pages of many layouts, with a fixed seed. Pages are read whole. A
null or empty page, or one without main text, gives ''. Repeated rows are extracted each; only id, url and html are
read, further columns of any name pass by.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .runtime import arrow_map

PAGES, BARE = 500, 12

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe template xmp noembed".split())
#: Nodes of their own that stand within lines; what is in svg and math may close itself.
EMBEDDED = frozenset("svg math object noscript".split())
_HTML_WITHIN = frozenset("foreignobject desc annotation-xml mtext".split())
_CLOSED = re.compile(r"(?<!=)/\Z")
_UNQUOTED = re.compile(r"=\s*[^\s\"'>]+\Z")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img input".split()
)
ITEMS = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table tbody thead tfoot", "td": "tr", "th": "tr", "option": "select"}
_PEERS = {"dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th"}
_STOP = {k: frozenset(v.split()) for k, v in ITEMS.items()}
_SAME = {k: frozenset(_PEERS.get(k, k).split()) for k in ITEMS}

GROUPS = [frozenset(g.split()) for g in (
    "article", "main", "section", "div", "p blockquote pre", "h1", "h2 h3 h4 h5 h6", "ul ol menu dl", "li dt dd", "table tbody thead tfoot tr",
    "td th caption", "nav", "header hgroup", "footer address", "aside", "form fieldset select button option label legend dialog", "figure figcaption", "body html", "head", "a",
)]
_GROUP = {tag: n for n, g in enumerate(GROUPS) for tag in g}
TOKENS = [frozenset(t.split()) for t in (
    "nav navbar navigation menu menubar breadcrumb breadcrumbs toc pagination pager links",
    "header masthead banner topbar logo branding",
    "footer copyright colophon bottom legal imprint",
    "sidebar aside side related recommended widget rail trending popular teaser complementary",
    "ad ads advert advertisement adsbygoogle sponsor sponsored promo promotion dfp banner-ad adslot",
    "cookie cookies consent notice alert gdpr popup modal overlay newsletter toast disclaimer message",
    "comment comments reply replies respond disqus discussion commentlist",
    "form login search subscribe signup register contact",
    "article content post entry story main body text articlebody page prose maincontent",
    "share social tags meta byline author toolbar buttons follow",
)]
_TOKEN = {w: n for n, g in enumerate(TOKENS) for w in g}

_NAME = re.compile(r"[^\s/>]*")
_SPECIAL = re.compile(r"[>\"']")
_NAMED = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARK = "data-main-text"


@lru_cache(maxsize=4096)
def attribute_tokens(attrs: str) -> int:
    """A bit for each group of TOKENS that class, id, role, itemprop or aria-label name."""
    bits = 0
    for m in _NAMED.finditer(attrs):
        for word in _WORD.findall(m[1] or m[2] or m[3] or ""):
            n = _TOKEN.get(word.lower())
            if n is not None:
                bits |= 1 << n
    return bits


@dataclass
class Page:
    """Nodes in page order: a parent comes before its children."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["html"])
    tokens: list[int] = field(default_factory=lambda: [0])
    marked: list[bool] = field(default_factory=lambda: [False])
    #: (node, block, within a link, text); texts of one block stand next to each other.
    runs: list[tuple[int, int, bool, str]] = field(default_factory=list)


class _Scanner:
    """Markup one piece after the other, in time proportional to the page."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in ">\"'"}
        #: Quotes from which on no tag ends.
        self.open: set[int] = set()

    def tag_end(self, at: int) -> int:
        """The > that ends a tag whose attributes begin at `at`: the next one outside of quotes, or else the next one; -1
        without any."""
        html, seen, here = self.html, [], at
        while here <= self.last[">"]:
            quote = _SPECIAL.search(html, here).start()
            if html[quote] == ">":
                return quote
            if quote in self.open:
                break
            seen.append(quote)
            if self.last[html[quote]] == quote:
                break
            here = html.find(html[quote], quote + 1) + 1
        self.open.update(seen)
        return html.find(">", at) if at <= self.last[">"] else -1

    def pieces(self):
        """(text before, kind, name, attributes, where the next piece begins); send() a place to go on from there. The
        kinds are start, end, data (CDATA, as name), other and, at last, rest."""
        html, text = self.html, 0
        at = html.find("<")
        while at >= 0:
            kind, name, attrs, end = "", "", "", -1
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                kind, end = "other", end + 3 if end >= 0 else len(html)
            elif html.startswith("<![CDATA[", at):
                end = html.find("]]>", at)
                kind, name, end = "data", html[at + 9 : end if end >= 0 else len(html)], end + 3 if end >= 0 else len(html)
            elif html.startswith(("<!", "<?"), at):
                end = html.find(">", at) + 1 if at < self.last[">"] else 0
                kind = "other" if end else ""
            else:
                start = at + 1 + html.startswith("/", at + 1)
                if html[start : start + 1].isascii() and html[start : start + 1].isalpha():
                    named = _NAME.match(html, start).end()
                    stop = self.tag_end(named)
                    if stop >= 0:
                        kind, name, attrs, end = "end" if start > at + 1 else "start", html[start:named].lower(), html[named:stop], stop + 1
            if kind:
                to = yield html[text:at], kind, name, attrs, end
                text = end if to is None else to
                if to is not None:
                    yield
                at = html.find("<", text)
            else:
                at = html.find("<", at + 1)
        yield html[text:], "rest", "", "", len(html)


class _Stack:
    """Open elements: (name, node that owns text in it, whether what is in it belongs to SVG or MathML)."""

    def __init__(self):
        self.rows: list[tuple[str, int, bool]] = []
        #: Where elements of each name stand, and those that aren't inline.
        self.at: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.push("html", 0)

    def push(self, name: str, owner: int) -> None:
        foreign = name not in _HTML_WITHIN and (name in ("svg", "math") or bool(self.rows) and self.foreign)
        self.at.setdefault(name, []).append(len(self.rows))
        if name not in INLINE and name != "noscript":
            self.blocks.append(len(self.rows))
        self.rows.append((name, owner, foreign))

    def pop(self) -> str:
        name = self.rows.pop()[0]
        self.at[name].pop()
        if self.blocks and self.blocks[-1] == len(self.rows):
            self.blocks.pop()
        return name

    @property
    def owner(self) -> int:
        return self.rows[-1][1]

    @property
    def foreign(self) -> bool:
        return self.rows[-1][2]

    def nearest(self, names) -> int:
        """The innermost element with one of the names, -1 without any."""
        return max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)


def parse(html: str) -> Page:
    page, stack = Page(), _Stack()
    parent, tags, tokens, marked, runs = page.parent, page.tag, page.tokens, page.marked, page.runs
    block, links, bodies = 0, 0, 0
    pieces = _Scanner(html).pieces()
    for text, kind, name, attrs, end in pieces:
        if text:
            runs.append((stack.owner, block, links > 0, unescape(text)))
        if kind == "data" and name:
            runs.append((stack.owner, block, links > 0, name))
        if kind == "end":
            if name == "br":
                runs.append((stack.owner, block, False, " "))
            if stack.nearest((name,)) > 0:
                while True:
                    top = stack.pop()
                    links -= top == "a"
                    if top not in INLINE and top not in EMBEDDED and not stack.foreign:
                        block += 1
                    if top == name:
                        break
        if kind != "start":
            continue
        foreign = stack.foreign
        if foreign and name in _GROUP and name != "a":  # HTML's blocks end what is left open of SVG and MathML
            while stack.foreign:
                links -= stack.pop() == "a"
            foreign = False
        if (foreign or name in ("svg", "math")) and _CLOSED.search(attrs) and not _UNQUOTED.search(attrs):
            continue
        if name in RAW and (not foreign or name in ("script", "style")):
            pieces.send(re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(html, end).end())
            if name not in INLINE:
                block += 1
            continue
        if name in INLINE or name in EMBEDDED or foreign:
            if name == "br":
                runs.append((stack.owner, block, False, " "))
            if name in VOID:
                continue
            owner = stack.owner
            if name == "label" or name in EMBEDDED or (attrs and attribute_tokens(attrs)):
                parent.append(owner)
                tags.append(name)
                tokens.append(attribute_tokens(attrs))
                marked.append(MARK in attrs)
                owner = len(parent) - 1
            links += name == "a"
            stack.push(name, owner)
            continue
        block += 1
        if name in VOID:
            continue
        if bodies and name in ("html", "body"):
            continue
        bodies += name == "body"
        # Implied ends: of a paragraph by a block, of an item by the next one.
        if name in _STOP:
            cut = stack.nearest(_SAME[name])
            cut = cut if cut > stack.nearest(_STOP[name]) else -1
        else:
            cut = stack.blocks[-1] if stack.rows[stack.blocks[-1]][0] == "p" else -1
        while 0 < cut < len(stack.rows):
            links -= stack.pop() == "a"
        parent.append(stack.owner)
        tags.append(name)
        tokens.append(attribute_tokens(attrs) if attrs else 0)
        marked.append(MARK in attrs if attrs else False)
        stack.push(name, len(parent) - 1)
    return page


_BITS = np.arange(32)


def _spread(bits: list[int], width: int) -> np.ndarray:
    return (np.array(bits, np.int64)[:, None] >> _BITS[:width] & 1).astype(np.float32)


def node_features(page: Page) -> np.ndarray:
    n = len(page.parent)
    parent = page.parent
    own, linked, stops, first = [0] * n, [0] * n, [0] * n, [-1] * n
    seen = 0
    for node, _, link, text in page.runs:
        size = len(text)
        if not text or text.isspace():
            continue
        own[node] += size
        if link:
            linked[node] += size
        stops[node] += text.count(". ") + text.count(", ")
        if first[node] < 0:
            first[node] = seen
        seen += size
    group = [_GROUP.get(t, -1) for t in page.tag]
    bits = [1 << g if g >= 0 else 0 for g in group]
    above_tag, above_token, depth = [0] * n, [0] * n, [0] * n
    number, children = [0] * n, [0] * n
    for i in range(1, n):
        p = parent[i]
        above_tag[i] = above_tag[p] | bits[p]
        above_token[i] = above_token[p] | page.tokens[p]
        depth[i] = depth[p] + 1
        number[i] = children[p]
        children[p] += 1
    total, below_tag, below_token, nodes, paragraphs = own[:], [0] * n, [0] * n, [1] * n, [0] * n
    links, marks, start = linked[:], stops[:], first[:]
    in_paragraphs = [own[i] if page.tag[i] == "p" else 0 for i in range(n)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        total[p] += total[i]
        links[p] += links[i]
        marks[p] += marks[i]
        nodes[p] += nodes[i]
        paragraphs[p] += page.tag[i] == "p"
        in_paragraphs[p] += in_paragraphs[i]
        below_tag[p] |= below_tag[i] | bits[i]
        below_token[p] |= below_token[i] | page.tokens[i]
        if start[i] >= 0 and (start[p] < 0 or start[i] < start[p]):
            start[p] = start[i]
    t = np.array(total, np.float32)
    par = np.array([max(x, 0) for x in parent])
    count = np.array(children, np.float32)
    around = np.maximum(count[par], 1)
    numbers = np.stack(
        [
            np.log1p(t), np.log1p(np.array(own, np.float32)), np.array(links) / np.maximum(t, 1), np.log1p(np.array(nodes)),
            t / np.array(nodes), np.array(depth), np.array(number), around, np.log1p(np.maximum(t[par] - t, 0) / around),
            np.array(marks) * 50 / np.maximum(t, 1), np.maximum(np.array(start), 0) / max(seen, 1), np.log1p(np.array(paragraphs)),
            np.array(in_paragraphs) / np.maximum(t, 1), t / max(seen, 1),
        ],
        axis=1,
    ).astype(np.float32)
    g, k = len(GROUPS), len(TOKENS)
    return np.hstack([numbers, _spread(bits, g), _spread(above_tag, g), _spread(below_tag, g), _spread(page.tokens, k), _spread(above_token, k), _spread(below_token, k)])


def decode(page: Page, log_odds: np.ndarray) -> list[bool]:
    """The nodes that hold main text: the likeliest choice in which nothing is kept below a node that isn't."""
    n = len(page.parent)
    gain = log_odds.tolist()  # of keeping a node and the best of what is below it, against dropping all of it
    for i in range(n - 1, 0, -1):
        if gain[i] > 0:
            gain[page.parent[i]] += gain[i]
    kept = [gain[0] > 0] * n
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and gain[i] > 0
    return kept


def rendered(page: Page, kept: list[bool]) -> str:
    """Kept texts: one line per block, white space inside a block as one space."""
    blocks, last = [], -1
    for node, block, _, text in page.runs:
        if kept[node]:
            if block != last:
                blocks.append([])
                last = block
            blocks[-1].append(text)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


# Training pages


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = [a + b for a in ("", "b", "d", "f", "gr", "k", "l", "m", "n", "pr", "s", "st", "t", "v") for b in ("a", "e", "i", "o", "u", "en", "er", "on")]

    def word(self) -> str:
        return "".join(self.r.choices(self.syllables, k=self.r.choice((1, 1, 2, 2, 3))))

    def text(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        words = [self.word() + self.r.choice(("", "", "", "", "", ",", ".")) for _ in range(n)]
        if self.r.random() < 0.12:
            words = [w + self.r.choice(("###", "%%%", "!!", "$$$", "&amp;&amp;")) for w in words]
        if self.r.random() < 0.05:
            words = [w.upper() for w in words]
        return " ".join(words).capitalize() + self.r.choice((".", ".", "", "!"))

    def pick(self, *options):
        return self.r.choice(options)

    def el(self, tag: str, inside: str, name: str = "", main: bool = False) -> str:
        attr = f' {self.pick("class", "class", "id")}="{name}"' if name else ""
        return f"<{tag}{attr}{f' {MARK}' if main else ''}>{inside}</{tag}>"

    def link(self) -> str:
        return f'<a href="/{self.word()}">{self.text(1, 4)}</a>'

    def links(self, low: int, high: int) -> str:
        return self.el("ul", "".join(f"<li>{self.link()}</li>" for _ in range(self.r.randint(low, high)))) if self.r.random() < 0.8 else " | ".join(self.link() for _ in range(self.r.randint(low, high)))

    def nav(self) -> str:
        return self.pick(lambda: self.el("nav", self.links(2, 9)), lambda: self.el("div", self.links(2, 9), self.pick("menu", "nav", "navbar", "main-navigation", "breadcrumbs")), lambda: self.el("nav", self.links(2, 6), "menu"))()

    def header(self) -> str:
        inside = self.pick(self.el("h1", self.text(1, 5)), self.el("p", self.text(2, 12)), self.el("div", self.text(1, 6), "logo")) + (self.nav() if self.r.random() < 0.4 else "")
        return self.pick(self.el("header", inside), self.el("div", inside, self.pick("header", "masthead", "site-header", "top-banner")))

    def footer(self) -> str:
        inside = self.pick(f"&copy; {self.text(2, 14)}", self.el("p", self.text(4, 30)), self.links(2, 6) + self.el("p", self.text(3, 12)))
        return self.pick(self.el("footer", inside), self.el("footer", inside), self.el("div", inside, self.pick("footer", "site-footer", "copyright")))

    def ad(self) -> str:
        inside = self.pick(self.text(3, 40), self.el("p", self.text(4, 40)), self.link(), self.el("h3", self.text(2, 5)) + self.el("p", self.text(3, 20)))
        return self.el(self.pick("div", "div", "div", "aside", "section", "p", "span"), inside, self.pick("ad", "ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner ad"))

    def notice(self) -> str:
        inside = self.el("p", self.text(4, 40)) + self.pick("", self.el("button", self.text(1, 2)))
        return self.el(self.pick("div", "div", "section", "aside", "dialog"), inside, self.pick("cookie-notice", "notice", "consent", "alert", "newsletter", "cookie-banner", "popup"))

    def side(self) -> str:
        inside = self.pick(self.links(3, 8), self.el("h3", self.text(1, 4)) + self.links(2, 6), self.el("h2", self.text(1, 4)) + self.el("p", self.text(5, 60)))
        return self.pick(self.el("aside", inside), self.el("div", inside, self.pick("sidebar", "related", "widget", "right-rail", "recommended")), self.el("aside", inside, "sidebar"))

    def form(self) -> str:
        inside = self.pick("", self.el("label", self.text(1, 4))) + '<input name="q">' + self.pick("", self.el("p", self.text(3, 20))) + self.el("button", self.text(1, 2))
        return self.pick(self.el("form", inside), self.el("form", inside, self.pick("search", "login", "subscribe")), self.el("div", self.el("form", inside), "search-form"))

    def comments(self) -> str:
        one = lambda: self.el(self.pick("div", "li", "article"), self.pick(self.el("p", self.text(3, 60)), self.el("b", self.word()) + self.el("p", self.text(3, 60))), "comment")
        inside = self.pick("", self.el("h2", self.text(1, 3)), self.el("h3", self.text(1, 3))) + "".join(one() for _ in range(self.r.randint(1, 5)))
        return self.el(self.pick("section", "div", "div", "ol"), inside, self.pick("comments", "comment-list", "replies", "discussion"))

    def noise(self) -> str:
        return self.pick(self.ad, self.ad, self.notice, self.side, self.form)()

    def part(self) -> str:
        p = lambda: self.el("p", self.pick(self.text(1, 6), self.text(5, 40), self.text(30, 160)), main=True)
        kind = self.r.random()
        if kind < 0.62:
            return p()
        if kind < 0.7:
            return f"<p {MARK}><b>{self.text(1, 12)}<br>"
        if kind < 0.78:
            return self.el(self.pick("h2", "h3"), self.text(1, 8), main=True) + p()
        if kind < 0.85:
            return self.el(self.pick("ul", "ol"), "".join(f"<li>{self.text(2, 25)}</li>" for _ in range(self.r.randint(2, 6))), main=True)
        if kind < 0.89:
            return self.el("blockquote", self.el("p", self.text(5, 40)), main=True)
        if kind < 0.92:
            return self.el("p", f"{self.text(5, 30)} {self.link()} {self.text(5, 30)}", main=True)
        if kind < 0.94:
            return self.el("pre", self.text(5, 40), main=True)
        if kind < 0.96:
            return self.el("table", "".join(f"<tr><td>{self.text(1, 4)}</td><td>{self.text(1, 4)}</td></tr>" for _ in range(3)), main=True)
        if kind < 0.98:
            return self.el("figure", '<img src="x.png">' + self.el("figcaption", self.text(3, 15)), main=True)
        return self.el("div", self.text(5, 80), main=True)

    def body(self) -> str:
        inside = self.pick("", self.el("h1", self.text(2, 14), main=True), self.el("h1", self.text(2, 14), main=True))
        for _ in range(self.pick(1, 2, 3, 4, 6, 10, 16)):
            inside += self.part()
            if self.r.random() < 0.06:
                inside += self.noise()
        kind = self.r.random()
        if kind < 0.5:
            return self.el("article", inside, self.pick("", "", "post", "entry"))
        if kind < 0.62:
            return self.el("main", self.pick(inside, self.el("article", inside)), self.pick("", "content"))
        if kind < 0.9:
            return self.el(self.pick("div", "div", "section"), inside, self.pick("content", "article-body", "post", "entry-content", "story", "main", "page-content"))
        return self.el("div", inside)

    def bare(self) -> str:
        """Nothing around the article."""
        return self.pick("", "<body>", "<html><body>") + "".join(self.part() for _ in range(self.pick(1, 1, 2, 4)))

    def page(self) -> str:
        before = [f for f, p in ((self.header, 0.5), (self.nav, 0.75), (self.notice, 0.25), (self.ad, 0.5), (self.form, 0.15), (self.side, 0.15)) if self.r.random() < p]
        after = [f for f, p in ((self.comments, 0.35), (self.side, 0.35), (self.ad, 0.3), (self.form, 0.15), (self.nav, 0.1), (self.footer, 0.8), (self.notice, 0.1)) if self.r.random() < p]
        if self.r.random() < 0.3:
            self.r.shuffle(before)
        inside = self.body()
        if self.r.random() < 0.3:
            inside = self.el("div", inside + (self.side() if self.r.random() < 0.5 else "") + (self.comments() if self.r.random() < 0.3 else ""), self.pick("", "wrapper", "container", "row"))
        inside = "".join(f() for f in before) + inside + "".join(f() for f in after)
        if self.r.random() < 0.25:
            inside = self.el("div", inside, self.pick("", "page", "wrapper", "site", "container"))
        return f"<!DOCTYPE html><html><head><title>{self.text(2, 9)}</title><style>p{{}}</style></head><body>{inside}</body></html>"


def _labels(page: Page) -> np.ndarray:
    """Whether a node's subtree holds marked text."""
    n = len(page.parent)
    main = page.marked[:]
    for i in range(1, n):
        main[i] = main[i] or main[page.parent[i]]
    out = np.zeros(n)
    for node, _, _, text in page.runs:
        if text.strip() and main[node]:
            out[node] = 1
    for i in range(n - 1, 0, -1):
        if out[i]:
            out[page.parent[i]] = 1
    return out


@lru_cache(maxsize=1)
def trained(pages: int = PAGES, seed: int = 7) -> boosting.Trees:
    maker = _Maker(seed)
    parsed = [parse(maker.page()) for _ in range(pages)] + [parse(maker.bare()) for _ in range(BARE)]
    return boosting.fit(np.vstack([node_features(p) for p in parsed]), np.concatenate([_labels(p) for p in parsed]))


def extract_batch(htmls: list[str | None], model: boosting.Trees) -> list[str]:
    pages = [parse(h or "") for h in htmls]
    if not pages:
        return []
    odds = model.margin(np.vstack([node_features(p) for p in pages]))
    out, at = [], 0
    for p in pages:
        out.append(rendered(p, decode(p, odds[at : at + len(p.parent)])))
        at += len(p.parent)
    return out


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: the id, url, text and n_chars (its code points)."""
    source = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    model = trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = extract_batch(batch.column(2).to_pylist(), model)
        cols = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(cols, ["key", "url", "text", "n_chars"])

    schema = f"key {source.schema['key'].dataType.simpleString()}, url string, text string, n_chars long"
    return arrow_map(source, run, schema).withColumnRenamed("key", id_col)
