"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 6).

A page is parsed into block-level nodes; inline elements belong to their block.  Features of a
node: kind of tag, groups of attribute tokens (its own and its ancestors'), depth, sibling
statistics, and subtree statistics (text, tags and link text, shares of the page and the
parent).  Boosted trees give each node the probability that it belongs to the article.

Hierarchical decoding picks the labels of all nodes together: along each path from the
root they read "before the article", "in the article", "removed from it" in this order, so
nothing under a removed node returns and no article starts inside another one.  The most
likely labelling is found by one pass up and one down the tree.

Training needs no hand labels: texts of at most ``TRAIN_PAGES`` pages (those with the
smallest hashes of their URLs, a documented bound) are put into randomly drawn layouts,
whose roles are known, and the trees are fitted to these.  Every page of the table is scored.

Text: character references are decoded, white space inside a block becomes one space, blocks
are joined by one space in page order; nothing else is dropped or cut.

Defined results: null, empty or markup-free pages without a block of text have an empty
text; a page of bare text is its own article; unclosed and stray tags are repaired as
browsers do for blocks; repeated rows get equal rows; other columns stay.  An empty table
trains nothing and gives no rows.  One pass without shuffle; memory is one batch of pages.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from citymotion.llm.common import small_batches

TRAIN_PAGES = 200
LAYOUTS = 500
TREES, DEPTH, RATE, BINS = 50, 4, 0.25, 32
SEED = 6

SKIPPED = frozenset("script style noscript template svg iframe select textarea title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
KINDS = {
    "html": 0, "body": 0, "article": 1, "main": 2, "section": 3, "div": 4, "p": 5, "h1": 6, "h2": 7, "h3": 7, "h4": 7, "h5": 7, "h6": 7,
    "ul": 8, "ol": 8, "dl": 8, "menu": 8, "li": 9, "dt": 9, "dd": 9, "nav": 10, "header": 11, "footer": 12, "aside": 13,
    "form": 14, "fieldset": 14, "button": 14, "label": 14, "table": 15, "thead": 15, "tbody": 15, "tfoot": 15, "tr": 15, "td": 15, "th": 15, "caption": 15,
    "blockquote": 16, "pre": 16, "address": 17, "figure": 16, "figcaption": 16, "details": 17, "summary": 17, "dialog": 18, "hgroup": 6, "center": 4, "head": 19,
}
N_KINDS = 20
GROUPS = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner commercial affiliate",
    "nav navigation navbar menu menubar breadcrumb breadcrumbs toc pager pagination tabs",
    "header masthead topbar top logo branding",
    "footer foot bottom copyright colophon legal imprint",
    "side sidebar aside widget widgets rail complementary",
    "notice cookie cookies consent gdpr alert warning popup modal overlay dialog toast message disclaimer",
    "form login signup subscribe subscription newsletter search register input",
    "comment comments reply replies discussion disqus respond reader readers feedback thread",
    "share sharing social related recommended more tags tag follow rating",
    "meta byline author date time info caption credit",
    "content main body text maintext entry story primary",
    "article post articlebody postbody blogpost news single hentry",
    "title headline heading subtitle lead intro summary abstract",
    "hidden skip sr none screenreader",
)
TOKENS = {t: 1 << g for g, words in enumerate(GROUPS) for t in words.split()}
ANCESTOR_KINDS = (1, 2, 10, 11, 12, 13, 14, 18)
CLOSES_P = frozenset(KINDS) - {"html", "body", "head", "button", "label", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
LIMITS = frozenset("ul ol dl table body html article section main div td th".split())
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
_tokens_of: dict[str, int] = {}


def token_groups(values: str) -> int:
    """Bits of the groups that the tokens of attribute values belong to."""
    found = _tokens_of.get(values)
    if found is None:
        found = 0
        for word in _WORDS.findall(values):
            found |= TOKENS.get(word.lower(), 0)
        for word in values.lower().split():
            found |= TOKENS.get(word, 0)
        if len(_tokens_of) > 100_000:
            _tokens_of.clear()
        _tokens_of[values] = found
    return found


class Page(HTMLParser):
    """Block-level nodes of a page in document order, as parallel lists, and its text pieces."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.depth, self.groups, self.gold = ["html"], [-1], [0], [0], [0]
        self.pieces: list[tuple[int, int, str]] = []  # block, node, text
        self.own, self.linked, self.inline, self.start = [0], [0], [0], [0]
        self.stack, self.links, self.block, self.seen = [0], [0], 0, 0
        self.skip, self.skips = "", 0
        self.places: dict[str, list[int]] = {}  # of each tag in the stack, but the root
        self.limits: list[int] = []  # those of LIMITS
        self.feed(html)
        if _CUT_TAG.match(self.rawdata):  # the page ends inside a tag
            self.rawdata = ""
        self.close()

    def _open(self, tag: str, groups: int, gold: int) -> None:
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        self.depth.append(len(self.stack))
        self.groups.append(groups)
        self.gold.append(gold)
        self.own.append(0)
        self.linked.append(0)
        self.inline.append(0)
        self.start.append(self.seen)
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in LIMITS:
            self.limits.append(len(self.stack))
        self.stack.append(len(self.tag) - 1)
        self.links.append(0)
        self.block += 1

    def _close(self, place: int) -> None:
        for node in self.stack[place:]:
            self.places[self.tag[node]].pop()
        while self.limits and self.limits[-1] >= place:
            self.limits.pop()
        del self.stack[place:], self.links[place:]
        self.block += 1

    def _last(self, tags: tuple[str, ...]) -> int:
        """Place in the stack of the innermost of ``tags`` that no limit hides, or 0."""
        place = max((p[-1] for t in tags if (p := self.places.get(t))), default=0)
        return 0 if self.limits and self.limits[-1] > place else place

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skip:
            self.skips += tag == self.skip
            return
        if tag in SKIPPED:
            self.skip, self.skips = tag, 1
            return
        if tag not in KINDS:
            if tag == "br" or tag == "hr":
                self.pieces.append((self.block, self.stack[-1], " "))
            elif tag == "a":
                self.links[-1] += 1
            self.inline[self.stack[-1]] += 1
            return
        if tag == "html" or tag == "body" and self.places.get("body"):
            return
        if tag in CLOSES_P and (place := self._last(("p",))):
            self._close(place)
        if tag in SAME and (place := self._last(SAME[tag])):
            self._close(place)
        if tag == "body" and (place := self._last(("head",))):
            self._close(place)
        groups = gold = 0
        for name, value in attrs:
            if name in ("class", "id", "role", "itemprop", "aria-label") and value:
                groups |= token_groups(value)
            elif name == "hidden" or name == "style" and value and "none" in value:
                groups |= 1 << 13
            elif name == "data-gold":
                gold = int(value or 0)
        self._open(tag, groups, gold)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "svg":  # empty, also inside another one
            return
        if tag in VOID or tag not in KINDS and tag not in SKIPPED:
            if not self.skip and tag == "br":
                self.pieces.append((self.block, self.stack[-1], " "))
            return
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if self.skip:
            if tag == self.skip:
                self.skips -= 1
                if not self.skips:
                    self.skip = ""
            return
        if tag == "a":
            self.links[-1] = max(0, self.links[-1] - 1)
        elif tag in KINDS and tag not in ("html", "body"):
            if places := self.places.get(tag):
                self._close(places[-1])

    def handle_data(self, data: str) -> None:
        if self.skip:
            return
        node = self.stack[-1]
        self.pieces.append((self.block, node, data))
        n = len(data) - data.count(" ") - data.count("\n")
        self.own[node] += n
        self.seen += n
        if self.links[-1]:
            self.linked[node] += n

    def unknown_decl(self, data: str) -> None:
        pass


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = page.parent
    text, linked, tags = page.own[:], page.linked[:], [1 + x for x in page.inline]
    children = [0] * n
    place, same = [0] * n, [0] * n
    by_tag: dict[tuple[int, int], int] = {}
    kinds = [KINDS[t] for t in page.tag]
    above, above_kinds = [0] * n, [0] * n
    for i in range(1, n):
        p = parent[i]
        place[i] = children[p]
        children[p] += 1
        key = (p, kinds[i])
        by_tag[key] = by_tag.get(key, 0) + 1
        above[i] = above[p] | page.groups[p]
        above_kinds[i] = above_kinds[p] | 1 << kinds[p]
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = parent[i]
        text[p] += text[i]
        linked[p] += linked[i]
        tags[p] += tags[i]
    most = [0] * n
    for i in range(1, n):
        same[i] = by_tag[parent[i], kinds[i]]
        most[parent[i]] = max(most[parent[i]], text[i])
    a = np.zeros((n, N_KINDS + 2 * len(GROUPS) + len(ANCESTOR_KINDS) + 16), dtype=np.float32)
    rows = np.arange(n)
    a[rows, kinds] = 1
    at = N_KINDS
    for bits in (page.groups, above):
        a[:, at : at + len(GROUPS)] = np.array(bits)[:, None] >> np.arange(len(GROUPS)) & 1
        at += len(GROUPS)
    a[:, at : at + len(ANCESTOR_KINDS)] = np.array(above_kinds)[:, None] >> np.array(ANCESTOR_KINDS) & 1
    at += len(ANCESTOR_KINDS)
    up = np.maximum(np.array(parent), 0)
    text_, linked_, tags_, own = (np.array(x, dtype=np.float32) for x in (text, linked, tags, page.own))
    kids, siblings = np.array(children, dtype=np.float32), np.array(children, dtype=np.float32)[up]
    total = max(1.0, float(text_[0]))
    numbers = (
        np.array(page.depth), np.array(place), siblings, np.array(same), kids, np.log1p(own), np.log1p(text_), linked_ / np.maximum(text_, 1),
        text_ / tags_, text_ / total, text_ / np.maximum(text_[up], 1), text_ / np.maximum(np.array(most)[up], 1), np.array(page.start) / total,
        np.array(place) / np.maximum(siblings, 1), np.array(most) / np.maximum(text_, 1), (linked_ / np.maximum(text_, 1))[up],
    )
    for k, x in enumerate(numbers):
        a[:, at + k] = x
    return a


# ---------------------------------------------------------------- boosted trees


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: the split of each inner node, the value of each leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(len(leaf).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - len(f)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS, ridge: float = 1.0) -> Trees:
    """Logistic gradient boosting with second-order gains on binned features."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.int64)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(n, base)
    inner = 2**depth - 1
    out_f, out_t, out_v = [], [], []
    flat = binned + np.arange(m) * bins
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        f, t, tb = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.full(inner, bins)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            key = ((node - first) * (m * bins))[:, None] + flat
            g = np.bincount(key.reshape(-1), np.repeat(grad, m), width * m * bins).reshape(width, m, bins).cumsum(axis=2)
            h = np.bincount(key.reshape(-1), np.repeat(hess, m), width * m * bins).reshape(width, m, bins).cumsum(axis=2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < 1.0) | (h_all - h < 1.0)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    f[first + k], t[first + k], tb[first + k] = j, edges[j][b], b
            node = 2 * node + 1 + (binned[np.arange(n), f[node]] > tb[node])
        leaf_of = node - inner
        g = np.bincount(leaf_of, grad, 2**depth)
        h = np.bincount(leaf_of, hess, 2**depth)
        value = -rate * g / (h + ridge)
        score += value[leaf_of]
        out_f.append(f)
        out_t.append(t)
        out_v.append(value)
    return Trees(np.array(out_f), np.array(out_t), np.array(out_v), base)


# ---------------------------------------------------------------- decoding


def decode(parent: list[int], odds: np.ndarray) -> list[bool]:
    """Whether each node is in the article, under the path rule of the module text."""
    n = len(parent)
    inside = (-np.logaddexp(0, -odds)).tolist()  # log p
    outside = (-np.logaddexp(0, odds)).tolist()  # log (1 - p)
    before, during, after = outside[:], inside[:], outside[:]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        after[p] += after[i]
        during[p] += max(during[i], after[i])
        before[p] += max(before[i], during[i])
    state = [0] * n
    state[0] = 0 if before[0] >= during[0] else 1
    for i in range(1, n):
        s = state[parent[i]]
        if s == 0:
            state[i] = 0 if before[i] >= during[i] else 1
        elif s == 1:
            state[i] = 1 if during[i] >= after[i] else 2
        else:
            state[i] = 2
    return [s == 1 for s in state]


def article(page: Page, chosen: list[bool]) -> str:
    """The text of the chosen nodes."""
    blocks: list[str] = []
    parts: list[str] = []
    last = -1
    for block, node, text in page.pieces:
        if not chosen[node]:
            continue
        if block != last and parts:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        last = block
        parts.append(text)
    blocks.append(" ".join("".join(parts).split()))
    return " ".join(b for b in blocks if b)


def extract(pages: list[str], model: Trees) -> list[str]:
    parsed = [Page(h or "") for h in pages]
    odds = model.scores(np.concatenate([features(p) for p in parsed])) if parsed else np.zeros(0)
    out, at = [], 0
    for p in parsed:
        n = len(p.tag)
        own = odds[at : at + n]
        at += n
        out.append(article(p, [True]) if n == 1 else article(p, decode(p.parent, own)))
    return out


# ---------------------------------------------------------------- layouts to train on


class Layouts:
    """Draws pages with known roles around given texts."""

    def __init__(self, texts: list[str], seed: int = SEED):
        self.rng = random.Random(seed)
        self.words = [w for t in texts for w in t.split()] or ["word", "text", "page", "line."]

    def say(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        k = self.rng.randrange(len(self.words))
        return escape(" ".join((self.words[k : k + n] or self.words[:1])))

    def tag(self, name: str, inner: str, names: str = "", gold: int = 0, rate: float = 0.85) -> str:
        token = self.rng.choice(names.split()) if names and self.rng.random() < rate else ""
        if token and self.rng.random() < 0.25:
            token += self.rng.choice(("-box", "-wrap", " block", "_area", "-1"))
        attr = f' {self.rng.choice(("class", "class", "id"))}="{token}"' if token else ""
        return f"<{name}{attr}{' data-gold=1' if gold else ''}>{inner}</{name}>"

    def links(self, low: int, high: int) -> str:
        return "".join(f'<li><a href="/x">{self.say(1, 3)}</a></li>' for _ in range(self.rng.randint(low, high)))

    def menu(self) -> str:
        inner = f"<ul>{self.links(3, 9)}</ul>" if self.rng.random() < 0.8 else " | ".join(f'<a href="/x">{self.say(1, 2)}</a>' for _ in range(self.rng.randint(3, 8)))
        name = self.rng.choice(("nav", "nav", "div", "ul"))
        return self.tag(name, inner if name != "ul" else self.links(3, 9), GROUPS[1], rate=0.4 if name == "nav" else 0.95)

    def advert(self) -> str:
        inner = self.say(3, 30)
        return self.tag(self.rng.choice(("div", "div", "section", "aside", "p")), inner if self.rng.random() < 0.6 else f"<p>{inner}</p>", GROUPS[0], rate=1)

    def head(self) -> str:
        return self.tag(self.rng.choice(("header", "header", "div")), self.tag(self.rng.choice(("div", "p", "h2", "h1")), self.say(1, 6), "logo title branding") + (self.menu() if self.rng.random() < 0.5 else ""), GROUPS[2], rate=0.95)

    def foot(self) -> str:
        inner = f"&copy; {self.say(1, 3)} &middot; {self.say(3, 25)}"
        return self.tag(self.rng.choice(("footer", "footer", "div")), inner if self.rng.random() < 0.6 else f"<p>{inner}</p><ul>{self.links(1, 5)}</ul>", GROUPS[3], rate=0.6)

    def side(self) -> str:
        inner = f"<h3>{self.say(1, 4)}</h3><ul>{self.links(2, 7)}</ul>" if self.rng.random() < 0.6 else f"<h3>{self.say(1, 4)}</h3><p>{self.say(5, 40)}</p>"
        name = self.rng.choice(("aside", "aside", "div", "section"))
        return self.tag(name, inner, GROUPS[4], rate=0.6 if name == "aside" else 1)

    def notice(self) -> str:
        inner = f"<p>{self.say(5, 35)}</p>" + ("<button>OK</button>" if self.rng.random() < 0.5 else "")
        return self.tag(self.rng.choice(("div", "div", "section", "dialog", "p")), self.say(5, 35) if self.rng.random() < 0.4 else inner, GROUPS[5], rate=1)

    def form(self) -> str:
        return self.tag("form", f"<label>{self.say(1, 4)}</label><input type=text><p>{self.say(2, 15)}</p><button>{self.say(1, 2)}</button>", GROUPS[6], rate=0.6)

    def comments(self) -> str:
        one = self.rng.choice(("li", "div", "article", "p"))
        each = "".join(self.tag(one, (f"<p>{self.say(4, 60)}</p>" if one != "p" else self.say(4, 60)), "comment reply", rate=0.8) for _ in range(self.rng.randint(1, 6)))
        inner = f"<h{2 + self.rng.randrange(2)}>{self.say(1, 3)}</h2>" + (f"<ol>{each}</ol>" if one == "li" else each) + (self.form() if self.rng.random() < 0.3 else "")
        return self.tag(self.rng.choice(("section", "div", "aside")), inner, GROUPS[7], rate=1)

    def related(self) -> str:
        return self.tag(self.rng.choice(("div", "section", "ul")), self.links(2, 6), GROUPS[8], rate=1)

    def body(self) -> str:
        """The article's inside; every block of it is gold."""
        out = []
        if self.rng.random() < 0.75:
            out.append(f"<h1 data-gold=1>{self.say(2, 14)}</h1>")
        for _ in range(self.rng.randint(1, 14)):
            r = self.rng.random()
            words = self.say(1, 12) if self.rng.random() < 0.25 else self.say(10, 130)
            if r < 0.66:
                out.append(f"<p data-gold=1>{words}</p>")
            elif r < 0.74:
                out.append(f"<p data-gold=1><b>{words}<br>")  # left open
            elif r < 0.80:
                out.append(f"<h2 data-gold=1>{self.say(1, 9)}</h2>")
            elif r < 0.85:
                out.append("<ul data-gold=1>" + "".join(f"<li data-gold=1>{self.say(2, 25)}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>")
            elif r < 0.89:
                out.append(f"<blockquote data-gold=1><p data-gold=1>{words}</p></blockquote>")
            elif r < 0.92:
                cells = "".join("<tr data-gold=1>" + "".join(f"<td data-gold=1>{self.say(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(3))
                out.append(f"<table data-gold=1>{cells}</table>")
            elif r < 0.95:
                out.append(f'<p data-gold=1>{words} <a href="/y">{self.say(1, 4)}</a> {self.say(2, 9)}</p>')
            elif r < 0.97:
                out.append(f"<div data-gold=1>{words}</div>")
            else:
                out.append(f"<pre data-gold=1>{words}</pre>")
            if self.rng.random() < 0.07:
                out.append(self.rng.choice((self.advert, self.related, self.notice, self.form, self.side))())
        return "".join(out)

    def page(self) -> str:
        rng = self.rng
        name = rng.choice(("article", "article", "article", "main", "div", "div", "section"))
        root = self.tag(name, self.body(), GROUPS[10] + " " + GROUPS[11], 1, rate=0.35 if name in ("article", "main") else 1)
        inside = [f for f in (self.related, self.comments, self.advert) if rng.random() < 0.2]
        middle = root + "".join(f() for f in inside)
        if rng.random() < 0.4:
            middle = self.tag(rng.choice(("main", "div", "div")), (self.menu() if rng.random() < 0.2 else "") + middle + (self.side() if rng.random() < 0.4 else ""), "container wrapper page layout content main")
        above = [f() for f in (self.notice, self.head, self.menu, self.advert, self.form) if rng.random() < 0.45]
        below = [f() for f in (self.side, self.comments, self.related, self.advert, self.form, self.notice, self.foot) if rng.random() < 0.4]
        rng.shuffle(above)
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(above)}{middle}{''.join(below)}" + ("</body></html>" if rng.random() < 0.9 else "")


def train(texts: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> Trees:
    """Trees fitted to drawn layouts around ``texts``."""
    draw = Layouts(texts, seed)
    pages = [Page(draw.page()) for _ in range(layouts)]
    x = np.concatenate([features(p) for p in pages])
    return fit_trees(x, np.concatenate([np.array(p.gold, dtype=np.float64) for p in pages]))


def plain_text(html: str | None) -> str:
    return article(p := Page(html or ""), [True] * len(p.tag))


def sample_texts(pages: DataFrame, html_col: str, key_col: str, n: int) -> list[str]:
    """Training text: of the ``n`` pages with the smallest hashes of ``key_col``, up to 4,000
    characters from the first 100,000 of each."""
    place = F.xxhash64(key_col)
    last = pages.select(place.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]  # numbers only
    if last is None:
        return []
    some = pages.filter(place <= last).orderBy(place, key_col, F.length(html_col)).limit(n)
    return [plain_text(r[0])[:4000] for r in some.select(F.substring(html_col, 1, 100_000)).collect()]


def with_text(pages: DataFrame, html_col: str = "html", key_col: str = "url", model: Trees | None = None, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; without a model one is trained on the sample."""
    small_batches(pages.sparkSession)
    model = model or train(sample_texts(pages, html_col, key_col, train_pages))

    @pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series(extract([h if isinstance(h, str) else "" for h in b], model), dtype=object)

    return pages.withColumn("text", texts(F.col(html_col))).withColumn("n_chars", F.char_length("text").cast("long"))
