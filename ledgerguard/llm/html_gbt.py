"""Main text of web pages by gradient-boosted trees over DOM nodes.

A tolerant parser makes a tree of block elements. Boosted trees score each
node from its tag and attribute tokens, its subtree's density of text, links
and punctuation, its depth and its siblings. A dynamic programme then cuts the
tree: every piece of text gets the verdict of exactly one node on its way to the
root, so an ancestor and a descendant never contradict each other.

The model is trained here, on a bounded number of generated pages whose nodes
are labelled by construction (``TRAINING_PAGES``).
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerguard.llm.common import NULL_ID, arrow_map

TRAINING_PAGES = 400
TREES, DEPTH, RATE, BINS = 40, 4, 0.3, 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head title script style noscript template svg math iframe object canvas audio video textarea "
                   "select button".split())
#: What may stand in a head; any other start tag, or text, ends an open one.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
CLOSES_P = frozenset(("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul").split())
#: Start tags that end a silent element which is never closed.
BLOCK = CLOSES_P | frozenset("body caption dd dt li tbody td tfoot th thead tr".split())
#: Elements that make nodes and blocks; all others, unknown ones too, stand in a line.
NODES = BLOCK | frozenset("center dir figcaption hgroup html legend listing optgroup option plaintext search summary xmp".split())
#: An open element that a start tag of the same group closes, within its container.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
        "th": ("td", "th"), "option": ("option",)}
CONTAINER = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
             "th": ("table", "tr"), "option": ("select",)}


def closed(html: str) -> str:
    """``html`` up to a comment that nothing ends: such a comment reaches to the end of the page."""
    at = html.rfind("<!--")
    if at < 0 or html.find("-->", at) >= 0 or html.find("--!>", at) >= 0:
        return html
    before = html[:at].lower()
    if any(before.rfind(f"<{tag}") > before.rfind(f"</{tag}") for tag in ("script", "style", "textarea", "title")):
        return html  # text of that element
    return html[:at]


class Page(HTMLParser):
    """Block elements of one page: parallel lists, parents before children."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.attrs, self.parent, self.depth = ["#root"], [""], [-1], [0]
        self.marks: list[str | None] = [None]
        self.texts: list[tuple[int, int, str, bool]] = []  # node, block, text, in a link
        self.open, self.silent, self.links, self.block = [0], [], 0, 0
        self.events: list[tuple] = []
        self.feed(closed(html))
        self.close()
        self.ends = self._ends()
        for i, (kind, what, attrs) in enumerate(self.events):
            kind(i, what, attrs)

    def handle_starttag(self, tag, attrs):
        self.events.append((self._start, tag, attrs))

    def handle_endtag(self, tag):
        self.events.append((self._end, tag, None))

    def handle_data(self, data):
        self.events.append((self._data, data, None))

    def _ends(self) -> dict[int, tuple[int, bool]]:
        """Where each silent element ends, by its event: at its own end tag (True), or at that of an element around it."""
        ends, stack, count = {}, [], Counter()
        for i, (kind, tag, _) in enumerate(self.events):
            if kind == self._data or tag not in NODES and tag not in SILENT:
                continue
            if kind == self._start:
                stack.append((tag, i))
                count[tag] += 1
            elif count[tag] or tag in ("body", "html"):
                while stack:
                    name, at = stack.pop()
                    count[name] -= 1
                    if name in SILENT:
                        ends[at] = i, name == tag
                    if name == tag:
                        break
        return ends

    def _silent_at(self, tag) -> bool:
        """Whether a start tag stands in a silent element, after it has ended those that it may end."""
        while self.silent:
            name, at = self.silent[-1]
            if name == "head":
                if tag in IN_HEAD:
                    return True
            elif self.ends.get(at, (0, False))[1] or tag not in BLOCK and tag != name:
                return True
            self.silent.pop()
        return False

    def _start(self, i, tag, attrs):
        if self._silent_at(tag):
            if self.silent[-1][0] == "head" and tag in SILENT and tag != "head":
                self.silent.append((tag, i))
            return
        if tag == "br":
            self._data(i, " ", None)
            return
        if tag in SILENT:
            self.silent.append((tag, i))
            self.block += tag in ("head", "title")
            return
        if tag not in NODES:
            self.links += tag == "a"
            self.block += tag == "hr"
            return
        if tag in CLOSES_P:
            self._close(("p",), ("table", "td", "th", "li", "article", "section", "div", "body"))
        if tag in SAME:
            self._close(SAME[tag], CONTAINER[tag])
        values = dict(attrs)
        self.block += 1
        self.tag.append(tag)
        self.attrs.append(" ".join(str(values.get(a) or "") for a in ("class", "id", "role")).lower())
        self.marks.append(values.get("data-y"))
        self.parent.append(self.open[-1])
        self.depth.append(len(self.open))
        self.open.append(len(self.tag) - 1)

    def _close(self, tags, stop):
        for i in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[i]]
            if name in tags:
                del self.open[i:]
                self.links = 0
                return
            if name in stop:
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in NODES or tag in SILENT:
            self.handle_endtag(tag)

    def _end(self, i, tag, _):
        for j, (_, at) in enumerate(self.silent):
            end, own = self.ends.get(at, (None, False))
            if end == i:
                del self.silent[j:]
                if own:
                    return
                break
        if self.silent:
            return
        if tag not in NODES:
            self.links -= tag == "a" and self.links > 0
            return
        self.block += 1
        for i in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[i]] == tag:
                del self.open[i:]
                self.links = 0
                return

    def _data(self, i, data, _):
        if self.silent and self.silent[-1][0] == "head" and data.strip():
            self.silent.pop()
        if not self.silent and data:
            self.texts.append((self.open[-1], self.block, data, self.links > 0))


# ---------------------------------------------------------------- features

TAGS = ("article main section div p h1 h2 h3 ul ol li nav header footer aside form table tr td blockquote pre body "
        "figure dl").split()
#: Words of class, id and role values that pages use for their parts.
TOKENS = ("ad ads advert adv banner sponsor promo nav menu breadcrumb header masthead logo footer foot copyright aside "
          "sidebar widget related recommend share social cookie consent notice alert popup modal newsletter subscribe "
          "signup login form search comment comments reply respond disqus discussion article post entry content body "
          "text story main page wrapper container title meta author tags pager pagination "
          "kommentar kommentare commentaire commentaires comentario comentarios commenti reacties").split()
#: Sentence marks, of unsegmented scripts too.
STOPS = ".,;:!?。，、；：！？"
_WORD = re.compile("[a-z]+").findall
_TOKEN = {t: i for i, t in enumerate(TOKENS)}
_TAG = {t: i for i, t in enumerate(TAGS)}
NUMERIC = 15
WIDTH = NUMERIC + 3 * len(TAGS) + 2 * len(TOKENS)


def features(page: Page) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per node, own text length, subtree text length)."""
    n = len(page.tag)
    own, link, stops, blocks = (np.zeros(n) for _ in range(4))
    for node, _, text, linked in page.texts:
        size = len(text.strip())
        own[node] += size
        link[node] += size * linked
        stops[node] += sum(map(text.count, STOPS))
        blocks[node] += 1
    total, links, marks, nodes, heads = own.copy(), link.copy(), stops.copy(), np.ones(n), np.zeros(n)
    place, siblings, before = np.zeros(n), np.zeros(n), np.zeros(n)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        place[i] = len(kids[page.parent[i]])
        kids[page.parent[i]].append(i)
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        for a in (total, links, marks, nodes):
            a[p] += a[i]
        heads[p] += heads[i] + (page.tag[i][0] == "h" and page.tag[i][1:].isdigit())
        siblings[i] = len(kids[p])
    whole = max(1.0, total[0])
    at = np.cumsum(own) - own
    same = np.zeros(n)
    for group in kids:
        names = [page.tag[i] for i in group]
        for i, name in zip(group, names):
            same[i] = names.count(name) if len(names) < 64 else len(names)
    beside = total[np.array(page.parent)] - total
    x = np.zeros((n, WIDTH))
    x[:, :NUMERIC] = np.stack([
        np.log1p(own), np.log1p(total), total / whole, links / np.maximum(total, 1), marks / np.maximum(total, 1),
        total / nodes, np.log1p(nodes), np.array(page.depth), place, siblings, same, at / whole,
        np.log1p(np.maximum(beside, 0)), heads, own / np.maximum(total, 1)], axis=1)
    base = NUMERIC
    for i in range(n):
        for tag, shift in ((page.tag[i], 0), (page.tag[page.parent[i]] if i else "", len(TAGS))):
            if tag in _TAG:
                x[i, base + shift + _TAG[tag]] = 1
        if i:
            p = page.parent[i]  # all tags and tokens above, so far as known
            x[i, base + 2 * len(TAGS):base + 3 * len(TAGS)] = x[p, base + 2 * len(TAGS):base + 3 * len(TAGS)]
            x[i, -len(TOKENS):] = x[p, -len(TOKENS):]
            if page.tag[p] in _TAG:
                x[i, base + 2 * len(TAGS) + _TAG[page.tag[p]]] = 1
        for word in _WORD(page.attrs[i]):
            if word in _TOKEN:
                x[i, base + 3 * len(TAGS) + _TOKEN[word]] = 1
                x[i, WIDTH - len(TOKENS) + _TOKEN[word]] = 1
    return x, own, total


# ---------------------------------------------------------------- boosted trees

class Boosted:
    """Gradient-boosted trees for log-odds, on quantile bins, all levels split by histogram."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        # a rare indicator has one quantile only: cut it in the middle
        self.cuts = [c if len(c) > 1 or not len(c) or v.min() == v.max() else np.array([(v.min() + v.max()) / 2])
                     for c, v in zip(self.cuts, x.T)]
        binned = self.bins(x)
        score = np.zeros(len(y))
        self.trees = []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, weight * (y - p), weight * p * (1 - p))
            self.trees.append(tree)
            score += self._walk(tree, binned)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], axis=1).astype(np.int8)

    @staticmethod
    def _grow(binned, gradient, curve):
        n, width = binned.shape
        feature, cut = np.zeros(2 ** DEPTH, int), np.full(2 ** DEPTH, BINS)
        node = np.ones(n, int)  # heap order; the root is 1
        for level in range(DEPTH):
            low, count = 2 ** level, 2 ** level
            gains = np.full((width, count, BINS), -np.inf)
            for f in range(width):
                key = (node - low) * BINS + binned[:, f]
                g = np.bincount(key, gradient, count * BINS).reshape(count, BINS)
                h = np.bincount(key, curve, count * BINS).reshape(count, BINS)
                left_g, left_h = g.cumsum(1), h.cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gains[f] = (left_g ** 2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1)
                            - all_g ** 2 / (all_h + 1))
            flat = gains.transpose(1, 0, 2).reshape(count, -1)
            best = flat.argmax(1)
            feature[low:2 * low], cut[low:2 * low] = best // BINS, best % BINS
            node = 2 * node + (binned[np.arange(n), feature[node]] > cut[node])
        leaf = node - 2 ** DEPTH
        g, h = np.bincount(leaf, gradient, 2 ** DEPTH), np.bincount(leaf, curve, 2 ** DEPTH)
        return feature, cut, RATE * g / (h + 1)

    @staticmethod
    def _walk(tree, binned):
        feature, cut, value = tree
        node, rows = np.ones(len(binned), int), np.arange(len(binned))
        for _ in range(DEPTH):
            node = 2 * node + (binned[rows, feature[node]] > cut[node])
        return value[node - 2 ** DEPTH]

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned = self.bins(x)
        return 1 / (1 + np.exp(-sum(self._walk(t, binned) for t in self.trees)))


PAGE = frozenset(("#root", "html", "body"))


def decode(page: Page, p: np.ndarray, own: np.ndarray, total: np.ndarray) -> np.ndarray:
    """For each node, whether its own text stays: the likeliest cut of the tree.

    A node either gives its verdict to its whole subtree, or leaves its children
    to themselves and judges its own text alone. Every part weighs by its text;
    ties go to the larger part.
    """
    n = len(p)
    odds = np.clip(np.log(p / (1 - p)), -4, 4)
    for i in range(1, n):  # main text above is evidence too, fading with the distance; the page as such is none
        if page.tag[page.parent[i]] not in PAGE:
            odds[i] += 0.65 * np.clip(odds[page.parent[i]], 0, 3)
    beside: dict[int, float] = {}  # so is the likeliest plain paragraph for those beside it
    plain = [i for i in range(1, n) if page.tag[i] == "p" and not page.attrs[i].strip()]
    for i in plain:
        beside[page.parent[i]] = max(beside.get(page.parent[i], 0.0), min(odds[i], 3.0))
    for i in plain:
        odds[i] = max(odds[i], min(odds[i] + 0.5 * beside[page.parent[i]], 3.0))
    below = total - own
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    split = own * np.maximum(keep, drop)
    # one verdict for a subtree is judged by its top and, as much, by what is below
    keep, drop = (own + below / 2) * keep, (own + below / 2) * drop
    cut, stays = np.zeros(n, bool), np.zeros(n, bool)
    for i in range(n - 1, -1, -1):
        whole = max(keep[i], drop[i])
        part = page.tag[i] not in PAGE  # the page as such has no verdict
        cut[i], stays[i] = part and whole >= split[i] - 0.1, keep[i] >= drop[i]
        if i:
            up = page.parent[i]
            split[up] += max(whole, split[i] - 0.1) if part else split[i]
            keep[up] += keep[i] / 2
            drop[up] += drop[i] / 2
    verdict, decided = odds > 0, np.zeros(n, bool)
    for i in range(n):
        up = page.parent[i]
        if i and decided[up]:
            verdict[i], decided[i] = verdict[up], True
        elif cut[i]:
            verdict[i], decided[i] = stays[i], True
    if total[0] and not own[verdict].sum():
        _only_paragraphs(page, odds, own, verdict)
    return verdict


#: Parents, by tag or token, whose paragraphs are never the article.
ASIDE = frozenset("nav header footer aside form".split())
NOISE = frozenset("ad ads advert adv banner sponsor promo nav menu breadcrumb footer foot copyright sidebar widget related recommend "
                  "share social cookie consent notice alert popup modal newsletter subscribe signup login search comment "
                  "comments kommentare commentaires comentarios".split())


def _only_paragraphs(page: Page, odds: np.ndarray, own: np.ndarray, verdict: np.ndarray) -> None:
    """Where nothing would stay: the likeliest paragraph outside of all boilerplate, and those beside it, stay."""
    noise = np.zeros(len(own), bool)
    for i in range(1, len(own)):
        noise[i] = noise[page.parent[i]] or page.tag[i] in ASIDE or not NOISE.isdisjoint(_WORD(page.attrs[i]))
    some = [i for i in range(1, len(own)) if page.tag[i] == "p" and own[i] and not noise[i]]
    if some:
        best = max(some, key=lambda i: odds[i])
        for i in some:
            verdict[i] = page.parent[i] == page.parent[best]


def text_of(page: Page, verdict: np.ndarray) -> str:
    """The blocks that stay, white space made one space, joined by newlines."""
    out, last = [], None
    for node, block, text, _ in page.texts:
        if verdict[node]:
            if block != last:
                out.append([])
                last = block
            out[-1].append(text)
    blocks = (" ".join("".join(parts).split()) for parts in out)
    return "\n".join(b for b in blocks if b)


# ---------------------------------------------------------------- training pages

_PARTS = {  # boilerplate: (element, class or id values)
    "menu": (("nav", "div", "ul"), ("", "menu", "nav main-nav", "breadcrumb", "pagination pager")),
    "header": (("header", "div"), ("", "header", "masthead", "site-header")),
    "footer": (("footer", "div"), ("", "footer", "site-footer", "copyright")),
    "sidebar": (("aside", "div"), ("", "sidebar", "widget", "related", "recommended")),
    "advert": (("div", "aside", "section"), ("ad", "ads", "advert", "banner", "sponsored", "promo box")),
    "notice": (("div", "section", "p"), ("notice", "cookie consent", "alert", "popup modal", "newsletter")),
    "form": (("form",), ("", "search", "login", "subscribe", "contact")),
    "share": (("div", "ul"), ("share", "social", "tags", "meta author")),
    "comments": (("section", "div", "ol"), ("comments", "comment-list", "comments-area", "disqus", "discussion",
                                            "kommentare", "commentaires", "comentarios")),
}

#: Kinds of generated articles: of mixed length; a few words; sentences that are
#: mostly links; with figures; in an unsegmented script; without a page around it.
STYLES = ("mixed", "mixed", "mixed", "mixed", "short", "linked", "figures", "unsegmented", "bare")


class _Writer:
    """One generated page; every element says in data-y how much of it is main text."""

    def __init__(self, seed: int, styles: tuple[str, ...] = STYLES):
        self.r = random.Random(seed)
        self.style = self.r.choice(styles)
        letters = self.r.choice(("aeinorst", "abcdefghijklmnopqrstuvwxyz", "éèaçeinrstu", "äöüaeinrst"))
        self.words = ["".join(self.r.choice(letters) for _ in range(self.r.randint(1, 9))) for _ in range(80)]

    def say(self, n: int) -> str:
        if self.style == "unsegmented":
            letters = "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后"
            return "".join(self.r.choice(letters) + ("。" if self.r.random() < 0.04 else "，" if self.r.random() < 0.05 else "")
                           for _ in range(2 * n))
        out = [self.r.choice(self.words) + ("." if self.r.random() < 0.1 else "," if self.r.random() < 0.06 else "")
               for _ in range(n)]
        return " ".join(out).capitalize()

    def tag(self, name: str, value: str, y: int, inner: str, close: bool = True) -> str:
        attr = f' {self.r.choice(("class", "class", "id"))}="{value}"' if value else ""
        return f'<{name}{attr} data-y="{y}">{inner}' + (f"</{name}>" if close else "")

    def links(self, n: int, y: int = 0) -> str:
        return "".join(self.tag("li", "", y, f'<a href="/x">{self.say(self.r.randint(1, 4))}</a>') for _ in range(n))

    def boilerplate(self, part: str) -> str:
        r = self.r
        elements, values = _PARTS[part]
        name, value = r.choice(elements), r.choice(values)
        if name == "div" and not value:
            value = values[1] if r.random() < 0.7 else ""
        if part in ("menu", "share") or part == "sidebar" and r.random() < 0.6:
            inner = self.links(r.randint(2, 12))
            inner = inner if name == "ul" else self.tag("ul", "", 0, inner)
        elif part == "comments":
            inner = "".join(self.tag(r.choice(("div", "article", "li", "p")), r.choice(("comment", "", "comment-body")), 0,
                                     self.tag("p", "", 0, self.say(r.randint(3, 60)))) for _ in range(r.randint(1, 8)))
        elif part == "form":
            inner = f"<label>{self.say(2)}</label><input>" + self.tag("p", "", 0, self.say(r.randint(2, 15)))
        else:
            inner = self.say(r.randint(2, 25))
            if part in ("footer", "header"):
                inner = "&copy; " + inner if part == "footer" else inner
            if name != "p" and r.random() < 0.4:
                inner = self.tag("p", "", 0, inner)
        return self.tag(name, value, 0, inner)

    def linked(self) -> str:
        """A sentence most of which is links."""
        return " ".join(f'<a href="/{i}">{self.say(self.r.randint(3, 12))}</a> {self.say(self.r.randint(0, 3))}'
                        for i in range(self.r.randint(1, 4)))

    def content(self) -> str:
        r, out = self.r, []
        if r.random() < (0.4 if self.style == "short" else 0.8):
            out.append(self.tag("h1", r.choice(("", "title")), 1, self.say(r.randint(2, 10))))
        for _ in range(r.choice((1, 1, 2) if self.style == "short" else (1, 1, 2, 4, 8, 20))):
            kind = r.random()
            if self.style == "short":
                out.append(self.tag("p", "", 1, self.say(r.randint(1, 4)), r.random() < 0.8))
            elif self.style == "linked" and kind < 0.7:
                out.append(self.tag("p", "", 1, self.linked()))
            elif self.style == "figures" and kind < 0.3:
                out.append(self.tag("figure", "", 1, "<img src=x>" + self.tag("figcaption", "", 1, self.say(r.randint(1, 8)))))
            elif kind < 0.75:
                out.append(self.tag("p", "", 1, self.say(r.choice((1, 2, 8, 30, 80, 150))), r.random() < 0.8))
            elif kind < 0.82:
                out.append(self.tag("p", "", 1, f"<b>{self.say(r.randint(3, 40))}<br>", False))
            elif kind < 0.88:
                out.append(self.tag(r.choice(("h2", "h3")), "", 1, self.say(r.randint(1, 8))))
            elif kind < 0.93:
                out.append(self.tag(r.choice(("ul", "ol")), "", 1, "".join(
                    self.tag("li", "", 1, self.say(r.randint(3, 25))) for _ in range(r.randint(2, 6)))))
            elif kind < 0.96:
                out.append(self.tag("blockquote", "", 1, self.tag("p", "", 1, self.say(r.randint(5, 60)))))
            else:
                out.append(self.tag("pre", "", 1, self.say(r.randint(5, 40))))
            if r.random() < 0.06:
                out.append(self.boilerplate(r.choice(("advert", "share", "notice"))))
        return "".join(out)

    def page(self) -> str:
        r = self.r
        if self.style == "bare":
            return self.content() if r.random() < 0.5 else self.tag("article", "", 1, self.content())
        name, value = r.choice((("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-body"),
                                ("div", "article"), ("div", "entry-content"), ("section", "story"), ("div", ""), ("div", "")))
        inner = self.content()
        if r.random() < 0.15:
            inner += self.boilerplate("comments")
        body = [self.boilerplate(p) for p in ("header", "menu", "notice", "advert") if r.random() < 0.5]
        body.append(self.tag(name, value, 1, inner))
        body += [self.boilerplate(p) for p in ("share", "sidebar", "advert", "form", "comments", "menu", "footer")
                 if r.random() < 0.45]
        if r.random() < 0.4:
            body = [self.tag("div", r.choice(("", "wrapper", "container", "page")), 2, "".join(body))]
        return "<html><head><title>x</title></head><body data-y='2'>" + "".join(body) + "</body></html>"


@lru_cache(maxsize=8)
def trained(pages: int = TRAINING_PAGES, styles: tuple[str, ...] = STYLES) -> Boosted:
    """The model, from ``pages`` generated pages; mixed elements count by the larger part of their text."""
    xs, ys, ws = [], [], []
    for seed in range(pages):
        page = Page(_Writer(seed, styles).page())
        x, own, total = features(page)
        good = np.array([float(m == "1") for m in page.marks]) * own
        for i in range(len(own) - 1, 0, -1):
            good[page.parent[i]] += good[i]
        some = total > 0
        xs.append(x[some])
        ys.append((good / np.maximum(total, 1))[some])
        ws.append(np.minimum(1.0, 0.3 + total[some] / 200))
    return Boosted(np.concatenate(xs), np.concatenate(ys), np.concatenate(ws))


def extract(pages: DataFrame, model: Boosted | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages`` (page_id, url, html).

    Null or empty html gives an empty text; broken markup is read as far as it
    goes; ids and urls pass as they are; equal pages give equal texts; an empty
    table an empty result. One narrow pass, no shuffle.
    """
    model = model or trained()

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        parsed = [Page(h) for h in batch.column("html").to_pylist()]
        made = [features(p) for p in parsed]
        probability = model.probability(np.concatenate([x for x, _, _ in made]))
        texts, at = [], 0
        for page, (x, own, total) in zip(parsed, made):
            texts.append(text_of(page, decode(page, probability[at:at + len(x)], own, total)))
            at += len(x)
        return pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                                pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    types = dict(rows.dtypes)
    return arrow_map(rows, step, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long", "html")


__all__ = ["Boosted", "Page", "decode", "extract", "features", "text_of", "trained", "NULL_ID"]
