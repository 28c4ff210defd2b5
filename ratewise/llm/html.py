"""Main text of web pages: gradient-boosted trees over DOM-node features.

A page is read into a tree of block elements (inline elements belong to the text
around them; unclosed paragraphs, list items and cells end where HTML ends them).
Every node is described by its tag, the words of its class, id and role and those
of its ancestors, the size, link share and density of its subtree, its depth, its
place, and how it compares with its siblings.  Boosted trees give the probability
that a node belongs to the article.  *Hierarchical decoding* then chooses keep or
drop for all nodes of a page at once: nothing below a dropped node is kept, and a
change from a kept parent to a dropped child costs ``CHANGE``, by dynamic
programming over the tree.

The pages carry no marked article, so the trees learn from pages put together
from the table's own words (``TRAIN_PAGES`` pages from at most ``SAMPLE_PAGES``
rows): an article, with menus, headers, footers, sidebars, notices, adverts,
forms and comments around and inside it, under changing tags and names.

A block's character references are decoded, its white space becomes single
spaces, blocks are joined by an empty line in page order.

Cases: null, empty and markup-only pages give the empty text; plain text without
tags is one block; very long pages are whole; unclosed or crossing tags end with
their parent; repeated ids are extracted row by row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain, read, small_batches, uniform

#: Bounds of the training sample: rows, characters read of each, words taken of its
#: longest block; and the pages composed of them.
SAMPLE_PAGES, SAMPLE_CHARS, SAMPLE_WORDS, TRAIN_PAGES = 300, 20_000, 4_000, 700
CHANGE = 1.5

# --- the tree of blocks --------------------------------------------------------------------

_INLINE = frozenset("""a abbr acronym audio b bdi bdo big canvas cite code data del dfn em font i img ins
kbd mark math nobr object q rp rt ruby s samp small span strike strong sub sup svg time tt u var video wbr
br""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SILENT = ("script", "style", "noscript", "template", "title", "iframe")
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
         "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = frozenset("ul ol dl table select body".split())
# Attributes: a quote counts only directly after "=", and only if it is closed.  Nothing
# here gives back what it has read, and what the page's end cuts off is read to the
# end, so a page is scanned once whatever it holds.
_ATTRIBUTES = r"(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+"
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
                  r"|<(" + "|".join(_SILENT) + r")(?=[\s/>]|\Z)" + _ATTRIBUTES + r"(?:>|\Z)"
                  r".*?(?:</\1\s*+>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*+)(" + _ATTRIBUTES + r")(?:>|\Z)", re.S | re.I)
_NAME = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_LETTERS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "names", "parent", "depth", "text", "link", "marks", "blocks", "kids", "at",
                 "gold", "place", "size", "links", "stops", "nodes", "paras", "heads")

    def __init__(self, tag: str, names: tuple[str, ...], parent: int, depth: int, at: int):
        self.tag, self.names, self.parent, self.depth, self.at = tag, names, parent, depth, at
        self.text = self.link = self.marks = 0
        self.blocks = 0
        self.kids: list[int] = []
        self.gold = -1
        self.place = 0  # among the parent's kids


@functools.lru_cache(4096)
def _names(attributes: str) -> tuple[str, ...]:
    return tuple(_LETTERS.findall(" ".join(_NAME.findall(attributes)).lower()))


def parse(html: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block nodes in page order (the first is the page), and the text blocks
    ``(node, text)``."""
    nodes = [Node("body", (), -1, 0, 0)]
    blocks: list[tuple[int, str]] = []
    stack = [0]
    pieces: list[str] = []
    anchor = 0  # depth of open links
    linked = 0
    silent = 0  # position in the stack of an open head

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                node = nodes[stack[-1]]
                node.text += len(text)
                node.link += min(linked, len(text))
                node.marks += text.count(". ") + text.count(", ") + text.endswith((".", "!", "?"))
                node.blocks += 1
                blocks.append((stack[-1], text))
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not silent:
            pieces.append(text)
            if anchor:
                linked += len(text)

    last = 0
    for m in _TAG.finditer(html):
        add(html[last:m.start()])
        last = m.end()
        tag = m[3]
        if tag is None:  # comment, declaration, or an element without text
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "br":
                add(" ")
            elif tag == "a":
                anchor = max(0, anchor - 1) if m[2] else 1
            continue
        if tag in ("html", "body"):
            if not m[2]:
                silent = 0
                nodes[0].names += _names(m[4])
            continue
        if tag == "head":
            silent = 0 if m[2] else 1
            continue
        if silent and tag not in _VOID:
            silent = 0  # an element of the body ends an unclosed head
        flush()
        anchor = 0
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in _VOID:
            if tag == "input":
                nodes[stack[-1]].marks -= 1
            continue
        if nodes[stack[-1]].tag == "p":
            stack.pop()
        if tag in _ENDS:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag in _ENDS[tag]:
                    del stack[k:]
                    break
                if nodes[stack[k]].tag in _LISTS:
                    break
        node = Node(tag, _names(m[4]) if m[4] else (), stack[-1], len(stack), m.start())
        if "data-gold" in m[4]:
            node.gold = int('data-gold="1"' in m[4])
        node.place = len(nodes[stack[-1]].kids)
        nodes[stack[-1]].kids.append(len(nodes))
        stack.append(len(nodes))
        nodes.append(node)
        if m[4].endswith("/"):
            stack.pop()
    add(html[last:])
    flush()
    return nodes, blocks


# --- features ---------------------------------------------------------------------------

# Word groups in class, id and role names.
_GROUPS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager tabs toc skip links".split(),
    "frame": "header masthead footer foot head topbar bottom colophon copyright logo branding top legal".split(),
    "side": "sidebar side aside widget rail related recommended trending popular more archive tags "
            "complementary secondary".split(),
    "notice": "cookie cookies notice banner consent gdpr alert popup modal overlay warning message "
              "announcement dialog".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
              "promoted dfp doubleclick adsense".split(),
    "form": "form search login signup subscribe subscription newsletter register contact input "
            "searchbox".split(),
    "comment": "comment comments reply replies respond discussion disqus thread review reviews "
               "commentlist feedback".split(),
    "share": "share sharing social follow tweet facebook twitter byline author bio meta".split(),
    "body": "article content post entry main story text body page blog news prose markdown "
            "read copy articlebody".split(),
}
_GROUP_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(_GROUPS.values()):
    for _w in _words:
        _GROUP_OF.setdefault(_w, []).append(_i)
_TAGS = {t: i for i, ts in enumerate((
    ("article", "main"), ("p", "blockquote", "pre"), ("h1",), ("h2", "h3", "h4", "h5", "h6"),
    ("div",), ("section",), ("ul", "ol", "dl"), ("li", "dt", "dd"), ("nav", "menu"), ("header",),
    ("footer",), ("aside",), ("form", "fieldset", "button", "select", "option", "textarea", "label"),
    ("table", "tbody", "thead", "tr", "td", "th"), ("figure", "figcaption"))) for t in ts}
N_TAGS, N_GROUPS = 16, len(_GROUPS)
N_FEATURES = N_TAGS * 2 + N_GROUPS * 2 + 19


@functools.lru_cache(4096)
def _groups(names: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(sorted({g for w in names for g in _GROUP_OF.get(w, ())}))


def features(nodes: list[Node]) -> np.ndarray:
    """One row a node; the page itself is row 0."""
    n = len(nodes)
    for node in reversed(nodes):
        node.size = node.text + sum(nodes[k].size for k in node.kids)
        node.links = node.link + sum(nodes[k].links for k in node.kids)
        node.stops = node.marks + sum(nodes[k].stops for k in node.kids)
        node.nodes = 1 + sum(nodes[k].nodes for k in node.kids)
        node.paras = (node.tag == "p") + sum(nodes[k].paras for k in node.kids)
        node.heads = (node.tag == "h1") + sum(nodes[k].heads for k in node.kids)
    x = np.zeros((n, N_FEATURES), np.float32)
    total = max(1, nodes[0].size)
    above = N_TAGS * 2 + N_GROUPS
    before = 0
    for i, node in enumerate(nodes):
        row = x[i]
        tag = _TAGS.get(node.tag, N_TAGS - 1)
        row[tag] = 1
        for g in _groups(node.names):
            row[N_TAGS * 2 + g] = 1
        if i:
            up = x[node.parent]
            row[N_TAGS:2 * N_TAGS] = up[N_TAGS:2 * N_TAGS]  # tags and names of all ancestors
            if node.parent:
                row[N_TAGS + _TAGS.get(nodes[node.parent].tag, N_TAGS - 1)] = 1
                row[above:above + N_GROUPS] = np.maximum(up[above:above + N_GROUPS],
                                                         up[N_TAGS * 2:N_TAGS * 2 + N_GROUPS])
        parent = nodes[node.parent] if i else node
        peers = parent.kids if i else [0]
        place = node.place
        size = node.size
        k = above + N_GROUPS
        row[k:] = (
            math.log1p(size), size / total, size / max(1, parent.size), node.links / max(1, size),
            parent.links / max(1, parent.size), math.log1p(size / node.nodes), node.stops / max(1.0, size / 50),
            math.log1p(max(0, node.stops)), min(node.depth, 12), math.log1p(node.nodes),
            min(node.paras, 20), node.heads, place / max(1, len(peers)), min(len(peers), 30),
            (peers[-1] - peers[0]) / max(1, n), before / total, i / n,
            max((nodes[p].size for p in (peers[max(0, place - 1):place] + peers[place + 1:place + 2])),
                default=0) / total if i else 0, node.text / max(1, size))
        before += node.text
    return x


# --- boosted trees ----------------------------------------------------------------------------

class Boosted:
    """Binary logistic boosting of complete trees over binned features."""

    def __init__(self, rounds: int = 60, depth: int = 4, step: float = 0.2, bins: int = 24):
        self.rounds, self.depth, self.step, self.bins = rounds, depth, step, bins

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Boosted":
        grid = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1]))
                for j in range(x.shape[1])]
        code = np.stack([np.searchsorted(g, x[:, j], "left") for j, g in enumerate(grid)], 1)
        mean = (weight * y).sum() / weight.sum()
        self.base = math.log(mean / (1 - mean))
        score = np.full(len(y), self.base)
        leaves = 1 << self.depth
        self.feature = np.zeros((self.rounds, leaves - 1), np.int32)
        self.cut = np.full((self.rounds, leaves - 1), np.inf, np.float32)
        self.leaf = np.zeros((self.rounds, leaves), np.float32)
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = (y - p) * weight, p * (1 - p) * weight
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                width = 1 << level
                best = np.full(width, 1e-6)
                pick = np.full((width, 2), -1)
                for j, edges in enumerate(grid):
                    key = at * (self.bins + 1) + code[:, j]
                    gs = np.bincount(key, g, width * (self.bins + 1)).reshape(width, -1).cumsum(1)
                    hs = np.bincount(key, h, width * (self.bins + 1)).reshape(width, -1).cumsum(1)
                    ga, ha = gs[:, -1:], hs[:, -1:]
                    gain = gs ** 2 / (hs + 1) + (ga - gs) ** 2 / (ha - hs + 1) - ga ** 2 / (ha + 1)
                    gain[:, len(edges):] = 0
                    b = gain.argmax(1)
                    top = gain[np.arange(width), b]
                    better = top > best
                    best[better] = top[better]
                    pick[better, 0], pick[better, 1] = j, b[better]
                right = np.zeros(len(y), bool)
                for k, (j, b) in enumerate(pick):
                    if j >= 0:
                        self.feature[t, width - 1 + k], self.cut[t, width - 1 + k] = j, grid[j][b]
                        own = at == k
                        right[own] = code[own, j] > b
                at = 2 * at + right
            gs, hs = np.bincount(at, g, leaves), np.bincount(at, h, leaves)
            self.leaf[t] = self.step * gs / (hs + 1)
            score += self.leaf[t][at]
        return self

    def logits(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base, np.float64), np.arange(len(x))
        for t in range(self.rounds):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[t][at]] > self.cut[t][at])
            out += self.leaf[t][at - len(self.feature[t])]
        return out


def decode(nodes: list[Node], logit: np.ndarray) -> list[bool]:
    """The best keep/drop choice of all nodes; the page itself is kept."""
    n = len(nodes)
    z = np.clip(logit, -8, 8)
    gain = np.log1p(np.exp(-np.abs(z)))  # log p and log (1 - p), by sign
    keep, drop = np.where(z > 0, -gain, z - gain), np.where(z > 0, -z - gain, -gain)
    best_keep, all_drop = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        best_keep[i] = float(keep[i]) if i else 0.0
        all_drop[i] = float(drop[i])
        for k in nodes[i].kids:
            best_keep[i] += max(best_keep[k], all_drop[k] - (CHANGE if i else 0))
            all_drop[i] += all_drop[k]
    out = [True] * n
    for i in range(1, n):
        up = nodes[i].parent
        out[i] = out[up] and best_keep[i] >= all_drop[i] - (CHANGE if up else 0)
    return out


# --- training pages ----------------------------------------------------------------------------

def _words_of(pages: list[str]) -> list[list[str]]:
    found = []
    for html in pages:
        _, blocks = parse(html)
        words = max((t for _, t in blocks), key=len, default="").split()
        if words:
            found.append(words[:SAMPLE_WORDS])
    return found or [["text", "words", "of", "a", "page."]]


def _compose(rng: random.Random, words: list[list[str]]) -> str:
    """One page with marked nodes (``data-gold``)."""
    def text(a: int, b: int) -> str:
        w = rng.choice(words)
        n = rng.randint(a, b)
        s = rng.randrange(max(1, len(w) - n))
        return " ".join(w[s:s + n])

    def attribute(*names: str) -> str:
        if rng.random() < 0.25:
            return ""
        name = rng.choice(names)
        if rng.random() < 0.3:
            name += rng.choice(("-1", "-wrap", " box", "-inner", "__x", " container"))
        return f' {rng.choice(("class", "class", "id"))}="{name}"'

    def element(tag: str, inside: str, names: str = "", gold: int | None = None) -> str:
        mark = "" if gold is None else f' data-gold="{gold}"'
        return f"<{tag}{names}{mark}>{inside}</{tag}>"

    def links(a: int, b: int) -> str:
        items = [f'<a href="/{i}">{text(1, 3)}</a>' for i in range(rng.randint(a, b))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.7 else " | ".join(items)

    def rubbish(kind: str) -> str:
        sure = {"menu": ("nav", links(3, 9), ("nav", "menu", "navbar", "breadcrumb")),
                "header": ("header", f"<h1>{text(1, 3)}</h1>" * (rng.random() < 0.3) + text(1, 6) + links(0, 3),
                           ("header", "masthead", "topbar")),
                "footer": ("footer", f"<p>&copy; {text(2, 25)}</p>" if rng.random() < 0.5 else "&copy; " + text(2, 25),
                           ("footer", "bottom", "copyright")),
                "side": ("aside", f"<h3>{text(1, 3)}</h3>" + (links(2, 8) if rng.random() < 0.6 else f"<p>{text(5, 40)}</p>"),
                         ("sidebar", "related", "widget", "recommended")),
                "notice": ("div", f"<p>{text(5, 30)}</p><button>{text(1, 2)}</button>" if rng.random() < 0.6 else text(5, 30),
                           ("cookie", "notice", "banner", "consent", "alert")),
                "advert": ("div", text(2, 40), ("ad", "ads", "advert", "sponsored", "promo")),
                "form": ("form", f"<label>{text(1, 3)}</label><input><button>{text(1, 2)}</button>" + text(0, 8),
                         ("search", "subscribe", "newsletter", "login")),
                "share": ("div", links(2, 5), ("share", "social")),
                "comments": ("section" if rng.random() < 0.5 else "div", f"<h3>{text(1, 2)}</h3>" + "".join(
                    f'<div{attribute("comment", "reply")}><p>{text(3, 60)}</p></div>' if rng.random() < 0.6
                    else f"<p>{text(3, 60)}</p>" for _ in range(rng.randint(1, 6))),
                    ("comments", "discussion", "respond", "replies"))}
        tag, inside, names = sure[kind]
        plain_tag = tag == "div" or (rng.random() < 0.3 and kind != "form")
        name = f' class="{rng.choice(names)}"' if plain_tag or tag == "section" else attribute(*names)
        return element("div" if plain_tag else tag, inside, name, 0)

    def article() -> str:
        parts = [f"<h1>{text(2, 12)}</h1>"] if rng.random() < 0.85 else []
        for _ in range(rng.choice((1, 1, 2, 3, 5, 9, 20))):
            kind = rng.random()
            if kind < 0.75:
                inline = rng.random()
                body = text(1, 6) if rng.random() < 0.2 else text(8, 120)
                body = f"<b>{body}" if inline < 0.1 else body + f' <a href="/x">{text(1, 3)}</a> ' + text(1, 20) \
                    if inline < 0.25 else body
                parts.append(f"<p>{body}" + ("</p>" if rng.random() < 0.8 else "<br>"))
            elif kind < 0.82:
                parts.append(f"<h2>{text(1, 6)}</h2>")
            elif kind < 0.88:
                parts.append("<ul>" + "".join(f"<li>{text(2, 25)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                parts.append(f"<blockquote>{text(5, 50)}</blockquote>")
            elif kind < 0.95:
                parts.append(f"<table><tr><td>{text(1, 5)}</td><td>{text(1, 5)}</td></tr></table>")
            else:
                parts.append(text(5, 60))
        if rng.random() < 0.15 and parts[0].startswith("<h1"):
            parts[0] = f"<header>{parts[0]}</header>"
        for kind in ("advert", "share", "side", "comments", "form", "notice"):
            if rng.random() < 0.12:
                at = rng.randint(1, len(parts)) if kind in ("advert", "side", "notice") else len(parts)
                parts.insert(at, rubbish(kind))
        tag, name = rng.choice((("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""),
                                ("div", ' class="content"'), ("div", ' id="article-body"'), ("section", ' class="story"'),
                                ("div", ' class="entry"'), ("div", "")))
        return element(tag, "".join(parts), name, 1)

    kinds = ["menu", "header", "notice", "advert", "form", "side", "share"]
    before = [rubbish(k) for k in kinds if rng.random() < {"menu": 0.85, "header": 0.4, "advert": 0.5}.get(k, 0.15)]
    after = [rubbish(k) for k in ("share", "comments", "side", "advert", "form", "notice", "menu")
             if rng.random() < 0.2]
    if rng.random() < 0.9:
        after.append(rubbish("footer"))
    inner = article()
    if rng.random() < 0.25:
        inner = element("div", inner + "".join(rubbish("side") for _ in range(rng.randint(0, 1))),
                        attribute("wrapper", "page", "container", "row"), 1)
    return "<html><body>" + "".join(before) + inner + "".join(after) + "</body></html>"


def train(pages: DataFrame, seed: int = 17) -> Boosted:
    """Trees from pages composed of the words of a bounded sample of rows."""
    usable = pages.where("html IS NOT NULL AND html <> ''").withColumn("u", uniform("page_id"))
    few = usable.where(F.col("u") * F.lit(float(usable.count())) <= 3 * SAMPLE_PAGES)
    rows = few.orderBy("u", "page_id").limit(SAMPLE_PAGES).select(
        F.substring("html", 1, SAMPLE_CHARS).alias("h")).collect()
    words = _words_of([r["h"] for r in rows])
    rng = random.Random(seed)
    xs, ys = [], []
    for _ in range(TRAIN_PAGES):
        nodes, _ = parse(_compose(rng, words))
        gold = [0] * len(nodes)
        for i, node in enumerate(nodes):
            gold[i] = node.gold if node.gold >= 0 else gold[node.parent] if i else 1
        xs.append(features(nodes)[1:])
        ys.append(np.array(gold[1:], float))
    x, y = np.concatenate(xs), np.concatenate(ys)
    return Boosted().fit(x, y, np.ones(len(y)))


# --- extraction ------------------------------------------------------------------------------

def extract(html: list[str | None], model: Boosted) -> list[str]:
    """Main texts of a batch of pages."""
    read_ = [parse(h or "") for h in html]
    x = [features(nodes) for nodes, _ in read_]
    logit = model.logits(np.concatenate(x)) if x else np.zeros(0)
    out, at = [], 0
    for nodes, blocks in read_:
        keep = decode(nodes, logit[at:at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(t for k, t in blocks if keep[k]))
    return out


def main_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    small_batches(pages.sparkSession, 500)
    rows = plain(pages, page_id="long", url="string", html="string")
    model = train(rows)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            text = extract(list(pdf["html"]), model)
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": text,
                                "n_chars": [len(t) for t in text]})
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(read(spark, sf_dir, "pages"))
