"""Main text of web pages: boosted trees over DOM nodes, then hierarchical decoding.

Every element gets features: tag and attribute words of itself and its
ancestors, text, link and punctuation density of its subtree, depth, place
among its siblings and their densities. Boosted regression trees give the
probability that an element leads to main text. Decoding then picks the most
likely consistent choice: below a rejected element everything is rejected.
Text that stands in no element (directly under ``body``, or in a page without
tags) is a leaf of its own, which trees and decoding judge like an element.

Training pages come from the table itself: up to ``SAMPLE`` pages (smallest
hashes) that mark their article as ``article`` or ``main``. So that the model
does not lean on one template, each is also used in ``VARIANTS`` rewritten
forms: regions change tag and attribute words, and boilerplate of other kinds,
with words of the page, is put around and into the article. Further forms have
the article without an element around it, or as plain text; from them trees of
their own learn to judge text without an element.

Null and empty pages, and pages without main text, give an empty text. The
trees add to a plain rule (no region by tag or attribute word, nothing that is
mostly links), which decides alone without a page to learn from, nearly alone
with a few, and wherever the trees leave nothing of a page.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopgrid.llm.common import text_blocks

SAMPLE, VARIANTS = 300, 3
TREES, DEPTH, BINS, RATE, RIDGE = 40, 4, 32, 0.2, 5.0
ENOUGH = 30          # pages from which on RIDGE alone holds the trees back

# Kinds of tags, and attribute words that name page regions.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
                   "time tt u var".split())
TAGS = ["article", "main", "section", "div", "p", "h", "list", "li", "a", "nav", "header", "footer", "aside", "form", "table", "inline", "quote", "other", "#text"]
KIND = {"h1": "h", "h2": "h", "h3": "h", "h4": "h", "h5": "h", "h6": "h", "ul": "list", "ol": "list", "dl": "list", "menu": "nav",
        "input": "form", "button": "form", "select": "form", "fieldset": "form", "dialog": "aside", "blockquote": "quote", "pre": "quote",
        "figure": "quote", "tr": "table", "td": "table", "th": "table", "tbody": "table", "dt": "li", "dd": "li"}
WORDS = {
    "main": "article content main post entry story body text prose",
    "menu": "nav menu navbar breadcrumb breadcrumbs navigation toolbar tabs",
    "frame": "header footer masthead topbar copyright legal colophon banner bottom top site",
    "side": "sidebar aside side rail widget related recommended more share social tags pagination",
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion outbrain",
    "notice": "cookie cookies consent notice alert popup modal gdpr overlay warning",
    "form": "form newsletter subscribe signup login search contact",
    "comment": "comment comments reply replies respond discussion disqus feedback",
}
GROUP = {w: g for g, ws in WORDS.items() for w in ws.split()}
GROUPS = list(WORDS)
GROUP_BIT = {g: 1 << i for i, g in enumerate(GROUPS)}
TAG_BIT = {t: 1 << i for i, t in enumerate(TAGS)}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
ATTRIBUTE = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# On the source itself: lower-casing can lengthen a text.
RAW_END = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW}
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)


class Page:
    """A flat tree: node 0 is the root; ``parent`` is always smaller. ``blocks``: (node, text) in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.groups, self.depth = ["html"], [-1], [frozenset()], [0]
        self.blocks: list[tuple[int, str]] = []
        self.link_chars: list[int] = []
        stack, text, links = [0], [], 0
        opened: dict[str, int] = {}   # tag -> how many are open; a look at the whole stack per tag would be quadratic

        def pop():
            opened[self.tag[stack.pop()]] -= 1

        def flush():
            nonlocal text, links
            if text:
                content = " ".join("".join(text).split())
                if content:
                    owner = next((k for k in reversed(stack) if self.tag[k] not in INLINE), 0)
                    if not owner:  # a leaf of its own, as the root is not chosen
                        owner = len(self.tag)
                        self.tag.append("#text")
                        self.parent.append(0)
                        self.groups.append(frozenset())
                        self.depth.append(1)
                    self.blocks.append((owner, content))
                    self.link_chars.append(min(links, len(content)))
                text, links = [], 0

        at, skip_to = 0, 0
        for m in TOKEN.finditer(source):
            if m.start() < skip_to:
                continue
            if m.start() > at:
                raw = html.unescape(source[at:m.start()])
                text.append(raw)
                if any(self.tag[k] == "a" for k in stack[-4:]):
                    links += len(raw.strip())
            at = m.end()
            if m.group(2) is None:
                continue
            tag = m.group(2).lower()
            if m.group(1):
                if tag not in INLINE:
                    flush()
                if opened.get(tag):
                    while self.tag[stack[-1]] != tag:
                        pop()
                    pop()
                continue
            if tag == "br" or tag == "hr":
                text.append(" ")
                continue
            if tag in ("html", "body", "head") or tag in VOID:
                continue
            if tag in RAW:
                if not m.group(3).endswith("/"):
                    close = RAW_END[tag].search(source, at)
                    end = source.find(">", close.start()) + 1 or len(source) if close else len(source)
                    at = skip_to = end
                continue
            if tag not in INLINE:
                flush()
                while opened.get("p") and self._closable(stack):
                    pop()
                closes = CLOSES.get(tag)
                if closes and any(map(opened.get, closes)):
                    for depth in range(len(stack) - 1, 0, -1):
                        if self.tag[stack[depth]] in closes:
                            while len(stack) > depth:
                                pop()
                            break
                        if self.tag[stack[depth]] in ("ul", "ol", "dl", "table"):
                            break
            words = " ".join(x for g in ATTRIBUTE.findall(m.group(3)) for x in g).lower() if m.group(3) else ""
            groups = frozenset(GROUP[w] for w in re.split(r"[^a-z]+", words) if w in GROUP)
            if m.group(3) and HIDDEN.search(m.group(3)):
                groups |= {"notice"}
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.groups.append(groups)
            self.depth.append(len(stack))
            if not m.group(3).endswith("/"):
                stack.append(len(self.tag) - 1)
                opened[tag] = opened.get(tag, 0) + 1
        if at < len(source):
            text.append(html.unescape(source[at:]))
        flush()

    def _closable(self, stack: list[int]) -> bool:
        """Whether the innermost open element is an unclosed paragraph or an inline element within it."""
        return self.tag[stack[-1]] == "p" or self.tag[stack[-1]] in INLINE

    def features(self) -> np.ndarray:
        n, parent = len(self.tag), self.parent
        kinds = [KIND.get(t, t if t in TAG_BIT else "inline" if t in INLINE else "other") for t in self.tag]
        # Sums over subtrees; plain lists, as single elements of arrays are slow.
        chars, links, stops, count = ([0.0] * n for _ in range(4))
        tags, heads = [1.0] * n, [float(k in ("p", "h")) for k in kinds]
        first = [1.0] * n
        total = sum(len(t) for _, t in self.blocks) or 1
        seen = 0
        for (node, text), link in zip(self.blocks, self.link_chars):
            chars[node] += len(text)
            links[node] += link
            stops[node] += text.count(".") + text.count(",")
            count[node] += 1
            first[node] = min(first[node], seen / total)
            seen += len(text)
        own_blocks = np.array(count)
        for i in range(n - 1, 0, -1):
            p = parent[i]
            for a in (chars, links, stops, count, tags, heads):
                a[p] += a[i]
            first[p] = min(first[p], first[i])
        children: dict[int, list[int]] = {}
        for i in range(1, n):
            children.setdefault(parent[i], []).append(i)
        density = [c / t for c, t in zip(chars, tags)]
        place, siblings, before, after = ([0.0] * n for _ in range(4))
        for own in children.values():
            for k, i in enumerate(own):
                place[i], siblings[i] = k / len(own), len(own)
                before[i] = density[own[k - 1]] if k else -1
                after[i] = density[own[k + 1]] if k + 1 < len(own) else -1
        # Region words and tags, of the element and above it, as bits.
        words, kind = [sum(GROUP_BIT[g] for g in s) for s in self.groups], [TAG_BIT[k] for k in kinds]
        words_above, kind_above = [0] * n, [0] * n
        for i in range(1, n):
            p = parent[i]
            words_above[i] = words_above[p] | words[p]
            kind_above[i] = kind_above[p] | kind[p]
        bits = [(np.array(mask)[:, None] >> np.arange(width) & 1).astype(float) for mask, width in
                ((words, len(GROUPS)), (words_above, len(GROUPS)), (kind, len(TAGS)), (kind_above, len(TAGS)))]
        chars, links, stops, count, tags, heads, density, before, after = map(np.array, (
            chars, links, stops, count, tags, heads, density, before, after))
        numbers = np.stack([np.log1p(chars), links / np.maximum(chars, 1), stops / np.maximum(chars, 1), np.log1p(count), np.log1p(tags),
                            np.log1p(heads), np.log1p(density), chars / total, np.array(self.depth, float), place, siblings,
                            np.log1p(before + 1), np.log1p(after + 1), first, own_blocks], 1)
        return np.concatenate([numbers, *bits], 1)

    def decode(self, p: np.ndarray) -> np.ndarray:
        """Most likely choice of nodes such that no kept node lies below a rejected one."""
        p = np.clip(p, 1e-4, 1 - 1e-4)
        keep, drop = np.log(p).tolist(), np.log(1 - p).tolist()
        for i in range(len(p) - 1, 0, -1):
            drop[self.parent[i]] += drop[i]
            keep[self.parent[i]] += max(keep[i], drop[i])
        out = [True] * len(p)
        for i in range(1, len(p)):
            out[i] = out[self.parent[i]] and keep[i] > drop[i]  # a tie drops
        return np.array(out)

    def text(self, chosen: np.ndarray) -> str:
        return " ".join(t for node, t in self.blocks if chosen[node])


class Trees:
    """Gradient-boosted regression trees on binned features, logistic loss.

    Boosting starts from the plain rule, and what a leaf may add is held back by
    ``RIDGE``, the more so the fewer pages the rows come from: rows of one page
    are no independent evidence. A handful of pages thus leaves the rule as it is.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, pages: int):
        self.ridge = RIDGE * max(1.0, ENOUGH / pages)
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = self._bins(x)
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = _plain_margin(x)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            feature, cut, value = self._grow(bins, y - p, p * (1 - p), self.ridge)
            self.trees.append((feature, cut, value))
            margin += value[self._leaf(bins, feature, cut)]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], 1).astype(np.int16)

    @staticmethod
    def _leaf(bins, feature, cut):
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(DEPTH):
            node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
        return node - (2 ** DEPTH - 1)

    @staticmethod
    def _grow(bins, g, h, ridge):
        inner = 2 ** DEPTH - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        node = np.zeros(len(bins), np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f in range(bins.shape[1]):
                key = (node - first) * BINS + bins[:, f]
                sums = np.stack([np.bincount(key, w, width * BINS).reshape(width, BINS) for w in (g, h)])
                left = np.cumsum(sums, 2)
                whole = left[:, :, -1:]
                right = whole - left
                gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - whole[0] ** 2 / (whole[1] + ridge)
                gain[(left[1] < ridge) | (right[1] < ridge)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best
                best[better] = top[better]
                feature[first:first + width][better], cut[first:first + width][better] = f, at[better]
            node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > cut[node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, 2 ** DEPTH), np.bincount(leaf, h, 2 ** DEPTH)
        return feature, cut, RATE * gs / (hs + ridge)

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        margin = _plain_margin(x)
        for feature, cut, value in self.trees:
            margin += value[self._leaf(bins, feature, cut)]
        return 1 / (1 + np.exp(-margin))


TEXT_FLAG = 15 + 2 * len(GROUPS) + TAGS.index("#text")


class Model:
    """Trees for elements, and trees for text without an element."""

    def __init__(self, elements: Trees | None, texts: Trees | None):
        self.elements, self.texts = elements, texts

    def predict(self, x: np.ndarray) -> np.ndarray:
        chance, loose = np.zeros(len(x)), x[:, TEXT_FLAG] > 0
        for rows, trees in ((~loose, self.elements), (loose, self.texts)):
            if rows.any():
                chance[rows] = trees.predict(x[rows]) if trees else _plain_chance(x[rows])
        return chance


MARK = "data-main"
BEGIN, END = "<!--hopmark-->", "<!--/hopmark-->"  # around an article without an element


def _region(rng, kind: str, words: list[str], inner: str | None = None) -> str:
    """A page region of a kind, with random tag and attribute words."""
    some = lambda n: " ".join(rng.choice(words, n))
    name = str(rng.choice(WORDS[kind].split()))
    tag = str(rng.choice({"menu": ["nav", "div", "ul"], "frame": ["header", "footer", "div"], "side": ["aside", "div"], "advert": ["div", "aside"],
                          "notice": ["div", "section"], "form": ["form", "div"], "comment": ["section", "div", "ol"]}[kind]))
    if inner is None:
        links = "".join(f'<li><a href="#">{some(rng.integers(1, 4))}</a></li>' for _ in range(rng.integers(3, 8)))
        inner = {"menu": f"<ul>{links}</ul>", "side": rng.choice([f"<h3>{some(2)}</h3><ul>{links}</ul>", f"<p>{some(rng.integers(8, 30))}.</p>"]),
                 "frame": rng.choice([f"<p>{some(rng.integers(4, 15))}</p>", f"<h2>{some(3)}</h2><a href='#'>{some(1)}</a>"]),
                 "advert": rng.choice([some(rng.integers(4, 20)), f"<p>{some(rng.integers(6, 40))}.</p>"]),
                 "notice": f"<p>{some(rng.integers(6, 25))}.</p><button>{some(1)}</button>",
                 "form": f"<label>{some(2)}</label><input name='x'><p>{some(rng.integers(3, 15))}</p><button>{some(1)}</button>",
                 "comment": "".join(f"<div class='{rng.choice(['comment', 'reply', 'item'])}'><b>{some(1)}</b><p>{some(rng.integers(5, 60))}.</p></div>"
                                    for _ in range(rng.integers(1, 5)))}[kind]
    named = rng.random() < 0.85 or tag in ("div", "section", "ul", "ol")
    return f"<{tag} class=\"{name}\">{inner}</{tag}>" if named else f"<{tag}>{inner}</{tag}>"


PARAGRAPH = re.compile(r"<p\b[^>]*>(.*?)</p\s*>", re.S | re.I)


def _other_block(rng, content: str) -> str:
    """A paragraph as it is, or as another block that articles have."""
    shape = rng.random()
    if shape < 0.6:
        return f"<p>{content}</p>"
    if shape < 0.7:
        return f"<blockquote>{content}</blockquote>"
    parts = re.split(r"(?<=[.,])\s+", content)
    if shape < 0.8:
        return f"<h2>{parts[0][:60]}</h2><p>{content}</p>"
    if shape < 0.9:
        parts = [part[:30] for part in parts]
    return "<ul>" + "".join(f"<li>{part}</li>" for part in parts) + "</ul>"


ARTICLE = re.compile(r"<(article|main)\b([^>]*)>(.*)</\1\s*>", re.S | re.I)


def training_pages(source: str, seed: int) -> list[str]:
    """The page with its article marked, and rewritten forms of it; nothing if it has no clear article."""
    m = ARTICLE.search(source)
    if not m:
        return []
    head, body, tail = source[:m.start()], m.group(3), source[m.end():]
    out = [f"{head}<{m.group(1)} {MARK}{m.group(2)}>{body}</{m.group(1)}>{tail}"]
    rng = np.random.default_rng(seed)
    words = re.sub(r"<[^>]*>", " ", source).split()[:400] or ["x"]
    for _ in range(VARIANTS):
        kinds = [k for k in GROUPS if k != "main"]
        put = lambda n: "".join(_region(rng, str(k), words) for k in rng.choice(kinds, n))
        tag = str(rng.choice(["article", "main", "div", "section"]))
        name = f" class=\"{rng.choice(WORDS['main'].split())}\"" if tag in ("div", "section") or rng.random() < 0.5 else ""
        inner = body
        if rng.random() < 0.5:
            inner = re.sub(r"<h1.*?</h1\s*>", "", inner, flags=re.S)
        if rng.random() < 0.5:
            inner = re.sub(r"</?b>|<br>", "", inner)
        if rng.random() < 0.5:  # an article of other length
            paragraphs = re.split(r"(?=<p\b)", inner)
            inner = "".join(p for p in paragraphs if rng.random() < 0.6) or inner
        if rng.random() < 0.6:  # quotes, lists and headings in it
            inner = PARAGRAPH.sub(lambda p: _other_block(rng, p[1]), inner)
        if rng.random() < 0.5:  # boilerplate within the article
            paragraphs = re.split(r"(?=<p\b)", inner)
            k = int(rng.integers(0, len(paragraphs) + 1))
            inner = "".join(paragraphs[:k]) + put(1) + "".join(paragraphs[k:])
        main = f"<{tag} {MARK}{name}>{inner}</{tag}>"
        if rng.random() < 0.5:
            main = f"<div class=\"{rng.choice(['wrap', 'page', 'container', 'row', 'col', 'layout'])}\">{put(int(rng.integers(0, 2)))}{main}{put(int(rng.integers(0, 3)))}</div>"
        if rng.random() < 0.5:
            head_, tail_ = head, tail
        else:
            head_, tail_ = "<html><body>", "</body></html>"
        out.append(f"{head_}{put(int(rng.integers(0, 3)))}{main}{put(int(rng.integers(0, 3)))}{tail_}")
    return out + _unwrapped(body, words, rng)


def _unwrapped(body: str, words: list[str], rng) -> list[str]:
    """Forms of an article without an element around it: among regions and loose boilerplate, as text with breaks, as plain text."""
    kinds = [k for k in GROUPS if k != "main"]
    put = lambda n: "".join(_region(rng, str(k), words) for k in rng.choice(kinds, n))
    some = lambda n: " ".join(rng.choice(words, n))

    def loose() -> str:
        if rng.random() < 0.5:
            return ""
        links = " | ".join(f'<a href="#">{some(rng.integers(1, 4))}</a>' for _ in range(rng.integers(2, 7)))
        return f"<hr>{links}<hr>" if rng.random() < 0.7 else f"{some(rng.integers(1, 4))} {links}"

    paragraphs = [t for b in re.split(r"</?(?:p|h[1-6]|div|section|ul|ol|li)\b[^>]*>", body) if (t := re.sub(r"<[^>]*>", " ", b).strip())]
    if not paragraphs:
        return []
    flat = "<br><br>".join(paragraphs)
    out = []
    for inner in (body, flat):
        regions = [put(int(rng.integers(0, 3))) for _ in range(2)]
        # Loose links stay apart from the article by a region, else they are one text with it.
        before = loose() + regions[0] if regions[0] else ""
        after = regions[1] + loose() if regions[1] else ""
        out.append(f"<html><body>{before}{BEGIN}{inner}{END}{after}</body></html>")
    plain = " ".join(paragraphs).split(" ")
    plain = " ".join(plain[:int(rng.integers(1, len(plain) + 1))] if rng.random() < 0.5 else plain[:int(rng.integers(1, 12))])
    out.append(f"{BEGIN}{plain}{END}")
    return out


REJECT = ("menu", "frame", "side", "advert", "notice", "form", "comment")
REJECTED_TAGS = frozenset("nav header footer aside form menu dialog button".split())


def training_rows(source: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Features and targets of a marked page: an element is wanted if it leads to text of the article that no region within takes away."""
    if BEGIN in source:
        page = Page(source)
        first, end = (len(Page(source[:source.index(mark)]).tag) for mark in (BEGIN, END))
        return _targets(page, first, end, lambda i: page.parent[i] < first)
    main = re.search(rf"<(\w+) {MARK}", source)
    page = Page(source.replace(f" {MARK}", f" {MARK} id=\"hopmark\"", 1)) if main else None
    if page is None:
        return None
    before = Page(source[:main.start()])
    mark = len(before.tag)  # the marked element is the next one
    if mark >= len(page.tag):
        return None
    return _targets(page, mark, len(page.tag), lambda i: False, mark)


def _targets(page: Page, first: int, end: int, top, mark: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Features and targets of nodes; those of the article are in [first, end), below ``mark`` or a node that ``top`` names."""
    wanted, inside = np.zeros(len(page.tag), bool), np.zeros(len(page.tag), bool)
    for i in range(first, end):
        rejected = page.tag[i] in REJECTED_TAGS or not page.groups[i].isdisjoint(REJECT)
        inside[i] = i == mark or (inside[page.parent[i]] or top(i)) and not rejected
    for node, _ in page.blocks:
        if inside[node]:
            while node >= 0 and not wanted[node]:
                wanted[node] = True
                node = page.parent[node]
    return page.features()[1:], wanted[1:].astype(float)


def learn(pages: DataFrame, html_: str = "html") -> Model | None:
    """Trees from at most SAMPLE pages."""
    clear = pages.where(F.lower(F.col(html_)).rlike("<(article|main)\\b"))
    hashed = clear.select(F.xxhash64(html_).alias("_h"), F.col(html_).alias("_html"))
    # Hashes first: tasks must not send SAMPLE whole pages each.
    least = [r._h for r in hashed.select("_h").orderBy("_h").limit(SAMPLE).collect()]
    rows = sorted(hashed.where(F.col("_h") <= least[-1]).dropDuplicates(["_h"]).collect()) if least else []
    return learn_from(rows)


def learn_from(rows: list[tuple[int, str]]) -> Model | None:
    """Trees from pages with a number each, which decides on their rewritten forms."""
    elements, texts, count = [], [], len({source for _, source in rows})
    for seed, page in rows:
        for source in training_pages(page, seed % 2**32):
            if (r := training_rows(source)) is not None:
                loose = r[0][:, TEXT_FLAG] > 0
                texts.append((r[0][loose], r[1][loose]))
                if BEGIN not in source:
                    elements.append((r[0][~loose], r[1][~loose]))
    trees = [Trees(np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]), count) if sum(len(y) for _, y in found) else None
             for found in (elements, texts)]
    return Model(*trees) if any(trees) else None


# Columns of the features: 15 numbers, region words of the element and above it, its tag, tags above it.
_REGIONS = [15 + GROUPS.index(g) + k * len(GROUPS) for g in REJECT for k in (0, 1)]
_REGION_TAGS = [15 + 2 * len(GROUPS) + TAGS.index(t) + k * len(TAGS) for t in ("nav", "header", "footer", "aside", "form") for k in (0, 1)]


def _plain_chance(x: np.ndarray) -> np.ndarray:
    """The rule without trees: nothing in a region by tag or attribute word, nothing that is mostly links."""
    region = x[:, _REGIONS + _REGION_TAGS].any(1)
    return np.where(region | (x[:, 1] > 0.5), 0.1, 0.9)


def _plain_margin(x: np.ndarray) -> np.ndarray:
    p = _plain_chance(x)
    return np.log(p / (1 - p))


def extract_texts(sources: list[str], model: Model | None) -> list[str]:
    """Main texts; where the trees leave nothing of a page, the plain rule decides."""
    pages = [Page(s) for s in sources]
    x = np.concatenate([p.features() for p in pages])
    chance, plain = model.predict(x) if model else _plain_chance(x), _plain_chance(x)
    out, at = [], 0
    for page in pages:
        n = len(page.tag)
        found = page.text(page.decode(chance[at:at + n]))
        out.append(found or page.text(page.decode(plain[at:at + n])))
        at += n
    return out


def main_texts(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    model = learn(pages, html_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sources, texts = batch.column(2).to_pylist(), []
            for low, high in text_blocks(sources, 1 << 19):
                texts += extract_texts(sources[low:high], model)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html_).cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
