"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded hierarchically.

A page becomes a tree of its block elements (inline markup belongs to the block around it; scripts, styles and the head hold no text). Every node has
features of its subtree (text, links, tags, density), of its tag and attribute tokens, its depth and its siblings. The trees give each node the
log-odds of being main text. Decoding chooses for every subtree "keep all", "drop all" or "look into the children" so that the
summed log-odds are largest: an ancestor can't be dropped around kept descendants or kept around dropped ones.

Training: no page is labelled, so the blocks of at most ``SAMPLE`` pages (those with the smallest hash) give the text for pages laid out by a seeded
generator with known parts: articles in many kinds of containers, menus, headers, footers, sidebars, notices, adverts, forms and
reader comments. The attribute tokens' log-odds are estimated on one half of them, the trees on the other. Nothing of this grows with the table.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page order. Rows: one
per input row; a null or empty page gives an empty text. Broken markup is read as far as it goes: a head
without end tag ends where the body begins, another silent element at the end of the block around it at the latest; elements deeper than ``MOST_DEPTH`` become siblings. Reading takes time in
proportion to the page. Columns besides page_id, url and html are ignored.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.storage import bounded_sample
from lakeops.llm.text import slices

SAMPLE = 200
BLOCKS = 10_000
BLOCK_CHARS = 5_000
LAID_OUT = 600
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
SWITCH = 0.5

#: Elements without main text, and elements that belong to the block around them (fixed values of HTML).
SILENT = {"script", "style", "head", "title", "noscript", "template", "svg", "iframe", "object", "canvas", "select", "textarea", "audio", "video", "annotation", "annotation-xml"}
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
#: Formulas stand inside their sentence; their annotations repeat them.
MATH = set("math maction menclose merror mfenced mfrac mglyph mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark meter nobr output q ruby rt rp s samp small span strike strong sub sup time tt u var wbr link meta".split()) | MATH
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag closes an open one of these on the way up to the stop tags.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
PARAGRAPH_ENDS = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())

_name = re.compile(r"[a-zA-Z][^\s/>]*")
_stop = re.compile(r"[>=]")
_space = re.compile(r"\s*")
#: Elements below this depth stand beside each other; their end tags close them and nothing else.
MOST_DEPTH = 512
_attribute = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_part = re.compile(r"[a-zA-Z][a-z]*")
_raw_end = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe")}


def _tag_end(html: str, at: int) -> int:
    """The place of the ``>`` that ends a tag, or -1. Only after ``=`` a quote hides it; one that never closes hides nothing."""
    while m := _stop.search(html, at):
        if m[0] == ">":
            return m.start()
        at = _space.match(html, m.end()).end()
        if html[at : at + 1] in ('"', "'"):
            close = html.find(html[at], at + 1)
            at = (at if close < 0 else close) + 1
    return -1


def _markup(html: str):
    """(start, end, name or empty, whether it closes, attributes) of every piece of markup, in one pass over the page. The consumer may send a
    place further on to go on from. What never ends, except a comment, is text."""
    at = 0
    while (start := html.find("<", at)) >= 0:
        at = start + 1
        follows = html[at : at + 1]
        if follows in ("!", "?"):
            mark = next((end for head, end in (("!--", "-->"), ("![CDATA[", "]]>")) if html.startswith(head, at)), ">")
            end = html.find(mark, at)
            at = len(html) if end < 0 else end + len(mark)
            yield start, at, "", False, ""
            continue
        closing = follows == "/"
        if not (name := _name.match(html, at + closing)):
            continue
        end = _tag_end(html, name.end())
        if end < 0:
            return
        at = max(end + 1, (yield start, end + 1, name[0].lower(), closing, html[name.end() : end]) or 0)


class Page:
    """Block elements in page order: parent, tag, attribute tokens, depth, and the blocks of text (node, text, characters in links)."""

    def __init__(self, html: str | None):
        self.parent, self.tag, self.tokens, self.depth, self.blocks, self.inline = [-1], ["#root"], [[]], [0], [], [0]
        html = html or ""
        stack, links, parts, linked = [0], 0, [], 0
        opened: list[str] = []  # a silent element and what is open inside it, with counts by name
        silent: Counter = Counter()

        def flush():
            nonlocal parts, linked
            if parts:
                text = " ".join(references.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((stack[-1], text, min(linked, len(text))))
                parts, linked = [], 0

        at, n, ahead = 0, len(html), 0
        pieces, endless = _markup(html), set()
        names: Counter = Counter()  # of open elements
        beyond: Counter = Counter()  # of open elements below ``MOST_DEPTH``

        def closes(tag: str, at: int):
            """The end tag of an element whose content is no markup; once there is none, there is none later."""
            if tag in endless or not (found := _raw_end[tag].search(html, at)):
                endless.add(tag)
                return None
            return found

        def silence(tag: str):
            opened.append(tag)
            silent[tag] += 1

        def speak(until: str | None = None):
            """Ends the silent elements, or the innermost ones up to a name."""
            while opened:
                last = opened.pop()
                silent[last] -= 1
                if last == until:
                    break

        def cut(i: int):
            for j in stack[i:]:
                names[self.tag[j]] -= 1
            del stack[i:]
            beyond.clear()

        while at < n:
            try:
                piece = pieces.send(ahead or None)
            except StopIteration:
                piece = None
            ahead = 0
            end = piece[0] if piece else n
            if opened == ["head"] and html[at:end].strip():
                speak()
            if end > at and not opened:
                text = html[at:end]
                parts.append(text)
                if links:
                    linked += len(text)
            if not piece:
                break
            _, at, tag, ends, attributes = piece
            if not tag:
                continue
            # head ends without its end tag where something comes that can't stand in it, another silent element with the block around it
            if opened and not ends and opened[0] == "head" and (tag == "body" or len(opened) == 1 and tag not in IN_HEAD):
                speak()
            elif opened and ends and not silent[tag] and names[tag] > 0:
                speak()
            if opened:
                if ends:
                    if silent[tag] > 0:
                        speak(tag)
                elif tag in _raw_end and (closing := closes(tag, at)):
                    at = ahead = closing.end()
                elif tag in SILENT or tag not in INLINE and tag not in VOID:
                    if not attributes.endswith("/"):
                        silence(tag)
                continue
            if ends:
                if tag == "a":
                    links = max(0, links - 1)
                elif tag not in INLINE:
                    flush()
                    if beyond[tag] > 0:
                        beyond[tag] -= 1
                    elif names[tag] > 0:
                        cut(next(i for i in range(len(stack) - 1, 0, -1) if self.tag[stack[i]] == tag))
                        links = 0
                continue
            if tag in _raw_end:
                closing = closes(tag, at)
                at = ahead = closing.end() if closing else n
                continue
            if tag in SILENT:
                if not attributes.endswith("/"):
                    silence(tag)
                continue
            if tag in INLINE:
                if tag == "br":
                    parts.append(" ")
                elif tag == "a":
                    links += 1
                self.inline[stack[-1]] += 1
                continue
            flush()
            if tag == "html":
                cut(1)
            kinds, stops = CLOSES.get(tag, (None, ()))
            if tag in PARAGRAPH_ENDS and self.tag[stack[-1]] == "p":
                cut(len(stack) - 1)
            elif kinds and any(names[k] > 0 for k in kinds):
                for i in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[i]]
                    if name in stops:
                        break
                    if name in kinds:
                        cut(i)
                        break
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.tokens.append([t.lower() for a in _attribute.finditer(attributes) for t in _part.findall(a[2] or a[3] or a[4] or "")])
            self.depth.append(self.depth[stack[-1]] + 1)
            self.inline.append(0)
            if tag in VOID:
                continue
            if len(stack) < MOST_DEPTH:
                stack.append(len(self.parent) - 1)
                names[tag] += 1
            else:
                beyond[tag] += 1
        flush()

    def features(self, odds: dict[str, float]) -> np.ndarray:
        n = len(self.parent)
        parent = np.array(self.parent)
        own, links, blocks, stops = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        for node, text, linked in self.blocks:
            own[node] += len(text)
            links[node] += linked
            blocks[node] += 1
            stops[node] += text.count(".") + text.count(",")
        tags = 1.0 + np.array(self.inline)
        text, linked, count, inner, stop = own.copy(), links.copy(), blocks.copy(), tags.copy(), stops.copy()
        for i in range(n - 1, 0, -1):
            p = parent[i]
            text[p] += text[i]
            linked[p] += linked[i]
            count[p] += count[i]
            inner[p] += inner[i]
            stop[p] += stop[i]
        siblings, place = np.zeros(n), np.zeros(n)
        same: dict[tuple[int, str], int] = defaultdict(int)
        for i in range(1, n):
            place[i] = siblings[parent[i]]
            siblings[parent[i]] += 1
            same[parent[i], self.tag[i]] += 1
        up = np.maximum(parent, 0)
        around = siblings[up]
        alike = np.array([same[p, t] for p, t in zip(self.parent, self.tag, strict=True)], float)
        low, high, ancestors = np.zeros(n), np.zeros(n), np.zeros(n)
        for i in range(n):
            scores = [odds.get(t, 0.0) for t in ("<" + self.tag[i], *self.tokens[i])]
            low[i], high[i] = min(scores), max(scores)
            ancestors[i] = min(low[i], ancestors[parent[i]]) if i else 0.0
        best = high.copy()
        for i in range(1, n):
            best[i] = max(best[i], best[parent[i]])
        return np.column_stack([
            np.log1p(text), np.log1p(own), linked / np.maximum(text, 1), np.log1p(text / inner), np.log1p(text / np.maximum(count, 1)), stop / np.maximum(text, 1),
            np.log1p(inner), np.array(self.depth), place / np.maximum(around - 1, 1), np.log1p(around), alike / np.maximum(around, 1), text / np.maximum(text[up], 1), text / max(text[0], 1),
            low, high, ancestors, best, np.log1p(np.cumsum(own) - own), linked[up] / np.maximum(text[up], 1),
        ])

    def decode(self, odds: np.ndarray) -> str:
        """The blocks of the best consistent choice. Text of its own makes a node one more child of itself."""
        n = len(self.parent)
        keep, drop, look = np.zeros(n), np.zeros(n), np.zeros(n)
        own = {node for node, _, _ in self.blocks}
        for i in range(n - 1, -1, -1):
            s = float(odds[i])
            has = i in own
            k, d = keep[i] + s, drop[i] - s
            mixed = look[i] - SWITCH + (abs(s) if has else 0.0)
            best = max(k, d, mixed)
            keep[i], drop[i], look[i] = k, d, mixed
            if i:
                p = self.parent[i]
                keep[p] += k
                drop[p] += d
                look[p] += best
        state = [""] * n
        for i in range(n):
            above = state[self.parent[i]] if i else "look"
            state[i] = above if above != "look" else ("keep" if keep[i] >= drop[i] and keep[i] >= look[i] else "drop" if drop[i] >= look[i] else "look")
        return " ".join(text for node, text, _ in self.blocks if state[node] == "keep" or state[node] == "look" and odds[node] > 0)


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Trees of DEPTH levels as (feature, threshold, leaf values), fitted to logistic gradients with Newton steps on binned features."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    total, made = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        inner = (1 << DEPTH) - 1
        feature, threshold, at = np.zeros(inner, int), np.full(inner, np.inf), np.zeros(len(y), int)
        for node in range(inner):
            here = np.flatnonzero(at == node)
            best = (1e-6, 0, -1)
            for f, e in enumerate(edges):
                if len(e) and len(here) > 8:
                    gs = np.cumsum(np.bincount(binned[here, f], weights=g[here], minlength=len(e) + 1))
                    hs = np.cumsum(np.bincount(binned[here, f], weights=h[here], minlength=len(e) + 1))
                    gain = gs[:-1] ** 2 / (hs[:-1] + 1) + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                    k = int(gain.argmax())
                    best = max(best, (float(gain[k]), f, k))
            if best[2] >= 0:
                feature[node], threshold[node] = best[1], edges[best[1]][best[2]]
            at[here] = 2 * node + 1 + (x[here, feature[node]] > threshold[node])
        leaf = at - inner
        value = RATE * np.bincount(leaf, weights=g, minlength=inner + 1) / (np.bincount(leaf, weights=h, minlength=inner + 1) + 1)
        total += value[leaf]
        made.append((feature, threshold, value))
    return made


def log_odds(x: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, threshold, value in trees:
        at = np.zeros(len(x), int)
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
        total += value[at - len(feature)]
    return total


#: Names that the generator gives to parts of pages (fixed values).
ARTICLE = ['<article>', '<main>', '<div class="content">', '<div id="main-content">', '<div class="post-body">', '<section class="article-text">', '<div itemprop="articleBody">', '<div class="entry">', '<div role="main">', '<div class="story">', '<article class="post">', '<div id="c1">', '<div>']
MENU = ['<nav>', '<div class="menu">', '<ul class="navigation">', '<div id="navbar">', '<div class="breadcrumbs">', '<div role="navigation">', '<div>']
HEADER = ['<header>', '<div class="header">', '<div id="top">', '<div class="site-title">', '<div class="masthead">', '<div role="banner">']
FOOTER = ['<footer>', '<div class="footer">', '<div id="bottom">', '<div class="copyright">', '<div class="legal">', '<div role="contentinfo">']
SIDEBAR = ['<aside>', '<div class="sidebar">', '<div id="side">', '<div class="related">', '<div class="widget">', '<section class="recommended">', '<div role="complementary">', '<div class="tags">', '<div class="share">', '<div class="author-bio">']
NOTICE = ['<div class="notice">', '<div class="cookie-banner">', '<div id="consent">', '<div class="popup">', '<div class="newsletter">', '<div class="subscribe">', '<div class="alert" role="alert">', '<dialog>', '<div class="modal">']
ADVERT = ['<div class="ad">', '<div class="advert">', '<div class="sponsored">', '<div id="banner">', '<aside class="promo">', '<div class="ads">', '<div class="advertisement">']
COMMENTS = ['<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<div class="discussion">', '<ol class="replies">', '<div class="responses">']


def lay_out(r: np.random.Generator, texts: list[str]) -> tuple[str, set[str]]:
    """A page, with a mark before every piece of text, and the marks of the main text."""
    marks, main = 0, set()

    def say(kept: bool, most: int) -> str:
        nonlocal marks
        text = texts[r.integers(len(texts))]
        words = text.split()
        n = max(1, int(r.integers(1, most + 1)))
        at = int(r.integers(max(1, len(words) - n + 1)))
        marks += 1
        name = f"☃{marks}☃"
        if kept:
            main.add(name)
        return f"{name} " + references.escape(" ".join(words[at : at + n]))

    def close(opening: str) -> str:
        return f"</{re.match('<(\\w+)', opening)[1]}>"

    def box(names: list[str], inside: str) -> str:
        opening = names[r.integers(len(names))]
        return opening + inside + close(opening)

    def links(n: int) -> str:
        items = [f'<li><a href="/x">{say(False, 3)}</a></li>' for _ in range(n)]
        return "<ul>" + "".join(items) + "</ul>" if r.random() < 0.7 else "".join(i[4:-5] + " | " for i in items)

    def paragraphs(kept: bool, n: int, most: int) -> str:
        out = []
        for _ in range(n):
            kind = r.random()
            words = int(r.choice([3, 12, most, most]))
            if kind < 0.08:
                out.append("<ul>" + "".join(f"<li>{say(kept, 12)}</li>" for _ in range(r.integers(2, 5))) + "</ul>")
            elif kind < 0.13:
                out.append(f"<blockquote>{say(kept, words)}</blockquote>")
            elif kind < 0.18:
                out.append(f"<h2>{say(kept, 6)}</h2>")
            elif kind < 0.22:
                out.append(f"<p><b>{say(kept, words)}<br>")
            elif kind < 0.3:
                out.append(f'<p>{say(kept, words)} <a href="/y">{say(kept, 3)}</a> {say(kept, words)}</p>')
            elif kind < 0.33:
                out.append(f"<div>{say(kept, words)}</div>")
            else:
                out.append(f"<p>{say(kept, words)}</p>")
        return "".join(out)

    def noise() -> str:
        kind = r.integers(6)
        if kind == 0:
            return box(ADVERT, say(False, 12) if r.random() < 0.6 else paragraphs(False, 1, 15))
        if kind == 1:
            return box(NOTICE, paragraphs(False, int(r.integers(1, 3)), 15) + (f"<button>{say(False, 2)}</button>" if r.random() < 0.5 else ""))
        if kind == 2:
            return box(SIDEBAR, f"<h3>{say(False, 3)}</h3>" + (links(int(r.integers(2, 8))) if r.random() < 0.6 else paragraphs(False, 2, 20)))
        if kind == 3:
            return f'<form action="/s"><label>{say(False, 3)}</label><input name="q"><button>{say(False, 1)}</button>' + (f"<p>{say(False, 10)}</p>" if r.random() < 0.5 else "") + "</form>"
        if kind == 4:
            each = "".join(f'<div class="comment"><span class="user">{say(False, 1)}</span><p>{say(False, 25)}</p></div>' if r.random() < 0.7 else f"<p>{say(False, 25)}</p>" for _ in range(r.integers(1, 5)))
            return box(COMMENTS, f"<h3>{say(False, 2)}</h3>" + each)
        return links(int(r.integers(2, 9)))

    def some(p: float) -> str:
        return noise() if r.random() < p else ""

    title = f"<h1>{say(True, 9)}</h1>" if r.random() < 0.8 else ""
    n = int(r.integers(1, 12))
    cut = int(r.integers(n + 1))
    body = paragraphs(True, cut, 70) + some(0.25) + paragraphs(True, n - cut, 70) + some(0.2)
    if r.random() < 0.15:
        body = f"<header>{title}</header>" + body
    else:
        body = title + body
    article = box(ARTICLE, body)
    if r.random() < 0.4:
        article = '<div class="' + str(r.choice(["wrapper", "container", "page", "row", "col", "x"])) + '">' + some(0.4) + article + some(0.5) + "</div>"
    page = box(MENU, links(int(r.integers(2, 9)))) if r.random() < 0.8 else ""
    page = box(HEADER, f"<p>{say(False, 5)}</p>" + page) if r.random() < 0.4 else page
    page += some(0.5) + some(0.3) + article + some(0.5) + some(0.4)
    page += box(FOOTER, say(False, 12) if r.random() < 0.6 else f"<p>{say(False, 8)}</p>" + links(3)) if r.random() < 0.85 else ""
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{page}</body></html>", main


_mark = re.compile("☃\\d+☃ ?")


def _labelled(html: str, main: set[str]) -> tuple[Page, np.ndarray, np.ndarray]:
    """The page without marks; each node's share of main text and whether it has text."""
    page = Page(html)
    n = len(page.parent)
    good, every, blocks = np.zeros(n), np.zeros(n), []
    for node, text, linked in page.blocks:
        kept = any(m.strip() in main for m in _mark.findall(text))
        plain = " ".join(_mark.sub("", text).split())
        if plain:
            blocks.append((node, plain, min(linked, len(plain))))
            good[node] += kept * (1 + len(plain))
            every[node] += 1 + len(plain)
    page.blocks = blocks
    for i in range(n - 1, 0, -1):
        good[page.parent[i]] += good[i]
        every[page.parent[i]] += every[i]
    return page, good / np.maximum(every, 1), every > 0


def train(texts: list[str], laid_out: int = LAID_OUT):
    """The attribute tokens' log-odds and the trees."""
    r = np.random.default_rng(17)
    texts = [t for t in texts if len(t.split()) > 3] or ["one two three four five, six seven eight. nine ten"]
    pages = [_labelled(*lay_out(r, texts)) for _ in range(laid_out)]
    uses: dict[str, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for page, share, has in pages[::2]:
        for i in np.flatnonzero(has).tolist():
            for t in {"<" + page.tag[i], *page.tokens[i]}:
                uses[t][int(share[i] > 0.5)] += 1
    odds = {t: float(np.log(b / a)) for t, (a, b) in uses.items() if a + b > 5}
    rows, target = [], []
    for page, share, has in pages[1::2]:
        clear = has & ((share > 0.9) | (share < 0.1))
        rows.append(page.features(odds)[clear])
        target.append(share[clear] > 0.5)
    return odds, boost(np.concatenate(rows), np.concatenate(target).astype(float))


def main_text(html: str | None, model) -> str:
    odds, trees = model
    page = Page(html)
    return page.decode(log_odds(page.features(odds), trees)) if page.blocks else ""


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "html"):
            yield pa.RecordBatch.from_arrays([pa.array([text for h in part.column(0).to_pylist() for _, text, _ in Page(h).blocks], pa.string())], ["text"])


def extract_main_text(pages: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every row. The blocks of the sampled pages are cut out in the tasks; ``BLOCKS`` of them at most, of ``BLOCK_CHARS`` characters at most, come to the driver."""
    pages = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    chosen = bounded_sample(pages.where("html is not null").select("html", F.xxhash64("page_id", "html").alias("order")), "order", sample)
    blocks = chosen.select("html").mapInArrow(_blocks_of, "text string").where(F.length("text") <= BLOCK_CHARS).orderBy(F.xxhash64("text"), "text").limit(BLOCKS)
    model = pages.sparkSession.sparkContext.broadcast(train([r["text"] for r in blocks.collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, trees = model.value
        for batch in batches:
            for part in slices(batch, "html"):
                made = [Page(h) for h in part.column(2).to_pylist()]
                features = [p.features(odds) for p in made]
                scores = log_odds(np.concatenate(features), trees)
                ends = np.cumsum([len(f) for f in features])
                texts = [p.decode(s) for p, s in zip(made, np.split(scores, ends[:-1]), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")
