"""HTML extraction by a recurrent block labeller.

1. A page becomes its leaf blocks: the text between two block borders, with the path of
   open block elements (tags, classes and ids), its words and the share of linked text.
   Scripts, styles, comments and the like never make blocks.
2. Each block is a vector: the path's elements hashed, the words hashed, and lengths.
3. A bidirectional LSTM in numpy reads the page's blocks in order, so each block is
   judged by the whole page; a logistic unit labels it as main text or not.
4. The main text is the labelled blocks in page order.

The network is trained on the driver, from a fixed seed, with synthetic pages of many
layouts (``training_pages``) whose blocks are known. Work on rows is one narrow pass;
pages of similar length share a batch. A page with a block so near the limit that the
shape of a batch could decide it is labelled once more by itself, so a page's text never
depends on its neighbours.

Markup is read in one forward walk: where no ``>`` or end of a quotation is left, that is
remembered, so broken pages take no longer than sound ones. The names of the open elements
are counted by bucket as elements open and close, so a block costs the same at any depth. A
page of very many blocks is labelled slice by slice, its states carried on.

Defined results: a null html counts as empty; a page without main blocks has an empty
text; white space is what ``str.split`` splits at; line breaks inside a block are white
space; an unclosed comment or element of raw text (``script``, ``style``, ``textarea``,
``title``, ``iframe``) reaches to the end of the page, and of any other unclosed element
only the tag is skipped; repeated rows give repeated results and an empty table an empty
one; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import functools
import html as html_module
import pickle
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, ship, table, text_or_empty
from .tokens import _Memo

# Elements that end a block, that have no end tag, and whose content is no text
# (raw text, which only its own end tag ends, and SKIPPED, which can nest).
BLOCKS = frozenset("address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
START = re.compile(r"<(?:(!--)|[!?]|(/?)([a-z][^\s/>]*+)|/)", re.I)
FOREIGN = re.compile(r"<(?:(!--)|(/?)(svg)(?=[\s/>]))", re.I)  # groups as in START; no raw text inside svg
TAG_REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
REPEATED = frozenset("p li option dd dt tr td th".split())  # a second one ends the first
SKIPPED = frozenset("noscript template svg object canvas".split())
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PATH, WORDS, NUMBERS, HIDDEN = 256, 64, 6, 20
#: Far more than the shape of a batch changes in a probability.
NEAR_LIMIT = 1e-3


class Open(NamedTuple):
    """An open block element; those around it are shared by all blocks below."""

    tag: str
    names: tuple[str, ...]
    around: Open | None


@dataclass(slots=True)
class Block:
    text: str
    element: Open | None
    marks: bytes  # 1 at the buckets of the path's names
    depth: int  # how many names the path has
    linked: float

    @property
    def path(self) -> tuple[str, ...]:
        parts, at = [], self.element
        while at:
            parts.append(at.names)
            at = at.around
        return tuple(x for names in reversed(parts) for x in names)


class Stack:
    """The open block elements with a count of their names by bucket, so that a block costs
    one row of marks however deep it lies."""

    def __init__(self) -> None:
        self.opened: list[Open] = []
        self.tags: Counter[str] = Counter()
        self.counts, self.marks, self.depth = [0] * PATH, bytearray(PATH), 0
        self.rows: dict[bytes, bytes] = {}

    def push(self, tag: str, names: tuple[str, ...]) -> None:
        self.opened.append(Open(tag, names, self.opened[-1] if self.opened else None))
        self.tags[tag] += 1
        self.depth += len(names)
        for b in map(path_bucket, names):
            self.counts[b] += 1
            self.marks[b] = 1

    def pop(self) -> None:
        tag, names, _ = self.opened.pop()
        self.tags[tag] -= 1
        self.depth -= len(names)
        for b in map(path_bucket, names):
            self.counts[b] -= 1
            self.marks[b] = self.counts[b] > 0

    def leave(self, tag: str) -> None:
        """Close the innermost element ``tag`` and all inside it; none if it isn't open."""
        while self.tags[tag] and self.opened[-1].tag != tag:
            self.pop()
        if self.tags[tag]:
            self.pop()

    def block(self, text: str, linked: float) -> Block:
        row = bytes(self.marks)
        return Block(text, self.opened[-1] if self.opened else None, self.rows.setdefault(row, row), self.depth, linked)


def bucket(text: str, size: int) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) % size


@functools.lru_cache(50_000)
def path_bucket(name: str) -> int:
    return bucket(name, PATH)


def elements(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag and the words of its class, id and role."""
    if "=" not in attributes:
        return (tag,)
    names = [x for m in NAMES.findall(attributes) for x in re.split(r"[\s_-]+", "".join(m).lower()) if x]
    return (tag, *[f".{x}" for x in names])


Markup = tuple[int, int, str, bool, str]  # start, end, name (none for what is no tag), is it an end tag, attributes


class Walk:
    """The markup of a page, in order, in time linear in its length.

    A tag ends at the first ``>`` outside quotations, if there is one, else at the first
    of all. ``TAG_REST`` finds it; once it has failed, quotations are followed through the
    sorted places of quotes and ``>``, and places outside quotations from which no ``>``
    can be reached are remembered."""

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.marks: dict[str, list[int]] | None = None
        self.dead: set[int] = set()

    def _tag_end(self, at: int) -> int:
        """Where the ``>`` is that ends a tag whose attributes begin at ``at``."""
        if self.marks is None:
            if m := TAG_REST.match(self.page, at):
                return m.end() - 1
            self.marks = {c: [m.start() for m in re.finditer(c, self.page)] for c in (">", '"', "'", "[>\"']")}
        path, p = [], at
        while p not in self.dead:
            path.append(p)
            every = self.marks["[>\"']"]
            k = bisect_left(every, p)
            if k == len(every):
                break
            c = self.page[every[k]]
            if c == ">":
                return every[k]
            own = self.marks[c]
            j = bisect_right(own, every[k])
            if j == len(own):
                break
            p = own[j] + 1
        self.dead.update(path)
        return self.page.index(">", at)

    def next(self, at: int, foreign: bool = False) -> Markup | None:
        """The first markup from ``at`` on; in foreign content (``svg``) its own tags and comments only."""
        page, pattern = self.page, FOREIGN if foreign else START
        while m := pattern.search(page, at):
            at = m.start()
            if m[1]:
                end = page.find("-->", m.end())
                return at, len(page) if end < 0 else end + 3, "", False, ""
            if m.end() > self.last:  # no tag can end any more; a comment may still begin
                at = page.find("<!--", at)
                if at < 0:
                    return None
                continue
            name = (m[3] or "").lower()
            if not name:
                return at, page.index(">", m.end()) + 1, "", False, ""
            if name in RAW and not m[2]:
                inside = page.index(">", m.end()) + 1
                end = RAW_END[name].search(page, inside)
                return at, end.end() if end else len(page), "", False, ""
            end = self._tag_end(m.end())
            return at, end + 1, name, bool(m[2]), page[m.end() : end]
        return None


def ends_of(walk: Walk, skipped: str) -> dict[int, int]:
    """Where the elements ``skipped`` end, by where they start; none for unclosed ones."""
    out: dict[int, int] = {}
    opened: list[int] = []
    at = 0
    while found := walk.next(at, foreign=skipped == "svg" and bool(opened)):
        start, at, tag, end, attributes = found
        if tag != skipped:
            continue
        if end:
            if opened:
                out[opened.pop()] = at
        elif tag == "svg" and attributes.endswith("/"):
            out[start] = at
        else:
            opened.append(start)
    return out


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    ends: dict[str, dict[int, int]] = {}
    stack = Stack()
    held: list[str] = []
    link, linked, at = 0, 0, 0

    def close() -> None:
        nonlocal link, linked
        text = " ".join("".join(held).split())
        if text:
            out.append(stack.block(text, min(1.0, linked / len(text))))
        held.clear()
        link = linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            text = html_module.unescape(text) if "&" in text else text
            held.append(text)
            linked += len(text) if link else 0

    walk = Walk(page)
    while found := walk.next(at):
        take(page[at : found[0]])
        start, at, tag, slash, attributes = found
        if tag in SKIPPED:
            if not slash:
                if tag not in ends:
                    ends[tag] = ends_of(walk, tag)
                at = ends[tag].get(start, at)
        elif tag in BLOCKS:
            close()
            if slash:
                stack.leave(tag)
            elif tag not in VOID:
                if tag in REPEATED and stack.opened and stack.opened[-1].tag == tag:
                    stack.pop()
                stack.push(tag, elements(tag, attributes))
        elif tag == "a":
            link = 0 if slash else 1
        elif tag == "br":
            held.append(" ")
    take(page[at:])
    close()
    return out


# ---- vectors ----


class Vectors:
    """Blocks as rows; a memo of bounded size holds hashed words."""

    def __init__(self) -> None:
        self.words = _Memo(lambda w: bucket(w, WORDS), 200_000)

    def rows(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), PATH + WORDS + NUMBERS), np.float32)
        lists = [b.text.lower().split(" ") for b in blocks]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter((self.words[w] for x in lists for w in x), np.int64, int(sizes.sum()))
        counts = np.bincount(np.repeat(np.arange(len(lists)) * WORDS, sizes) + at, minlength=len(lists) * WORDS).reshape(-1, WORDS)
        out[:, PATH : PATH + WORDS] = counts / np.sqrt((counts**2).sum(axis=1, keepdims=True))
        out[:, :PATH] = np.frombuffer(b"".join([b.marks for b in blocks]), np.uint8).reshape(-1, PATH)
        out[:, PATH + WORDS :] = np.array([(b.linked, b.text[-1] in ".!?", "©" in b.text, b.depth / 10, min(1, n / 8), min(1, n / 60)) for b, n in zip(blocks, sizes.tolist(), strict=True)])
        return out


# ---- network ----


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """Two LSTMs, one in each direction, and a logistic unit over both states."""

    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = 3):
        draw = np.random.default_rng(seed)
        self.h = hidden
        self.p: dict[str, np.ndarray] = {"out": draw.normal(0, 0.2, 2 * hidden).astype(np.float32), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p[f"x{d}"] = draw.normal(0, 0.15, (size, 4 * hidden)).astype(np.float32)
            self.p[f"h{d}"] = draw.normal(0, 0.15, (hidden, 4 * hidden)).astype(np.float32)
            self.p[f"c{d}"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)

    def project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """What the inputs add to the gates of both directions."""
        return {d: x @ self.p[f"x{d}"] + self.p[f"c{d}"] for d in "fb"}

    def _run(self, d: str, z_all: np.ndarray, real: np.ndarray, keep: bool, begin: list[np.ndarray] | None = None) -> tuple[np.ndarray, list]:
        """States by step of (steps, pages, 4 * hidden) gate inputs; padding leaves the state as it is.
        ``begin`` holds the state and cell before the first step, and then those after the last."""
        steps, n, h = z_all.shape[0], z_all.shape[1], self.h
        state, cell = begin or (np.zeros((n, h), np.float32), np.zeros((n, h), np.float32))
        states, trace = np.zeros((steps, n, h), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = z_all[t] + state @ self.p[f"h{d}"]
            gates = sigmoid(z[:, : 3 * h])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            g = np.tanh(z[:, 3 * h :])
            new = f * cell + i * g
            top = np.tanh(new)
            if keep:
                trace.append((t, state, cell, i, f, o, g, top))
            state, cell = np.where(real[t], o * top, state), np.where(real[t], new, cell)
            states[t] = state
        if begin is not None:
            begin[:] = state, cell
        return states, trace

    def probabilities(self, z: dict[str, np.ndarray], real: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(d, z[d], real, False)[0] for d in "fb"], axis=2)
        return sigmoid(both @ self.p["out"] + self.p["bias"])

    def long_page(self, slices: int, rows) -> np.ndarray:
        """The probabilities of one page whose vectors ``rows(k)`` come slice by slice."""
        both = []
        for d in "fb":
            begin, found = [np.zeros((1, self.h), np.float32)] * 2, {}
            for k in range(slices) if d == "f" else range(slices - 1, -1, -1):
                z = rows(k) @ self.p[f"x{d}"] + self.p[f"c{d}"]
                found[k] = self._run(d, z[:, None], np.ones((len(z), 1, 1), bool), False, begin)[0][:, 0]
            both.append(np.concatenate([found[k] for k in range(slices)]))
        return sigmoid(np.concatenate(both, axis=1) @ self.p["out"] + self.p["bias"])

    def slopes(self, x: np.ndarray, real: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        z = self.project(x)
        runs = {d: self._run(d, z[d], real, True) for d in "fb"}
        both = np.concatenate([runs[d][0] for d in "fb"], axis=2)
        error = (sigmoid(both @ self.p["out"] + self.p["bias"]) - y) * real[..., 0] / real.sum()
        out = {"out": np.einsum("tn,tnk->k", error, both), "bias": np.array([error.sum()])}
        h = self.h
        for k, d in enumerate("fb"):
            dz_all = np.zeros((*x.shape[:2], 4 * h), np.float32)
            dh, dc = np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
            dw = np.zeros_like(self.p[f"h{d}"])
            for t, before, cell, i, f, o, g, top in reversed(runs[d][1]):
                own = dh + error[t][:, None] * self.p["out"][k * h : (k + 1) * h]
                on = real[t]
                dcell = np.where(on, dc + own * o * (1 - top**2), 0)
                dz = np.concatenate([dcell * g * i * (1 - i), dcell * cell * f * (1 - f), np.where(on, own * top, 0) * o * (1 - o), dcell * i * (1 - g**2)], axis=1)
                dz_all[t] = dz
                dw += before.T @ dz
                dh = np.where(on, dz @ self.p[f"h{d}"].T, own)
                dc = np.where(on, dcell * f, dc)
            out[f"x{d}"] = x.reshape(-1, x.shape[2]).T @ dz_all.reshape(-1, 4 * h)
            out[f"h{d}"], out[f"c{d}"] = dw, dz_all.sum(axis=(0, 1))
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x = np.zeros((steps, len(rows), rows[0].shape[1]), np.float32)
    real = np.zeros((steps, len(rows), 1), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], real[: len(r), k] = r, True
    return x, real


# ---- training pages ----


class _Pages:
    """Synthetic pages and the labels of their blocks, from a seed."""

    def __init__(self, seed: int):
        self.draw = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.draw.integers(len(options)))]

    def some(self, low: int, high: int) -> int:
        return int(self.draw.integers(low, high + 1))

    def words(self, low: int, high: int) -> str:
        letters = "abcdefghijklmnopqrstuvwxyzäéñ"
        out = " ".join("".join(self.pick(letters) for _ in range(self.some(1, 9))) for _ in range(self.some(low, high)))
        return out.capitalize() + self.pick([".", ".", ".", "", "!", "***"])

    def page(self) -> tuple[str, list[int]]:
        parts: list[str] = []
        labels: list[int] = []

        def put(html: str, label: int) -> None:
            parts.append(html)
            labels.append(label)

        def links(n: int) -> None:
            parts.append("<ul>")
            for _ in range(n):
                put(f'<li><a href="/{self.words(1, 1)}">{self.words(1, 3)}</a></li>', 0)
            parts.append("</ul>")

        def notice() -> None:
            kind = self.pick(["ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "cookie-notice", "cookie", "newsletter", "popup", "share", "social", "related", "breadcrumb", "widget", "notice"])
            put(f'<div {self.pick(["class", "id"])}="{kind}">{self.pick(["", "Advertisement ", "Subscribe ", "We use cookies "])}{self.words(1, 14)}</div>', 0)

        def form() -> None:
            parts.append(self.pick(["<form>", '<form class="search">', '<form id="subscribe">', '<form class="login">']))
            put(f"<label>{self.words(1, 4)}</label><input>", 0)
            put(f"<button>{self.words(1, 2)}</button></form>", 0)

        def comments() -> None:
            tag = self.pick(["div", "section", "ul", "ol"])
            parts.append(f'<{tag} {self.pick(["class", "id"])}="{self.pick(["comments", "comment-list", "user-comments", "responses", "discussion", "reader-comments"])}">')
            if self.some(0, 1):
                put(f"<h3>{self.words(1, 3)}</h3>", 0)
            for _ in range(self.some(1, 6)):
                inner = self.pick(["p", "div", "li"])
                put(f'<{inner}{self.pick(["", " class=comment"])}>{self.words(2, 40)}</{inner}>', 0)
            parts.append(f"</{tag}>")

        def sidebar() -> None:
            tag = self.pick(["<aside>", '<div class="sidebar">', '<div id="side">', '<aside class="related">'])
            parts.append(tag)
            for _ in range(self.some(1, 4)):
                put(f"<p>{self.words(2, 30)}</p>", 0)
            if self.some(0, 1):
                links(self.some(1, 5))
            parts.append("</aside>" if "aside" in tag else "</div>")

        def paragraph() -> None:
            kind = self.some(0, 15)
            text = self.words(1, self.pick([2, 6, 20, 60, 120]))
            if kind <= 9:
                put(f"<p>{text}</p>", 1)
            elif kind == 10:
                put(f"<p><b>{text}<br>", 1)
            elif kind == 11:
                put(f'<p>{text} <a href="#">{self.words(1, 3)}</a> {self.words(1, 10)}</p>', 1)
            elif kind == 12:
                put(f"<{(h := self.pick(['h2', 'h3']))}>{self.words(1, 6)}</{h}>", 1)
            elif kind == 13:
                put(f"<{(q := self.pick(['blockquote', 'pre', 'figcaption', 'div']))}>{text}</{q}>", 1)
            elif kind == 14:
                parts.append("<ul>")
                for _ in range(self.some(1, 4)):
                    put(f"<li>{self.words(1, 12)}</li>", 1)
                parts.append("</ul>")
            else:
                parts.append("<table><tr>")
                for _ in range(self.some(1, 4)):
                    put(f"<td>{self.words(1, 4)}</td>", 1)
                parts.append("</tr></table>")

        parts.append(self.pick(["<html><head><title>x</title></head><body>", "<!DOCTYPE html><html lang=en><body>", ""]))
        top = self.some(0, 3)
        if top:
            parts.append({1: "<nav>", 2: "<header><nav>", 3: '<div class="menu">'}[top])
            links(self.some(1, 8))
            parts.append({1: "</nav>", 2: "</nav></header>", 3: "</div>"}[top])
        for _ in range(self.some(0, 2)):
            self.pick([notice, notice, form, sidebar])()
        opening, closing = self.pick([
            ("<article>", "</article>"), ("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main-content">', "</div>"),
            ('<div class="post"><div class="entry-content">', "</div></div>"), ('<section class="article-body">', "</section>"), ('<div class="story-body">', "</div>"), ('<div role="main">', "</div>"), ("", ""),
        ])
        parts.append(opening)
        if self.some(0, 4):
            put(self.pick(["<h1>{}</h1>", "<header><h1>{}</h1></header>", '<h1 class="title">{}</h1>']).format(self.words(1, 10)), 1)
        for _ in range(self.some(1, self.pick([2, 8, 20, 35]))):
            paragraph()
            if not self.some(0, 24):
                self.pick([notice, form, sidebar, notice])()
        inside = opening and not self.some(0, 5)
        if inside:
            self.pick([comments, notice, form])()
        parts.append(closing)
        for _ in range(self.some(0, 2)):
            self.pick([notice, comments, comments, form, sidebar])()
        end = self.some(0, 3)
        if end:
            foot = {1: ("<footer>", "</footer>"), 2: ('<div class="footer">', "</div>"), 3: ('<footer id="bottom">', "</footer>")}[end]
            parts.append(foot[0])
            if self.some(0, 2):
                put(f"<p>{self.words(1, 12)}</p>" if self.some(0, 1) else f"&copy; {self.words(1, 12)}", 0)
            else:
                links(self.some(1, 5))
            parts.append(foot[1])
        return "".join(parts), labels


def training_pages(count: int, seed: int) -> list[tuple[list[Block], np.ndarray]]:
    source, out = _Pages(seed), []
    while len(out) < count:
        page, labels = source.page()
        blocks = blocks_of(page)
        if len(blocks) != len(labels):
            raise AssertionError("a training page does not give its blocks")
        if blocks:
            out.append((blocks, np.array(labels, np.float32)))
    return out


def train(pages: int = 500, epochs: int = 10, batch: int = 50, rate: float = 0.015, seed: int = 17) -> BiLstm:
    vectors = Vectors()
    data = sorted(((vectors.rows(b), y) for b, y in training_pages(pages, seed)), key=lambda d: len(d[1]))
    sets = []
    for k in range(0, len(data), batch):
        x, real = padded([r for r, _ in data[k : k + batch]])
        y = np.zeros(real.shape[:2], np.float32)
        for j, (_, own) in enumerate(data[k : k + batch]):
            y[: len(own), j] = own
        sets.append((x, real, y))
    net, draw = BiLstm(PATH + WORDS + NUMBERS), np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    turn = 0
    for epoch in range(epochs):
        for k in draw.permutation(len(sets)):
            turn += 1
            x, real, y = sets[k]
            shown = x * (draw.random((x.shape[1], x.shape[2])) > 0.05)  # no single feature carries a label alone
            now = rate * (1 - epoch / epochs) + 1e-3
            for name, g in net.slopes(shown.astype(np.float32), real, y).items():
                m, v = moments[name]
                m[:] = 0.9 * m + 0.1 * g
                v[:] = 0.99 * v + 0.01 * g * g
                net.p[name] = (net.p[name] - now * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
    return net


@functools.lru_cache(1)
def trained() -> BiLstm:
    return train()


class Labeller:
    def __init__(self, net: BiLstm):
        self.net, self.vectors = net, Vectors()

    def main_blocks(self, pages: list[list[Block]], cells: int = 1 << 15) -> list[list[str]]:
        """The texts of the main blocks of each page. A page of more than ``cells`` blocks is by itself."""
        short = [k for k, blocks in enumerate(pages) if len(blocks) <= cells]
        main = dict(zip(short, self._together([pages[k] for k in short], cells), strict=True))
        return [[b.text for b, yes in zip(blocks, (main[k] if k in main else self._alone(blocks, cells)).tolist(), strict=True) if yes] for k, blocks in enumerate(pages)]

    def _together(self, pages: list[list[Block]], cells: int) -> list[np.ndarray]:
        flat = [b for blocks in pages for b in blocks]
        parts = [self.net.project(self.vectors.rows(flat[k : k + cells])) for k in range(0, len(flat), cells)]
        z = {d: np.concatenate([x[d] for x in parts]) for d in "fb"} if parts else {}
        sizes = np.array([len(b) for b in pages], np.int64)
        first = np.cumsum(sizes) - sizes
        main = np.zeros(len(flat), bool)
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        while len(order):  # the longest pages that are left, while they differ little
            steps = int(sizes[order[-1]])
            alike = len(order) - int(np.searchsorted(sizes[order], 0.7 * steps - 2))
            own, order = np.split(order, [len(order) - max(1, min(alike, cells // steps))])[::-1]
            at = np.minimum(first[own] + np.arange(steps)[:, None], len(flat) - 1)
            real = np.arange(steps)[:, None] < sizes[own]
            chance = self.net.probabilities({d: x[at] for d, x in z.items()}, real[..., None])
            main[at[real]] = chance[real] >= 0.5
            for j in np.flatnonzero(((np.abs(chance - 0.5) < NEAR_LIMIT) & real).any(axis=0)):
                main[first[own[j]] + np.arange(sizes[own[j]])] = self._alone(pages[own[j]], cells)
        return np.split(main, first[1:]) if len(pages) else []

    def _alone(self, blocks: list[Block], cells: int) -> np.ndarray:
        return self.net.long_page(-(-len(blocks) // cells), lambda k: self.vectors.rows(blocks[k * cells : (k + 1) * cells])) >= 0.5


def _groups(pages: list[str], most: int, blocks: int = 1 << 16) -> Iterator[list[list[Block]]]:
    """The blocks of consecutive pages, until there are ``most`` pages or ``blocks`` blocks."""
    held: list[list[Block]] = []
    size = 0
    for page in pages:
        held.append(blocks_of(page))
        size += len(held[-1])
        if len(held) >= most or size >= blocks:
            yield held
            held, size = [], 0
    if held:
        yield held


@functools.lru_cache(1)
def _labeller(packed: bytes) -> Labeller:
    """One a worker process, so that its memos outlive a task."""
    return Labeller(pickle.loads(packed))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group: int = 512) -> DataFrame:
    """``id, url, text, n_chars`` a row."""
    ship(pages.sparkSession)
    packed = pickle.dumps(trained())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = _labeller(packed)
        for batch in batches:
            texts = []
            for blocks in _groups(batch["html"].tolist(), group):
                texts += ["\n".join(x) for x in labeller.main_blocks(blocks)]
            yield pd.DataFrame({"id": batch["id"].array, "url": batch["url"].array, "text": texts, "n_chars": [len(t) for t in texts]})

    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    return map_batches(source, run, "url string, text string, n_chars long").withColumnsRenamed({"id": id_col, "url": url_col})


def op2_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
