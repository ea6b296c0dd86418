"""Pages as trees: a page's elements as an array, and selectors compiled into columns over it.

``page_tree`` reads a page once into its visible text and its elements, numbered in page order.
Every element knows its parent, the last element inside it and where its text begins and ends,
so any number of selectors and rules of a batch share the one pass, and stay columns.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

NODE = "struct<index int, parent int, last int, place int, tag string, id string, classes array<string>, attributes array<struct<name string, value string>>, begin int, end int, shape long>"
TREE = f"struct<text string, nodes array<{NODE}>, data array<string>>"

# Elements that begin a line, that have no end tag, whose text is not shown, and the
# open elements that the beginning of another one ends.
LINES = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody tfoot thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head noscript script style template title".split())
ENDS = {"li": {"li"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("html table caption td th button object template".split())  # a paragraph outside stays open


class _Open(NamedTuple):
    tag: str
    index: int
    paragraph: int | None  # which entry of the stack is the open paragraph


class _Reader(HTMLParser):
    """One pass, linear in the page's length."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.stack: list[_Open] = []
        self.open: dict[str, int] = {}
        self.children: list[int] = [0]  # of every open element, and of the page
        self.shapes: list[list[int]] = [[]]
        self.parts: list[str] = []
        self.length, self.gap, self.hidden = 0, "", 0
        self.data: list[str] = []
        self.script: list[str] | None = None  # an open one that holds linked data

    def _gap(self, kind: str) -> None:
        if self.length and (kind == "\n" or self.gap != "\n" and (kind == "\t" or not self.gap)):
            self.gap = kind

    def handle_data(self, data: str) -> None:
        if self.script is not None:
            self.script.append(data)
        if self.hidden or not data:
            return
        words = data.split()
        if not words or data[0].isspace():
            self._gap(" ")
        if words:
            text = self.gap + " ".join(words)
            self.parts.append(text)
            self.length += len(text)
            self.gap = " " if data[-1].isspace() else ""

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag in ENDS:
            while self.stack and self.stack[-1].tag in ENDS[tag]:
                self._pop()
        elif tag in LINES and self.stack and self.stack[-1].paragraph is not None:
            keep = self.stack[-1].paragraph
            while len(self.stack) > keep:
                self._pop()
        if tag in LINES or tag == "br":
            self._gap("\n")
        first = {}
        for name, value in attributes:
            first.setdefault(name, value or "")
        self.children[-1] += 1
        parent = self.stack[-1].index if self.stack else -1
        index = len(self.nodes)
        self.nodes.append([index, parent, index, self.children[-1], tag, first.get("id", ""), first.get("class", "").split(), list(first.items()), self.length, self.length, 0])
        if tag in VOID:
            self._shape(index, ())
            return
        above = self.stack[-1].paragraph if self.stack and tag not in SCOPES else None
        self.stack.append(_Open(tag, index, len(self.stack) if tag == "p" else above))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.children.append(0)
        self.shapes.append([])
        self.hidden += tag in HIDDEN
        if tag == "script" and first.get("type", "").strip().lower() == "application/ld+json":
            self.script = []

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attributes)

    def handle_endtag(self, tag: str) -> None:
        while self.open.get(tag):
            if self._pop() == tag:
                break
        if tag in LINES:
            self._gap("\n")

    def _pop(self) -> str:
        tag, index, _ = self.stack.pop()
        self.children.pop()
        self.open[tag] -= 1
        self.hidden -= tag in HIDDEN
        if tag == "script" and self.script is not None:
            self.data.append("".join(self.script))
            self.script = None
        self.nodes[index][2], self.nodes[index][9] = len(self.nodes) - 1, self.length
        self._shape(index, self.shapes.pop())
        self._gap("\n" if tag in LINES else "\t" if tag in ("td", "th") else "")
        return tag

    def _shape(self, index: int, inside: list[int] | tuple[()]) -> None:
        """A number that elements of the same tags and classes, all the way down, share; runs of equal children count once."""
        distinct = [x for k, x in enumerate(inside) if not k or inside[k - 1] != x]
        node = self.nodes[index]
        node[10] = zlib.crc32(repr((node[4], sorted(node[6]), distinct)).encode("utf-8", "surrogatepass"))
        self.shapes[-1].append(node[10])


NAMES = ("index", "parent", "last", "place", "tag", "id", "classes", "attributes", "begin", "end", "shape")


#: An ampersand that begins no character reference with its semicolon; comments, scripts and styles, where there are none, as group 1.
_OPEN_REFERENCE = re.compile(r"(<!--(?:[^-]|-(?!->))*|<(script|style)\b(?:[^<]|<(?!/\2\b))*)|&(?!#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)", re.I)

#: As much html as a task holds the elements of at once.
SLICE = 1 << 18


def _read(html: str | None, closed: bool = False) -> _Reader:
    reader = _Reader()
    reader.feed(_OPEN_REFERENCE.sub(lambda m: m[1] or "&amp;", html or "") if closed else html or "")
    reader.close()
    while reader.stack:
        reader._pop()
    return reader


def read_tree(html: str | None) -> tuple[str, list[dict], list[str]]:
    reader = _read(html)
    nodes = [dict(zip(NAMES, n, strict=True)) for n in reader.nodes]
    for n in nodes:
        n["attributes"] = [{"name": k, "value": v} for k, v in n["attributes"]]
    return "".join(reader.parts), nodes, reader.data


def _lists(lists: list, values: Callable[[list], pa.Array]) -> pa.Array:
    offsets = pa.array([0, *accumulate(map(len, lists))], pa.int32())
    return pa.ListArray.from_arrays(offsets, values([x for held in lists for x in held]))


def _strings(values: list[str]) -> pa.Array:
    return pa.array(values, pa.string())


def _pairs(values: list[tuple[str, str]]) -> pa.Array:
    return pa.StructArray.from_arrays([_strings([k for k, _ in values]), _strings([v for _, v in values])], ["name", "value"])


def _nodes(values: list[list]) -> pa.Array:
    kinds = {"tag": _strings, "id": _strings, "classes": lambda x: _lists(x, _strings), "attributes": lambda x: _lists(x, _pairs), "shape": lambda x: pa.array(x, pa.int64())}
    return pa.StructArray.from_arrays([kinds.get(name, lambda x: pa.array(x, pa.int32()))([n[k] for n in values]) for k, name in enumerate(NAMES)], list(NAMES))


def _trees(held: list[_Reader]) -> pa.Array:
    texts = _strings(["".join(r.parts) for r in held])
    return pa.StructArray.from_arrays([texts, _lists([r.nodes for r in held], _nodes), _lists([r.data for r in held], _strings)], ["text", "nodes", "data"])


def read_slices(pages: pa.Array, closed: bool = False) -> Iterator[pa.Array]:
    """The trees of a batch, of about ``SLICE`` characters of html at a time."""
    held, length = [], 0
    for page in pages:
        html = page.as_py() or ""
        held.append(_read(html, closed))
        length += len(html)
        if length >= SLICE:
            yield _trees(held)
            held, length = [], 0
    if held:
        yield _trees(held)


def page_tree(html: Column, closed: bool = False) -> Column:
    """``text, nodes, data`` of a page: the text as it is shown, a line an element that begins one, white
    space inside a line as single spaces, table cells parted by a tab; the elements as ``NODE``; the
    linked data of its scripts. A missing page is an empty one. With ``closed`` a character
    reference without its semicolon is text, as where a text was escaped and cut; else it counts as in browsers. The session's workers need the package: call ``shipping.ship``."""

    @F.arrow_udf(TREE)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield from read_slices(pages, closed)

    return read(html)


# ---- selectors ----

_TOKEN = re.compile(
    r"""(?P<join>\s*[>,]\s*|\s+)|(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)
    |\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[*^$]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[^\]\s]+))\s*)?\]|:(?P<first>first-child)|:nth-child\((?P<nth>\d+)\)""",
    re.X,
)


def parse_selector(selector: str) -> list[list[tuple[str, list[dict[str, str]]]]]:
    """Alternatives of steps ``(combinator, simple selectors)``; the first combinator is a space."""
    out: list = [[(" ", [])]]
    at, selector = 0, selector.strip()
    while at < len(selector):
        m = _TOKEN.match(selector, at)
        if not m:
            raise ValueError(f"selector not understood at {selector[at:]!r}")
        at = m.end()
        if m["join"] is None:
            out[-1][-1][1].append({k: v for k, v in m.groupdict().items() if v is not None})
        elif "," in m["join"]:
            out.append([(" ", [])])
        else:
            out[-1].append((m["join"].strip() or " ", []))
    if any(not simple for steps in out for _, simple in steps):
        raise ValueError(f"selector with an empty part: {selector!r}")
    return out


def _attribute(node: Column, name: str) -> Column:
    return F.get(F.transform(F.filter(node["attributes"], lambda a: a["name"] == name), lambda a: a["value"]), 0)


def _meets(node: Column, simple: dict[str, str]) -> Column:
    if "tag" in simple:
        return F.lit(True) if simple["tag"] == "*" else node["tag"] == simple["tag"].lower()
    if "id" in simple:
        return node["id"] == simple["id"]
    if "cls" in simple:
        return F.array_contains(node["classes"], simple["cls"])
    if "attr" in simple:
        held, wanted = _attribute(node, simple["attr"].lower()), F.lit(simple.get("dq") or simple.get("sq") or simple.get("bare") or "")
        tests = {"=": held == wanted, "*=": F.contains(held, wanted), "^=": F.startswith(held, wanted), "$=": F.endswith(held, wanted)}
        return F.coalesce(tests[simple["op"]], F.lit(False)) if "op" in simple else held.isNotNull()
    return node["place"] == int(simple.get("nth", 1))


def select(nodes: Column, selector: str, within: Column | None = None) -> Column:
    """The indexes of the elements that a selector finds, in page order: tags, ids, classes,
    attributes (``=``, ``*=``, ``^=``, ``$=``), ``:first-child``, ``:nth-child(n)``, descendants, children and
    lists of these. ``within`` limits it to the elements inside one. The time is that of the elements
    times what the steps before the last find."""
    if within is not None:
        nodes = F.slice(nodes, within["index"] + 2, within["last"] - within["index"])

    def step(held: Column | None, join: str, simple: list[dict[str, str]]) -> Column:
        def fits(n: Column) -> Column:
            out = functools.reduce(lambda a, s: a & _meets(n, s), simple, F.lit(True))
            if held is None:
                return out
            if join == ">":
                return out & F.exists(held, lambda a: a["index"] == n["parent"])  # few are held: what the step before found
            return out & F.exists(held, lambda a: (a["index"] < n["index"]) & (n["index"] <= a["last"]))

        return F.filter(nodes, fits)

    def found(steps: list[tuple[str, list[dict[str, str]]]]) -> Column:
        held = functools.reduce(lambda h, s: step(h, *s), steps, None)
        return F.transform(held, lambda n: n["index"])

    parts = [found(steps) for steps in parse_selector(selector)]
    return parts[0] if len(parts) == 1 else F.array_sort(F.array_distinct(F.concat(*parts)))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` worked out once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


class Page:
    """Columns of a page that has been read: what its elements say."""

    def __init__(self, tree: Column):
        self.shown, self.nodes = tree["text"], tree["nodes"]

    def node(self, index: Column) -> Column:
        return F.get(self.nodes, index)

    def text(self, node: Column) -> Column:
        """What an element shows, null without one."""
        return bound(node, lambda n: F.btrim(F.substring(self.shown, n["begin"] + 1, n["end"] - n["begin"]), F.lit(" \n\t")))

    def attribute(self, node: Column, name: str) -> Column:
        return _attribute(node, name)

    def first(self, selector: str, within: Column | None = None, nth: int = 0) -> Column:
        """The element of that number, from 0 on, that a selector finds; null if there is none."""
        return self.node(F.get(select(self.nodes, selector, within), nth))

    def text_of(self, selector: str, within: Column | None = None, nth: int = 0) -> Column:
        return self.text(self.first(selector, within, nth))

    def repeated(self) -> Column:
        """The indexes of the most siblings of one shape that have elements inside (ties: the first
        parent's), which is what a page of unknown make lists: cards, rows, reviews; empty if none repeats."""
        inner = F.filter(self.nodes, lambda n: n["last"] > n["index"])
        order = F.array_sort(F.transform(inner, lambda n: F.struct(n["parent"].alias("parent"), n["shape"].alias("shape"))))
        none = F.struct(F.lit(-2).alias("parent"), F.lit(0).cast("long").alias("shape"))
        begin = F.struct(none.alias("now"), F.lit(0).alias("n"), none.alias("best"), F.lit(1).alias("most"))

        def count(held: Column, kind: Column) -> Column:
            n = F.when(held["now"] == kind, held["n"] + 1).otherwise(1)
            more = n > held["most"]
            return F.struct(kind.alias("now"), n.alias("n"), F.when(more, kind).otherwise(held["best"]).alias("best"), F.greatest(n, held["most"]).alias("most"))

        best = F.aggregate(order, begin, count)["best"]
        return F.transform(F.filter(inner, lambda n: (n["parent"] == best["parent"]) & (n["shape"] == best["shape"])), lambda n: n["index"])
