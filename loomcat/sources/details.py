"""Material and product code of detail pages: rules by site over a page's elements."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .page_tree import Page, bound
from .registry import ParserRegistry

# ---- what a text says; every function gives null where it says nothing ----


def filled(text: Column, most: int | None = None) -> Column:
    text = F.btrim(text, F.lit(" \n\t"))
    return F.nullif(F.btrim(F.substring(text, 1, most), F.lit(" \n\t")) if most else text, F.lit(""))


def after(text: Column, label: str) -> Column:
    """What follows the first place that ``label``, a pattern, matches."""
    return F.when(F.rlike(text, F.lit(label)), F.regexp_extract(text, rf"(?s)(?:{label})(.*)", 1))


def before(text: Column, words: str) -> Column:
    """What comes before the first of ``words``, a pattern; all if there is none."""
    return F.regexp_extract(text, rf"(?s)^(.*?)(?:{words}|\z)", 1)


def line(text: Column) -> Column:
    return F.regexp_extract(text, r"^[^\n]*", 0)


def between(text: Column, begin: str, ends: tuple[str, ...]) -> Column:
    """From the word ``begin`` (the text's begin without it) to the first of ``ends`` that is there at all."""
    place = lambda word: F.nullif(F.instr(text, word), F.lit(0))
    start = F.coalesce(place(begin) + len(begin), F.lit(1))
    stop = F.coalesce(*[F.when(place(e) > 1, place(e)) for e in ends], F.length(text) + 1)
    return F.substring(text, start, F.greatest(stop - start, F.lit(0)))


def lines(text: Column, parting: str = "\n") -> Column:
    """The parts of a text between any of the characters ``parting``, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, f"[{parting}]"), lambda x: F.btrim(x, F.lit(" \n\t"))), lambda x: x != "")


def starting(parts: Column, pattern: str) -> Column:
    return F.filter(parts, lambda x: F.rlike(x, F.lit(f"^(?:{pattern})")))


def next_line(parts: Column, pattern: str) -> Column:
    """The part after the first one that ``pattern`` matches whole."""
    at = F.get(F.filter(F.transform(parts, lambda x, k: F.when(F.rlike(x, F.lit(f"^(?:{pattern})$")), k)), lambda k: k.isNotNull()), 0)
    return F.get(parts, at + 1)


SHARE, FIBRE = r"[0-9]+\s*%", r"[A-Za-z가-힣]+"
PART = rf"(?:{SHARE}\s*{FIBRE}|{FIBRE}\s*{SHARE})"
COMPOSITION = rf"{PART}(?:\s*[,/]\s*{PART})*"


def composition(text: Column) -> Column:
    """The first run of shares and fibres."""
    return F.nullif(F.regexp_extract(text, COMPOSITION, 0), F.lit(""))


def labelled_composition(text: Column) -> Column:
    """The first one after a label of material, else the first of all."""
    return F.coalesce(composition(after(text, MATERIAL_LABEL)), composition(text))


# Labels of material, and where pages of no special make keep their descriptions and codes.
MATERIAL_LABEL = r"(?i)소재|원단|material|fabric|composition"
DESCRIPTIONS = (".cont_detail", "#prdDetail", ".product-detail", ".xans-product-detaildesign", ".detail_cont", "#productDetail", ".item.open .content", ".prd_detail_box")
CODES = (".product_code", ".prd_code")
ADDITIONAL = ".xans-product-additional"

# ---- rules ----

Rule = Callable[[Page], Column]


@dataclass(frozen=True)
class Detail:
    material: Rule
    code: Rule = lambda _: F.lit(None).cast("string")


def plain(*descriptions: str) -> Detail:
    """The composition in the first description of more than ten characters; the code element's text after its colon."""

    def material(page: Page) -> Column:
        found = F.coalesce(*[bound(page.text_of(d), lambda t: F.when(F.length(t) > 10, t)) for d in descriptions])
        return bound(found, lambda t: filled(labelled_composition(t)))

    def code(page: Page) -> Column:
        found = F.coalesce(*[filled(page.text_of(c)) for c in CODES])
        return bound(found, lambda t: filled(F.coalesce(line(after(t, r"[:：]\s*")), t)))

    return Detail(material, code)


def at(selector: str, rule: Callable[[Column], Column], nth: int = 0, most: int = 500) -> Rule:
    """A rule over the text of one element."""
    return lambda page: bound(page.text_of(selector, nth=nth), lambda t: filled(rule(t), most))


def shown(rule: Callable[[Column], Column], most: int = 500) -> Rule:
    """A rule over all that the page shows."""
    return lambda page: filled(rule(page.shown), most)


def joined(parts: Column, by: str) -> Column:
    return F.when(F.size(parts) > 0, F.array_join(parts, by))


def _office(text: Column) -> Column:
    """After the country of make in the passage on returns: from the first Latin letter up to words on care."""
    passage = line(after(F.substring(after(text, "교환 및 반품정보"), 1, 490), r"제조국\s*:\s*"))
    said = F.regexp_extract(passage, r"[A-Za-z][\w\s,%.'·()]+", 0)
    cut = before(said, r"-(?:본|이)\s*제품|드라이|세탁|물세탁")
    return F.when(F.length(F.trim(cut)) > 3, cut)


def _two_lines(text: Column) -> Column:
    """The two lines below a line that is a label of material, up to an empty one, if longer than three characters."""
    below = after(text, r"(?im)^[ \t]*(?:원단|소재|fabric)[ \t]*$\n?")
    return joined(F.slice(F.filter(lines(before(below, r"\n[ \t]*\n")), lambda x: F.length(x) > 3), 1, 2), " / ")


DETAILS: ParserRegistry = ParserRegistry()
PLAIN = plain(*DESCRIPTIONS)
# Where each site keeps what, under which labels, in which form.
for _site, _detail in {
    "ojos": PLAIN,
    "goyowear": PLAIN,
    "taats": PLAIN,
    "blankroom": plain(".product-description"),
    "visualaid": plain(".tab_wrap"),
    "emis": plain(".accordion-list:first-child .accordion-content"),
    "8division": Detail(at("div.product-addinfo", lambda t: composition(between(t, "제품정보", ("매장 이용안내", "배송 및 교환"))), most=200)),
    "adekuver": Detail(
        at(".item.open .content", lambda t: F.get(starting(lines(t, r"\-\n"), rf"{SHARE}\s*[A-Za-z가-힣]"), 0), most=200),
        at(".item.open .content", lambda t: joined(F.filter(F.split(t, r"\s+"), lambda x: F.rlike(x, F.lit("^[A-Z0-9]{6,}$"))), ", ")),
    ),
    "anotheroffice": Detail(at(".ec-base-tab", _office, nth=1)),
    "bastong": Detail(at(ADDITIONAL, lambda t: line(F.coalesce(after(t, r"겉감\s*[:：]\s*"), after(t, r"Fabric\s*[-:：]\s*"))))),
    "chanceclothing": Detail(at(ADDITIONAL, lambda t: before(after(t, r"소재\s+"), "원산지")), at(ADDITIONAL, lambda t: line(after(t, r"브랜드\s*품번\s*[:：]\s*")))),
    "eastlogue": Detail(at(ADDITIONAL, lambda t: F.coalesce(joined(starting(lines(t, r"\-\n"), "(?i)outshell|lining|shell"), " / "), F.get(starting(lines(t, r"\-\n"), rf"{SHARE}\s"), 0)), most=200)),
    "etcseoul": Detail(shown(lambda t: F.coalesce(next_line(lines(t), r"\[MATERIAL\]"), after(F.get(starting(lines(t), r"소재\s*[-–]\s*."), 0), r"^소재\s*[-–]\s*")))),
    "fr8ight": Detail(at(".xans-product-additional.description", lambda t: F.get(starting(lines(t, r"\-\n"), rf"(?i){SHARE}\s|outshell\s|100%|cotton|polyester|nylon|wool|linen"), 0), most=200)),
    "havati": Detail(shown(lambda t: joined(starting(lines(t), r"(?:OUTSHELL|SHELL|TRIM|LINING|FILLING)\s*:"), "\n"))),
    "roughside": Detail(at("ul.prd-detail-desc-list", lambda t: joined(starting(lines(t), r"(?i)(?:shell|lining|겉감|안감|소재|원단)\s*[:：]"), " / "), most=200)),
    "sculpstore": Detail(shown(lambda t: F.nullif(F.regexp_extract(t, r"혼용률\s*[:：]?\s*([^\n]{3,100})", 1), F.lit(""))), shown(lambda t: next_line(lines(t), "(?i)code"))),
    "shopamomento": Detail(at(ADDITIONAL, lambda t: before(after(t, r"Composition\s+"), "Size Measurement"))),
    "sienneboutique": Detail(at(".tabs-content", lambda t: F.coalesce(filled(before(after(t, r"(?i)fabric\s*\*?\s*"), "(?i)care guide")), F.when(F.length(t) > 3, before(t, "Care Guide"))), nth=1)),
    "slowsteadyclub": Detail(at(ADDITIONAL, lambda t: before(after(t, r"소재\s+"), "원산지|사이즈"))),
    "swallowlounge": Detail(at('li[data-name="material"] > div', lambda t: t)),
    "takeastreet": Detail(at("div.detail_left", lambda t: F.coalesce(filled(before(after(t, r"소재\s*[:：]\s*"), "MODEL SIZE")), F.concat(F.lit("Shell : "), filled(before(after(t, r"(?i)shell\s*[:：]\s*"), "(?i)model size")))), most=200)),
    "triplestore": Detail(at(ADDITIONAL, _two_lines, most=200)),
}.items():
    DETAILS.register(_site, _detail)


def page_details(tree: Column, site: Column, registry: ParserRegistry = DETAILS) -> Column:
    """``material, product_code`` of a page that ``page_tree.page_tree`` has read, by the rules of its
    site, or by the plain ones where the site has none. Only a page's own rules are worked out."""
    page = Page(tree)
    result = lambda d: F.struct(d.material(page).alias("material"), d.code(page).alias("product_code"))
    sites: dict[Detail, list[str]] = {}
    for key in registry.keys():
        sites.setdefault(registry.resolve(key), []).append(key)
    sites.pop(PLAIN, None)
    out = functools.reduce(lambda a, d: a.when(site.isin(sites[d]), result(d)), sites, F.when(F.lit(False), result(PLAIN)))
    return out.otherwise(result(PLAIN))
