"""Small rules on what to keep: stock, names of goods, sources, pages that are a product's own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import composed
from ..functions.urls import absolute, same_page
from ..sources.page_tree import Page, bound, select
from ..vocabulary import Entry, Vocabulary

# ---- stock ----

# Fields of an option, words for sold out, and how pages mark a button to buy and what is sold out.
OPTION = "struct<is_display string, is_selling string, use_stock string, stock_number string>"
SOLD_OUT_WORDS = ("sold out", "soldout", "out of stock", "outof stock", "out ofstock", "outofstock")
SOLD_OUT_PARTS = ("품절",)
BUY_BUTTONS = '#actionBuy, .btnSubmit, [class*=btn_buy], .prd-btn__buy, .prd-btn__basket, [onclick*="product_submit(1"], [onclick*="product_submit(2"]'
SOLD_OUT_MARKS = "#actionSoldout, .soldout, .sold-out, [class*=btn_soldout], .prd-btn__soldout"


def option_stock(options: Column) -> Column:
    """Is one of a product's options in stock? ``options`` is JSON, a map of ``OPTION``. Null if it doesn't say: there are none, or some count their
    stock without a number. Options that aren't shown or sold don't count; one that counts no stock is always there."""

    def judged(found: Column) -> Column:
        sold = F.filter(found, lambda o: F.coalesce(o["is_display"] != "F", F.lit(True)) & F.coalesce(o["is_selling"] != "F", F.lit(True)))
        counts = lambda o: F.coalesce(o["use_stock"].isin("T", "true"), F.lit(False))
        number = lambda o: F.nullif(F.trim(o["stock_number"]), F.lit("")).try_cast("double")
        there = F.exists(sold, lambda o: ~counts(o) | F.coalesce(number(o) > 0, F.lit(False)))
        all_known = F.forall(sold, lambda o: ~counts(o) | number(o).isNotNull())
        return F.when(F.size(found) > 0, F.when(F.size(sold) == 0, False).when(there, True).when(all_known, False))

    return bound(F.map_values(F.from_json(options, f"map<string, {OPTION}>")), judged)


def detail_stock(options: Column, page: Page) -> Column:
    """The options' word, else what the page shows: a button to buy, then a mark of sold out; else null."""
    shows = lambda selector: F.size(select(page.nodes, selector)) > 0
    return F.coalesce(option_stock(options), F.when(shows(BUY_BUTTONS), True).when(shows(SOLD_OUT_MARKS), False))


def listing_stock(current: Column, names_sold_out: Column) -> Column:
    """A name that says sold out is stronger than a listing's badge."""
    return F.coalesce(F.when(names_sold_out, False), current)


def sold_out_names() -> Vocabulary:
    return Vocabulary([Entry("sold out", SOLD_OUT_WORDS, SOLD_OUT_PARTS)])


def keep_product(in_stock: Column, listing_only: bool = False, include_out_of_stock: bool = False) -> Column:
    return F.lit(listing_only or include_out_of_stock) | F.coalesce(in_stock, F.lit(True))


# ---- names of what is no fashion ----


def _forms(*phrases: str) -> tuple[str, ...]:
    """Each phrase in singular and plural, its last words joined as well where a dash stands for a space that may be missing."""
    out = []
    for p in phrases:
        for q in (p.replace("~", " "), p.replace("~", "")):
            out += [q, q + "s"]
    return tuple(dict.fromkeys(out))


# Goods that are no fashion, and words that make them so all the same; ~ is a space that may be missing.
GOODS = (
    Entry("hard", _forms("phone~case", "i~phone~case", "iphone case", "flat file", "locker basket", "glasses tray", "apple watch strap", "apple watch sport strap", "shoe~horn", "laundry bag"), ("폰케이스", "폰 케이스", "플랫 파일", "락커 바스켓", "글라스 트레이", "애플워치 스트랩", "애플 워치 스트랩")),
    Entry("basket", _forms("mesh basket")),
    Entry("only beside others", (), ("슈혼", "세탁 가방", "런드리 백")),
    Entry("basket beside others", (), ("메쉬 바스켓",)),
    Entry("umbrella", _forms("umbrella"), ("우산",)),
    Entry("reflector", _forms("reflector"), ("반사판",)),
    Entry("soft", (*_forms("towel"), "pen"), ("타월", "수건")),
    Entry("laundry", _forms("laundry basket")),
    Entry("pen", ("펜",)),
    Entry("wearable", ("shirt", "shirts", "t shirt", "tshirt", "tee", "tees", "polo", "jacket", "jackets", "vest", "vests", "shorts", "pants", "slacks", "dress", "dresses", "skirt", "skirts", "socks", "hoodie", "sweatshirt", *_forms("sneaker"), "bag", "bags", *_forms("earring"), "jewelry")),
    Entry("bag", ("bag", "bags"), ("백", "가방")),
    Entry("earring", _forms("earring"), ("귀걸이",)),
    Entry("with reflectors", ("dress", "dresses", "pants", "slacks", "shorts", "skirt", "skirts", "knitted")),
)


def goods() -> Vocabulary:
    return Vocabulary(GOODS)


NO_FASHION = ("hard", "basket", "umbrella", "reflector", "soft", "laundry", "pen")


def is_no_fashion(found: Column) -> Column:
    """From the labels of ``goods()`` that a name has. Some goods never are; a mesh basket may be a bag, an umbrella an earring, a
    reflector on clothes; a towel or pen may be part of something wearable."""
    has = lambda label: F.array_contains(found, label)
    return (
        F.when(~F.coalesce(F.arrays_overlap(found, F.array(*map(F.lit, NO_FASHION))), F.lit(False)), False)
        .when(has("hard") | has("only beside others") | ((has("basket") | has("basket beside others")) & ~has("bag")), True)
        .when(has("umbrella"), ~has("earring"))
        .when(has("reflector"), ~has("with reflectors"))
        .otherwise(~has("wearable") | ~has("soft"))
    )


# ---- sources ----

# States of a brand's onboarding after and before a first collection, and what makes a shop eligible.
COLLECTED = ("crawled", "imported", "embedded", "active")
ONBOARDING = ("tech_detected", "qc_failed")
ELIGIBLE = ("eligible_origin", "eligible_storefront")
FAMILIES = ("imweb", "sixshop")
WORTH_RETRYING = ("transient_exhausted", "db_read_failed", "db_write_exhausted")


def has_config(status: Column, origin: Column, eligibility: Column) -> Column:
    """Is a source's configuration generated? Once collected or blocked always, before that if it may sell to the market."""
    may = F.coalesce(origin == "KR", F.lit(False)) | F.coalesce(eligibility.isin(*ELIGIBLE), F.lit(False))
    return F.coalesce(status.isin(*COLLECTED, "blocked") | (status.isin(*ONBOARDING) & may), F.lit(False))


def engine_of(kind: Column, family: Column) -> Column:
    """The engine that reads a source, null if there is none."""
    return F.when(kind.isin("cafe24", "shopify"), kind).when((kind == "custom") & family.isin(*FAMILIES), family)


def is_runnable(status: Column, attempts: Column, most: int, code: Column, robots_unread: Column) -> Column:
    """May a batch run a source (again)? What failed in a way that time may mend, until ``most`` attempts."""
    again = F.coalesce(code.isin(*WORTH_RETRYING) | ((code == "external_block") & robots_unread), F.lit(False))
    return F.when(status == "success", False).when(status != "exception", True).otherwise(again & (attempts < most))


# ---- pages and names of a product ----

LEAST_NAME, CLOSE = 4, 0.8


def page_is_products(page: Page, html: Column, url: Column) -> Column:
    """Is a page that of the product at ``url``: by a canonical link, or by the product number that its script states?"""
    links = F.transform(select(page.nodes, "link[rel=canonical][href]"), lambda i: absolute(page.attribute(page.node(i), "href"), url))
    number = F.nullif(F.regexp_extract(html, r"\bvar\s+iProductNo\s*=\s*([0-9]+)\s*;", 1), F.lit(""))
    stated = absolute(F.concat(F.lit("/product/detail.html?product_no="), number), url)
    return F.coalesce(F.exists(links, lambda u: F.coalesce(same_page(u, url), F.lit(False))), F.lit(False)) | F.coalesce(same_page(stated, url), F.lit(False))


def name_core(name: Column) -> Column:
    """Letters and digits of a name only, without what some pages put before it."""
    return F.regexp_replace(F.regexp_replace(F.lower(composed(name)), r"^product\s*:\s*", ""), r"[^\p{L}\p{N}]", "")


def same_name(a: Column, b: Column) -> Column:
    """Do two names in ``name_core`` form mean one product: equal, or one inside the other and nearly as long?"""
    short, long = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    inside = (short / long > CLOSE) & (F.contains(a, b) | F.contains(b, a))
    return F.coalesce((short >= LEAST_NAME) & ((a == b) | inside), F.lit(False))
