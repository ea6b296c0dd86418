"""Entries of listings, whatever shop system they come from, as one struct ``ENTRY``.

Payloads are read with an explicit schema; an entry that can't be sold or shown (no name, link or
price) is null, and so is every field that a payload doesn't have.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.urls import absolute, host
from .page_tree import bound

ENTRY = (
    "struct<brand string, name string, product_url string, product_code string, price double, original_price double, sale_price double, state string, currency string,"
    " in_stock boolean, images array<string>, size_info string, gender array<string>, category string>"
)


def priced(current: Column, original: Column, sale: Column | None = None, known: bool = True) -> dict[str, Column]:
    """``price, original_price, sale_price, state``: on sale if the sale price is below the original one."""
    none = F.lit(None).cast("double")
    sale = F.when(current < original, current) if sale is None else sale
    state = F.when(sale.isNotNull(), "sale").when(current.isNotNull(), "regular").otherwise("unknown") if known else F.lit("unknown")
    return {"price": F.coalesce(sale, current), "original_price": F.coalesce(original, current) if known else none, "sale_price": sale, "state": state}


def entry(when: Column, **fields: Column | str | None) -> Column:
    """``ENTRY`` where ``when`` holds, else null."""
    columns = [x.split()[0] for x in ENTRY[len("struct<") : -1].split(", ")]
    value = lambda v: v if isinstance(v, Column) else F.lit(v)
    whole = F.struct(*[value(fields.get(c)).alias(c) for c in columns]).cast(ENTRY)
    return F.when(F.coalesce(when, F.lit(False)), whole)


def at(value: Column, path: str) -> Column:
    """A field of a field."""
    return functools.reduce(lambda c, name: c[name], path.split("."), value)


def said(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def positive(value: Column) -> Column:
    return F.when(value > 0, value)


# ---- catalogue interfaces ----

ITEM = (
    "struct<productId string, name string, genderName string, genderCategory string, prices struct<base struct<value double>, promo struct<value double>>,"
    " representative struct<sales boolean, color struct<displayCode string>>, representativeColorDisplayCode string, sizes array<struct<name string>>,"
    " images struct<main map<string, struct<image string>>, sub array<struct<image string>>>>"
)
ITEMS = f"struct<result struct<items array<{ITEM}>>>"
LONGEST_SIZES = 200


def item_images(item: Column, hosts: tuple[str, ...]) -> Column:
    """Of allowed hosts, each once: that of the representative colour, those of the others (numbers first, in their order), the further ones."""
    main = at(item, "images.main")
    chosen = F.coalesce(at(item, "representative.color.displayCode"), item["representativeColorDisplayCode"])
    order = lambda e, k: F.struct((~F.rlike(e["key"], F.lit("^(?:0|[1-9][0-9]*)$"))).alias("named"), F.when(F.rlike(e["key"], F.lit("^(?:0|[1-9][0-9]*)$")), e["key"].try_cast("long")).alias("number"), k.alias("place"), at(e, "value.image").alias("image"))
    others = F.transform(F.array_sort(F.transform(F.map_entries(main), order)), lambda e: e["image"])
    more = F.transform(at(item, "images.sub"), lambda s: s["image"])
    none = F.array().cast("array<string>")
    every = F.concat(F.array(F.try_element_at(main, chosen)["image"]), F.coalesce(others, none), F.coalesce(more, none))
    return F.array_distinct(F.filter(every, lambda u: F.coalesce(F.startswith(u, F.lit("https://")) & host(u).isin(*hosts), F.lit(False))))


def catalogue_items(payload: Column, base_url: str, brand: str, currency: str, image_hosts: tuple[str, ...]) -> Column:
    """The entries of an interface that lists items with a base and a promotional price; a promotion counts if it is
    below the base. An item without a price is listed as of unknown price."""

    def one(item: Column) -> Column:
        base, promo = at(item, "prices.base.value"), at(item, "prices.promo.value")
        sale = F.when(promo < base, promo)
        sizes = F.substring(F.array_join(F.filter(F.transform(item["sizes"], lambda s: s["name"]), lambda n: n != ""), ", "), 1, LONGEST_SIZES)
        who = F.lower(said(item["genderName"]))
        return entry(
            said(item["productId"]).isNotNull(), brand=brand, name=F.coalesce(item["name"], F.lit("")), product_url=F.concat(F.lit(f"{base_url}/products/"), item["productId"]), product_code=item["productId"], **priced(base, base, sale),
            currency=currency, in_stock=F.coalesce(at(item, "representative.sales"), F.lit(True)), images=item_images(item, image_hosts), size_info=F.nullif(sizes, F.lit("")), gender=F.when(who.isNotNull(), F.array(who)).otherwise(F.array()), category=F.coalesce(item["genderCategory"], F.lit("")),
        )

    return F.array_compact(F.transform(at(F.from_json(payload, ITEMS), "result.items"), one))


# ---- widgets of shop pages ----

WIDGET = "struct<name string, code string, original_price string, price string, image_url string>"


def whole_amount(text: Column) -> Column:
    """The digits and points of a number or text, rounded; null unless above 0."""
    return positive(F.round(F.nullif(F.regexp_replace(text, "[^0-9.]", ""), F.lit("")).try_cast("double")))


def widget_entry(properties: Column, link: Column, sold_out: Column, brand: str | None = None, currency: str = "KRW") -> Column:
    """The entry of a list widget whose properties are JSON; amounts may be numbers or texts. On sale if the price is below the original one."""

    def one(p: Column) -> Column:
        original = whole_amount(p["original_price"])
        price = F.coalesce(whole_amount(p["price"]), original)
        image = F.when(F.rlike(p["image_url"], F.lit("^https?://")), p["image_url"])
        return entry(
            said(p["name"]).isNotNull() & said(link).isNotNull() & price.isNotNull(), brand=brand or "", name=said(p["name"]), product_url=link, product_code=p["code"], **priced(price, original),
            currency=currency, in_stock=~F.coalesce(sold_out, F.lit(False)), images=F.array_compact(F.array(image)),
        )

    return bound(F.from_json(properties, WIDGET), one)


# ---- two versions of one shop system ----

GRADED = "struct<id string, name string, address string, soldOut boolean, thumbnails array<string>, price struct<regularPrice double, currency string, groupByGradeId map<string, struct<salesPrice double>>>>"
#: Whose price counts, and where uploaded images are, by what their address begins with.
GRADES = ("-2", "-1")
UPLOADED = {"/uploadedFiles/": "https://contents.sixshop.com"}


def graded_entry(row: Column, base_url: str, brand: str, currency: str = "KRW", product_path: str = "product") -> Column:
    """First version: the price of the first grade of customers in ``GRADES`` counts if it is below the regular one."""

    def one(r: Column) -> Column:
        regular = positive(at(r, "price.regularPrice"))
        grade = positive(F.coalesce(*[F.try_element_at(at(r, "price.groupByGradeId"), F.lit(g))["salesPrice"] for g in GRADES]))
        picture = F.get(F.filter(r["thumbnails"], lambda t: said(t).isNotNull()), 0)
        home = F.coalesce(*[F.when(F.startswith(picture, F.lit(p)), f"{h}/") for p, h in UPLOADED.items()], F.lit(f"{base_url}/"))
        own = at(r, "price.currency")
        return entry(
            said(r["name"]).isNotNull() & said(r["address"]).isNotNull() & regular.isNotNull(), brand=brand, name=said(r["name"]), product_url=F.concat(F.lit(f"{base_url}/{product_path}/"), F.trim(r["address"])), product_code=r["id"],
            **priced(regular, regular, F.when(grade < regular, grade)), currency=F.when(F.rlike(own, F.lit("^[A-Z]{3}$")), own).otherwise(currency), in_stock=~F.coalesce(r["soldOut"], F.lit(False)), images=F.array_compact(F.array(absolute(picture, home))),
        )

    return bound(F.from_json(row, GRADED), one)


SLUGGED = "struct<name string, slug string, managementCode string, isOutOfStock boolean, availability string, price struct<original double, sale double>, images array<struct<url string>>>"


def slugged_entry(row: Column, base_url: str, brand: str, currency: str = "KRW") -> Column:
    """Second version: original and sale price, images as a list."""

    def one(r: Column) -> Column:
        regular = positive(at(r, "price.original"))
        current = F.coalesce(positive(at(r, "price.sale")), regular)
        gone = F.coalesce(r["isOutOfStock"], F.lit(False)) | F.coalesce(r["availability"] == "out-of-stock", F.lit(False))
        return entry(
            said(r["name"]).isNotNull() & said(r["slug"]).isNotNull() & regular.isNotNull(), brand=brand, name=said(r["name"]), product_url=F.concat(F.lit(f"{base_url}/products/"), F.trim(r["slug"])), product_code=r["managementCode"],
            **priced(current, regular), currency=currency, in_stock=~gone, images=F.coalesce(F.array_compact(F.transform(r["images"], lambda i: said(i["url"]))), F.array().cast("array<string>")),
        )

    return bound(F.from_json(row, SLUGGED), one)


# ---- cards ----

# The sign before an amount, what an amount looks like and what is plausible, by currency.
CARDS = {"KRW": ("₩", r"[0-9,]+", 1_000, 100_000_000), "USD": ("$", r"[0-9,]+(?:\.[0-9]+)?", 5, 100_000)}


def card_amounts(text: Column, currency: str) -> Column:
    """The amounts above 0 of a card's price text, in order."""
    sign, amount, _, _ = CARDS[currency]
    found = F.regexp_extract_all(text, F.lit(rf"[{sign}]\s*({amount})"), 1)
    return F.filter(F.transform(found, lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double")), lambda v: v > 0)


def card_entry(card: Column, currency: str, hosts: tuple[str, ...], image_hosts: tuple[str, ...]) -> Column:
    """The entry of a card ``href, brand, name, price_text, image_url``: the last amount is the current price, a higher
    first one the original; the product's number stands at the end of its address."""
    _, _, least, most = CARDS[currency]

    def one(c: Column) -> Column:
        amounts = card_amounts(c["price_text"], currency)
        return bound(F.struct(F.try_element_at(amounts, F.lit(-1)).alias("price"), F.get(amounts, 0).alias("first"), F.size(amounts).alias("n")), lambda a: of(c, a))

    def of(c: Column, a: Column) -> Column:
        sale = F.when((a["n"] >= 2) & (a["first"] > a["price"]), a["price"])
        number = F.regexp_extract(c["href"], r"-item-([0-9]+)\.aspx$", 1)
        good = said(c["brand"]).isNotNull() & said(c["name"]).isNotNull() & host(c["href"]).isin(*hosts) & (number != "") & F.startswith(c["image_url"], F.lit("https://")) & host(c["image_url"]).isin(*image_hosts) & a["price"].between(least, most)
        return entry(
            good, brand=c["brand"], name=c["name"], product_url=c["href"], product_code=number, **priced(a["price"], F.when(sale.isNotNull(), a["first"]).otherwise(a["price"]), sale),
            currency=currency, in_stock=F.lit(True), images=F.array(c["image_url"]), category="",
        )

    return bound(card, one)
