"""Products that pages describe in linked data (JSON-LD) and in Open Graph tags, merged field by field.

Linked data is read as VARIANT. Its levels are arrays of values with the path to each, one
column a level, so no value is exploded and nothing is shuffled.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_html
from ..functions.urls import absolute, same_page
from .page_tree import Page, bound

# Keys below which products are nested, how deep, and what availability is called.
NESTED = ("@graph", "mainEntity", "itemListElement", "item")
DEEPEST = 6
GONE, THERE = ("outofstock", "soldout", "discontinued"), ("instock", "limitedavailability")
LONGEST = 2000
FIELDS = ("name", "description", "brand", "price", "currency", "images", "in_stock", "color", "sku", "url")

_LIST = "array<variant>"


def _get(value: Column, key: str, kind: str = "variant") -> Column:
    return F.try_variant_get(value, f"$['{key}']", kind)


def _is(value: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _string(value: Column) -> Column:
    """A string that is not blank, else null."""
    return bound(value, lambda v: F.when(_is(v, "STRING"), F.nullif(F.btrim(v.try_cast("string"), F.lit(" \t\n\r")), F.lit(""))))


def _text(value: Column, key: str) -> Column:
    return _string(_get(value, key))


def _items(value: Column) -> Column:
    """The elements of a list, or the value itself as the only one."""
    return bound(value, lambda v: F.when(_is(v, "ARRAY"), v.try_cast(_LIST)).when(v.isNotNull(), F.array(v)).otherwise(F.array().cast(_LIST)))


def _type_is(value: Column, name: str) -> Column:
    return F.exists(_items(_get(value, "@type")), lambda t: F.coalesce(F.lower(_string(t)) == name.lower(), F.lit(False)))


def parse_block(raw: Column) -> Column:
    """A block of linked data as VARIANT; comments and commas before a closing bracket are
    forgiven, other broken blocks are null."""
    mended = F.regexp_replace(F.regexp_replace(raw, r"(?s)<!--.*?-->", ""), r",\s*([}\]])", "$1")
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(mended))


def _entry(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"))


def _is_product(entry: Column) -> Column:
    return _is(entry["value"], "OBJECT") & _type_is(entry["value"], "Product")


def _below(entry: Column) -> Column:
    """The values that a value leads to: a list's elements, what an object has under ``NESTED``."""
    path, value = entry["path"], entry["value"]
    keyed = [F.array(_entry(F.concat(path, F.array(F.lit(k), F.lit(0))), _get(value, key))) for k, key in enumerate(NESTED)]
    listed = F.transform(value.try_cast(_LIST), lambda v, k: _entry(F.concat(path, F.array(F.lit(0), k)), v))
    return F.when(_is(value, "ARRAY"), listed).when(_is(value, "OBJECT"), F.concat(*keyed)).otherwise(F.array())


def with_product_nodes(df: DataFrame, data: Column, name: str) -> DataFrame:
    """With ``name``: all product nodes of a page's blocks as VARIANTs, in the order in which they stand
    there. Lists, and the keys in ``NESTED`` of nodes that are no products, are followed down to ``DEEPEST`` steps."""
    there = lambda e: F.coalesce(e["value"].isNotNull(), F.lit(False))
    out = df.withColumn("_level", F.filter(F.transform(data, lambda raw, k: _entry(F.array(k), parse_block(raw))), there)).withColumn("_found", F.array().cast("array<struct<path array<int>, value variant>>"))
    for depth in range(DEEPEST + 1):
        out = out.withColumn("_found", F.concat("_found", F.filter("_level", _is_product)))
        if depth < DEEPEST:
            out = out.withColumn("_level", F.filter(F.flatten(F.transform(F.filter("_level", lambda e: ~_is_product(e)), _below)), there))
    order = lambda a, b: F.when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0)
    return out.withColumn(name, F.transform(F.array_sort("_found", order), lambda e: e["value"])).drop("_level", "_found")


def _price(value: Column) -> Column:
    """A number, or the digits and points of a string."""
    digits = lambda v: F.nullif(F.regexp_replace(v.try_cast("string"), "[^0-9.]", ""), F.lit("")).try_cast("double")
    return bound(value, lambda v: F.when(_is(v, "STRING"), digits(v)).otherwise(v.try_cast("double")))


def availability(text: Column) -> Column:
    """Is it in stock? Null if the text doesn't say."""
    letters = F.regexp_replace(F.lower(text), "[^a-z]", "")
    names = lambda words: functools.reduce(lambda a, w: a | F.contains(letters, F.lit(w)), words, F.lit(False))
    return F.when(names(GONE), False).when(names(THERE), True)


_OFFER = "struct<price double, currency string, in_stock boolean>"


def _single_offer(offer: Column) -> Column:
    spec = _get(offer, "priceSpecification")
    return F.struct(F.coalesce(_price(_get(offer, "price")), _price(_get(spec, "price"))).alias("price"), F.coalesce(_text(offer, "priceCurrency"), _text(spec, "priceCurrency")).alias("currency"), availability(_text(offer, "availability")).alias("in_stock"))


def _best(offers: Column) -> Column:
    """The first offer that has a price or says whether it is in stock."""
    return F.get(F.filter(offers, lambda o: o["price"].isNotNull() | o["in_stock"].isNotNull()), 0).cast(_OFFER)


def _any_offer(offer: Column) -> Column:
    def summed(inner: Column) -> Column:
        return F.struct(
            F.coalesce(inner["price"], _price(F.coalesce(_get(offer, "lowPrice"), _get(offer, "highPrice")))).alias("price"),
            F.coalesce(inner["currency"], _text(offer, "priceCurrency")).alias("currency"), F.coalesce(inner["in_stock"], availability(_text(offer, "availability"))).alias("in_stock"),
        )

    return F.when(_type_is(offer, "AggregateOffer"), bound(_best(F.transform(_items(_get(offer, "offers")), _single_offer)), summed)).otherwise(_single_offer(offer))


def _images(value: Column, url: Column) -> Column:
    each = lambda v: F.coalesce(_string(v), _text(v, "url"), _text(v, "contentUrl"))
    return web_images(F.transform(_items(value), each), url)


def web_images(addresses: Column, url: Column) -> Column:
    whole = F.transform(F.array_compact(addresses), lambda a: absolute(a, url))
    return F.array_distinct(F.filter(whole, lambda a: F.coalesce(F.rlike(a, F.lit("(?i)^https?://")), F.lit(False))))


def linked_product(node: Column, url: Column) -> Column:
    """The fields of a product node."""

    def fields(offer: Column) -> Column:
        said = F.nullif(F.substring(strip_html(_text(node, "description")), 1, LONGEST), F.lit(""))
        brand = F.coalesce(_text(node, "brand"), _text(_get(node, "brand"), "name"))
        values = [_text(node, "name"), said, brand, offer["price"], offer["currency"], _images(_get(node, "image"), url), offer["in_stock"], _text(node, "color"), F.coalesce(_text(node, "sku"), _text(node, "productID")), _text(node, "url")]
        return F.struct(*[v.alias(n) for n, v in zip(FIELDS, values, strict=True)])

    return bound(_best(F.transform(_items(_get(node, "offers")), _any_offer)), fields)


# The tags by which a block of Open Graph tags begins, and those that hold its image.
IDENTITY = ("og:type", "og:url", "og:title")
IMAGES = ("og:image", "og:image:secure_url")


def graph_tags(page: Page) -> Column:
    """``key, content`` of the Open Graph tags of the page's last block. A block ends where one of
    ``IDENTITY`` comes again; tags after the block's last image already belong to the next one if they
    identify something and the one that comes again is not among them."""
    metas = F.transform(F.filter(page.nodes, lambda n: n["tag"] == "meta"), lambda n: F.struct(F.lower(F.coalesce(page.attribute(n, "property"), page.attribute(n, "name"))).alias("key"), F.nullif(F.trim(page.attribute(n, "content")), F.lit("")).alias("content")))
    tags = F.filter(metas, lambda m: F.startswith(m["key"], F.lit("og:")) | F.startswith(m["key"], F.lit("product:")))

    def last_block(tags: Column) -> Column:
        begin = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("at"), F.lit(-1).alias("image"), *[F.lit(-1).alias(f"k{j}") for j in range(len(IDENTITY))])

        def read(held: Column, tag: Column) -> Column:
            seen = functools.reduce(lambda a, j: a.when(tag["key"] == IDENTITY[j], held[f"k{j}"]), range(len(IDENTITY)), F.when(F.lit(False), -1)).otherwise(-1)
            latest = F.greatest(*[held[f"k{j}"] for j in range(len(IDENTITY))])
            again = seen >= held["begin"]
            carried = (held["image"] >= held["begin"]) & (latest > held["image"]) & (seen < held["image"])
            start = F.when(again & carried, held["image"] + 1).when(again, held["at"]).otherwise(held["begin"])
            places = [F.when(tag["key"] == name, held["at"]).otherwise(held[f"k{j}"]).alias(f"k{j}") for j, name in enumerate(IDENTITY)]
            return F.struct(start.alias("begin"), (held["at"] + 1).alias("at"), F.when(tag["key"].isin(*IMAGES), held["at"]).otherwise(held["image"]).alias("image"), *places)

        return F.slice(tags, F.aggregate(tags, begin, read)["begin"] + 1, F.greatest(F.size(tags), F.lit(0)))

    return bound(tags, last_block)


def graph_product(tags: Column, url: Column) -> Column:
    """The fields of Open Graph tags; null if they tell of no product."""

    def last(key: str) -> Column:
        contents = F.transform(F.filter(tags, lambda t: (t["key"] == key) & t["content"].isNotNull()), lambda t: t["content"])
        return F.get(contents, F.size(contents) - 1)

    value = lambda *keys: F.coalesce(*map(last, keys))
    price = F.nullif(F.regexp_replace(value("product:price:amount", "og:price:amount"), "[^0-9.]", ""), F.lit("")).try_cast("double")
    none = F.lit(None).cast("string")
    values = [value("og:title"), value("og:description"), value("product:brand"), price, value("product:price:currency", "og:price:currency"), web_images(F.array(value("og:image")), url), availability(value("product:availability", "og:availability")), none, none, value("og:url")]
    return F.when(F.coalesce(F.contains(F.lower(value("og:type")), F.lit("product")), F.lit(False)) | price.isNotNull(), F.struct(*[v.alias(n) for n, v in zip(FIELDS, values, strict=True)]))


def _merged(linked: Column, graph: Column) -> Column:
    """Field by field, linked data first."""

    def field(name: str) -> Column:
        own, other = linked[name], graph[name]
        return F.when(F.size(own) > 0, own).otherwise(F.coalesce(other, own)) if name == "images" else F.coalesce(own, other)

    source = F.when(graph.isNull(), "jsonld").when(linked.isNull(), "og").otherwise("merged")
    return F.when(linked.isNotNull() | graph.isNotNull(), F.struct(*[field(n).alias(n) for n in FIELDS], source.alias("source")))


def with_structured_product(df: DataFrame, tree: str, url: str, name: str = "product") -> DataFrame:
    """``df`` with ``name``: ``FIELDS`` and ``source`` of the product that a page (column ``tree``, from
    ``page_tree``) is about, null if there is none: the product node whose address is that of the
    page, or the only one if it has none, merged with the Open Graph tags if they are not of another page."""
    own = lambda u: F.coalesce(same_page(u, F.col(url)), F.lit(False))
    out = with_product_nodes(df, F.col(tree)["data"], "_nodes")
    out = out.withColumn("_linked", F.transform("_nodes", lambda n: linked_product(n, F.col(url))))
    only = F.get("_linked", 0)
    chosen = F.coalesce(F.get(F.filter("_linked", lambda p: own(p["url"])), 0), F.when((F.size("_linked") == 1) & only["url"].isNull(), only))
    out = out.withColumn("_linked", chosen).withColumn("_tags", graph_tags(Page(F.col(tree)))).withColumn("_graph", graph_product(F.col("_tags"), F.col(url)))
    out = out.withColumn("_graph", F.when(F.col("_graph.url").isNull() | own(F.col("_graph.url")), F.col("_graph")))
    return out.withColumn(name, _merged(F.col("_linked"), F.col("_graph"))).drop("_nodes", "_linked", "_tags", "_graph")
