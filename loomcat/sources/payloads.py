"""Parsers of storefront payloads: JSON, cards, price texts and structured data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise

VARIANTS = "struct<variants: array<struct<compare_at_price: double, price: double, available: boolean>>>"


#: A product with at most so many variants has one payload.
FEW = 1024


def shopify_payloads(variants: DataFrame, id_: str, order: str, line: str, variant: Column) -> DataFrame:
    """``id_, payload``: payloads of at most 1024 variants, however many a product has.

    A product with at most ``FEW`` has one. Of those with more a payload holds 64 whole numbers
    of ``order`` and 16 of ``line``, which are together the key of ``variants``."""
    large = materialise(variants.groupBy(id_).agg(F.count("*").alias("_n")).filter(F.col("_n") > FEW).select(id_, F.lit(True).alias("_large")), "large-products")
    cut = lambda name, width: F.when(F.col("_large") | F.col(id_).isNull(), F.floor(F.col(name) / width))
    dealt = variants.join(large, id_, "left").withColumns({"_orders": cut(order, 64), "_lines": cut(line, 16)})
    return dealt.groupBy(id_, "_orders", "_lines").agg(F.to_json(F.struct(F.collect_list(variant).alias("variants"))).alias("payload")).drop("_orders", "_lines")


def shopify_variants(df: DataFrame, id_: str, payload: str) -> DataFrame:
    """One row a product, of all its payloads: price of the cheapest variant on sale, else of the cheapest."""
    v = F.col("_variants")
    least = lambda a: F.array_min(F.transform(a, lambda x: x["price"]))
    on_sale = F.filter(v, lambda x: x["price"] < x["compare_at_price"])
    read = df.select(id_, F.from_json(payload, VARIANTS)["variants"].alias("_variants"))  # a step of its own, so that a payload is parsed once
    parsed = read.select(id_, least(on_sale).alias("sale"), least(v).alias("price"), F.size(v).cast("long").alias("variants"), F.exists(v, lambda x: x["available"]).alias("in_stock"))
    return parsed.groupBy(id_).agg(F.coalesce(F.min("sale"), F.min("price")).alias("price"), F.sum("variants").alias("variants"), F.bool_or("in_stock").alias("in_stock"))


def price_in(text: Column) -> Column:
    """The first amount with two decimals."""
    return F.expr("double(1)") * F.nullif(F.replace(F.regexp_extract(text, r"(-?[0-9][0-9,]*\.[0-9]{2})", 1), F.lit(","), F.lit("")), F.lit("")).try_cast("double")


def currency_in(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"([A-Z]{3})$", 1), F.lit(""))


def card_price(text: Column, low: int = 1, high: int = 1_000_000_000) -> Column:
    """``price, original`` of a listing card: the last token is the current price."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(r"([0-9][0-9,]*)"), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("long"))
    sane = F.filter(tokens, lambda x: x.between(low, high))
    current, first = F.try_element_at(sane, F.lit(-1)), F.try_element_at(sane, F.lit(1))
    return F.struct(current.alias("price"), F.greatest(first, current).alias("original"))


def best_srcset(srcset: Column) -> Column:
    """``width, url`` of the widest candidate; densities count as 1000 a unit."""
    entries = F.transform(F.split(srcset, r",\s+"), lambda x: F.split(F.trim(x), r"\s+"))
    size = lambda d: F.when(F.endswith(d, F.lit("x")), F.regexp_replace(d, "x$", "").try_cast("double") * 1000).otherwise(F.regexp_replace(d, "w$", "").try_cast("double"))
    return F.array_max(F.transform(entries, lambda e: F.struct(F.coalesce(size(F.get(e, 1)), F.lit(0.0)).alias("width"), F.get(e, 0).alias("url"))))


LD = "struct<`@type`: string, name: string, brand: string, offers: struct<price: string, availability: string>>"


def structured_products(df: DataFrame, id_: str, html: str) -> DataFrame:
    """``name, brand, price, in_stock`` of a page's first Product node; broken blocks are skipped."""
    bodies = F.regexp_extract_all(F.col(html), F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), 1)
    nodes = F.transform(bodies, lambda b: F.coalesce(F.from_json(b, f"struct<`@graph`: array<{LD}>>")["@graph"], F.array(F.from_json(b, LD))))
    products = F.filter(F.flatten(F.array_compact(nodes)), lambda n: n["@type"] == "Product")
    p = F.get(products, 0)
    return df.select(id_, p["name"].alias("name"), p["brand"].alias("brand"), p["offers"]["price"].try_cast("double").alias("price"), F.endswith(p["offers"]["availability"], F.lit("InStock")).alias("in_stock"))


def guarded_cell(value: Column) -> Column:
    """A CSV cell that no spreadsheet takes for a formula."""
    return F.when(F.rlike(value, F.lit("^[=+@-]")), F.concat(F.lit("'"), value)).otherwise(value)


def scan_products(spark, folder: str, schema: str, sites: list[str] | None = None) -> DataFrame:
    """JSON array files ``<site>-products.json`` with their ``site``; fails if one is missing."""
    rows = spark.read.schema(schema).option("multiLine", True).json(f"{folder}/*-products.json")
    rows = rows.withColumn("site", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)-products\.json$", 1))
    if sites is not None:
        rows = rows.filter(F.col("site").isin(sites))
        missing = set(sites) - {r[0] for r in rows.select("site").distinct().limit(len(sites) + 1).collect()}
        if missing:
            raise ValueError(f"no product file for {sorted(missing)}")
    return rows
