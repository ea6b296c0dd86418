"""Products of Shopify catalogue pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import observed_pricing

PAGE = """struct<products: array<struct<title: string, handle: string, vendor: string, product_type: string, tags: array<string>,
  options: array<struct<name: string, position: int>>, images: array<struct<src: string>>,
  variants: array<struct<price: string, compare_at_price: string, available: boolean, option1: string, option2: string, option3: string>>>>>"""

# Names of size options, what is no product, and hosts of images besides the shop's own.
SIZES = "size|length|taille|größe|taglia|talla|사이즈|치수"
NO_TITLES = ("return protection", "shipping protection", "package protection")
NO_TYPES = ("lookbook", "gift card", "gift-card")
NO_VENDORS = ("Rise.ai",)
IMAGE_HOSTS = r"^(?:cdn\.shopify\.com|.*\.myshopify\.com|.*\.shopifycdn\.com)$"
MOST_SIZES, MOST_TAGS, MOST_TAG = 200, 50, 100


def number(text: Column) -> Column:
    """The number that a text begins with."""
    return F.nullif(F.regexp_extract(text, r"^\s*([+-]?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def is_product(p: Column, excluded_tags: list[str], excluded_handles: list[str]) -> Column:
    title, kind = F.lower(p["title"]), F.lower(F.coalesce(p["product_type"], F.lit("")))
    other = F.startswith(title, F.lit("lookbook")) | F.endswith(title, F.lit("gift card")) | title.isin(*NO_TITLES) | kind.isin(*NO_TYPES) | p["vendor"].isin(*NO_VENDORS)
    tags = F.transform(F.coalesce(p["tags"], F.array().cast("array<string>")), lambda t: F.lower(F.trim(t)))
    unwanted = F.arrays_overlap(tags, F.array(*[F.lit(t.strip().lower()) for t in excluded_tags])) if excluded_tags else F.lit(False)
    unwanted = unwanted | (p["handle"].isin(*excluded_handles) if excluded_handles else F.lit(False))
    return ~F.coalesce(other, F.lit(False)) & ~F.coalesce(unwanted, F.lit(False)) & F.coalesce(F.rlike(p["handle"], F.lit("^[a-z0-9][a-z0-9-]*$")), F.lit(False))


def parse_products(df: DataFrame, id_: str, payload: str, base_url: str, excluded_tags: list[str] = (), excluded_handles: list[str] = (), keep_sold_out: bool = False, brand: str | None = None, brand_fallback: str = "") -> DataFrame:
    """A row a product of the pages: ``id_, handle, product_url, name, brand, product_type,
    in_stock, pricing, size_info, images, image_url, tags``.

    Lookbooks, gift cards, insurances, unsafe handles, unwanted tags and handles, products
    without a price and (unless kept) sold out ones are left out. The cheapest variant on
    sale gives the price, else the cheapest; of a product in stock only available variants
    count. Images are kept from the shop's own host and Shopify's. A broken page has no products."""
    host = F.regexp_extract(F.lit(base_url), r"^[a-z]+://([^/:?#]+)", 1)
    p = F.col("_p")
    rows = df.select(id_, F.explode(F.from_json(payload, PAGE)["products"]).alias("_p")).filter(is_product(p, list(excluded_tags), list(excluded_handles)))
    stock = F.coalesce(F.exists(p["variants"], lambda v: F.coalesce(v["available"], F.lit(False))), F.lit(False))
    rows = rows.withColumn("in_stock", stock).filter(F.col("in_stock") | F.lit(keep_sold_out))
    usable = F.filter(p["variants"], lambda v: F.coalesce(v["available"], F.lit(False)) | ~F.col("in_stock"))
    entry = lambda v, i: F.struct(number(v["price"]).alias("price"), i.alias("place"), number(v["compare_at_price"]).alias("before"))
    rows = rows.withColumn("_priced", F.filter(F.transform(usable, entry), lambda e: e["price"] > 0))
    rows = rows.withColumn("_sale", F.array_min(F.filter("_priced", lambda e: e["before"] > e["price"]))).withColumn("_any", F.array_min("_priced")).filter("_any is not null")
    on_sale = F.col("_sale").isNotNull()
    best = F.coalesce("_sale", "_any")
    pricing = observed_pricing(best["price"], best["before"], F.when(on_sale, best["price"]), F.when(on_sale, "sale").otherwise("regular"), F.lit("variant"))
    at = F.try_element_at(F.filter(p["options"], lambda o: F.rlike(F.lower(o["name"]), F.lit(SIZES))), F.lit(-1))["position"]
    picked = F.array_distinct(F.filter(F.transform(p["variants"], lambda v: F.when(at == 1, v["option1"]).when(at == 2, v["option2"]).when(at == 3, v["option3"])), lambda s: F.coalesce((s != "") & (s != "Default Title"), F.lit(False))))
    own = lambda src: F.regexp_extract(src, r"^https://([^/:?#]+)", 1)
    images = F.filter(F.transform(p["images"], lambda i: i["src"]), lambda s: F.coalesce((own(s) != "") & ((own(s) == host) | F.rlike(own(s), F.lit(IMAGE_HOSTS))), F.lit(False)))
    return rows.select(
        id_, p["handle"].alias("handle"), F.concat(F.lit(f"{base_url}/products/"), p["handle"]).alias("product_url"), p["title"].alias("name"), (F.lit(brand) if brand else F.coalesce(F.nullif(p["vendor"], F.lit("")), F.lit(brand_fallback))).alias("brand"), p["product_type"].alias("product_type"), "in_stock", pricing.alias("pricing"),
        F.when(F.size(picked) > 0, F.substring(F.array_join(picked, ", "), 1, MOST_SIZES)).alias("size_info"), images.alias("images"), F.coalesce(F.get(images, 0), F.lit("")).alias("image_url"), F.transform(F.slice(F.coalesce(p["tags"], F.array().cast("array<string>")), 1, MOST_TAGS), lambda t: F.substring(t, 1, MOST_TAG)).alias("tags"),
    )
