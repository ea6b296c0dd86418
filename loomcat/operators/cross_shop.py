"""One product in two shops: rows of a brand's own shop and of retailers that show the same thing.

Rows agree on brand, name and category. Of such pairs, those of one colour whose images are
chosen, whose addresses share a product number and whose images are equal (cosine distance at most ``EXACT``)
are matches. Pairs are counted from the sizes of groups, and only matches are ever looked for: rows meet
by a number of their addresses, the rarest that they share, and by cells of what two fixed
directions see of their images, which equal images share or neighbour. Rows of one shop that
are alike in all of this are one class, so copies make no pairs either.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import cosine_distance
from ..functions.urls import path, values_of
from ..scratch import materialise

EXACT = 0.01
SAME = ["brand", "name", "category"]
# How long a product number is at least, of digits alone, and of capitals, digits, - and _ with both a capital and a digit.
LEAST_DIGITS, LEAST_MIXED = 5, 8


def _is_number(part: Column) -> Column:
    made_of = lambda kinds: F.rlike(part, F.lit(f"^[{kinds}]+$"))
    holds = lambda kind: F.rlike(part, F.lit(f"[{kind}]"))
    return (made_of("0-9") & (F.length(part) >= LEAST_DIGITS)) | (made_of("A-Z0-9_-") & (F.length(part) >= LEAST_MIXED) & holds("A-Z") & holds("0-9"))


def source_numbers(url: Column) -> Column:
    """The product numbers of an address, from its query and the parts of its path."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.concat(values_of(query, "product_no"), values_of(query, "productNo"), F.split(path(url), "/"))
    return F.array_distinct(F.filter(F.transform(parts, lambda p: F.upper(F.trim(p))), _is_number))


def cross_shop_decision(same_brand: Column, platforms: tuple[Column, Column], hosts: tuple[Column, Column], colours: tuple[Column, Column], ready: tuple[Column, Column], same_name: Column, same_category: Column, shared: Column, distance: Column) -> Column:
    """``status, confidence, reason`` of two rows; ``shared`` is a source number of both or null, ``distance`` that of their images or null."""
    out = lambda status, confidence, reason: F.struct(F.lit(status).alias("status"), (confidence if isinstance(confidence, Column) else F.lit(float(confidence))).alias("confidence"), F.lit(reason).alias("reason"))
    sure = lambda c: F.coalesce(c, F.lit(False))
    exact = sure(distance <= EXACT)
    steps = [
        (~sure(same_brand), out("reject", 1, "brand_conflict")),
        (sure(platforms[0] == platforms[1]), out("reject", 1, "same_platform")),
        (~sure(hosts[0] != hosts[1]), out("reject", 1, "not_cross_shop")),
        (colours[0].isNull() | colours[1].isNull(), out("review", 0, "color_evidence_missing")),
        (colours[0] != colours[1], out("reject", 1, "color_conflict")),
        (sure(~ready[0]) | sure(~ready[1]), out("review", 0, "pending_image_selection")),
        (~sure(same_name) | ~sure(same_category), out("reject", 1, "product_description_conflict")),
        (shared.isNotNull() & exact, out("auto", 0.999, "cross_shop_source_token_and_image_exact")),
    ]
    last = out("review", F.when(exact | shared.isNotNull(), 0.95).otherwise(0.7), "cross_shop_corroboration_missing")
    return functools.reduce(lambda a, s: a.when(*s), steps[1:], F.when(*steps[0])).otherwise(last)


def _pairs(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``name``: how many pairs of an official and a retailer's row agree on ``keys`` and are of different hosts; one row.
    Counted from groups: all pairs less those of one host."""
    count = lambda by: rows.groupBy(*by).agg(F.count_if("official").alias("a"), F.count_if("retailer").alias("b"))
    total = lambda by: count(by).agg(F.coalesce(F.sum((F.col("a") * F.col("b")).cast("decimal(38,0)")), F.lit(0)).alias("n"))
    return total(keys).select(F.col("n").alias("_all")).crossJoin(total([*keys, "host"])).select((F.col("_all") - F.col("n")).cast("long").alias(name))  # two single rows


def cascade(rows: DataFrame, matches: DataFrame) -> DataFrame:
    """``preliminary, coloured, ready, matched``: the pairs that are left after each step. ``rows`` has ``SAME``, ``host, colour,
    ready, official, retailer``; ``matches`` is from ``cross_shop_matches``."""
    known = materialise(rows.filter(" and ".join(f"{c} is not null" for c in [*SAME, "host"])).select(*SAME, "host", "colour", "ready", "official", "retailer"), "cross-shop-rows")
    coloured = known.filter("colour is not null")
    steps = [_pairs(known, SAME, "preliminary"), _pairs(coloured, [*SAME, "colour"], "coloured"), _pairs(coloured.filter("ready"), [*SAME, "colour"], "ready")]
    out = functools.reduce(lambda a, b: a.crossJoin(b), steps)  # single rows
    return out.crossJoin(matches.agg(F.coalesce(F.sum(F.col("officials") * F.col("retailers")), F.lit(0)).alias("matched")))


def _directions(size: int) -> list[list[float]]:
    """Two directions of length 1, at right angles: what they see of two equal images differs by little."""
    flat = [[math.cos(0.7 + 1.3 * k * (d + 1)) for k in range(size)] for d in range(2)]
    length = lambda v: math.sqrt(sum(x * x for x in v))
    first = [x / length(flat[0]) for x in flat[0]]
    along = sum(x * y for x, y in zip(first, flat[1], strict=True))
    rest = [y - along * x for x, y in zip(first, flat[1], strict=True)]
    return [first, [x / length(rest) for x in rest]]


def _cells(embedding: Column, size: int) -> list[Column]:
    """The cell of an image in each direction. Images at cosine distance d are, at length 1, sqrt(2 d) apart, and no
    farther as any direction sees them; a cell is as wide."""
    dot = lambda v: F.aggregate(F.zip_with(embedding, F.lit(v), lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
    length = F.sqrt(F.aggregate(embedding, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    width = math.sqrt(2 * EXACT) * (1 + 1e-6)
    return [F.floor(dot(v) / length / width).cast("int") for v in _directions(size)]


def cross_shop_matches(rows: DataFrame, size: int) -> DataFrame:
    """Classes of matching rows: ``official_id, retailer_id`` (the smallest id of each class), ``officials, retailers`` (how
    many rows each class has), ``number`` (the rarest that both share) and ``distance``.

    ``rows`` has ``id``, ``SAME``, ``platform, host, colour, ready, official, retailer, numbers`` and ``embedding`` of ``size``; a
    class is made of rows that agree in all of it but the id."""
    usable = rows.filter(" and ".join(f"{c} is not null" for c in [*SAME, "host", "platform", "colour"]) + " and ready and size(numbers) > 0").filter((F.size("embedding") == size) & F.exists("embedding", lambda x: x != 0))
    alike = [*SAME, "colour", "platform", "host", "official", "retailer", F.array_sort("numbers").alias("numbers"), "embedding"]
    classes = usable.select("id", *alike).groupBy(*[c if isinstance(c, str) else "numbers" for c in alike]).agg(F.min("id").alias("id"), F.count("*").alias("n"))
    x, y = _cells(F.col("embedding"), size)
    classes = materialise(classes.withColumns({"cx": x, "cy": y}), "cross-shop-classes")
    numbered = classes.select("id", "n", *SAME, "colour", "platform", "host", "official", "retailer", "cx", "cy", F.explode("numbers").alias("number"))
    often = numbered.groupBy(*SAME, "colour", "number").agg(F.sum("n").alias("often"))
    near = lambda c: F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1))
    a = numbered.filter("official").select(*SAME, "colour", "number", "cx", "cy", F.col("id").alias("official_id"), F.col("host").alias("_h"), F.col("platform").alias("_p"))
    b = numbered.filter("retailer").withColumn("cx", near("cx")).withColumn("cy", near("cy")).select(*SAME, "colour", "number", "cx", "cy", F.col("id").alias("retailer_id"), "host", "platform")
    met = a.join(b, [*SAME, "colour", "number", "cx", "cy"]).filter("host <> _h and platform <> _p").join(often, [*SAME, "colour", "number"])
    met = met.groupBy("official_id", "retailer_id").agg(F.min_by("number", F.struct("often", "number")).alias("number"))
    side = lambda role: classes.select(F.col("id").alias(f"{role}_id"), F.col("n").alias(f"{role}s"), F.col("embedding").alias(f"_{role}"))
    compared = met.join(side("official"), "official_id").join(side("retailer"), "retailer_id").withColumn("distance", cosine_distance(F.col("_official"), F.col("_retailer")))
    return compared.filter(F.col("distance") <= EXACT).select("official_id", "retailer_id", "officials", "retailers", "number", "distance")
