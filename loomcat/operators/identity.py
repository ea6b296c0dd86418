"""Identity sync: which catalogue variant each source row belongs to, run after run.

A row with a trusted identifier and a colour belongs to the variant of that identifier and colour,
another one to a variant of its own. Runs build on the last one's targets: a row without
proof keeps a trusted target that it once had, a variant of a single row that gives way to a
trusted one is superseded by it, and rows that join a variant which is already there are logged
as decisions.

Rows count in the order of their ids: the category of a product is that of the last row that
joined it, and a row of another category stays by itself. A row without category joins
anything and leaves the category open. So between rows without category, all rows of a product
follow the first of them: positions over the whole table and aggregates say which, and no product's rows meet in one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise
from .ordering import running_total

# Identifiers that can prove an identity, and the trust they need.
PROVING = ("gtin", "mpn", "model_id", "product_group_id")
LEAST_TRUST = {"gtin": 0.99}
LEAST_OTHER = 0.8
PRESERVED = ("trusted:", "cross-shop:")


class Catalogue(NamedTuple):
    """``products``: ``identity_key, category``; ``variants``: ``identity_key, merged_into``; ``offers``: ``offer_key, target``."""

    products: DataFrame
    variants: DataFrame
    offers: DataFrame


def product_key(brand: Column, kind: Column, namespace: Column, number: Column, trust: Column, colour: Column) -> Column:
    """The key of a product that a row's identifier proves, null without proof."""
    least = F.when(kind == "gtin", LEAST_TRUST["gtin"]).otherwise(LEAST_OTHER)
    proven = kind.isin(*PROVING) & (trust >= least) & (F.coalesce(colour, F.lit("")) != "") & (F.coalesce(number, F.lit("")) != "")
    return F.when(F.coalesce(proven, F.lit(False)), F.concat_ws(":", F.lit("trusted"), F.coalesce(brand, F.lit("")), kind, F.coalesce(namespace, F.lit("")), number))


def _joining(rows: DataFrame, products: DataFrame) -> DataFrame:
    """``id, product_key, category`` of the rows with proof whose category does not speak against it."""
    proven = rows.filter("product_key is not null").select("id", "product_key", "category", F.struct("product_key", "id").alias("_order"))
    none = F.col("category").isNull().cast("int")
    # how many rows without category come before or at a row, over all products
    placed = materialise(running_total(proven, "_order", none, "_upto").drop("_order"), "identity-places")
    keys = placed.groupBy("product_key").agg(F.min(F.col("_upto") - none).alias("_base"))
    leaders = placed.filter("category is not null").groupBy("product_key", "_upto").agg(F.min_by("category", "id").alias("_leader"))
    known = products.select(F.col("identity_key").alias("product_key"), F.col("category").alias("_known"))
    ruled = placed.join(keys, "product_key").join(leaders, ["product_key", "_upto"], "left").join(known, "product_key", "left")
    rule = F.when(F.col("_upto") == F.col("_base"), F.coalesce("_known", "_leader")).otherwise(F.col("_leader"))
    return ruled.filter(F.col("category").isNull() | (F.col("category") == rule)).select("id", "product_key", "category")


def sync_identities(rows: DataFrame, last: Catalogue) -> DataFrame:
    """``id, offer_key, product_key, category, target, seed, attached, superseded, confidence`` a row.

    ``rows`` has ``id`` (unique), ``offer_key`` (unique), ``product_key`` (from ``product_key``), ``colour``, ``category`` and
    ``kind``, in normal form. ``seed`` is ``trusted``, ``kept`` (a target of an earlier run) or ``singleton``; ``attached``
    says that the variant was there before the row; ``superseded`` is the variant of its own that it leaves;
    ``confidence`` is that of the logged decision, null if there is none to log."""
    rows = materialise(rows.select("id", "offer_key", "product_key", "colour", "category", "kind"), "identity-rows")
    joining = _joining(rows, last.products).select("id", F.lit(True).alias("_joins"))
    marked = rows.join(joining, "id", "left").withColumn("_variant", F.when(F.col("_joins"), F.concat("product_key", F.lit(":color:"), "colour")))
    marked = materialise(marked, "identity-variants")
    first = marked.filter("_variant is not null").groupBy("_variant").agg(F.min("id").alias("_first"))
    there = last.variants.select(F.col("identity_key").alias("_variant"), F.lit(True).alias("_there")).distinct()
    before = last.offers.select("offer_key", F.col("target").alias("_previous"))
    out = marked.join(first, "_variant", "left").join(there, "_variant", "left").join(before, "offer_key", "left")
    previous = F.col("_previous")
    kept = F.col("_variant").isNull() & F.coalesce(F.rlike(previous, F.lit("^(?:" + "|".join(PRESERVED) + ")")), F.lit(False))
    own = F.concat(F.lit("source:"), "id", F.lit(":color:unknown"))
    target = F.when(kept, previous).otherwise(F.coalesce("_variant", own))
    attached = F.col("_variant").isNotNull() & (F.coalesce("_there", F.lit(False)) | (F.col("id") > F.col("_first")))
    moved = ~previous.eqNullSafe(target)
    return out.select(
        "id",
        "offer_key",
        F.when(F.col("_variant").isNotNull(), F.col("product_key")).alias("product_key"),
        "category",
        target.alias("target"),
        F.when(kept, "kept").when(F.col("_variant").isNotNull(), "trusted").otherwise("singleton").alias("seed"),
        attached.alias("attached"),
        F.when(moved & F.startswith(previous, F.lit("source:")), previous).alias("superseded"),
        F.when(attached & moved, F.when(F.col("kind") == "gtin", 1.0).otherwise(0.995)).alias("confidence"),
    )


def catalogue_after(synced: DataFrame, last: Catalogue) -> Catalogue:
    """The catalogue that a run leaves to the next one; ``synced`` must be a written table."""
    single = F.concat(F.lit("source:"), "id")
    touched = synced.filter("seed <> 'kept'").groupBy(F.coalesce("product_key", single).alias("identity_key")).agg(F.max_by(F.struct("category"), "id").alias("c")).select("identity_key", "c.category")
    products = last.products.join(touched, "identity_key", "left_anti").unionByName(touched)
    made = synced.filter("seed <> 'kept'").select(F.col("target").alias("identity_key")).distinct()
    merged = synced.filter("superseded is not null").select(F.col("superseded").alias("identity_key"), F.col("target").alias("_into"))
    # a variant that rows use again is active; one that is superseded points to what took its place
    old = last.variants.join(made, "identity_key", "left_anti").join(merged, "identity_key", "left").select("identity_key", F.coalesce("_into", "merged_into").alias("merged_into"))
    variants = old.unionByName(made.withColumn("merged_into", F.lit(None).cast("string")))
    now = synced.select("offer_key", "target")
    return Catalogue(products, variants, last.offers.join(now, "offer_key", "left_anti").unionByName(now))


def empty_catalogue(rows: DataFrame) -> Catalogue:
    spark = rows.sparkSession
    return Catalogue(*[spark.createDataFrame([], s) for s in ("identity_key string, category string", "identity_key string, merged_into string", "offer_key string, target string")])
