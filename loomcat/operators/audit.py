"""Audit of catalogue, candidates and embeddings, and recovery from what it finds.

A finding says what is wrong with one row, how certain that is, what would mend it
(``action``), the row's guarded values when it was seen (``expected``) and the new ones
(``proposed``), both as JSON. Recovery applies a finding only where the row still has the
expected values, and leaves what needs another service or a person alone.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import stable_hash
from ..functions.text import brand_form
from .listing import first_by

# Outcomes of a normalisation that need no further work, statuses of confirmed prices.
NORMALISED = ("not_required", "succeeded", "unchanged")
CONFIRMED = ("sale", "regular")
GUARDS = ("updated_at", "brand_node_id", "review_count", "image_url", "image_revision")
APPLICABLE = {"repair_brand": "brand_node_id", "repair_review_count": "review_count"}


def finding(rows: DataFrame, entity: str, issue: str, certainty: Column | str, action: Column | str, proposed: dict[str, Column], expected: Column) -> DataFrame:
    text = lambda x: x if isinstance(x, Column) else F.lit(x)
    new = F.to_json(F.struct(*[v.cast("string").alias(k) for k, v in proposed.items()])) if proposed else F.lit("{}")
    return rows.select(
        F.substring(stable_hash(F.lit(entity), F.col("id"), F.lit(issue)), 1, 24).alias("finding_id"),
        F.lit(entity).alias("entity"), "id", F.lit(issue).alias("issue"), text(certainty).alias("certainty"), text(action).alias("action"), expected.alias("expected"), new.alias("proposed"),
    )


def _grown(rows: DataFrame) -> DataFrame:
    """``rows`` to be joined by sorting both sides: a row or more a product, with texts longer than Spark's
    estimate of them, so a broadcast would take the driver's memory."""
    return rows.hint("merge")


def expected_product() -> Column:
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in GUARDS]))


def product_findings(products: DataFrame, embeddings: DataFrame, brands: DataFrame, review_counts: DataFrame) -> DataFrame:
    """Products without a brand, with impossible prices, with a wrong count of reviews, and
    embeddings of unknown or other images."""
    expected = expected_product()
    keys = brands.select(brand_form(F.col("name")).alias("_form"), F.col("id").alias("_brand")).filter("_form <> ''")
    unique = keys.groupBy("_form").agg(F.min("_brand").alias("_brand"), F.max("_brand").alias("_last")).filter("_brand = _last")
    nameless = products.filter("brand_node_id is null").withColumn("_form", brand_form(F.col("brand"))).join(unique, "_form", "left")
    found = [finding(nameless, "product", "product_brand_missing", "confirmed", F.when(F.col("_brand").isNotNull(), "repair_brand").otherwise("manual_review"), {"brand_node_id": F.col("_brand")}, expected)]
    price, original, sale = F.col("price"), F.col("original_price"), F.col("sale_price")
    odd = ~F.coalesce(price > 0, F.lit(False)) | F.coalesce(original < price, F.lit(False)) | (sale.isNotNull() & ~F.coalesce((sale == price) & (sale < original), F.lit(False)))
    found.append(finding(products.filter(odd), "product", "product_price_invalid", "confirmed", "manual_review", {}, expected))
    counted = products.join(_grown(review_counts.select(F.col("product_id").alias("id"), F.col("n").alias("_n"))), "id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    found.append(finding(counted.filter(F.col("_n") != F.coalesce("review_count", F.lit(0))), "product", "review_count_mismatch", "confirmed", "repair_review_count", {"review_count": F.col("_n")}, expected))
    pictured = products.join(_grown(embeddings.select(F.col("product_id").alias("id"), "source_image_url", "source_image_revision")), "id")
    renew = F.when(F.col("in_stock") & F.col("image_url").isNotNull(), "regenerate_embedding").otherwise("manual_review")
    unknown = F.col("source_image_url").isNull() | F.col("source_image_revision").isNull()
    differs = ~(F.col("source_image_url").eqNullSafe(F.col("image_url")) & F.col("source_image_revision").eqNullSafe(F.col("image_revision")))
    image = {"source_image_url": F.col("image_url"), "source_image_revision": F.col("image_revision")}
    found.append(finding(pictured.filter(unknown), "embedding", "embedding_provenance_unknown", "unverified", renew, image, expected))
    found.append(finding(pictured.filter(~unknown & differs), "embedding", "embedding_source_mismatch", "confirmed", renew, image, expected))
    return functools.reduce(DataFrame.unionByName, found)


def candidate_findings(candidates: DataFrame, now: Column, most_hours: int) -> DataFrame:
    """Candidates with unconfirmed prices, old observations, no brand, an import that isn't
    proven complete, or a retry that stands out."""
    expected = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in ("updated_at", "status", "revision")]))
    old = ~F.coalesce(F.col("observed_at") >= now - F.make_dt_interval(hours=F.lit(most_hours)), F.lit(False))
    leased = F.coalesce(F.col("token").isNotNull() & (F.col("lease_until") > now), F.lit(False))
    resume = F.when(leased, "manual_review").when(old, "reobserve_candidate").otherwise("resume_candidate")
    imported = F.col("status") == "imported"
    branded = F.col("brand_node_id").isNotNull()
    unproven = imported & ~F.coalesce(F.col("imported_product_id").isNotNull() & F.col("normalisation").isin(*NORMALISED) & (F.col("prepared_revision") == F.col("revision")), F.lit(False))
    definite = F.col("imported_product_id").isNull() | F.coalesce(F.col("normalisation") == "failed", F.lit(False))
    one = lambda where, issue, certainty, action: finding(candidates.filter(where), "candidate", issue, certainty, action, {}, expected)
    found = [
        one(~F.coalesce(F.col("price_state").isin(*CONFIRMED), F.lit(False)), "candidate_price_unconfirmed", "unverified", F.when(imported, "manual_review").otherwise(resume)),
        one(old & ~F.col("status").isin("imported", "rejected"), "candidate_observation_stale", F.when(F.col("observed_at").isNull(), "unverified").otherwise("confirmed"), F.when(leased, "manual_review").otherwise("reobserve_candidate")),
        one(~branded, "candidate_brand_unmatched", "confirmed", "manual_review"),
        one(unproven, "candidate_import_completion_unverified", F.when(definite, "confirmed").otherwise("unverified"), F.when(branded, resume).otherwise("manual_review")),
        one(~unproven & F.col("status").isin("failed", "blocked") & branded, "candidate_retry_incomplete", "confirmed", resume),
    ]
    return functools.reduce(DataFrame.unionByName, found)


def _judged(findings: DataFrame, products: DataFrame) -> DataFrame:
    """The findings of products that count, each once, with their ``outcome``."""
    own = first_by(findings.filter("entity <> 'candidate'"), ["id", "action"], F.col("finding_id"))
    now = products.select("id", expected_product().alias("_now"))
    outcome = F.when(~F.col("action").isin(*APPLICABLE), "deferred").when(F.col("_now").eqNullSafe(F.col("expected")), "applied").otherwise("conflicted")
    return own.join(_grown(now), "id", "left").withColumn("outcome", outcome)


def recover(findings: DataFrame, products: DataFrame) -> DataFrame:
    """``finding_id, id, action, outcome`` of product findings against the current rows:
    ``applied``, ``conflicted`` (the row has changed or is gone), ``deferred`` (another
    service's or a person's work). Of several findings for an action on a row, the first counts."""
    return _judged(findings, products).select("finding_id", "id", "action", "outcome")


def recovered(findings: DataFrame, products: DataFrame) -> DataFrame:
    """``products`` with the applied findings' new values. Both actions of a row were
    checked against the same expected row, so they are applied together."""
    done = _judged(findings, products).filter("outcome = 'applied'")
    new = done.groupBy("id").agg(*[F.max(F.when(F.col("action") == a, F.get_json_object("proposed", f"$.{c}"))).alias(f"_{c}") for a, c in APPLICABLE.items()])
    out = products.join(_grown(new), "id", "left")
    for c in APPLICABLE.values():
        out = out.withColumn(c, F.coalesce(F.col(f"_{c}").cast(products.schema[c].dataType), F.col(c)))
    return out.select(*products.columns)
