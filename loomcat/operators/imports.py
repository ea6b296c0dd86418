"""Preparing products for the catalogue, and an import run over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import is_confirmed, stored_price
from .listing import first_by

OUTCOME = "struct<status: string, stage: string, code: string, retryable: boolean>"


def is_timestamp(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}")) & text.try_cast("timestamp").isNotNull(), F.lit(False))


def is_blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def failed(stage: str, code: Column | str, retryable: Column | bool) -> Column:
    text = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(F.lit("failed").alias("status"), F.lit(stage).alias("stage"), text(code).alias("code"), text(retryable).alias("retryable"))


def settled(status: str, code: str | None = None) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(None).cast("string").alias("stage"), F.lit(code).cast("string").alias("code"), F.lit(False).alias("retryable"))


def prepare(df: DataFrame, rate: Column, converted: Column) -> DataFrame:
    """``df`` with ``prepared`` (``OUTCOME``) and ``fields`` (prices in the target currency).

    The first stage that says something decides: times, pricing (a site whose listing
    states no sure price needs the detail's), scope, brand and its node, taxonomy,
    normalisation, gender, image, price fields; what passes all is ``prepared``, or
    ``would_create`` if its brand has no node yet.

    Reads ``observed_at, expected_updated_at, detail_at`` (texts), ``pricing,
    detail_pricing`` (as ``observed_pricing`` gives), ``needs_detail, in_scope, brand,
    resolution`` (``status, brand, node_id``), ``valid_category, normalisation``
    (``status, code, retryable``), ``genders`` and ``image_url``."""
    # one row each comes out of the array: a border for the optimiser, which else writes the prices out anew at every use
    sure = df.withColumn("_row", F.explode(F.array(F.struct(F.col("pricing"), F.col("detail_pricing"))))).withColumns({c: F.col("_row")[c] for c in ("pricing", "detail_pricing")}).drop("_row")
    sure = sure.withColumn("_pricing", F.when(~is_confirmed(F.col("pricing")) & F.col("needs_detail"), F.col("detail_pricing")).otherwise(F.col("pricing")))
    sure = sure.withColumn("fields", stored_price(F.col("_pricing"), rate, converted))
    r, n = F.col("resolution"), F.col("normalisation")
    known = r["status"] == "existing"
    stages = [
        (~is_timestamp(F.col("observed_at")), failed("validation", "observed_at_invalid", False)),
        (F.col("expected_updated_at").isNotNull() & ~is_timestamp(F.col("expected_updated_at")), failed("validation", "expected_updated_at_invalid", False)),
        (~is_confirmed(F.col("pricing")) & F.col("needs_detail") & F.col("detail_pricing").isNull(), failed("pricing", "detail_pricing_required", True)),
        (~is_confirmed(F.col("_pricing")), failed("pricing", "pricing_unverified", True)),
        (F.col("detail_at").isNotNull() & ~is_timestamp(F.col("detail_at")), failed("validation", "observed_at_invalid", False)),
        (~F.col("in_scope"), settled("policy_excluded", "product_out_of_scope")),
        (is_blank(F.col("brand")), failed("brand", "brand_missing", False)),
        (r.isNull() | r["status"].isNull(), failed("brand", "brand_resolution_failed", True)),
        (is_blank(r["brand"]), failed("brand", "brand_resolution_invalid", False)),
        (r["status"] == "quarantined", settled("quarantined")),
        (~r["status"].isin("existing", "would_create"), failed("brand", "brand_resolution_invalid", False)),
        (known & ~F.rlike(r["node_id"], F.lit("^[1-9][0-9]*$")), failed("brand", "brand_node_id_invalid", False)),
        (~F.col("valid_category"), failed("validation", "product_validation_failed", False)),
        (n.isNull() | (n["status"] == "failed"), failed("normalization", F.coalesce(n["code"], F.lit("normalization_failed")), F.coalesce(n["retryable"], F.lit(True)))),
        (F.size("genders") != 1, failed("validation", "gender_unverified", False)),
        (is_blank(F.col("image_url")), failed("validation", "image_missing", False)),
        (F.col("fields").isNull(), failed("pricing", "pricing_invalid", False)),
        (~known, settled("would_create")),
    ]
    rung = F.lit(len(stages))
    for k, (met, _) in reversed(list(enumerate(stages))):
        rung = F.when(F.coalesce(met, F.lit(True)), k).otherwise(rung)
    numbered = sure.withColumn("_rung", rung)
    outcome = F.get(F.array(*[result.cast(OUTCOME) for _, result in stages], settled("prepared").cast(OUTCOME)), F.col("_rung"))
    return numbered.withColumn("prepared", outcome).drop("_pricing", "_rung")


def run_import(df: DataFrame, stored: DataFrame) -> DataFrame:
    """``ord, outcome`` of prepared rows (``ord``, unique, ``product_url, seen_at, prepared, fields``) against
    stored ones (``product_url, seen_at, price``): of one address the first row counts, an
    observation older than the stored one is stale, the rest is inserted, updated or unchanged."""
    first = first_by(df.filter("product_url is not null"), ["product_url"], F.col("ord")).select("ord", F.lit(True).alias("_first"))
    old = stored.select("product_url", F.col("seen_at").alias("_seen"), F.col("price").alias("_price"), F.lit(True).alias("_stored"))
    joined = df.join(first, "ord", "left").join(old, "product_url", "left")
    outcome = F.when(F.col("product_url").isNull(), "rejected").when(F.col("_first").isNull(), "duplicate_url").when(F.coalesce(F.col("seen_at") < F.col("_seen"), F.lit(False)), "stale_observation")
    outcome = outcome.when(F.col("prepared.status") != "prepared", F.concat_ws(":", "prepared.status", "prepared.code")).when(F.col("_stored").isNull(), "inserted")
    return joined.select("ord", outcome.when(F.col("fields.price").eqNullSafe(F.col("_price")), "unchanged").otherwise("updated").alias("outcome"))
