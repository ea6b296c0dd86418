"""Incremental comparison of a crawled snapshot with stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import refreshed_price
from ..functions.urls import identity_of, parts_of

PRICES = ("price", "original_price", "sale_price")


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first in ``order``. The filter on the rank becomes a limit a group
    before the shuffle, so a key that many rows share sends one row a task."""
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(at)).filter("_rank = 1").drop("_rank")


def latest_observation(df: DataFrame, key: str, ts: str, ord_: str) -> DataFrame:
    """The newest row a key; of equal times the later one."""
    return first_by(df, [key], F.desc_nulls_last(ts), F.desc(ord_))


def match_listing(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """Every crawled address once (first by ``ord``) with the stored rows it stands for:
    those of its product identity, or of its address if it has none. Unmatched ones have a null id.

    Equal addresses have equal identities, so one join on whichever key there is will do;
    a row without an address has no key and matches nothing."""

    def keyed(df: DataFrame) -> DataFrame:
        cut = df.withColumn("_parts", parts_of(F.col("product_url")))
        return cut.withColumn("_key", F.coalesce(identity_of(F.col("_parts")), F.concat(F.lit("address:"), "product_url"))).drop("_parts")

    seen = keyed(first_by(crawled.filter("product_url is not null"), ["product_url"], F.col("ord")))
    left = seen.select(*[F.col(c).alias(f"new_{c}") for c in crawled.columns], "_key")
    return left.join(keyed(stored.filter("product_url is not null")), "_key", "left").drop("_key")


def diff_listing(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """A row a matched stored row: ``id, outcome, price, original_price, sale_price, in_stock``
    as they are to be after it.

    An observation without a time, or older than the newest stored one (``last_seen_at``,
    ``crawled_at`` if there is one), writes nothing. One without a price leaves the prices as
    they are; a price below the stored baseline is a sale (``refreshed_price``, or confirmed
    ``new_fields``). A row in quarantine (``quarantined``) doesn't come back into stock."""
    m = match_listing(crawled, stored).filter("id is not null")
    newest = first_by(m, ["id"], F.col("new_ord"))
    has = lambda c, otherwise: F.coalesce(F.col(c), otherwise) if c in m.columns else otherwise
    none = F.lit(None)
    known = F.greatest("last_seen_at", F.col("crawled_at").cast(m.schema["last_seen_at"].dataType)) if "crawled_at" in m.columns else F.col("last_seen_at")
    late = F.col("new_observed_at").isNull() | F.coalesce(F.col("new_observed_at") < known, F.lit(False))
    held = has("quarantined", F.lit(False)) & F.col("new_in_stock")
    fields = F.struct(*[none.cast("double").alias(c) for c in PRICES])
    fresh = refreshed_price(F.col("new_price"), F.lit(False), fields, F.col("original_price"), F.col("price"))
    if "new_fields" in m.columns:
        fresh = refreshed_price(F.col("new_price"), F.col("new_fields").isNotNull(), F.col("new_fields"), F.col("original_price"), F.col("price"))
    old_sale = F.col("sale_price") if "sale_price" in m.columns else none.cast("double")
    now = newest.withColumns({"_late": late, "_held": held, "_price": F.when(~late, fresh), "_stock": F.when(late, F.col("in_stock")).when(held, False).otherwise(F.col("new_in_stock"))})
    priced = F.col("_price").isNotNull()
    changed = ~F.col("_stock").eqNullSafe(F.col("in_stock"))
    outcome = F.when(F.col("_late"), "stale").when(changed & F.col("_stock"), "restocked").when(changed & ~F.col("_held"), "sold_out").when(F.col("_held") & F.coalesce("in_stock", F.lit(True)), "blocked")
    outcome = outcome.when(priced & ~F.col("_price.price").eqNullSafe(F.col("price")), "price").otherwise("unchanged")
    keep = {"price": F.col("price"), "original_price": F.col("original_price"), "sale_price": old_sale}
    return now.select("id", outcome.alias("outcome"), *[F.when(priced, F.col(f"_price.{c}")).otherwise(keep[c]).alias(c) for c in PRICES], F.col("_stock").alias("in_stock"))


def missing_rows(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored rows that no crawled address stands for; a late one counts as seen."""
    return stored.join(match_listing(crawled, stored).filter("id is not null").select("id").distinct(), "id", "left_anti")


def unknown_observations(crawled: DataFrame, stored: DataFrame) -> DataFrame:
    return match_listing(crawled, stored).filter("id is null").select(*[F.col(f"new_{c}").alias(c) for c in crawled.columns])


def coverage(total: Column, missing: Column) -> Column:
    return F.when(total == 0, F.lit(1.0)).otherwise((total - missing) / total)


def mark_missing(crawled: DataFrame, stored: DataFrame, least: float) -> DataFrame:
    """Missing rows that are to be out of stock, if the listing covers at least ``least``."""
    gone = missing_rows(crawled, stored)
    counted = stored.agg(F.count("*").alias("total")).crossJoin(gone.agg(F.count("*").alias("missing")))  # one row each
    guard = counted.select(coverage(F.col("total"), F.col("missing")).alias("coverage"))
    return gone.filter("in_stock").crossJoin(F.broadcast(guard)).filter(F.col("coverage") >= least)


def image_changes(before: DataFrame, after: DataFrame, key: str = "id", image: str = "image_url") -> DataFrame:
    """``key, bucket`` of a full comparison of two image snapshots."""
    a, b = before.select(key, F.col(image).alias("_old")), after.select(key, F.col(image).alias("_new"))
    a, b = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    bucket = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_old").eqNullSafe(F.col("_new")), "same").when(F.col("_old").isNull(), "gained").when(F.col("_new").isNull(), "lost").otherwise("changed")
    return a.join(b, key, "full_outer").select(key, bucket.alias("bucket"))


def write_outcomes(stored: DataFrame, prepared: DataFrame, key: str, value_columns: list[str]) -> DataFrame:
    """What an upsert under an expected version does, row by row: ``key, outcome``."""
    old = stored.select(key, F.col("version").alias("_version"), *[F.col(c).alias(f"_{c}") for c in value_columns])
    same = F.lit(True)
    for c in value_columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    outcome = F.when(F.col(key).isNull(), "rejected").when(F.col("_version").isNull(), F.when(F.col("expected_version").isNull(), "inserted").otherwise("conflicted")).when(same, "unchanged").when(F.col("_version").eqNullSafe(F.col("expected_version")), "updated").otherwise("conflicted")
    return prepared.join(old, key, "left").select(key, outcome.alias("outcome"))


def upsert(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows replace stored ones of equal key; others stay."""
    return stored.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def touch(stored: DataFrame, confirmed: DataFrame, key: str, column: str, seen_at: Column) -> DataFrame:
    """``column`` becomes ``seen_at`` where the key is confirmed."""
    marks = confirmed.select(key).distinct().withColumn("_seen", F.lit(True))
    return stored.join(marks, key, "left").withColumn(column, F.when(F.col("_seen"), seen_at).otherwise(F.col(column))).drop("_seen")


def guarded_update(stored: DataFrame, changes: DataFrame, key: str, column: str) -> DataFrame:
    """``changes`` has ``key, before, after``; a value changes only where it still is ``before``."""
    joined = stored.join(changes.select(key, "before", "after"), key, "left")
    hit = F.col("after").isNotNull() & F.col(column).eqNullSafe(F.col("before"))
    return joined.withColumn("applied", F.coalesce(hit, F.lit(False))).withColumn(column, F.when(F.col("applied"), F.col("after")).otherwise(F.col(column))).drop("before", "after")
