"""Prices: observed state, stored fields and conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MOST = 100_000_000


def positive(x: Column) -> Column:
    return F.when((x > 0) & (x < float("inf")), x)


def observed_pricing(current: Column, original: Column, sale: Column, state: Column, source: Column) -> Column:
    """``price, original_price, sale_price, source_price, state, source, version``: a sale
    that is no reduction is not taken for one, but its state becomes unknown."""
    current, original, sale = positive(current), positive(original), positive(sale)
    effective = F.coalesce(sale, current)
    real = (state == "sale") & (effective < original)
    regular = state == "regular"
    return F.struct(
        F.when(real, effective).otherwise(current).alias("price"),
        F.when(real, original).when(regular, current).otherwise(F.coalesce(original, current)).alias("original_price"),
        F.when(real, effective).alias("sale_price"),
        F.when(real, effective).otherwise(current).alias("source_price"),
        F.when(real, "sale").when(regular, "regular").otherwise("unknown").alias("state"),
        source.alias("source"),
        F.lit(2).alias("version"),
    )


def is_confirmed(pricing: Column) -> Column:
    return F.coalesce((pricing["version"] == 2) & (pricing["state"] != "unknown"), F.lit(False))


def whole(x: Column, converted: Column) -> Column:
    """A storable price: positive, at most ``MOST``, rounded only if it was converted."""
    usable = (x > 0) & (x <= MOST)
    return F.when(usable & (x == F.floor(x)), x).when(usable & converted, F.floor(x + 0.5)).cast("long")


def stored_price(pricing: Column, rate: Column, converted: Column) -> Column:
    """``price, original_price, sale_price`` in the target currency, or null if the tuple is
    not consistent; ``rate`` is null for an unknown currency."""
    price, original, sale = (whole(F.when(converted, F.floor(pricing[k] * rate + 0.5)).otherwise(pricing[k]), converted) for k in ("price", "original_price", "sale_price"))
    effective, base = F.coalesce(sale, price), F.coalesce(original, price)
    sound = effective.isNotNull() & base.isNotNull() & (sale.isNull() | ((sale < base) & (sale == effective)))
    return F.when(sound & (~converted | rate.isNotNull()), F.struct(effective.alias("price"), base.alias("original_price"), sale.alias("sale_price")))


def refreshed_price(price: Column, confirmed: Column, fields: Column, old_original: Column, old_price: Column) -> Column:
    """Confirmed fields as they are; a lone price is a sale if it is below the stored baseline."""
    baseline = F.coalesce(F.when(old_original > 0, old_original), F.when(old_price > 0, old_price), price)
    reduced = price < baseline
    lone = F.struct(price.alias("price"), F.when(reduced, baseline).otherwise(price).alias("original_price"), F.when(reduced, price).alias("sale_price"))
    return F.when(confirmed & fields.isNotNull(), fields).when(price.isNotNull(), lone)


def convert(amount: Column, rate: Column) -> Column:
    """Half up to whole units; null for an unknown currency."""
    return F.floor(amount * rate + 0.5).cast("long")
