"""Exchange rates in force: the newest snapshot before each observation, while it is fresh enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import carried


def rates_in_force(observations: DataFrame, snapshots: DataFrame, most_days: int, committed: Column | None = None, currency: str = "currency", at: str = "observed_at") -> DataFrame:
    """``observations`` with ``rate, rate_at, rate_source``: ``live`` for the newest rate of the currency at or before
    ``at``, if it is at most ``most_days`` old; else ``committed`` for the rate that is given as last
    resort, a map by currency; else null. ``snapshots`` has ``currency, taken_at, rate``; a rate that is not
    positive doesn't count, and of several of one time the greatest does.

    Observations and snapshots are one sorted table, along which rates are carried, so a currency
    of any size is many tasks' work. An observation without currency or time has no live rate."""
    columns = observations.columns
    seen = observations.select(F.col(currency).alias("_c"), F.col(at).alias("_t"), F.lit(1).alias("_k"), F.lit(None).cast("double").alias("_r"), F.struct(*columns).alias("_kept"))
    known = snapshots.filter("rate > 0 and currency is not null and taken_at is not null").groupBy("currency", "taken_at").agg(F.max("rate").cast("double").alias("rate"))
    rates = known.select(F.col("currency").alias("_c"), F.col("taken_at").alias("_t"), F.lit(0).alias("_k"), F.col("rate").alias("_r")).withColumn("_kept", F.lit(None).cast(seen.schema["_kept"].dataType))
    held = F.when(F.col("_k") == 0, F.struct("_c", "_t", "_r"))
    found = carried(seen.unionByName(rates), held, "_held", F.asc_nulls_first("_c"), F.asc_nulls_first("_t"), F.asc("_k")).filter("_k = 1")
    age = F.unix_timestamp("_t") - F.unix_timestamp("_held._t")
    live = F.coalesce((F.col("_held._c") == F.col("_c")) & (age <= most_days * 86_400), F.lit(False))
    last_resort = F.try_element_at(committed, F.col("_c")) if committed is not None else F.lit(None)
    last_resort = last_resort.cast("double")
    return found.select(
        "_kept.*",
        F.when(live, F.col("_held._r")).otherwise(last_resort).alias("rate"),
        F.when(live, F.col("_held._t")).alias("rate_at"),
        F.when(live, "live").when(last_resort.isNotNull(), "committed").alias("rate_source"),
    )
