"""Audited repair: a plan with before and after, applied only where before still holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .listing import guarded_update


def plan_repair(df: DataFrame, key: str, column: str, proposed: Column) -> DataFrame:
    """``key, before, after`` of the rows whose value would change."""
    return df.select(key, F.col(column).alias("before"), proposed.alias("after")).filter(F.col("after").isNotNull() & ~F.col("after").eqNullSafe(F.col("before")))


def apply_repair(df: DataFrame, plan: DataFrame, key: str, column: str, dry_run: bool = True) -> DataFrame:
    """The repaired rows with ``applied``; a dry run changes nothing and says what would be."""
    out = guarded_update(df, plan, key, column)
    if dry_run:
        return df.join(out.select(key, "applied"), key)
    return out
