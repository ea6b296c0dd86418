"""Listing scans that go on where they stopped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scan_slice(pages: DataFrame, cursors: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """The next ``budget`` pages of every site and the cursors after them.

    ``pages`` has ``site, category_index, page`` and the site's ``fingerprint`` of its
    categories; ``cursors`` has ``site, category_index, page, fingerprint`` of the last page
    that was read. A cursor whose fingerprint is no longer the site's starts over. The new
    cursors also say whether the cycle is ``complete``; a complete one begins anew."""
    held = cursors.select("site", F.col("category_index").alias("_c"), F.col("page").alias("_p"), F.col("fingerprint").alias("_f"), F.coalesce("complete", F.lit(False)).alias("_done"))
    joined = pages.join(held, "site", "left")
    valid = F.coalesce((F.col("_f") == F.col("fingerprint")) & ~F.col("_done"), F.lit(False))
    left = joined.filter(~valid | (F.struct("category_index", "page") > F.struct(F.col("_c").alias("category_index"), F.col("_p").alias("page"))))
    numbered = first_places(left, "site", budget + 1, F.col("category_index"), F.col("page"))
    taken = numbered.filter(F.col("_place") <= budget).select(*pages.columns)
    more = numbered.groupBy("site").agg(F.max("_place").alias("_n"))
    last = taken.groupBy("site").agg(F.max(F.struct("category_index", "page", "fingerprint")).alias("at")).join(more, "site")
    after = last.select("site", "at.*", (F.col("_n") <= budget).alias("complete"))
    # a site with nothing left keeps its place and is complete
    idle = cursors.join(after, "site", "left_anti").select("site", "category_index", "page", "fingerprint", F.lit(True).alias("complete"))
    return taken, after.unionByName(idle)


def first_places(df: DataFrame, group: str, most: int, *order: Column) -> DataFrame:
    """The first ``most`` rows a group with ``_place``; a limit by group precedes the shuffle."""
    from pyspark.sql import Window

    return df.withColumn("_place", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_place") <= most)
