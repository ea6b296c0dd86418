"""Running totals, places and chunks over a whole table without one task that sees all rows."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise


def _ranged(df: DataFrame, ranges: int, *order: Column) -> DataFrame:
    """``df`` with ``_range`` and ``_row``. Ranges are cut at sampled rows, so sparse or
    clustered keys fill them evenly, and are written, so that they cannot change."""
    rows = materialise(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    return rows.withColumn("_range", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND(2**33 - 1)).drop("_at")


def _sums_before(rows: DataFrame, value: Column) -> DataFrame:
    """``_range, _before``: a row a range, so one window over them is small."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("_range").agg(value.alias("_sum")).select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))


def running_total(df: DataFrame, key: str, value: Column, name: str, ranges: int = 256) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows up to this one by ``key``, which is unique."""
    return summed_to(df, value, name, F.col(key).asc(), ranges=ranges)


def placed(df: DataFrame, *order: Column, name: str = "place", ranges: int = 64) -> DataFrame:
    """``df`` with ``name``: each row's place, from 1 on, among all rows by ``order``, which has no ties."""
    rows = _ranged(df, ranges, *order)
    return rows.join(F.broadcast(_sums_before(rows, F.count("*"))), "_range").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_range", "_row", "_before")  # at most `ranges` counts


def summed_to(df: DataFrame, value: Column, name: str, *order: Column, ranges: int = 64) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows up to this one by ``order``, which has no ties."""
    rows = _ranged(df.withColumn("_value", value.cast("long")), ranges, *order)
    within = F.sum("_value").over(Window.partitionBy("_range").orderBy("_row"))
    return rows.join(F.broadcast(_sums_before(rows, F.sum("_value"))), "_range").withColumn(name, F.col("_before") + within).drop("_range", "_row", "_value", "_before")  # at most `ranges` sums


def range_numbers(df: DataFrame, *order: Column, name: str = "range", ranges: int = 64) -> DataFrame:
    """``df`` with ``name``: the number of the range by ``order`` in which a row lies. Ranges are about
    even, rows that ``order`` does not tell apart lie in one."""
    return _ranged(df, ranges, *order).withColumnRenamed("_range", name).drop("_row")


def placed_in(df: DataFrame, group: list[str], *order: Column, name: str = "place", ranges: int = 64) -> DataFrame:
    """``df`` with ``name``: each row's place, from 1 on, in its group by ``order``, which has no ties within one. Places
    among all rows less where the group begins, so a group of any size is many tasks' work."""
    rows = materialise(placed(df.withColumn("_group", F.struct(*group)), F.asc("_group"), *order, name="_all", ranges=ranges), "placed")
    first = rows.groupBy("_group").agg(F.min("_all").alias("_first"))
    return rows.join(first, "_group").withColumn(name, F.col("_all") - F.col("_first") + 1).drop("_group", "_all", "_first")


def carried(df: DataFrame, value: Column, name: str, *order: Column, ranges: int = 256) -> DataFrame:
    """``df`` with ``name``: the last ``value`` that is not null, of this row or those before it by ``order``. Ranges of
    rows carry it within; between them goes one value a range."""
    rows = _ranged(df.withColumn("_value", value), ranges, *order)
    ends = rows.groupBy("_range").agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col("_row"))).alias("_end"))
    before = F.last("_end", ignorenulls=True).over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    within = F.last("_value", ignorenulls=True).over(Window.partitionBy("_range").orderBy("_row"))
    joined = rows.join(F.broadcast(ends.select("_range", before.alias("_before"))), "_range")  # at most `ranges` values
    return joined.withColumn(name, F.coalesce(within, "_before")).drop("_range", "_row", "_value", "_before")


def _next_starts(sizes: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of sizes up to each row, and for a chunk that starts at a row, where the next one starts."""
    upto = np.cumsum(sizes)
    fits = np.searchsorted(upto, upto - sizes + budget, side="right")
    return upto, np.maximum(fits, np.arange(1, len(sizes) + 1))


def greedy_chunks(df: DataFrame, key: str, size: Column, budget: int, rows_a_range: int = 1_000_000) -> DataFrame:
    """``key, chunk`` of every row: consecutive rows by ``key`` (unique) share a chunk while their
    sizes fit ``budget``; a row larger than that is a chunk of its own. Sizes are 0 or more, a missing one is 0.

    The law is one over all rows. Every range of rows works out what it does to a chunk that is
    open at its beginning: only the first break depends on how full that chunk is, so the answer
    is a table over the rows of one chunk. The driver walks these tables range by range,
    holding one at a time, and gives every range the chunk it begins with."""
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    slim = df.select(F.col(key), F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("_size"))
    rows = _ranged(slim, slim.count() // rows_a_range + 1, F.col(key).asc())

    def effect(part: pd.DataFrame) -> pd.DataFrame:
        sizes = part.sort_values("_row")["_size"].to_numpy()
        upto, nxt = _next_starts(sizes, budget)
        m, after = len(sizes), nxt.tolist()
        last, breaks = list(range(m)), [1] * m  # of the chunks that begin at a row: where the last one starts, how many there are
        for i in range(m - 1, -1, -1):
            if after[i] < m:
                last[i], breaks[i] = last[after[i]], 1 + breaks[after[i]]
        first = min(m, int(np.searchsorted(upto, budget, side="right")) + 1)  # no later row can be the first break
        before = upto - sizes
        return pd.DataFrame({"_range": part["_range"].iloc[:1], "upto": [upto[:first]], "held": [(upto[-1] - before)[last[:first]]], "breaks": [breaks[:first]], "total": [upto[-1]]})

    entries, held, chunk = [], None, 0
    effects = rows.groupBy("_range").applyInPandas(effect, "_range long, upto array<long>, held array<long>, breaks array<long>, total long")
    for r in materialise(effects, "chunk-effects").orderBy("_range").toLocalIterator():
        entries.append((r["_range"], held, chunk))
        if held is None:
            held, chunk = r["held"][0], r["breaks"][0] - 1
            continue
        k = bisect_right(r["upto"], budget - held)
        if k < len(r["upto"]):
            held, chunk = r["held"][k], chunk + r["breaks"][k]
        else:
            held += r["total"]

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_row")
        upto, nxt = _next_starts(part["_size"].to_numpy(), budget)
        held = part["_held"].iloc[0]
        at, starts = 0 if pd.isna(held) else int(np.searchsorted(upto, budget - int(held), side="right")), np.zeros(len(part), np.int64)
        begin = int(pd.isna(held))
        while at < len(part):
            starts[at], at = 1, int(nxt[at])
        return pd.DataFrame({key: part[key], "chunk": part["_chunk"].iloc[0] - begin + np.cumsum(starts)})

    known = spark.createDataFrame(entries, "_range long, _held long, _chunk long")  # one row a range
    return rows.join(F.broadcast(known), "_range").groupBy("_range").applyInPandas(cut, f"{key} {kind}, chunk long")
