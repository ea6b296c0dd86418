"""Sharding by sampled splitters, under the law of equal bytes.

1. One narrow pass keeps key and size of every row, beside the columns that are carried
   along, as a written table. The key is the id, a hash of id and text, and the row's
   number, so no two rows share one and any group of equal rows can be cut.
2. A sample drawn with a chance in proportion to size gives quantile splitters; they
   cut the keys into many more ranges than shards.
3. Ranges that hold too many bytes are subdivided by splitters sampled inside them.
4. With the exact bytes and rows of every range, a running sum within each range places
   a row at its global byte position; equal stretches of bytes are the shards.

All work is native. Splitters and range totals are small written tables (at most about
``most_ranges`` rows); a row finds its range by a binary search in the sorted splitters,
which a scalar subquery brings to every task once. The driver sees a few single numbers.

Defined results: a null text has no bytes; a null id sorts first; repeated rows are
rows of their own, next to each other; an empty table gives an empty result; columns of
the input named like those that are added are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, table

SHARDS = 40
ROW_BYTES = 16
RANGES_A_SHARD = 16
RANGE_BYTES = 256 << 20
MOST_RANGES = 16_384
SAMPLES_A_RANGE = 8
ROUNDS = 3
KEY = ("_id", "_hash", "_row")
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def keyed(docs: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    """The columns ``carried``, key, size and checksum of every row; the text itself only if carried."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(
        *carried,
        (F.octet_length(text).cast("long") + ROW_BYTES).alias("_size"),
        F.crc32(text).alias("_crc"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("_id"),
        F.xxhash64(id_col, text_col).alias("_hash"),
        F.monotonically_increasing_id().alias("_row"),
    )


def with_range(rows: DataFrame, splitters: DataFrame, count: int) -> DataFrame:
    """``rows`` with ``_range``: how many of the ``count`` splitters are at or below the key.

    The search is one expression: as a chain of projections, what the optimizer infers
    of a column at every join would double with every step."""
    array = splitters.agg(F.sort_array(F.collect_list(F.struct(*KEY))).alias("a")).scalar()
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, count.bit_length())))])
    below = lambda at: (at <= count) & (F.get("_array", at - 1) <= F.struct(*KEY))
    found = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(below(at + step), step).otherwise(0))
    return rows.withColumn("_array", array).withColumn("_range", F.coalesce(found, F.lit(0))).drop("_array")


def drawn(rows: DataFrame, share: Column, turn: int) -> DataFrame:
    """Key and weight ``w`` of rows drawn with the chance ``_size * share``; a row so large
    that it is certain counts as often as it would be drawn."""
    chance = F.col("_size") * share
    draw = (F.xxhash64(*KEY, F.lit(turn)).cast("double") / 2.0**64) + 0.5
    return rows.filter(draw < chance).withColumn("w", F.greatest(F.lit(1), F.floor(chance)).cast("long"))


def quantiles(sample: DataFrame, parts: Column, within: Column) -> DataFrame:
    """The keys that cut the sample's weight within each ``within`` into ``parts`` equal parts.

    The sample has a bounded number of rows, so one window over all of it is too."""
    order = Window.partitionBy(within).orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sample.withColumns({"_upto": F.sum("w").over(order), "_all": F.sum("w").over(Window.partitionBy(within)), "_parts": parts})
    passed = lambda weight: f"least(_parts - 1, ({weight} * _parts - 1) div _all)"  # noqa: E731  how many cuts lie below it
    return summed.filter(F.expr(f"{passed('_upto')} > greatest(0, {passed('(_upto - w)')})")).select(*KEY)


def range_totals(rows: DataFrame, splitters: DataFrame, count: int) -> DataFrame:
    return materialise(with_range(rows.select(*KEY, "_size"), splitters, count).groupBy("_range").agg(F.sum("_size").alias("bytes"), F.count("*").alias("n")), "totals")


def splitters_for(rows: DataFrame, total: int, ranges: int) -> tuple[DataFrame, int, DataFrame]:
    """Splitters, their number, and (bytes, n) of each range, as written tables."""
    even = total / ranges
    sample = drawn(rows.select(*KEY, "_size"), F.lit(SAMPLES_A_RANGE * ranges / total), 0)
    splitters = materialise(quantiles(sample, F.lit(ranges).cast("long"), F.lit(0)), "splitters")
    count = splitters.count()
    totals = range_totals(rows, splitters, count)
    for turn in range(1, ROUNDS + 1):
        overfull = totals.filter((F.col("bytes") > 2 * even) & (F.col("n") > 1))
        if overfull.isEmpty():
            break
        # a range of twice the even bytes or more: fewer of them than ranges
        inside = with_range(rows.select(*KEY, "_size"), splitters, count).join(F.broadcast(overfull), "_range")
        own = drawn(inside, F.lit(4 * SAMPLES_A_RANGE / even), turn)
        more = quantiles(own, (1 + F.floor(2 * F.col("bytes") / even)).cast("long"), F.col("_range"))
        grown = materialise(splitters.union(more).distinct(), "splitters")
        now = grown.count()
        if now == count:
            break
        old, splitters, count, totals = (splitters, totals), grown, now, range_totals(rows, grown, now)
        discard(rows.sparkSession, *old)
    return splitters, count, totals


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", most_ranges: int = MOST_RANGES, columns: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` with ``size, text_crc32, law, shard, slot, grown_shard``; of the
    columns of ``docs``, those named (all if none are), which are written once."""
    own = [c for c in (docs.columns if columns is None else columns) if c not in ADDED]
    safe = {c: f"own_{k}" for k, c in enumerate(own)}  # no clash with the names used here
    renamed = docs.select(*[F.col(c).alias(n) for c, n in safe.items()], F.col(id_col).alias("key_id"), F.col(text_col).alias("key_text"))
    rows = materialise(keyed(renamed, "key_id", "key_text", list(safe.values())), "keys")
    total = rows.agg(F.sum("_size")).first()[0] or 1
    ranges = int(min(most_ranges, max(shards * RANGES_A_SHARD, total // RANGE_BYTES)))
    splitters, count, totals = splitters_for(rows, total, ranges)
    # range totals are bounded by the number of splitters, so one window over them and a broadcast are too
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("_range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("_first_byte"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first_row"))
    by_key = Window.partitionBy("_range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def placed(frame: DataFrame) -> DataFrame:
        at = with_range(frame, splitters, count).withColumns({"_end": F.sum("_size").over(by_key), "_nth": F.count(F.lit(1)).over(by_key)})
        at = at.join(F.broadcast(first), "_range")
        # the byte position of a row is its middle, so a row across a border goes where most of it lies
        middle = F.col("_first_byte") + F.col("_end") - F.expr("_size div 2") - 1
        return at.withColumns({"_shard": F.least(F.lit(shards - 1), F.floor(middle * shards / total)).cast("int"), "_place": F.col("_first_row") + F.col("_nth") - 1})

    starts = materialise(placed(rows.select(*KEY, "_size")).groupBy("_shard").agg(F.min("_place").alias("_start")), "starts")
    return (
        placed(rows)
        .join(F.broadcast(starts), "_shard")  # a row a shard
        .select(
            *[F.col(n).alias(c) for c, n in safe.items()],
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            F.col("_shard").alias("shard"),
            (F.col("_place") - F.col("_start")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def op6_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), columns=["doc_id"])
