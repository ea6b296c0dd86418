"""Validation, quality gates, metrics and reports over batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """With ``error``: ``field`` of the first rule that fails, null if all hold."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), field) for field, ok in rules.items()]))
    return df.withColumn("error", F.get(failed, 0))


def share(part: Column, total: Column) -> Column:
    """Percent, two digits; 0 of nothing."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(part * 100.0 / total, 2))


def batch_quality(df: DataFrame, by: list[str], flags: dict[str, Column], limits: dict[str, float]) -> DataFrame:
    """Counts and shares of each flag a group, and the flags beyond their limit."""
    counted = df.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(c).alias(f"{k}_count") for k, c in flags.items()])
    shares = counted.withColumns({f"{k}_share": share(F.col(f"{k}_count"), F.col("total")) for k in flags})
    beyond = F.array_compact(F.array(*[F.when(F.col(f"{k}_share") > x, k) for k, x in limits.items()]))
    return shares.withColumn("problems", F.array_join(beyond, ",")).withColumn("pass", F.size(beyond) == 0)


def samples_by(df: DataFrame, by: list[str], sample: str, order: Column, most: int = 3) -> DataFrame:
    """``count`` a group and its first ``most`` samples; no group is gathered whole."""
    at = Window.partitionBy(*by).orderBy(order)
    ranked = df.withColumn("_r", F.row_number().over(at))
    kept = ranked.filter(F.col("_r") <= most).groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(sample).cast("string").alias("s")))), lambda x: x["s"]), ",").alias("samples"))
    return df.groupBy(*by).agg(F.count("*").alias("count")).join(kept, by)


def gate_against(before: DataFrame, after: DataFrame, least: dict[str, float]) -> DataFrame:
    """One row: the metrics of ``after`` (one-row frames) that fall below ``least`` times before's."""
    joined = before.select(*[F.col(k).alias(f"_{k}") for k in least]).crossJoin(after)
    low = F.array_compact(F.array(*[F.when(F.col(k) < F.col(f"_{k}") * x, k) for k, x in least.items()]))
    return joined.select(*least, F.array_join(low, ",").alias("failures"), (F.size(low) == 0).alias("pass"))


def dominant_value(df: DataFrame, key: str, value: str, least_share: float, least_rows: int) -> DataFrame:
    """The most frequent value a key with its share; ``decision`` is adopt or review."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    total = n.withColumn("total", F.sum("n").over(Window.partitionBy(key)))
    top = total.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), value))).filter("_r = 1")
    part = F.col("n") / F.col("total")
    decision = F.when(F.col("total") < least_rows, "review:few").when(part < least_share, "review:mixed").otherwise("adopt")
    return top.select(key, value, "n", "total", F.round(part, 6).alias("share"), decision.alias("decision"))


def run_health(df: DataFrame, by: str) -> DataFrame:
    """``status, reason`` a source; the first rule that holds wins."""
    a = df.groupBy(by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("status") == "success").alias("succeeded"))
    rule = F.when(F.col("succeeded") == 0, F.array(F.lit("failed"), F.lit("no-success"))).when(F.col("failed") * 2 > F.col("total"), F.array(F.lit("failed"), F.lit("mostly-failed"))).when(F.col("failed") > F.col("succeeded"), F.array(F.lit("degraded"), F.lit("more-failed-than-succeeded"))).otherwise(F.array(F.lit("success"), F.lit("")))
    return a.withColumn("status", F.get(rule, 0)).withColumn("reason", F.get(rule, 1))
