"""Lookups and matches between catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import first_apart
from ..functions.text import trigrams
from ..scratch import materialise
from ..shipping import ship
from .ordering import placed, summed_to


def unique_lookup(rows: DataFrame, dimension: DataFrame, row_keys: list[Column], dim_keys: list[Column], row_id: str, dim_id: str) -> DataFrame:
    """``row_id, dim_id``: the one dimension row that shares a key, null if none or several do."""
    left = rows.select(F.col(row_id).alias("_row"), F.explode(F.array_distinct(F.array_compact(F.array(*row_keys)))).alias("_key"))
    right = dimension.select(F.col(dim_id).alias("_dim"), F.explode(F.array_distinct(F.array_compact(F.array(*dim_keys)))).alias("_key"))
    # one row a key is enough: that which is the only one over all keys is the first and the last of each
    right = right.groupBy("_key").agg(F.min("_dim").alias("_low"), F.max("_dim").alias("_high"))
    found = left.join(right, "_key").groupBy("_row").agg(F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    one = found.filter("_low = _high").select(F.col("_row").alias(row_id), F.col("_low").alias(dim_id))
    return rows.select(row_id).join(one, row_id, "left")


def fuzzy_best(left: DataFrame, right: DataFrame, left_id: str, right_id: str, text: str, threshold: float) -> DataFrame:
    """The right row with the largest trigram Jaccard similarity, at least ``threshold``;
    ties to the smaller id. Pairs meet on shared trigrams only, which loses none as long
    as the threshold is positive. A pair above the threshold shares one of the rarest
    trigrams of the left text (prefix filter), so frequent ones make no pairs."""
    a = left.select(F.col(left_id).alias("_a"), trigrams(F.col(text)).alias("_ta"))
    b = right.select(F.col(right_id).alias("_b"), trigrams(F.col(text)).alias("_tb"))
    grams = b.select(F.explode("_tb").alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    rare = a.select("_a", F.size("_ta").alias("size"), F.explode("_ta").alias("g")).join(grams, "g", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    order = Window.partitionBy("_a").orderBy("n", "g")
    # at most (1 - threshold) of the left text's trigrams may be missing from the other
    prefix = rare.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= F.col("size") - F.ceil(F.lit(threshold) * F.col("size")) + 1)
    pairs = prefix.filter("n > 0").select("_a", "g").join(b.select("_b", F.explode("_tb").alias("g")), "g").select("_a", "_b").distinct()
    both = F.size(F.array_intersect("_ta", "_tb"))
    scored = pairs.join(a, "_a").join(b, "_b").withColumn("score", both / (F.size("_ta") + F.size("_tb") - both)).filter(F.col("score") >= threshold)
    best = Window.partitionBy("_a").orderBy(F.desc("score"), "_b")
    return scored.withColumn("_r", F.row_number().over(best)).filter("_r = 1").select(F.col("_a").alias(left_id), F.col("_b").alias(right_id), "score")


def candidate_pairs(df: DataFrame, keys: list[str], id_: str, host: str) -> DataFrame:
    """Pairs ``left_id < right_id`` of rows that agree on ``keys`` and differ in ``host``."""
    a = df.select(*keys, F.col(id_).alias("left_id"), F.col(host).alias("_h1"))
    b = df.select(*keys, F.col(id_).alias("right_id"), F.col(host).alias("_h2"))
    return a.join(b, keys).filter("left_id < right_id and _h1 <> _h2").select("left_id", "right_id")


def candidate_partners(df: DataFrame, keys: list[str], id_: str, host: str) -> DataFrame:
    """``left_id, partners, last`` of ``candidate_pairs``, without making the pairs: how many rows
    of other hosts with a larger id agree on ``keys``, and the largest such id.

    Places in two sorted orders count the rows after one; the largest id of another host
    comes from the two best hosts of a group. So no group meets in one task."""
    rows = df.filter(" and ".join(f"{k} is not null" for k in [*keys, host])).select(*keys, F.col(id_).alias("_id"), F.col(host).alias("_host"))
    order = [F.asc(k) for k in keys]
    a = placed(placed(rows, *order, F.asc("_id"), name="_all"), *order, F.asc("_host"), F.asc("_id"), name="_same")
    a = materialise(a, "partners")
    hosts = a.groupBy(*keys, "_host").agg(F.max("_same").alias("_same_end"), F.max("_id").alias("_host_last"))
    top = hosts.groupBy(*keys).agg(F.max(F.struct("_host_last", "_host")).alias("_top"))
    second = hosts.join(top, keys).filter("_host <> _top._host").groupBy(*keys).agg(F.max("_host_last").alias("_second"))
    groups = a.groupBy(*keys).agg(F.max("_all").alias("_all_end")).join(top, keys).join(second, keys)
    j = a.join(hosts.drop("_host_last"), [*keys, "_host"]).join(groups, keys)
    partners = (F.col("_all_end") - F.col("_all")) - (F.col("_same_end") - F.col("_same"))
    last = F.when(F.col("_host") == F.col("_top._host"), F.col("_second")).otherwise(F.col("_top._host_last"))
    return j.select(F.col("_id").alias("left_id"), partners.alias("partners"), last.alias("last")).filter("partners > 0")


def _laws(host: str, brand: str | None) -> Column:
    """Groups with a sign each, whose pairs add up to those of different ``host`` and, with ``brand``, of no two different
    brands: all pairs less those of one host, of the rows with brands only those of one brand."""
    law = lambda number, sign, where=None, b=None, h=None: F.when(F.lit(True) if where is None else where, F.struct(F.lit(number).alias("law"), F.lit(sign).alias("sign"), (F.lit(None).cast("string") if b is None else F.col(b).cast("string")).alias("b"), (F.lit(None).cast("string") if h is None else F.col(h).cast("string")).alias("h")))
    out = [law(0, 1), law(1, -1, h=host)]
    if brand:
        known = F.col(brand).isNotNull()
        out += [law(2, -1, known), law(3, 1, known, h=host), law(4, 1, known, brand), law(5, -1, known, brand, host)]
    return F.explode(F.array_compact(F.array(*out)))


def _whole(n: Column) -> Column:
    return n.cast("decimal(19,0)")


def count_pairs(nodes: DataFrame, keys: list[str], host: str, n: str, name: str, brand: str | None = None) -> DataFrame:
    """``name``, one row: how many pairs of rows agree on ``keys``, differ in ``host`` and, with ``brand``, do not differ in
    that (a missing one differs from none). ``nodes`` stands for ``n`` rows each. Counted from groups, not from pairs."""
    known = nodes.filter(" and ".join(f"{k} is not null" for k in [*keys, host]))
    groups = known.select(*keys, n, _laws(host, brand).alias("_law")).groupBy(*keys, "_law").agg(F.sum(n).alias("_n"))
    pairs = F.floor(_whole(F.col("_n")) * _whole(F.col("_n") - 1) / 2) * F.col("_law.sign")
    return groups.agg(F.coalesce(F.sum(pairs.cast("decimal(38,0)")), F.lit(0)).cast("long").alias(name))


def count_near(nodes: DataFrame, keys: list[str], host: str, n: str, name: str, value: str, gap: float, brand: str | None = None) -> DataFrame:
    """As ``count_pairs``, of those pairs only that are less than ``gap`` (above 0) apart in ``value``, a finite double.

    A row is near all rows from it on up to the first value that is ``gap`` apart. Each value and each such
    end are rows of one order, in which sums count the rows before an end; so no group meets in one task."""
    ship(nodes.sparkSession)
    known = nodes.filter(" and ".join(f"{k} is not null" for k in [*keys, host]))
    dealt = known.select(*keys, F.col(value).alias("_value"), n, _laws(host, brand).alias("_law")).groupBy(*keys, "_law", "_value").agg(F.sum(n).alias("_n"))
    end = F.struct(first_apart(F.col("_value"), gap).alias("at"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("rows"), F.col("_n").alias("ends"))
    row = F.struct(F.col("_value").alias("at"), F.lit(1).alias("kind"), F.col("_n").alias("rows"), F.lit(0).cast("long").alias("ends"))
    places = dealt.select(*keys, "_law", F.explode(F.array(end, row)).alias("_e")).select(*keys, "_law", "_e.*")
    order = [F.asc(k) for k in [*keys, "_law", "at", "kind"]]
    placed_ = summed_to(places, F.col("rows"), "_upto", *order)
    before = F.sum(_whole(F.col("ends")) * _whole(F.col("_upto"))).cast("decimal(38,0)")
    groups = placed_.groupBy(*keys, "_law").agg(before.alias("_ends"), F.min(F.col("_upto") - F.col("rows")).alias("_begin"), F.sum("rows").alias("_n"))
    m = _whole(F.col("_n"))
    own = groups.select(F.col("_law.sign").alias("_sign"), (F.col("_ends") - m * _whole(F.col("_begin"))).cast("decimal(38,0)").alias("_met"), F.floor(m * _whole(F.col("_n") + 1) / 2).cast("decimal(38,0)").alias("_self"))
    return own.agg(F.coalesce(F.sum(((F.col("_met") - F.col("_self")) * F.col("_sign")).cast("decimal(38,0)")), F.lit(0)).cast("long").alias(name))


def match_decision(same_identifier: Column, similarity: Column, same_category: Column) -> Column:
    return F.when(same_identifier, F.struct(F.lit("auto").alias("status"), F.lit(1.0).alias("confidence"), F.lit("identifier").alias("reason"))).when((similarity >= 0.8) & same_category, F.struct(F.lit("review").alias("status"), similarity.alias("confidence"), F.lit("similar-name").alias("reason"))).otherwise(F.struct(F.lit("reject").alias("status"), similarity.alias("confidence"), F.lit("different").alias("reason")))


def catalogue_decision(brands: tuple[Column, Column], colours: tuple[Column, Column], identifier: Column, similarity: Column, same_category: Column) -> Column:
    """``status, confidence, reason`` of two rows of the catalogue.

    Other brands and other colours are never one product; without both colours a person
    decides. A shared ``identifier`` (``gtin`` or another kind, null if there is none) is
    proof; much the same name in the same category is for a person again."""
    out = lambda status, confidence, reason: F.struct(F.lit(status).alias("status"), confidence.cast("double").alias("confidence"), F.lit(reason).alias("reason"))
    a, b = colours
    alike = F.coalesce(same_category & (similarity >= 0.8), F.lit(False))
    return (
        F.when(~brands[0].eqNullSafe(brands[1]), out("reject", F.lit(1), "brand_conflict"))
        .when(a.isNull() | b.isNull(), out("review", F.lit(0), "color_evidence_missing"))
        .when(a != b, out("reject", F.lit(1), "color_conflict"))
        .when(identifier.isNotNull(), out("auto", F.when(identifier == "gtin", 1.0).otherwise(0.995), "trusted_identifier_exact"))
        .when(alike, out("review", F.least(F.lit(0.94), 0.55 + similarity * 0.35), "composite_candidate_requires_review"))
        .otherwise(out("reject", similarity, "insufficient_evidence"))
    )


def ready(df: DataFrame, id_: str, *sets: DataFrame) -> DataFrame:
    """Rows whose id is in every set."""
    for s in sets:
        df = df.join(s.select(id_), id_, "left_semi")
    return df
