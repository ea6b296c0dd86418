"""The catalogue's frames over the test tables, in Spark and as SQL.

Products are ``part`` rows, offers ``lineitem`` rows, sources suppliers or users, run
logs ``events``, stored and crawled snapshots two overlapping selections of products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

CUTOFF = "2024-01-20 00:00:00"


def offers(spark: SparkSession, d: str) -> DataFrame:
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    joined = line.join(part, line.l_partkey == part.p_partkey)
    return joined.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("p_partkey").alias("product_id"),
        F.col("l_suppkey").alias("platform"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("l_extendedprice").alias("original"),
        F.when(F.col("l_discount") > 0, F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")))).cast("double").alias("sale"),
        F.when(F.col("l_discount") > 0, "sale").when(F.col("l_tax") > 0, "regular").otherwise("unknown").alias("state"),
        F.col("l_shipdate").alias("observed_at"),
        (F.col("l_returnflag") != "R").alias("in_stock"),
    )


OFFERS = """offers AS (
    SELECT l_orderkey AS order_id, l_linenumber AS line, p_partkey AS product_id, l_suppkey AS platform, p_name AS name, p_brand AS brand, p_type AS category,
           l_extendedprice AS original, CASE WHEN l_discount > 0 THEN floor(l_extendedprice * (1 - l_discount)) END AS sale,
           CASE WHEN l_discount > 0 THEN 'sale' WHEN l_tax > 0 THEN 'regular' ELSE 'unknown' END AS state, l_shipdate AS observed_at, l_returnflag <> 'R' AS in_stock
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the catalogue as stored: some products have several addresses."""
    p = table(spark, d, "part").filter("p_partkey % 10 <> 7")
    row = lambda suffix, where: p.filter(where).select(
        (F.col("p_partkey") * 2 + (1 if suffix else 0)).alias("id"),
        F.concat(F.lit("https://www.shop.example/product/x/"), F.col("p_partkey"), F.lit(suffix or "/")).alias("product_url"),
        F.col("p_retailprice").alias("price"),
        F.col("p_retailprice").alias("original_price"),
        (F.col("p_partkey") % 3 != 0).alias("in_stock"),
        F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(cast(p_partkey % 40 as int))").alias("last_seen_at"),
        F.col("p_brand").alias("brand"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
    )
    return row("", "true").unionByName(row("/category/7/", "p_partkey % 5 = 0"))


STORED = """stored AS (
    SELECT p_partkey * 2 + k AS id, 'https://www.shop.example/product/x/' || p_partkey || CASE k WHEN 0 THEN '/' ELSE '/category/7/' END AS product_url,
           p_retailprice AS price, p_retailprice AS original_price, p_partkey % 3 <> 0 AS in_stock,
           TIMESTAMP '2024-01-01 00:00:00' + to_days((p_partkey % 40)::INT) AS last_seen_at, p_brand AS brand, p_name AS name, p_type AS category
    FROM part, (VALUES (0), (1)) AS v(k) WHERE p_partkey % 10 <> 7 AND (k = 0 OR p_partkey % 5 = 0))"""


def listing(spark: SparkSession, d: str) -> DataFrame:
    """A crawled snapshot, with repeated observations of some addresses."""
    p = table(spark, d, "part").filter("p_partkey % 10 <> 3")
    first = p.select(
        F.col("p_partkey").alias("ord"),
        F.concat(F.lit("https://shop.example/product/y/"), F.col("p_partkey"), F.when(F.col("p_partkey") % 4 == 0, "/").otherwise("")).alias("product_url"),
        F.when(F.col("p_partkey") % 4 == 0, F.round(F.col("p_retailprice") * 0.9, 2)).otherwise(F.col("p_retailprice")).alias("price"),
        (F.col("p_partkey") % 6 != 0).alias("in_stock"),
        F.expr("timestamp'2024-01-20 00:00:00' + make_dt_interval(cast(p_partkey % 9 as int))").alias("observed_at"),
    )
    again = first.filter("ord % 8 = 0").withColumns({"ord": F.col("ord") + 10_000_000, "price": F.col("price") + 1})
    return first.unionByName(again)


LISTING = """first_seen AS (
    SELECT p_partkey AS ord, 'https://shop.example/product/y/' || p_partkey || CASE WHEN p_partkey % 4 = 0 THEN '/' ELSE '' END AS product_url,
           CASE WHEN p_partkey % 4 = 0 THEN round(p_retailprice * 0.9, 2) ELSE p_retailprice END AS price, p_partkey % 6 <> 0 AS in_stock,
           TIMESTAMP '2024-01-20 00:00:00' + to_days((p_partkey % 9)::INT) AS observed_at
    FROM part WHERE p_partkey % 10 <> 3),
    listing AS (SELECT * FROM first_seen UNION ALL SELECT ord + 10000000, product_url, price + 1, in_stock, observed_at FROM first_seen WHERE ord % 8 = 0)"""


def runs(spark: SparkSession, d: str) -> DataFrame:
    """The run log: one row a run of a source."""
    e = table(spark, d, "events")
    status = F.expr("case event_type when 'error' then 'failed' when 'purchase' then 'success' when 'signup' then 'partial' when 'view' then 'skipped' else 'running' end")
    return e.select(F.col("event_id").alias("run_id"), F.col("user_id").alias("source"), F.col("ts").alias("started_at"), status.alias("status"), (F.col("event_id") % 7 == 0).alias("unreachable_only"), (F.col("event_id") % 5 == 0).alias("db_partial_only"), F.col("value"))


RUNS = """runs AS (
    SELECT event_id AS run_id, user_id AS source, ts AS started_at,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' WHEN 'signup' THEN 'partial' WHEN 'view' THEN 'skipped' ELSE 'running' END AS status,
           event_id % 7 = 0 AS unreachable_only, event_id % 5 = 0 AS db_partial_only, value
    FROM events)"""
