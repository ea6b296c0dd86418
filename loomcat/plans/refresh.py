"""Queries on pricing, listing comparison, writes and scheduling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import money
from ..operators import listing as L
from ..operators import schedule
from ..operators.ordering import placed
from .frames import CUTOFF, LISTING, OFFERS, RUNS, STORED, listing, offers, runs, stored
from .registry import query, table

PRICED = f"""{OFFERS}, priced AS (
    SELECT *, state = 'sale' AND sale > 0 AND sale < original AS real FROM offers),
  fields AS (
    SELECT *, CASE WHEN real THEN sale ELSE original END AS p_price, original AS p_original, CASE WHEN real THEN sale END AS p_sale,
           CASE WHEN real THEN 'sale' WHEN state = 'regular' THEN 'regular' ELSE 'unknown' END AS p_state FROM priced)"""


def priced(spark, d):
    o = offers(spark, d)
    return o.withColumn("pricing", money.observed_pricing(F.col("original"), F.col("original"), F.col("sale"), F.col("state"), F.lit("listing")))


@query(
    "a12_observed_pricing",
    f"""WITH {PRICED}
    SELECT platform, count(*) AS offers, count(*) FILTER (WHERE p_state = 'sale') AS on_sale, count(*) FILTER (WHERE p_state = 'regular') AS regular,
           count(*) FILTER (WHERE p_state = 'unknown') AS unknown, count(*) FILTER (WHERE p_sale >= p_original) AS broken,
           round(sum(p_price::DECIMAL(18,2)), 2)::DOUBLE AS total_price FROM fields GROUP BY platform""",
)
def observed_pricing(spark, d):
    p = priced(spark, d).select("platform", "pricing.*")
    return p.groupBy("platform").agg(
        F.count("*").alias("offers"),
        *[F.count_if(F.col("state") == s).alias(n) for s, n in (("sale", "on_sale"), ("regular", "regular"), ("unknown", "unknown"))],
        F.count_if(F.col("sale_price") >= F.col("original_price")).alias("broken"),
        F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("total_price"),
    )


@query(
    "x14_stored_price_fields",
    f"""WITH {PRICED}, c AS (SELECT *, platform % 3 <> 0 AS converted, CASE platform % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 1.5 END::DOUBLE AS rate FROM fields),
    r AS (SELECT order_id, line, product_id, platform, converted, rate,
        CASE WHEN converted THEN floor(p_price * rate + 0.5) ELSE p_price END AS a, CASE WHEN converted THEN floor(p_original * rate + 0.5) ELSE p_original END AS b, CASE WHEN converted THEN floor(p_sale * rate + 0.5) ELSE p_sale END AS s FROM c),
    w AS (SELECT *, CASE WHEN a > 0 AND a <= 100000000 AND a = floor(a) THEN a::BIGINT END AS wa, CASE WHEN b > 0 AND b <= 100000000 AND b = floor(b) THEN b::BIGINT END AS wb, CASE WHEN s > 0 AND s <= 100000000 AND s = floor(s) THEN s::BIGINT END AS ws FROM r),
    e AS (SELECT platform, coalesce(ws, wa) AS price, coalesce(wb, wa) AS original_price, ws AS sale_price, (rate IS NOT NULL OR NOT converted) AND coalesce(ws, wa) IS NOT NULL AND coalesce(wb, wa) IS NOT NULL AND (ws IS NULL OR (ws < coalesce(wb, wa) AND ws = coalesce(ws, wa))) AS sound FROM w)
    SELECT platform, count(*) AS offers, count(*) FILTER (WHERE sound) AS storable, coalesce(sum(price) FILTER (WHERE sound), 0)::BIGINT AS price_sum, coalesce(sum(original_price) FILTER (WHERE sound), 0)::BIGINT AS original_sum, count(*) FILTER (WHERE sound AND sale_price IS NOT NULL) AS sales FROM e GROUP BY platform""",
)
def stored_price_fields(spark, d):
    p = priced(spark, d)
    converted, rate = F.col("platform") % 3 != 0, F.when(F.col("platform") % 3 == 0, 1.0).when(F.col("platform") % 3 == 1, 1.5)
    f = p.select("platform", money.stored_price(F.col("pricing"), rate, converted).alias("f"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return f.groupBy("platform").agg(F.count("*").alias("offers"), F.count("f").alias("storable"), total("f.price").alias("price_sum"), total("f.original_price").alias("original_sum"), F.count("f.sale_price").alias("sales"))


MATCHED = f"""{STORED}, {LISTING},
  seen AS (SELECT * FROM listing QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY ord) = 1),
  keyed AS (SELECT *, regexp_extract(product_url, '/product/[^/]+/([0-9]+)', 1) AS k FROM seen),
  matched AS (SELECT s.*, n.ord AS new_ord, n.price AS new_price, n.in_stock AS new_in_stock, n.observed_at AS new_observed_at
              FROM stored s JOIN keyed n ON regexp_extract(s.product_url, '/product/[^/]+/([0-9]+)', 1) = n.k
              QUALIFY row_number() OVER (PARTITION BY s.id ORDER BY n.ord) = 1)"""


# observations without a price or a time, rows crawled after they were last seen, and rows in quarantine
GAPS = f"""{MATCHED}, gaps AS (SELECT *, CASE WHEN new_ord % 13 <> 0 THEN new_price END AS np, CASE WHEN new_ord % 17 <> 0 THEN new_observed_at END AS nt, CASE WHEN id % 4 <> 3 THEN price END AS p,
      greatest(last_seen_at, CASE WHEN id % 3 = 0 THEN last_seen_at + INTERVAL 2 DAYS END) AS known, id % 22 = 0 AS quarantined FROM matched),
  b AS (SELECT *, nt IS NULL OR nt < known AS late, CASE WHEN original_price > 0 THEN original_price WHEN p > 0 THEN p ELSE np END AS base, CASE WHEN quarantined AND new_in_stock THEN false ELSE new_in_stock END AS stock FROM gaps)"""


def with_gaps(spark, d):
    new, old = listing(spark, d), stored(spark, d)
    # matched rows keep the first observation of an address, whose gaps these are
    new = new.withColumns({"price": F.when(F.col("ord") % 13 != 0, F.col("price")), "observed_at": F.when(F.col("ord") % 17 != 0, F.col("observed_at"))})
    old = old.withColumns({"price": F.when(F.col("id") % 4 != 3, F.col("price")), "crawled_at": F.when(F.col("id") % 3 == 0, F.expr("last_seen_at + interval 2 days")), "quarantined": F.col("id") % 22 == 0})
    return new, old


@query(
    "j1_listing_diff",
    f"""WITH {GAPS} SELECT id, CASE WHEN late THEN 'stale' WHEN stock <> in_stock AND stock THEN 'restocked' WHEN stock <> in_stock AND NOT (quarantined AND new_in_stock) THEN 'sold_out' WHEN quarantined AND new_in_stock AND in_stock THEN 'blocked'
      WHEN np IS NOT NULL AND np IS DISTINCT FROM p THEN 'price' ELSE 'unchanged' END AS outcome,
      CASE WHEN late OR np IS NULL THEN p ELSE np END AS price, CASE WHEN late OR np IS NULL THEN original_price WHEN np < base THEN base ELSE np END AS original_price,
      CASE WHEN NOT late AND np < base THEN np END AS sale_price, CASE WHEN late THEN in_stock ELSE stock END AS in_stock FROM b""",
)
def listing_diff(spark, d):
    return L.diff_listing(*with_gaps(spark, d))


@query("j2_missing_rows", f"WITH {MATCHED} SELECT id, product_url FROM stored WHERE id NOT IN (SELECT id FROM matched)")
def missing_rows(spark, d):
    return L.missing_rows(listing(spark, d), stored(spark, d)).select("id", "product_url")


@query("j3_unknown_observations", f"WITH {MATCHED} SELECT ord, product_url, price FROM keyed WHERE k NOT IN (SELECT regexp_extract(product_url, '/product/[^/]+/([0-9]+)', 1) FROM stored)")
def unknown_observations(spark, d):
    return L.unknown_observations(listing(spark, d), stored(spark, d)).select("ord", "product_url", "price")


@query(
    "t6_completeness_guard",
    f"""WITH {MATCHED}, gone AS (SELECT * FROM stored WHERE id NOT IN (SELECT id FROM matched)),
    g AS (SELECT ((SELECT count(*) FROM stored) - (SELECT count(*) FROM gone)) / (SELECT count(*) FROM stored)::DOUBLE AS coverage)
    SELECT id, round(coverage, 9) AS coverage FROM gone, g WHERE in_stock AND coverage >= 0.5""",
)
def completeness_guard(spark, d):
    return L.mark_missing(listing(spark, d), stored(spark, d), 0.5).select("id", F.round("coverage", 9).alias("coverage"))


@query("a13_coverage", f"WITH {MATCHED} SELECT s.brand, count(*) AS total, count(m.id) AS seen, round(count(m.id) / count(*)::DOUBLE, 9) AS coverage FROM stored s LEFT JOIN matched m USING (id) GROUP BY s.brand")
def coverage(spark, d):
    s = stored(spark, d)
    gone = L.missing_rows(listing(spark, d), s).select("id", F.lit(1).alias("gone"))
    g = s.join(gone, "id", "left").groupBy("brand").agg(F.count("*").alias("total"), F.count("gone").alias("gone"))
    return g.select("brand", "total", (F.col("total") - F.col("gone")).alias("seen"), F.round(L.coverage(F.col("total"), F.col("gone")), 9).alias("coverage"))


@query(
    "j4_image_changes",
    """WITH a AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS image FROM customer WHERE c_custkey % 7 <> 0),
    b AS (SELECT c_custkey AS id, CASE WHEN c_nationkey % 3 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN 'new' ELSE c_mktsegment END AS image FROM customer WHERE c_custkey % 11 <> 0)
    SELECT CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' WHEN a.image IS NOT DISTINCT FROM b.image THEN 'same' WHEN a.image IS NULL THEN 'gained' WHEN b.image IS NULL THEN 'lost' ELSE 'changed' END AS bucket, count(*) AS n
    FROM a FULL JOIN b ON a.id = b.id GROUP BY 1""",
)
def image_changes(spark, d):
    c = table(spark, d, "customer")
    a = c.filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("id"), F.expr("case when c_nationkey % 5 = 0 then null else c_mktsegment end").alias("image_url"))
    b = c.filter("c_custkey % 11 <> 0").select(F.col("c_custkey").alias("id"), F.expr("case when c_nationkey % 3 = 0 then null when c_custkey % 4 = 0 then 'new' else c_mktsegment end").alias("image_url"))
    return L.image_changes(a, b).groupBy("bucket").agg(F.count("*").alias("n"))


@query(
    "t9_embedding_invalidation",
    """WITH a AS (SELECT p_partkey AS id, p_name || '_' || p_size || 'x' || p_size || '.jpg' AS image FROM part),
    b AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 4 = 0 THEN p_type || '.jpg' ELSE p_name || '.jpg' END AS image FROM part),
    j AS (SELECT regexp_replace(a.image, '_[0-9]+x[0-9]*(\\.[A-Za-z]{3,4})$', '\\1') AS x, b.image AS y FROM a JOIN b USING (id))
    SELECT count(*) AS total, count(*) FILTER (WHERE x IS DISTINCT FROM y) AS invalidated, round(count(*) FILTER (WHERE x IS DISTINCT FROM y) / count(*)::DOUBLE, 9) AS ratio, count(*) FILTER (WHERE x IS DISTINCT FROM y) / count(*)::DOUBLE >= 0.2 AS alert FROM j""",
)
def embedding_invalidation(spark, d):
    n = changed_images(spark, d).agg(F.count("*").alias("total"), F.count_if("invalidated").alias("invalidated"))
    return n.withColumn("ratio", F.round(F.col("invalidated") / F.col("total"), 9)).withColumn("alert", F.col("invalidated") / F.col("total") >= 0.2)


def changed_images(spark, d):
    from ..functions.urls import plain_image

    p = table(spark, d, "part")
    old = plain_image(F.concat("p_name", F.lit("_"), "p_size", F.lit("x"), "p_size", F.lit(".jpg")))
    new = F.when(F.col("p_partkey") % 9 == 0, None).when(F.col("p_partkey") % 4 == 0, F.concat("p_type", F.lit(".jpg"))).otherwise(F.concat("p_name", F.lit(".jpg")))
    return p.select(F.col("p_partkey").alias("id"), (~old.eqNullSafe(new)).alias("invalidated"))


@query("t9_invalidated_rows", "SELECT p_partkey AS id, p_partkey % 9 = 0 OR (p_partkey % 4 = 0 AND p_type <> p_name) AS invalidated FROM part")
def invalidated_rows(spark, d):
    return changed_images(spark, d)


@query(
    "w2_upsert_outcomes",
    """WITH s AS (SELECT c_custkey AS id, c_acctbal AS v, c_custkey % 5 AS version FROM customer WHERE c_custkey % 6 <> 0),
    n AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal ELSE c_acctbal + 1 END AS v, CASE WHEN c_custkey % 6 = 0 AND c_custkey % 12 <> 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 99 ELSE c_custkey % 5 END AS expected FROM customer)
    SELECT CASE WHEN s.id IS NULL THEN CASE WHEN n.expected IS NULL THEN 'inserted' ELSE 'conflicted' END WHEN s.v = n.v THEN 'unchanged' WHEN s.version = n.expected THEN 'updated' ELSE 'conflicted' END AS outcome, count(*) AS n FROM n LEFT JOIN s USING (id) GROUP BY 1""",
)
def upsert_outcomes(spark, d):
    c = table(spark, d, "customer")
    s = c.filter("c_custkey % 6 <> 0").selectExpr("c_custkey as id", "c_acctbal as v", "c_custkey % 5 as version")
    n = c.selectExpr("c_custkey as id", "case when c_custkey % 2 = 0 then c_acctbal else c_acctbal + 1 end as v", "case when c_custkey % 6 = 0 and c_custkey % 12 <> 0 then null when c_custkey % 10 = 1 then 99 else c_custkey % 5 end as expected_version")
    return L.write_outcomes(s, n, "id", ["v"]).groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "w3_conflict_key_upsert",
    """WITH s AS (SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey % 3 <> 0), n AS (SELECT s_suppkey AS id, upper(s_name) AS name FROM supplier WHERE s_suppkey % 2 = 0)
    SELECT id, name FROM n UNION ALL SELECT id, name FROM s WHERE id NOT IN (SELECT id FROM n)""",
)
def conflict_key_upsert(spark, d):
    s = table(spark, d, "supplier")
    return L.upsert(s.filter("s_suppkey % 3 <> 0").selectExpr("s_suppkey as id", "s_name as name"), s.filter("s_suppkey % 2 = 0").selectExpr("s_suppkey as id", "upper(s_name) as name"), ["id"])


@query(
    "w4_snapshot_replace",
    """WITH old AS (SELECT conv_id AS list_id, turn AS rank, role AS item FROM conversations), new AS (SELECT conv_id AS list_id, turn AS rank, 'new-' || role AS item FROM conversations WHERE conv_id % 4 = 0 AND turn < 2)
    SELECT list_id, count(*) AS items, min(item) AS first_item FROM (SELECT * FROM new UNION ALL SELECT * FROM old WHERE list_id NOT IN (SELECT list_id FROM new)) GROUP BY list_id""",
)
def snapshot_replace(spark, d):
    c = table(spark, d, "conversations")
    new = c.filter("conv_id % 4 = 0 and turn < 2").selectExpr("conv_id as list_id", "turn as rank", "'new-' || role as item")
    return L.upsert(c.selectExpr("conv_id as list_id", "turn as rank", "role as item"), new, ["list_id"]).groupBy("list_id").agg(F.count("*").alias("items"), F.min("item").alias("first_item"))


@query(
    "w7_liveness_touch",
    f"""WITH {MATCHED} SELECT id, CASE WHEN id IN (SELECT id FROM matched) THEN TIMESTAMP '{CUTOFF}' ELSE last_seen_at END AS last_seen_at FROM stored""",
)
def liveness_touch(spark, d):
    s = stored(spark, d)
    seen = L.match_listing(listing(spark, d), s).filter("id is not null")
    return L.touch(s, seen, "id", "last_seen_at", F.lit(CUTOFF).cast("timestamp_ntz")).selectExpr("id", "cast(last_seen_at as timestamp) as last_seen_at")


@query(
    "j14_guarded_update",
    """WITH ch AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS b, 'Z' AS a FROM orders WHERE o_orderkey % 2 = 0)
    SELECT CASE WHEN ch.id IS NOT NULL AND ch.b = o.o_orderstatus THEN 'Z' ELSE o.o_orderstatus END AS status, count(*) AS n FROM orders o LEFT JOIN ch ON ch.id = o.o_orderkey GROUP BY 1""",
)
def guarded_update(spark, d):
    o = table(spark, d, "orders").selectExpr("o_orderkey as id", "o_orderstatus as status")
    changes = o.filter("id % 2 = 0").selectExpr("id", "case when id % 3 = 0 then 'X' else status end as before", "'Z' as after")
    return L.guarded_update(o, changes, "id", "status").groupBy("status").agg(F.count("*").alias("n"))


STREAKS = f"""{RUNS}, ended AS (SELECT source, max(started_at) FILTER (WHERE status IN ('success', 'partial')) AS e FROM runs GROUP BY source),
  streaks AS (SELECT r.source, count(*) AS failures, max(started_at) AS last_failed_at FROM runs r JOIN ended USING (source) WHERE status = 'failed' AND NOT unreachable_only AND NOT db_partial_only AND (e IS NULL OR started_at > e) GROUP BY r.source)"""


@query("n1_failure_streak", f"WITH {STREAKS} SELECT * FROM streaks")
def failure_streak(spark, d):
    return schedule.failure_streaks(runs(spark, d))


LADDER = "CASE WHEN failures >= 7 THEN 336 WHEN failures >= 6 THEN 168 WHEN failures >= 5 THEN 72 WHEN failures >= 4 THEN 24 WHEN failures >= 3 THEN 12 ELSE 0 END"


@query("n2_backoff", f"WITH {STREAKS} SELECT source, failures, {LADDER} AS wait_hours, greatest({LADDER} * 3600 - (epoch(TIMESTAMP '2024-01-31 00:00:00')::BIGINT - floor(epoch(last_failed_at))::BIGINT), 0)::BIGINT AS rest_seconds FROM streaks")
def backoff(spark, d):
    return schedule.resting(schedule.failure_streaks(runs(spark, d)), F.lit("2024-01-31 00:00:00").cast("timestamp")).select("source", "failures", "wait_hours", "rest_seconds")


@query("n3_latest_in_list", "WITH r AS (SELECT user_id, event_type, ts, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT user_id, event_type, event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY ts DESC) AS place FROM r WHERE k = 1")
def latest_in_list(spark, d):
    from pyspark.sql import Window

    latest = L.first_by(table(spark, d, "events"), ["user_id", "event_type"], F.desc("ts"), F.desc("event_id"))
    return latest.select("user_id", "event_type", "event_id", F.dense_rank().over(Window.partitionBy("user_id").orderBy(F.desc("ts"))).alias("place"))


@query("n4_retry_schedule", "SELECT event_id, to_timestamp(greatest(floor(epoch(ts)) + CASE event_type WHEN 'error' THEN 3600 WHEN 'view' THEN 86400 ELSE 1800 END, CASE WHEN event_id % 3 = 0 THEN floor(epoch(ts)) + 7200 ELSE 0 END))::TIMESTAMP AS retry FROM events")
def retry_schedule(spark, d):
    e = table(spark, d, "events")
    now = F.date_trunc("second", F.col("ts").cast("timestamp"))
    reason = F.when(F.col("event_type") == "error", "rate_limited").when(F.col("event_type") == "view", "blocked").otherwise("other")
    asked = F.when(F.col("event_id") % 3 == 0, F.timestamp_seconds(F.unix_timestamp(now) + 7200))
    return e.select("event_id", schedule.retry_at(reason, now, asked).alias("retry"))


@query("n5_cycle_coverage", f"WITH {RUNS} SELECT source, count(*) FILTER (WHERE started_at >= TIMESTAMP '{CUTOFF}') AS seen, count(*) AS total, round(count(*) FILTER (WHERE started_at >= TIMESTAMP '{CUTOFF}') / count(*)::DOUBLE, 9) AS share FROM runs GROUP BY source")
def cycle_coverage(spark, d):
    seen = F.count_if(F.col("started_at") >= F.lit(CUTOFF).cast("timestamp"))
    g = runs(spark, d).groupBy("source").agg(seen.alias("seen"), F.count("*").alias("total"))
    return g.withColumn("share", F.round(F.col("seen") / F.col("total"), 9))


@query("n6_fallback_chain", "SELECT p_partkey, coalesce(CASE WHEN p_size > 40 THEN p_brand END, CASE WHEN p_retailprice > 1000 THEN p_type END, p_name) AS chosen FROM part")
def fallback_chain(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.coalesce(F.when(F.col("p_size") > 40, F.col("p_brand")), F.when(F.col("p_retailprice") > 1000, F.col("p_type")), F.col("p_name")).alias("chosen"))


@query(
    "j15_worklist",
    f"""WITH {STREAKS}, c AS (SELECT l_suppkey AS source, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT CASE WHEN s_acctbal < 0 THEN 'disabled' WHEN coalesce(failures, 0) >= 3 THEN 'resting' WHEN coalesce(n, 0) < 500 THEN 'too_few_rows' END AS skip, count(*) AS sources
    FROM supplier s LEFT JOIN streaks t ON t.source = s.s_suppkey LEFT JOIN c ON c.source = s.s_suppkey GROUP BY 1""",
)
def worklist(spark, d):
    sources = table(spark, d, "supplier").selectExpr("s_suppkey as source", "s_acctbal >= 0 as enabled")
    counts = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("source")).agg(F.count("*").alias("rows"))
    return schedule.worklist(sources, schedule.failure_streaks(runs(spark, d)), counts, "source", 500).groupBy("skip").agg(F.count("*").alias("sources"))


@query("a14_run_health", f"""WITH {RUNS}, a AS (SELECT source, count(*) AS total, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'success') AS succeeded FROM runs GROUP BY source)
    SELECT *, CASE WHEN succeeded = 0 OR failed * 2 > total THEN 'failed' WHEN failed > succeeded THEN 'degraded' ELSE 'success' END AS status,
    CASE WHEN succeeded = 0 THEN 'no-success' WHEN failed * 2 > total THEN 'mostly-failed' WHEN failed > succeeded THEN 'more-failed-than-succeeded' ELSE '' END AS reason FROM a""")
def run_health(spark, d):
    from ..operators.quality_gates import run_health as health

    return health(runs(spark, d), "source")


@query("o3_round_robin", f"WITH {STORED} SELECT id, row_number() OVER (PARTITION BY brand ORDER BY last_seen_at, id) AS turn FROM stored")
def round_robin(spark, d):
    return schedule.round_robin(stored(spark, d), "brand", F.col("last_seen_at"), F.col("id")).select("id", "turn")


@query(
    "o4_diverse_top",
    f"""WITH {STORED}, t AS (SELECT *, count(*) OVER (PARTITION BY brand, category) AS n, row_number() OVER (PARTITION BY brand, category ORDER BY in_stock DESC, last_seen_at DESC, id) AS turn FROM stored)
    SELECT id, brand, pick::INT AS pick FROM (SELECT *, row_number() OVER (PARTITION BY brand ORDER BY turn, n DESC, category) AS pick FROM t) WHERE pick <= 5""",
)
def diverse_top(spark, d):
    return schedule.diverse_top(stored(spark, d), "brand", "category", 5, F.desc("in_stock"), F.desc("last_seen_at"), F.col("id")).select("id", "brand", "pick")


@query("o1_worklist_order", f"WITH {RUNS}, a AS (SELECT s_suppkey AS source, max(started_at) AS last FROM supplier LEFT JOIN runs ON source = s_suppkey GROUP BY 1) SELECT source, row_number() OVER (ORDER BY last NULLS FIRST, source) AS place FROM a")
def worklist_order(spark, d):
    last = runs(spark, d).groupBy("source").agg(F.max("started_at").alias("last"))
    sources = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source")).join(last, "source", "left")
    return placed(sources, F.asc_nulls_first("last"), F.asc("source")).select("source", "place")


@query("o2_oldest_order", f"WITH {STORED} SELECT id, row_number() OVER (ORDER BY CASE WHEN in_stock THEN 0 ELSE 1 END, last_seen_at DESC, id) AS place FROM stored")
def oldest_order(spark, d):
    return placed(stored(spark, d), F.when(F.col("in_stock"), 0).otherwise(1).asc(), F.desc("last_seen_at"), F.asc("id")).select("id", "place")


@query("o6_claim_limit", f"WITH {RUNS} SELECT run_id FROM runs WHERE status = 'running' ORDER BY started_at, run_id LIMIT 10")
def claim_limit(spark, d):
    return runs(spark, d).filter("status = 'running'").orderBy("started_at", "run_id").limit(10).select("run_id")


@query("o7_onboarding_batch", f"WITH {STREAKS} SELECT s_suppkey AS source FROM supplier LEFT JOIN streaks ON source = s_suppkey WHERE coalesce(failures, 0) < 3 ORDER BY s_acctbal DESC, s_suppkey LIMIT 25")
def onboarding_batch(spark, d):
    s = table(spark, d, "supplier").withColumnRenamed("s_suppkey", "source")
    return s.join(schedule.failure_streaks(runs(spark, d)), "source", "left").filter(F.coalesce("failures", F.lit(0)) < 3).orderBy(F.desc("s_acctbal"), "source").limit(25).select("source")


@query("o8_recrawl_worklist", "WITH g AS (SELECT l_suppkey AS platform, min(l_shipdate) AS oldest, count(*) AS n FROM lineitem GROUP BY 1) SELECT platform, oldest, n FROM g WHERE n BETWEEN 100 AND 640")
def recrawl_worklist(spark, d):
    g = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("platform")).agg(F.min("l_shipdate").alias("oldest"), F.count("*").alias("n"))
    return g.filter(F.col("n").between(100, 640))


@query("t1_late_data", f"WITH {MATCHED} SELECT new_observed_at < last_seen_at AS late, count(*) AS n FROM matched GROUP BY 1")
def late_data(spark, d):
    m = L.first_by(L.match_listing(listing(spark, d), stored(spark, d)).filter("id is not null"), ["id"], F.col("new_ord"))
    return m.groupBy((F.col("new_observed_at") < F.col("last_seen_at")).alias("late")).agg(F.count("*").alias("n"))


@query("t10_quarantine", f"WITH {GAPS} SELECT id, CASE WHEN late THEN in_stock ELSE stock END AS in_stock, NOT late AND new_in_stock AND in_stock AS blocked FROM b WHERE quarantined")
def quarantine(spark, d):
    new, old = with_gaps(spark, d)
    held = L.diff_listing(new, old).join(old.filter("quarantined").select("id"), "id", "left_semi")
    return held.select("id", "in_stock", (F.col("outcome") == "blocked").alias("blocked"))


@query("a22_latest_observation", f"WITH {LISTING} SELECT product_url, ord, price FROM listing QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY observed_at DESC, ord DESC) = 1")
def latest_observation(spark, d):
    return L.latest_observation(listing(spark, d), "product_url", "observed_at", "ord").select("product_url", "ord", "price")
