"""Queries on operators that build on earlier runs, on another writer or on large word tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import cross_shop, identity
from ..operators.rates import rates_in_force
from ..operators.retries import compare_and_set
from ..scratch import materialise, shared_folder
from ..sources.gated import published, write_gated
from ..vocabulary import Entry, Vocabulary
from .registry import query, table


@query(
    "w1_gated_sink",
    """SELECT coalesce(CASE WHEN NOT p_retailprice > 905 THEN 'price' WHEN contains(p_name, 'red') THEN 'name' WHEN NOT p_size % 4 > 0 THEN 'size' END, 'published') AS gate, count(*) AS n FROM part GROUP BY 1
    UNION ALL SELECT 'pieces', sum(p_size)::BIGINT FROM part WHERE p_retailprice > 905 AND NOT contains(p_name, 'red') AND p_size % 4 > 0""",
)
def gated_sink(spark, d):
    """A table published behind three gates, and what a reader then finds in it."""
    part, path = table(spark, d, "part"), f"{shared_folder(spark)}/gated-part"
    counts = write_gated(part, path, {"price": F.col("p_retailprice") > 905, "name": ~F.contains("p_name", F.lit("red")), "size": F.col("p_size") % 4 > 0})
    found = published(spark, path)
    return counts.withColumnRenamed("rejected", "n").unionByName(found.agg(F.count("*").alias("n")).withColumn("gate", F.lit("published"))).unionByName(found.agg(F.sum("p_size").cast("long").alias("n")).withColumn("gate", F.lit("pieces")))


@query(
    "w6_compare_and_set",
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 4 THEN 'unchanged' WHEN p_partkey % 10 < 2 THEN 'conflicted' ELSE 'written' END AS outcome,
        CASE WHEN p_partkey % 5 = 4 OR p_partkey % 7 <> 0 AND p_partkey % 10 >= 4 THEN 1 WHEN p_partkey % 10 >= 3 THEN 2 ELSE 3 END AS round FROM part""",
)
def rival_writer(spark, d):
    """Prices set beside a rival that gets in first with some rows, fewer every round."""
    part = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit(1).cast("long").alias("version"), F.lit(1).alias("observed_at"), F.col("p_retailprice").alias("price"))
    store, turn = [part], [0]

    def write(rows):
        turn[0] += 1
        faster = F.col("id") % 10 < 5 - turn[0]
        now = store[0].withColumns({"version": F.when(faster, F.col("version") + 1).otherwise(F.col("version")), "price": F.when(faster, -1.0).otherwise(F.col("price"))})
        done = materialise(rows.join(now.select("id", "version"), ["id", "version"]), "rival-done")
        new = done.select("id", (F.col("version") + 1).alias("version"), "observed_at", "price")
        store[0] = materialise(now.join(done, "id", "left_anti").unionByName(new), "rival-store")
        return done

    price = F.when(F.col("id") % 5 == 4, F.col("price")).otherwise(F.col("price") + 0.5)
    updates = part.withColumns({"version": F.when(F.col("id") % 7 == 0, 0).otherwise(1).cast("long"), "observed_at": F.lit(2), "price": price})
    return compare_and_set(updates, ["price"], lambda: store[0], write)


@query(
    "s18_rates_in_force",
    """WITH e AS (SELECT event_id, 'C' || (user_id % 6) AS currency, ts, value, event_id % 3 = 0 AS snap FROM events),
    s AS (SELECT currency, ts, max(value) AS rate FROM e WHERE snap AND value > 0 GROUP BY ALL), o AS (SELECT * FROM e WHERE NOT snap),
    j AS (SELECT o.event_id, o.currency, o.ts, s.rate, s.ts AS rate_at FROM o ASOF LEFT JOIN s ON o.currency = s.currency AND o.ts >= s.ts)
    SELECT event_id, CASE WHEN epoch(ts) - epoch(rate_at) <= 86400 THEN rate WHEN currency IN ('C1', 'C2') THEN 7.5 END AS rate,
        CASE WHEN epoch(ts) - epoch(rate_at) <= 86400 THEN rate_at END AS rate_at, CASE WHEN epoch(ts) - epoch(rate_at) <= 86400 THEN 'live' WHEN currency IN ('C1', 'C2') THEN 'committed' END AS rate_source FROM j""",
)
def rates(spark, d):
    e = table(spark, d, "events").withColumn("currency", F.concat(F.lit("C"), F.col("user_id") % 6))
    snapshots = e.filter("event_id % 3 = 0").select("currency", F.col("ts").alias("taken_at"), F.col("value").alias("rate"))
    committed = F.create_map(F.lit("C1"), F.lit(7.5), F.lit("C2"), F.lit(7.5))
    found = rates_in_force(e.filter("event_id % 3 <> 0").select("event_id", "currency", "ts"), snapshots, 1, committed, at="ts")
    return found.select("event_id", "rate", "rate_at", "rate_source")


_RUNS = """p AS (SELECT p_partkey AS id, 'trusted:' || lower(p_brand) || ':gtin::' || (p_size % 9) AS pk, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 'b' ELSE 'a' END AS cat, p_type AS colour FROM part),
    a1 AS (SELECT *, count(*) FILTER (cat IS NULL) OVER (PARTITION BY pk ORDER BY id) AS seg FROM p WHERE id % 3 < 2),
    b1 AS (SELECT *, first_value(cat IGNORE NULLS) OVER (PARTITION BY pk, seg ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS leader FROM a1),
    run1 AS (SELECT *, cat IS NULL OR cat = leader AS joins, pk || ':color:' || colour AS vk FROM b1),
    known AS (SELECT pk, arg_max(struct_pack(c := cat), id).c AS cat FROM run1 WHERE joins GROUP BY pk),
    a2 AS (SELECT *, id % 11 > 0 AS proven FROM p),
    s2 AS (SELECT *, count(*) FILTER (cat IS NULL) OVER (PARTITION BY pk ORDER BY id) AS seg FROM a2 WHERE proven),
    b2 AS (SELECT s2.*, CASE WHEN seg = 0 THEN known.cat END AS held, first_value(s2.cat IGNORE NULLS) OVER (PARTITION BY s2.pk, seg ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS leader FROM s2 LEFT JOIN known USING (pk)),
    run2 AS (SELECT id, cat IS NULL OR cat = coalesce(held, leader) AS joins FROM b2),
    q AS (SELECT p.id, p.pk || ':color:' || p.colour AS vk, coalesce(run2.joins, false) AS joins, CASE WHEN run1.id IS NULL THEN NULL WHEN run1.joins THEN run1.vk ELSE 'source:' || p.id || ':color:unknown' END AS previous
          FROM p LEFT JOIN run2 USING (id) LEFT JOIN run1 USING (id)),
    t AS (SELECT *, CASE WHEN joins THEN vk WHEN previous LIKE 'trusted:%' THEN previous ELSE 'source:' || id || ':color:unknown' END AS target, CASE WHEN joins THEN 'trusted' WHEN previous LIKE 'trusted:%' THEN 'kept' ELSE 'singleton' END AS seed,
          joins AND (vk IN (SELECT vk FROM run1 WHERE joins) OR id > min(id) FILTER (joins) OVER (PARTITION BY vk)) AS attached FROM q)"""


@query("c5_identity_runs", f"WITH {_RUNS} SELECT id, target, seed, attached, CASE WHEN previous <> target AND previous LIKE 'source:%' THEN previous END AS superseded, CASE WHEN attached AND previous IS DISTINCT FROM target THEN 1.0::DOUBLE END AS confidence FROM t")
def identity_runs(spark, d):
    """Two runs over the products: the second sees all of them, some without the proof that they had."""
    kind = F.lit("gtin")

    def rows(parts, proof):
        code = F.when(proof, (F.col("p_size") % 9).cast("string"))
        key = identity.product_key(F.lower("p_brand"), kind, F.lit(""), code, F.lit(1.0), F.col("p_type"))
        category = F.when(F.col("p_size") % 5 == 0, None).when(F.col("p_size") % 5 == 1, "b").otherwise("a")
        return parts.select(F.col("p_partkey").alias("id"), F.concat(F.lit("offer"), "p_partkey").alias("offer_key"), key.alias("product_key"), F.col("p_type").alias("colour"), category.alias("category"), kind.alias("kind"))

    part = table(spark, d, "part")
    first = rows(part.filter("p_partkey % 3 < 2"), F.lit(True))
    empty = identity.empty_catalogue(first)
    done = materialise(identity.sync_identities(first, empty), "identity-run")
    second = identity.sync_identities(rows(part, F.col("p_partkey") % 11 > 0), identity.catalogue_after(done, empty))
    return second.select("id", "target", "seed", "attached", "superseded", "confidence")


_SHOPS = """s AS (SELECT p_partkey AS id, p_type AS brand, regexp_extract(p_name, '[a-z]+$') AS name, 'goods' AS category, p_partkey % 2 = 0 AS official, CASE WHEN p_partkey % 2 = 0 THEN 'own' ELSE 'shop' END AS platform,
        'h' || (p_partkey % 3) AS host, CASE WHEN p_partkey % 13 > 0 THEN p_partkey % 4 // 2 END AS colour, p_partkey % 17 > 0 AS ready, '1000' || (p_partkey % 5 // 3) AS number, embedding
      FROM part LEFT JOIN embeddings ON vec_id = p_size % 4),
    pairs AS (SELECT a.id AS a, b.id AS b, a.colour = b.colour AS same, a.ready AND b.ready AS ready, a.number = b.number AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.99 AS equal
      FROM s a JOIN s b USING (brand, name, category) WHERE a.official AND NOT b.official AND a.host <> b.host)"""


def shops(spark, d):
    """Products as rows of shops; each shows one of the given images."""
    k = F.col("p_partkey")
    image = table(spark, d, "embeddings").select(F.col("vec_id").alias("image"), "embedding")
    s = table(spark, d, "part").withColumn("image", F.col("p_size") % 4).join(image, "image", "left")
    official = k % 2 == 0
    return s.select(
        k.alias("id"), F.col("p_type").alias("brand"), text.entity_form(F.regexp_extract("p_name", "[a-z]+$", 0)).alias("name"), F.lit("goods").alias("category"), F.when(official, "own").otherwise("shop").alias("platform"), F.concat(F.lit("h"), k % 3).alias("host"),
        F.when(k % 13 > 0, F.floor(k % 4 / 2).cast("string")).alias("colour"), (k % 17 > 0).alias("ready"), official.alias("official"), (~official).alias("retailer"), F.array(F.concat(F.lit("1000"), F.floor(k % 5 / 3))).alias("numbers"), "embedding",
    )


def shop_matches(spark, d):
    rows = shops(spark, d)
    size = rows.select(F.max(F.size("embedding"))).first()[0]
    return rows, materialise(cross_shop.cross_shop_matches(rows, size), "cross-shop")


@query("j6_cross_shop_cascade", f"WITH {_SHOPS} SELECT count(*) AS preliminary, count_if(same) AS coloured, count_if(same AND ready) AS ready, count_if(same AND ready AND equal)::DECIMAL(38,0) AS matched FROM pairs")
def cross_shop_cascade(spark, d):
    rows, matches = shop_matches(spark, d)
    return cross_shop.cascade(rows, matches).withColumn("matched", F.col("matched").cast("decimal(38,0)"))


@query("c6_cross_shop_matches", f"WITH {_SHOPS} SELECT b AS retailer_id, count(*)::BIGINT AS partners, min(a) AS first FROM pairs WHERE same AND ready AND equal GROUP BY 1")
def cross_shop_found(spark, d):
    """What each class of a retailer's rows is matched with; here every row is a class of its own or shares one with its copies."""
    rows, matches = shop_matches(spark, d)
    member = rows.filter("ready and colour is not null and embedding is not null").withColumn("_class", F.min("id").over(_alike()))
    found = member.select("id", "_class").join(matches.withColumnRenamed("retailer_id", "_class"), "_class")
    return found.groupBy(F.col("id").alias("retailer_id")).agg(F.sum("officials").cast("long").alias("partners"), F.min("official_id").alias("first"))


def _alike():
    from pyspark.sql import Window

    return Window.partitionBy("brand", "name", "category", "platform", "host", "colour", "official", "retailer", "numbers", "embedding")


SYLLABLES = ("th", "er", "on", "an", "in", "re", "nd", "ha", "en", "st")


def syllable_vocabulary() -> Vocabulary:
    """1,110 words, of one to three syllables; a word's label is its first one."""
    return Vocabulary([Entry(a, (a, *[a + b for b in SYLLABLES], *[a + b + c for b in SYLLABLES for c in SYLLABLES])) for a in SYLLABLES])


@query(
    "x22_vocabulary",
    f"""WITH y AS (SELECT unnest({list(SYLLABLES)}) AS s, unnest(range({len(SYLLABLES)})) AS k), v AS (SELECT a.s AS label, a.k, a.s || coalesce(b.s, '') || coalesce(c.s, '') AS word FROM y a, (SELECT s FROM y UNION ALL SELECT NULL) b, (SELECT s FROM y UNION ALL SELECT NULL) c WHERE b.s IS NOT NULL OR c.s IS NULL),
    w AS (SELECT DISTINCT doc_id, unnest(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+')) AS word FROM documents), f AS (SELECT DISTINCT doc_id, label, k FROM w JOIN v USING (word)),
    g AS (SELECT doc_id, count(*)::INT AS labels, arg_min(label, k) AS first, CASE WHEN count(*) = 1 THEN min(label) END AS sole FROM f GROUP BY doc_id)
    SELECT doc_id, coalesce(labels, 0) AS labels, first, sole FROM documents LEFT JOIN g USING (doc_id)""",
)
def vocabulary(spark, d):
    from ..rules import unique_match

    v = syllable_vocabulary()
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.size(v.labels(t)), F.lit(0)).alias("labels"), F.get(v.labels(t), 0).alias("first"), unique_match(v, t).alias("sole"))
