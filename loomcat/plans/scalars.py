"""Queries on scalar functions, parsers and event windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import money, numbers, text, urls
from ..operators import matching as M
from ..operators import schedule
from ..operators.ordering import placed
from ..rules import Rule, first_match
from ..sources import payloads, shopify
from ..sources import price_text as price_texts
from .frames import OFFERS, offers
from .registry import query, table


@query("x1_compatible_fold", "SELECT doc_id, sha256(lower(strip_accents(nfc_normalize(text)))) AS folded FROM documents")
def compatible_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(F.lower(text.fold_compatible(F.col("text"))), 256).alias("folded"))


@query("x1_match_form", "SELECT p_partkey, trim(regexp_replace(lower(strip_accents(translate(p_name || '_' || p_type || '-Caf' || chr(233) || ' ' || p_brand, '_-', '  '))), '\\s+', ' ', 'g')) AS form FROM part")
def match_form(spark, d):
    return table(spark, d, "part").select("p_partkey", text.match_form(F.concat("p_name", F.lit("_"), "p_type", F.lit("-Cafe\u0301 "), "p_brand")).alias("form"))


@query("x2_entity_form", "SELECT doc_id, sha256(trim(regexp_replace(lower(nfc_normalize(text)), '[^\\p{L}\\p{N}]+', ' ', 'g'))) AS form FROM documents")
def entity_form(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2(text.entity_form(F.col("text")), 256).alias("form"))


@query("x3_identifier_forms", "SELECT p_partkey, upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS code, regexp_replace(lower(regexp_replace('[shop] ' || p_brand, '^\\[[^\\]]*\\]\\s*', '')), '[^a-z0-9]', '', 'g') AS brand FROM part")
def identifier_forms(spark, d):
    return table(spark, d, "part").select("p_partkey", text.identifier_form(F.col("p_brand")).alias("code"), text.brand_form(F.concat(F.lit("[shop] "), "p_brand")).alias("brand"))


@query("x4_any_match", "SELECT doc_id, contains(text, 'token') OR contains(text, 'idiot') OR contains(text, '|') AS hit FROM documents")
def any_match(spark, d):
    return table(spark, d, "documents").select("doc_id", text.contains_any(F.col("text"), ["token", "idiot", "|"]).alias("hit"))


@query("x5_clean_name", "SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN 'name: ' || p_name ELSE p_name END AS name FROM part")
def clean_name(spark, d):
    """At most three labels go; the fourth stays."""
    k = F.col("p_partkey") % 4
    prefix = F.when(k == 0, " 상품명 :  Product  Name： ").when(k == 1, "브랜드:").when(k == 3, "name: name: name: name: ").otherwise("")
    return table(spark, d, "part").select("p_partkey", text.clean_name(F.concat(prefix, F.replace("p_name", F.lit(" "), F.lit("  ")))).alias("name"))


STRIP = "regexp_replace(regexp_replace(html, '<(script|style)[^>]*>.*?</(script|style)>', ' ', 'gs'), '<[^>]*>', ' ', 'g')"


@query("x6_strip_html", f"SELECT page_id, sha256(trim(regexp_replace(replace(replace(replace(replace(replace(replace({STRIP}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))) AS text, regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang FROM pages")
def strip_html(spark, d):
    h = F.col("html")
    return table(spark, d, "pages").select("page_id", F.sha2(text.strip_html(h), 256).alias("text"), text.html_attribute(h, "html", "lang").alias("lang"))


@query(
    "x7_safe_message",
    r"""SELECT doc_id, substr(regexp_replace(regexp_replace(regexp_replace(text,
        '(?i)\b(?:https?|postgres|postgresql)://[\p{L}\p{N}\-._~:/?#\[\]@!$&()*+,;=%]+', '[url]', 'g'), '(?i)\b(bearer\s+)[^\s,;]+', '\1[hidden]', 'g'),
        '(?i)(api[ _-]?key|password|secret|token)([A-Za-z0-9_-]*)\s*[=:]\s*[^,;\s]+', '\1\2=[hidden]', 'g'), 1, 2000) AS message FROM documents""",
)
def safe_message(spark, d):
    return table(spark, d, "documents").select("doc_id", text.safe_message(F.col("text")).alias("message"))


@query("x8_body_measurements", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN (100 + event_id % 99) || ' cm' END AS height, CASE WHEN event_id % 3 = 0 THEN (10 + event_id % 90) || 'kg' END AS weight, CASE WHEN event_id % 5 = 0 THEN 'M' END AS usual_size, CASE WHEN event_id % 7 = 0 THEN 'L slim' END AS purchased_size, CASE WHEN event_id % 11 = 0 THEN 'tall' END AS body_type FROM events WHERE event_id % 2 = 0 OR event_id % 3 = 0 OR event_id % 5 = 0 OR event_id % 7 = 0 OR event_id % 11 = 0")
def body_measurements(spark, d):
    k = F.col("event_id")
    said = [(2, "height: ", 100 + k % 99, " cm"), (3, "몸무게 ", 10 + k % 90, "kg"), (5, "Usual size : ", F.lit("M"), ""), (7, "구매 사이즈: ", F.lit("L slim"), ""), (11, "Body type ", F.lit("tall"), "")]
    t = F.concat_ws(", ", *[F.when(k % n == 0, F.concat(F.lit(before), v, F.lit(after))) for n, before, v, after in said])
    return table(spark, d, "events").select("event_id", text.body_info(t).alias("b")).filter("b is not null").select("event_id", "b.*")


GRAMS = "list_distinct([substr({0}, i, 3) FOR i IN range(1, greatest(length({0}) - 1, 2))])"


@query("x9_similarity", f"WITH g AS (SELECT s_suppkey, {GRAMS.format('a')} AS ga, {GRAMS.format('b')} AS gb FROM (SELECT s_suppkey, s_name AS a, 'Supplier#' || (s_suppkey * 7) AS b FROM supplier)) SELECT s_suppkey, round(len(list_intersect(ga, gb)) / (len(ga) + len(gb) - len(list_intersect(ga, gb)))::DOUBLE, 9) AS similarity FROM g")
def similarity(spark, d):
    a, b = text.trigrams(F.col("s_name")), text.trigrams(F.concat(F.lit("Supplier#"), F.col("s_suppkey") * 7))
    return table(spark, d, "supplier").select("s_suppkey", F.round(text.jaccard(a, b), 9).alias("similarity"))


@query("x9_token_similarity", "WITH g AS (SELECT p_partkey, list_distinct(string_split(lower(replace(p_name, '-', ' ')), ' ')) AS ga, list_distinct([lower(p_type), 'red', 'ring']) AS gb FROM part) SELECT p_partkey, round(len(list_intersect(ga, gb)) / (len(ga) + len(gb) - len(list_intersect(ga, gb)))::DOUBLE, 9) AS similarity FROM g")
def token_similarity(spark, d):
    a, b = (text.tokens(text.entity_form(x)) for x in (F.col("p_name"), F.concat_ws(", ", "p_type", F.lit("Red RING"))))
    return table(spark, d, "part").select("p_partkey", F.round(text.jaccard(a, b), 9).alias("similarity"))


HOST = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"
PATH_ = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
SHOP_URL = "CASE page_id % 5 WHEN 0 THEN 'https://www.Shop.example/item?idx=' || page_id WHEN 1 THEN 'http://shop.example/detail.html?a=1&product_no=' || page_id || '#x' WHEN 2 THEN 'https://zara.com/kr/ko/shirt-p0' || page_id || '.html' WHEN 3 THEN 'https://shop.example/en-kr/products/Shirt-' || page_id || '?variant=' || page_id ELSE url END"


@query(
    "x10_product_identity",
    f"""WITH u AS (SELECT page_id, {SHOP_URL} AS url FROM pages), p AS (SELECT page_id, url, {HOST} AS h, {PATH_} AS p FROM u)
    SELECT page_id, coalesce(h || '#idx=' || nullif(regexp_extract(url, '[?&]idx=([^&#]*)', 1), ''), h || '#product_no=' || nullif(regexp_extract(url, '[?&]product_no=([^&#]*)', 1), ''),
      CASE WHEN h = 'zara.com' AND regexp_extract(p, '-p(\\d+)\\.html$', 1) <> '' THEN h || '#zara_product=' || regexp_extract(p, '-p(\\d+)\\.html$', 1) || '&locale=' || regexp_extract(p, '^/([a-z]{{2}}/[a-z]{{2}})/', 1) END,
      CASE WHEN regexp_extract(p, '(?i)^/(?:[a-z]{{2}}(?:-[a-z]{{2}})?/)?products/([a-z0-9][a-z0-9-]*)/?$', 1) <> '' THEN h || '#shopify_handle=' || lower(regexp_extract(p, '(?i)^/(?:[a-z]{{2}}(?:-[a-z]{{2}})?/)?products/([a-z0-9][a-z0-9-]*)/?$', 1)) || coalesce('&variant=' || nullif(regexp_extract(url, '[?&]variant=([^&#]*)', 1), ''), '') END) AS identity FROM p""",
)
def product_identity(spark, d):
    k = F.col("page_id")
    url = F.when(k % 5 == 0, F.concat(F.lit("https://www.Shop.example/item?idx="), k)).when(k % 5 == 1, F.concat(F.lit("http://shop.example/detail.html?a=1&product_no="), k, F.lit("#x"))).when(k % 5 == 2, F.concat(F.lit("https://zara.com/kr/ko/shirt-p0"), k, F.lit(".html"))).when(k % 5 == 3, F.concat(F.lit("https://shop.example/en-kr/products/Shirt-"), k, F.lit("?variant="), k)).otherwise(F.col("url"))
    return table(spark, d, "pages").select(k, urls.product_identity(url).alias("identity"))


@query("x11_canonical_url", f"SELECT page_id, 'https://' || regexp_replace({HOST}, '^m\\.', '') || regexp_replace({PATH_}, '/+$', '') AS canonical, len(list_filter(string_split(lower({PATH_}), '/'), lambda x: x <> '')) AS tokens FROM pages")
def canonical_url(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", urls.canonical(u).alias("canonical"), F.size(urls.path_tokens(u)).alias("tokens"))


@query("x12_plain_image", "SELECT p_partkey, regexp_replace(regexp_replace('//cdn.example/' || p_partkey || CASE p_partkey % 3 WHEN 0 THEN '_640x480.jpg?v=1' WHEN 1 THEN '_small.png' ELSE '.webp#a' END, '^//', 'https://'), '[?#].*$', '').regexp_replace('_(?:\\d+x\\d*|x\\d+|small|medium|large|grande)(\\.[A-Za-z]{3,4})$', '\\1') AS image FROM part")
def plain_image(spark, d):
    k = F.col("p_partkey")
    u = F.concat(F.lit("//cdn.example/"), k, F.when(k % 3 == 0, "_640x480.jpg?v=1").when(k % 3 == 1, "_small.png").otherwise(".webp#a"))
    return table(spark, d, "part").select(k, urls.plain_image(u).alias("image"))


@query("x13_currency_conversion", "SELECT o_orderkey, CASE WHEN o_custkey % 5 < 4 THEN floor(o_totalprice * (1 + o_custkey % 5 * 0.25::DOUBLE) + 0.5)::BIGINT END AS krw FROM orders")
def currency_conversion(spark, d):
    rates = spark.createDataFrame([(k, 1 + k * 0.25) for k in range(4)], "currency long, rate double")
    o = table(spark, d, "orders").withColumn("currency", F.col("o_custkey") % 5)
    return o.join(F.broadcast(rates), "currency", "left").select("o_orderkey", money.convert(F.col("o_totalprice"), F.col("rate")).alias("krw"))  # four rates


@query(
    "x15_price_text",
    """WITH v AS (SELECT s_suppkey, floor(abs(s_acctbal))::BIGINT AS v FROM supplier)
    SELECT s_suppkey, (CASE s_suppkey % 5 WHEN 0 THEN CASE WHEN v >= 1000 THEN v END WHEN 1 THEN CASE WHEN v > 0 THEN v END WHEN 3 THEN CASE WHEN v > 0 THEN v END WHEN 4 THEN CASE WHEN v >= 1000 THEN v ELSE v + 5000 END END)::DOUBLE AS price,
      CASE s_suppkey % 5 WHEN 0 THEN 'KRW' WHEN 1 THEN 'USD' WHEN 3 THEN 'EUR' END AS currency, (CASE WHEN s_suppkey % 5 = 4 THEN v + 5000 WHEN s_suppkey % 5 = 0 AND v >= 1000 THEN v END)::DOUBLE AS original FROM v""",
)
def price_text(spark, d):
    v = F.floor(F.abs("s_acctbal"))
    number = F.format_number(v, 0)
    t = F.when(F.col("s_suppkey") % 5 == 0, F.concat(F.lit("판매가 : ₩"), number)).when(F.col("s_suppkey") % 5 == 1, F.concat(F.lit("Now $"), number)).when(F.col("s_suppkey") % 5 == 2, number).when(F.col("s_suppkey") % 5 == 3, F.concat(F.lit("EUR "), number)).otherwise(F.concat(F.lit("할인판매가 "), number, F.lit("원 판매가 "), F.format_number(v + 5000, 0)))
    return table(spark, d, "supplier").select("s_suppkey", price_texts.price_candidate(t, None).alias("price"), price_texts.infer_currency(t).alias("currency"), price_texts.labelled_price(t, "original", None).alias("original"))


@query("x16_cosine_distance", "SELECT a.vec_id, round(1 - list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_distance(spark, d):
    e = table(spark, d, "embeddings")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(b, "vec_id").select("vec_id", F.round(numbers.cosine_distance(F.col("embedding"), F.col("other")), 6).alias("distance"))


@query("x17_gtin", "WITH c AS (SELECT o_orderkey, lpad((o_orderkey * 7919 + 40000000)::VARCHAR, 8, '0') AS code FROM orders) SELECT o_orderkey, length(code) = 8 AND list_sum([substr(code, i, 1)::INT * CASE WHEN (8 - i) % 2 = 1 THEN 3 ELSE 1 END FOR i IN range(1, 9)]) % 10 = 0 AS valid FROM c")
def gtin(spark, d):
    code = F.lpad((F.col("o_orderkey") * 7919 + 40000000).cast("string"), 8, "0")
    return table(spark, d, "orders").select("o_orderkey", numbers.is_gtin(code).alias("valid"))


@query("x18_stable_hash", "SELECT c_custkey, sha256('=' || c_name || chr(31) || CASE WHEN c_nationkey % 4 = 0 THEN '-' ELSE '=' || c_mktsegment END) AS hash FROM customer")
def stable_hash(spark, d):
    segment = F.when(F.col("c_nationkey") % 4 != 0, F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", numbers.stable_hash(F.col("c_name"), segment).alias("hash"))


@query("x19_array_cleaning", "SELECT doc_id, list_distinct(list_filter(list_transform(string_split(text, ' '), lambda x: lower(x)), lambda x: x IN ('the', 'la', 'de', 'and'))).list_sort().array_to_string(',') AS words FROM documents")
def array_cleaning(spark, d):
    w = F.filter(F.transform(F.split("text", " "), lambda x: F.lower(x)), lambda x: x.isin("the", "la", "de", "and"))
    return table(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(F.array_distinct(w)), ",").alias("words"))


@query(
    "x21_gender_resolution",
    """WITH e AS (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'men' WHEN 1 THEN 'women' WHEN 2 THEN 'unisex' WHEN 3 THEN 'men' END AS t, p_size % 6 IN (0, 3) AS label, p_size % 6 = 4 AS kids, CASE p_partkey % 4 WHEN 0 THEN 'women' WHEN 1 THEN 'men' WHEN 2 THEN 'unisex' END AS u,
        CASE p_partkey % 7 WHEN 0 THEN 'men' WHEN 1 THEN 'women' WHEN 2 THEN 'unisex' END AS stated, CASE p_partkey % 7 WHEN 3 THEN 'men' WHEN 4 THEN 'unisex' END AS def, p_partkey % 3 = 0 AS scoped FROM part),
    s AS (SELECT *, CASE WHEN t IS NULL AND u IS NULL AND kids THEN 'none' WHEN stated IN ('men', 'women') THEN CASE WHEN label AND stated = 'women' THEN CASE WHEN u = 'women' THEN 'conflict' ELSE 'label' END ELSE 'engine' END
        WHEN u <> t THEN CASE WHEN u = 'unisex' THEN 'text' WHEN t = 'unisex' THEN 'url' WHEN stated IS NOT NULL THEN 'engine' ELSE 'conflict' END WHEN u IN ('men', 'women') THEN 'url' WHEN t IN ('men', 'women') THEN 'text' WHEN stated IS NOT NULL THEN 'engine' WHEN u IS NOT NULL THEN 'url' WHEN t IS NOT NULL THEN 'text'
        WHEN def = 'men' THEN 'config_default' WHEN def IS NOT NULL THEN 'none' WHEN scoped THEN 'brand_scope' ELSE 'none' END AS step FROM e)
    SELECT p_partkey, CASE step WHEN 'label' THEN 'men' WHEN 'engine' THEN stated WHEN 'text' THEN t WHEN 'url' THEN u WHEN 'config_default' THEN def WHEN 'brand_scope' THEN 'women' END AS gender,
        CASE WHEN step = 'label' THEN 'text' WHEN step NOT IN ('none', 'conflict') THEN step END AS source, step = 'conflict' AS conflict FROM s""",
)
def gender_resolution(spark, d):
    from ..operators.gender import resolve_gender

    k, n = F.col("p_partkey"), F.col("p_size") % 6
    array = lambda g: F.array(F.lit(g))
    suffix = F.when(n == 0, " for men").when(n == 1, " women").when(n == 2, " unisex").when(n == 3, " (Men's)").when(n == 4, " kids").otherwise("")
    p = table(spark, d, "part").select(
        k, F.concat("p_name", suffix).alias("name"), F.col("p_type").alias("category"), F.lit(None).cast("string").alias("subcategory"), F.lit(None).cast("array<string>").alias("tags"),
        F.concat(F.lit("https://www.shop.example/"), F.when(k % 4 == 0, "women/").when(k % 4 == 1, "men/").when(k % 4 == 2, "unisex/").otherwise(""), k).alias("product_url"),
        F.when(k % 7 == 0, array("men")).when(k % 7 == 1, array("women")).when(k % 7 == 2, array("unisex")).when(k % 7 == 3, array("men")).when(k % 7 == 4, array("unisex")).alias("gender"),
        F.when((k % 7).isin(3, 4), "config_default").otherwise("engine").alias("gender_source"), F.when(k % 3 == 0, array("women")).alias("scope"),
    )
    r = resolve_gender(p, brand_scope="scope")
    return r.select("p_partkey", F.col("resolved_gender").alias("gender"), F.col("resolved_source").alias("source"), F.col("gender_conflict").alias("conflict"))


@query("x23_source_precedence", "SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN lower(p_type) WHEN contains(p_name, 'bolt') THEN 'hardware' WHEN contains(p_name, 'ring') THEN 'jewelry' ELSE 'other' END AS category FROM part")
def source_precedence(spark, d):
    by_type = F.when(F.col("p_type").isin("SMALL", "LARGE"), F.lower("p_type"))
    by_title = first_match([Rule("hardware", "bolt"), Rule("jewelry", "ring")], F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", F.coalesce(by_type, by_title, F.lit("other")).alias("category"))


@query(
    "x26_error_class",
    """SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE ['transient_exhausted', 'external_block', 'external_block', 'endpoint_removed', 'transient_exhausted', 'transient_exhausted', 'config_drift',
        CASE WHEN event_id % 3 = 0 THEN 'db_read_failed' WHEN event_id % 5 = 0 THEN 'db_write_failed' WHEN event_id % 7 = 0 THEN 'coverage_guard' ELSE 'source_failed' END][1 + (event_id % 8)::INT] END AS code,
        CASE WHEN event_id % 8 = 4 THEN TIMESTAMP '2024-02-03 04:05:06' END AS retry, ['transient', 'blocked', 'blocked', 'removed', 'transient', 'confirmed', 'unreadable'][1 + (event_id % 7)::INT] AS class FROM events""",
)
def error_class(spark, d):
    k = F.col("event_id")
    messages = ["robots.txt fetch failed", "HTTP 403", "disallowed by robots", "http 410 gone", "HTTP 429 retry_at=never|retry_at=x retry", "Timeout", "no category found", "odd"]
    said = F.get(F.array(*map(F.lit, messages)), (k % 8).cast("int"))
    errors = F.array(F.lit("first"), said, F.when(k % 8 == 4, "again RETRY_AT=2024-02-03T04:05:06Z|x").otherwise("last"))
    only = k % 8 == 7  # flags count where no message decides before
    code = schedule.exception_code(F.when(k % 13 == 0, "success").otherwise("failed"), errors, only & (k % 3 == 0), only & (k % 5 == 0), only & (k % 7 == 0))
    status = F.get(F.lit([429, 401, 403, 404, 500, 302, 100]), (k % 7).cast("int"))
    return table(spark, d, "events").select("event_id", code.alias("code"), schedule.retry_from(errors).alias("retry"), schedule.http_class(status).alias("class"))


@query("x27_brand_resolution", "SELECT p_partkey, CASE WHEN p_brand = 'Brand#1' THEN 'house' WHEN p_brand IN ('Brand#2', 'Brand#3') THEN 'Brand#23' WHEN length(p_brand) > 7 THEN p_brand ELSE 'unknown' END AS brand FROM part")
def brand_resolution(spark, d):
    from ..operators.classify import resolve_brand

    return table(spark, d, "part").select("p_partkey", resolve_brand(F.col("p_brand"), {"Brand#1": "house", "Brand#2": "Brand#23", "Brand#3": "Brand#23"}, F.length("p_brand") > 7).alias("brand"))


@query(
    "x28_match_decision",
    """WITH p AS (SELECT a.p_partkey AS a, a.p_brand <> b.p_brand AND a.p_partkey % 2 = 0 AS brand, CASE WHEN a.p_partkey % 11 <> 0 THEN a.p_size % 2 END AS c1, b.p_size % 2 AS c2, CASE WHEN a.p_partkey % 7 = 0 THEN 'gtin' WHEN a.p_partkey % 5 = 0 THEN 'sku' END AS id,
        list_distinct(string_split(lower(replace(a.p_name, '-', ' ')), ' ')) AS ga, list_distinct(string_split(lower(replace(b.p_name, '-', ' ')), ' ')) AS gb, a.p_type = b.p_type OR a.p_partkey % 3 = 0 AS same_cat FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 10),
    s AS (SELECT *, len(list_intersect(ga, gb)) / (len(ga) + len(gb) - len(list_intersect(ga, gb)))::DOUBLE AS sim FROM p)
    SELECT a, CASE WHEN brand THEN 'reject' WHEN c1 IS NULL THEN 'review' WHEN c1 <> c2 THEN 'reject' WHEN id IS NOT NULL THEN 'auto' WHEN sim >= 0.8 AND same_cat THEN 'review' ELSE 'reject' END AS status,
      round(CASE WHEN brand THEN 1 WHEN c1 IS NULL THEN 0 WHEN c1 <> c2 THEN 1 WHEN id = 'gtin' THEN 1 WHEN id = 'sku' THEN 0.995 WHEN sim >= 0.8 AND same_cat THEN least(0.94, 0.55 + sim * 0.35) ELSE sim END, 9)::DOUBLE AS confidence,
      CASE WHEN brand THEN 'brand_conflict' WHEN c1 IS NULL THEN 'color_evidence_missing' WHEN c1 <> c2 THEN 'color_conflict' WHEN id IS NOT NULL THEN 'trusted_identifier_exact' WHEN sim >= 0.8 AND same_cat THEN 'composite_candidate_requires_review' ELSE 'insufficient_evidence' END AS reason FROM s""",
)
def match_decision(spark, d):
    p = table(spark, d, "part").withColumn("form", text.entity_form(F.col("p_name")))
    side = lambda key, n: p.select(key.alias("a"), F.col("p_size").alias(f"s{n}"), F.col("form").alias(f"n{n}"), F.col("p_type").alias(f"t{n}"), F.col("p_brand").alias(f"b{n}"))
    k = F.col("a")
    m = side(F.col("p_partkey"), 1).join(side(F.col("p_partkey") - 10, 2), "a")
    brands = (F.when(k % 2 == 0, F.col("b1")).otherwise("one"), F.when(k % 2 == 0, F.col("b2")).otherwise("one"))
    colours = (F.when(k % 11 != 0, F.col("s1") % 2), F.col("s2") % 2)
    similarity = text.jaccard(text.tokens(F.col("n1")), text.tokens(F.col("n2")))
    decided = M.catalogue_decision(brands, colours, F.when(k % 7 == 0, "gtin").when(k % 5 == 0, "sku"), similarity, (F.col("t1") == F.col("t2")) | (k % 3 == 0))
    return m.select("a", decided.alias("m")).select("a", "m.status", F.round("m.confidence", 9).alias("confidence"), "m.reason")


@query("x29_json_access", "SELECT event_id, (props->>'$.k')::INT AS k, '{\"id\":' || event_id || ',\"type\":\"' || event_type || '\"}' AS envelope FROM events")
def json_access(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))).alias("envelope"))


@query("x30_enum_membership", "SELECT event_type IN ('click', 'view', 'purchase') AS known, count(*) AS n FROM events GROUP BY 1")
def enum_membership(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").isin("click", "view", "purchase").alias("known")).agg(F.count("*").alias("n"))


@query("x33_locale", f"SELECT page_id, nullif(regexp_extract({PATH_}, '^/([a-z]{{2}})/', 1), '') AS locale, CASE page_id % 3 WHEN 0 THEN 'US,KR,JP' WHEN 1 THEN 'DE' ELSE '' END AS countries FROM pages")
def locale(spark, d):
    from ..operators.market import market_countries
    from ..shipping import ship, spread
    from ..sources.page_tree import Page, page_tree

    ship(spark)
    k = F.col("page_id")
    form = F.when(k % 3 == 0, '<form class="localization"><option value="US"><option selected value="KR"><option value="xx"><input name="country_code" value="jp"></form>').when(k % 3 == 1, '{"country_code": "DE", "iso_code": \'DE\'}').otherwise('<option value="FR">')
    p = spread(table(spark, d, "pages").select("page_id", "url")).select("page_id", "url", form.alias("form"), page_tree(form).alias("tree"))
    return p.select("page_id", F.nullif(F.regexp_extract(urls.path(F.col("url")), "^/([a-z]{2})/", 1), F.lit("")).alias("locale"), F.array_join(market_countries(Page(F.col("tree")), F.col("form")), ",").alias("countries"))


@query("x11_same_page", "SELECT page_id, page_id % 6 IN (0, 1, 4) AS same FROM pages")
def same_page(spark, d):
    k = F.col("page_id")
    a = F.concat(F.lit("https://www.shop.example/product/x/"), k, F.when(k % 6 == 3, "?variant=2").otherwise("?utm=1"))
    b = F.when(k % 6 == 0, F.concat(F.lit("http://shop.example/detail?product_no="), k)).when(k % 6 == 1, F.concat(F.lit("/product/"), k, F.lit("/"))).when(k % 6 == 2, F.concat(F.lit("https://other.example/product/x/"), k)).when(k % 6 == 4, F.concat(F.lit("https://shop.example/product/renamed/"), k, F.lit("/category/3"))).when(k % 6 == 5, F.lit("https://shop.example/product/x/0")).otherwise(a)
    b = F.when(k % 6 == 3, F.regexp_replace(a, "variant=2", "variant=3")).otherwise(b)
    return table(spark, d, "pages").select("page_id", urls.same_page(b, a).alias("same"))


@query("x12_small_variants", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'https://s.example/web/product/big/a.jpg,https://s.example/b.jpg' ELSE 'https://s.example/web/product/small/a.jpg,https://s.example/web/product/medium/c.jpg,https://s.example/b.jpg' END AS images FROM part")
def small_variants(spark, d):
    at = lambda x: F.lit(f"https://s.example/{x}.jpg")
    images = F.array_compact(F.array(F.when(F.col("p_partkey") % 2 == 0, at("web/product/big/a")), at("web/product/small/a"), F.when(F.col("p_partkey") % 2 == 1, at("web/product/medium/c")), at("b")))
    return table(spark, d, "part").select("p_partkey", F.array_join(urls.drop_small_variants(images), ",").alias("images"))


@query("o9_best_srcset", "SELECT p_partkey, 'c.jpg' AS best, 300 + p_partkey % 7 AS width FROM part")
def best_srcset(spark, d):
    srcset = F.concat(F.lit("a.jpg 100w, c.jpg "), 300 + F.col("p_partkey") % 7, F.lit("w, b.jpg 200w"))
    best = payloads.best_srcset(srcset)
    return table(spark, d, "part").select("p_partkey", best["url"].alias("best"), best["width"].cast("long").alias("width"))


# ---- parsers ----


@query("s6_shopify_payload", f"WITH {OFFERS}, v AS (SELECT product_id, min(CASE WHEN sale IS NOT NULL THEN sale END) AS cheapest_sale, min(original) AS cheapest, count(*) AS variants, bool_or(in_stock) AS in_stock FROM offers GROUP BY 1) SELECT product_id, coalesce(cheapest_sale, cheapest) AS price, variants, in_stock FROM v")
def shopify_payload(spark, d):
    variant = F.struct(F.col("original").alias("compare_at_price"), F.coalesce("sale", "original").alias("price"), F.col("in_stock").alias("available"))
    # the payloads that the parser reads, several for a product with many offers
    raw = payloads.shopify_payloads(offers(spark, d), "product_id", "order_id", "line", variant)
    return payloads.shopify_variants(raw, "product_id", "payload")


@query(
    "s6_shopify_products",
    """WITH p AS (SELECT p_partkey, p_name, p_size, p_brand, floor(p_retailprice) AS price FROM part)
    SELECT p_partkey AS page, 'item-' || p_partkey AS handle, CASE WHEN p_size % 3 = 0 THEN price - 5 ELSE price END AS price, CASE WHEN p_size % 3 = 0 THEN price END AS before, CASE WHEN p_size % 2 = 0 THEN 'S, M' END AS size_info,
      CASE WHEN p_partkey % 6 = 5 THEN '' ELSE 'https://cdn.shopify.com/' || p_partkey || '.jpg' END AS image_url FROM p WHERE p_partkey % 13 <> 0 AND p_partkey % 11 <> 0 AND p_partkey % 17 <> 0""",
)
def shopify_products(spark, d):
    """A page a part: a product, whose second variant is sold out, and a gift card."""
    k, n, v = F.col("p_partkey"), F.col("p_size"), F.floor("p_retailprice").cast("string")
    variant = lambda price, before, size, there: F.struct(price.alias("price"), before.cast("string").alias("compare_at_price"), there.alias("available"), F.lit("x").alias("option1"), F.lit(size).alias("option2"))
    sale = n % 3 == 0
    product = F.struct(
        F.concat("p_name", F.when(k % 13 == 0, " Gift Card").otherwise("")).alias("title"), F.concat(F.when(k % 17 == 0, "../").otherwise(""), F.lit("item-"), k).alias("handle"), F.col("p_brand").alias("vendor"), F.array(F.lit("a"), F.when(k % 11 == 0, " Wholesale ").otherwise("b")).alias("tags"),
        F.array(F.struct(F.lit("Colour").alias("name"), F.lit(1).alias("position")), F.struct(F.when(n % 2 == 0, "Shoe Size").otherwise("Fit").alias("name"), F.lit(2).alias("position"))).alias("options"),
        F.array(F.struct(F.when(k % 6 == 5, "https://elsewhere.example/a.jpg").otherwise(F.concat(F.lit("https://cdn.shopify.com/"), k, F.lit(".jpg"))).alias("src"))).alias("images"),
        F.array(variant(v, F.lit(None), "S", F.lit(True)), variant(F.lit("1.00"), F.lit(None), "M", F.lit(False)), variant(F.when(sale, (v.cast("long") - 5).cast("string")).otherwise("999999"), F.when(sale, v), "S", F.lit(True))).alias("variants"),
    )
    pages = table(spark, d, "part").select(k.alias("page"), F.to_json(F.struct(F.array(product).alias("products"))).alias("payload"))
    r = shopify.parse_products(pages, "page", "payload", "https://shop.example", excluded_tags=["wholesale"])
    return r.select("page", "handle", F.col("pricing.price").alias("price"), F.when(F.col("pricing.state") == "sale", F.col("pricing.original_price")).alias("before"), "size_info", "image_url")


@query("s9_card_prices", "SELECT o_orderkey, floor(o_totalprice * 0.9)::BIGINT AS price, floor(o_totalprice)::BIGINT AS original FROM orders")
def card_prices(spark, d):
    t = F.concat(F.lit("₩"), F.floor("o_totalprice"), F.lit(" → ₩"), F.floor(F.col("o_totalprice") * 0.9))
    c = payloads.card_price(t)
    return table(spark, d, "orders").select("o_orderkey", c["price"].alias("price"), c["original"].alias("original"))


@query("s13_structured_data", "SELECT p_partkey, p_name AS name, p_retailprice AS price, p_size % 2 = 0 AS in_stock FROM part")
def structured_data(spark, d):
    ld = F.to_json(F.struct(F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.struct(F.col("p_retailprice").cast("string").alias("price"), F.when(F.col("p_size") % 2 == 0, "https://schema.org/InStock").otherwise("https://schema.org/OutOfStock").alias("availability")).alias("offers")))
    page = F.concat(F.lit('<html><script type="application/ld+json">{broken</script><script type="application/ld+json">{"@graph":['), ld, F.lit("]}</script></html>"))
    return payloads.structured_products(table(spark, d, "part").select("p_partkey", page.alias("html")), "p_partkey", "html").select("p_partkey", "name", "price", "in_stock")


@query("s17_review_status", "SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS reviews, CASE WHEN count(*) FILTER (WHERE role = 'user') = 0 THEN 'failed' WHEN count(*) FILTER (WHERE role = 'user') < count(*) THEN 'partial' ELSE 'succeeded' END AS status FROM conversations GROUP BY 1")
def review_status(spark, d):
    n = F.count_if(F.col("role") == "user")
    return table(spark, d, "conversations").groupBy("conv_id").agg(n.alias("reviews"), F.when(n == 0, "failed").when(n < F.count("*"), "partial").otherwise("succeeded").alias("status"))


@query("s3_keyset_scan", "SELECT o_orderkey, o_totalprice, row_number() OVER w AS place, coalesce(o_orderkey > lag(o_orderkey) OVER w, true) AS increasing FROM orders WINDOW w AS (ORDER BY o_orderkey, o_totalprice)")
def keyset_scan(spark, d):
    """All pages in order; ids increase strictly where no row before has the same one."""
    o = placed(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), F.asc("o_orderkey"), F.asc("o_totalprice"))
    first = F.row_number().over(Window.partitionBy("o_orderkey").orderBy("place")) == 1
    return o.withColumn("increasing", first)


@query("s4_batched_lookup", "SELECT p_partkey, label FROM part LEFT JOIN embeddings ON vec_id = p_partkey")
def batched_lookup(spark, d):
    return table(spark, d, "part").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("p_partkey"), "label"), "p_partkey", "left").select("p_partkey", "label")


@query("w8_csv_guard", "SELECT s_suppkey, CASE WHEN regexp_matches(v, '^[=+@-]') THEN '''' || v ELSE v END AS cell FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN '=' WHEN 1 THEN '-' WHEN 2 THEN '' ELSE '@' END || s_name AS v FROM supplier)")
def csv_guard(spark, d):
    v = F.concat(F.when(F.col("s_suppkey") % 4 == 0, "=").when(F.col("s_suppkey") % 4 == 1, "-").when(F.col("s_suppkey") % 4 == 2, "").otherwise("@"), "s_name")
    return table(spark, d, "supplier").select("s_suppkey", payloads.guarded_cell(v).alias("cell"))


# ---- event windows ----


@query("t_tumbling_window", "SELECT time_bucket(INTERVAL 6 HOURS, ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_window(spark, d):
    return table(spark, d, "events").groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")


@query("t_sliding_window", "WITH s AS (SELECT time_bucket(INTERVAL 12 HOURS, ts) - to_hours(k) AS start, value FROM events, (VALUES (0), (12)) AS v(k)) SELECT start, count(*) AS n, round(sum(value::DECIMAL(18,2)), 2)::DOUBLE AS total FROM s GROUP BY 1")
def sliding_window(spark, d):
    w = table(spark, d, "events").groupBy(F.window("ts", "24 hours", "12 hours").alias("w"))
    return w.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")).select("w.start", "n", "total")


@query("t_session_window", "WITH l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events), s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 8 HOURS THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM l) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k")
def session_window(spark, d):
    return table(spark, d, "events").groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "n")


@query("t4_state_machine", "WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id) AS e FROM events WHERE event_type IN ('click', 'purchase', 'error')) SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'imported' WHEN event_type = 'error' AND e >= 5 THEN 'rejected' WHEN event_type = 'error' THEN 'retry' ELSE 'claimed' END AS status, e AS attempts FROM r WHERE k = 1")
def state_machine(spark, d):
    from ..streaming.candidates import replay

    return replay(table(spark, d, "events").select(F.col("user_id"), "ts", "event_id", "event_type"), most=5)


@query("t3_claim_queue")
def claim_queue(spark, d):
    """Users as candidates, their events as commands; the state machine has no SQL, tests replay it by hand."""
    from ..streaming import queue

    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "signup", "observe").when(F.col("event_type") == "click", "claim").when(F.col("event_type") == "view", "heartbeat").when(F.col("event_type") == "purchase", F.when(F.col("event_id") % 2 == 0, "checkpoint").otherwise("publish")).otherwise("finish")
    ended = F.get(F.array(*map(F.lit, ["retry", "rejected", "release", "stale"])), (F.col("event_id") % 4).cast("int"))
    c = e.select(F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), kind.alias("kind"), F.when(kind == "observe", F.col("event_id")).alias("revision"), F.lit("worker").alias("token"), ended.alias("outcome"), (F.col("event_id") % 9 != 0).alias("matched"))
    return queue.final_status(queue.replay(c, lease_seconds=14 * 86_400))
