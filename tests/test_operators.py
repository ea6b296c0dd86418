import datetime as dt
import random

import pytest
from loomcat.functions import money, numbers, text, urls
from loomcat.operators import images, matching, ordering, quality_gates, repair, schedule
from loomcat.operators import listing as L
from loomcat.rules import Rule, all_matches, first_match, unique_match
from loomcat.sources import gated, payloads, registry, scans
from pyspark.sql import functions as F


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def day(n):
    return dt.datetime(2024, 1, n)


def test_observed_pricing(spark):
    def price(current, original, sale, state):
        number = lambda x: F.lit(x).cast("double")
        p = value(spark, money.observed_pricing(number(current), number(original), number(sale), F.lit(state), F.lit("s")))
        return p.price, p.original_price, p.sale_price, p.state

    assert price(80, 100, 80, "sale") == (80, 100, 80, "sale")
    assert price(80, 100, None, "sale") == (80, 100, 80, "sale")
    assert price(100, 100, 100, "sale") == (100, 100, None, "unknown")
    assert price(100, None, 90, "sale") == (100, 100, None, "unknown")
    assert price(100, 120, None, "regular") == (100, 100, None, "regular")
    assert price(-5, None, None, "regular") == (None, None, None, "regular")
    assert price(70, 90, None, "other") == (70, 90, None, "unknown")


def test_stored_price(spark):
    def stored(price, original, sale, rate=1.0, converted=False):
        number = lambda x: F.lit(x).cast("double")
        s = F.struct(number(price).alias("price"), number(original).alias("original_price"), number(sale).alias("sale_price"))
        r = value(spark, money.stored_price(s, number(rate), F.lit(converted)))
        return None if r is None else tuple(r)

    assert stored(90, 100, 90) == (90, 100, 90)
    assert stored(100, 100, None) == (100, 100, None)
    assert stored(100, 100, 100) is None
    assert stored(10.5, 10.5, None) is None
    assert stored(10.5, 10.5, None, 2.0, True) == (21, 21, None)
    assert stored(10, 10, None, None, True) is None
    assert stored(2e8, 2e8, None) is None


STORED = "id long, product_url string, price double, original_price double, in_stock boolean, last_seen_at timestamp"
CRAWLED = "ord long, product_url string, price double, in_stock boolean, observed_at timestamp"


def test_listing_diff(spark):
    old = spark.createDataFrame([
        (1, "https://www.a.example/product/x/7/", 100.0, 100.0, True, day(1)), (2, "https://a.example/product/y/7/category/3/", 100.0, 100.0, True, day(9)),
        (3, "https://a.example/plain", 50.0, None, False, None), (4, "https://a.example/gone", 5.0, 5.0, True, day(1)), (5, None, 5.0, 5.0, True, day(1)),
    ], STORED)
    new = spark.createDataFrame([
        (1, "https://a.example/detail?product_no=7", 80.0, True, day(5)), (2, "https://a.example/detail?product_no=7", 1.0, True, day(5)),
        (3, "https://a.example/plain", 50.0, True, day(5)), (4, "https://a.example/new", 3.0, True, day(5)), (5, None, 3.0, True, day(5)),
    ], CRAWLED)
    got = {r.id: (r.outcome, r.price, r.original_price, r.sale_price, r.in_stock) for r in L.diff_listing(new, old).collect()}
    assert got == {1: ("price", 80.0, 100.0, 80.0, True), 2: ("stale", 100.0, 100.0, None, True), 3: ("restocked", 50.0, 50.0, None, True)}
    assert sorted(r.id for r in L.missing_rows(new, old).collect()) == [4, 5]
    assert [r.ord for r in L.unknown_observations(new, old).collect()] == [4]
    assert L.mark_missing(new, old, 0.9).count() == 0 and L.mark_missing(new, old, 0.5).count() == 2
    assert L.diff_listing(new.limit(0), old).count() == 0 and L.missing_rows(new.limit(0), old).count() == 5


def test_observations_with_gaps_write_no_more_than_they_say(spark):
    kinds = f"{STORED}, crawled_at timestamp, quarantined boolean"
    at = lambda k: f"https://a.example/plain/{k}"
    old = spark.createDataFrame([
        (1, at(1), 100.0, 120.0, True, day(3), None, False), (2, at(2), 100.0, 120.0, True, day(3), day(9), None), (3, at(3), 100.0, 100.0, True, None, None, False),
        (4, at(4), 100.0, 100.0, False, day(1), None, True), (5, at(5), 100.0, 100.0, True, day(1), None, True), (6, at(6), None, None, True, day(1), None, False), (7, at(7), 100.0, 100.0, True, day(1), None, True),
    ], kinds)
    new = spark.createDataFrame([(1, at(1), None, True, day(5)), (2, at(2), 1.0, False, day(5)), (3, at(3), 90.0, True, None), (4, at(4), 90.0, True, day(5)), (5, at(5), 100.0, True, day(5)), (6, at(6), 70.0, True, day(5)), (7, at(7), None, False, day(5))], CRAWLED)
    got = {r.id: tuple(r)[1:] for r in L.diff_listing(new, old).collect()}
    assert got == {
        1: ("unchanged", 100.0, 120.0, None, True), 2: ("stale", 100.0, 120.0, None, True), 3: ("stale", 100.0, 100.0, None, True), 4: ("price", 90.0, 100.0, 90.0, False),
        5: ("blocked", 100.0, 100.0, None, False), 6: ("price", 70.0, 70.0, None, True), 7: ("sold_out", 100.0, 100.0, None, False),
    }
    confirmed = new.withColumn("fields", F.when(F.col("ord") == 6, F.struct(F.lit(60.0).alias("price"), F.lit(80.0).alias("original_price"), F.lit(60.0).alias("sale_price"))))
    assert {r.id: tuple(r)[1:] for r in L.diff_listing(confirmed, old).collect()}[6] == ("price", 60.0, 80.0, 60.0, True)


def test_failures_of_our_own_store_do_not_count(spark):
    rows = [("a", day(1), "failed", False, True), ("a", day(2), "failed", False, None), ("b", day(1), "failed", None, True)]
    runs = spark.createDataFrame(rows, "source string, started_at timestamp, status string, unreachable_only boolean, db_partial_only boolean")
    assert [tuple(r) for r in schedule.failure_streaks(runs).collect()] == [("a", 1, day(2))]


def test_chunks_are_packed_greedily(spark):
    sizes = [60, 60, 70, 10, 20, 200, 5, 95, 1]
    df = spark.createDataFrame(list(enumerate(sizes)), "k long, n long")
    for rows_a_range in (1_000_000, 4, 1):
        got = {r.k: r.chunk for r in ordering.greedy_chunks(df, "k", F.col("n"), 100, rows_a_range).collect()}
        assert got == dict(enumerate([0, 1, 2, 2, 2, 3, 4, 4, 5]))
    assert ordering.greedy_chunks(df.limit(0), "k", F.col("n"), 100).count() == 0


def test_chunks_know_no_borders(spark):
    """One law over all rows, whatever the ranges: sizes of 0, missing ones, large ones, a chunk that spans ranges."""
    r = random.Random(5)
    sizes = [r.choice([0, 0, None, 1, 2, 3, 3, 40, 99, 120]) if k % 700 < 400 else 0 for k in range(12_000)]
    df = spark.createDataFrame([(3 * k, n) for k, n in enumerate(sizes)], "k long, n long").repartition(5)
    held, chunk, wanted = None, 0, {}
    for k, n in enumerate(sizes):
        if held is not None and held + (n or 0) > 100:
            held, chunk = 0, chunk + 1
        held = (held or 0) + (n or 0)
        wanted[3 * k] = chunk
    for rows_a_range in (1_000_000, 900):
        assert {x.k: x.chunk for x in ordering.greedy_chunks(df, "k", F.col("n"), 100, rows_a_range).collect()} == wanted


def test_forms_of_texts(spark):
    df = spark.createDataFrame([("Cafe\u0301_Noir-\uff21 ",), ("Café Noir A",), (None,)], "t string")
    assert [r[0] for r in df.select(text.match_form(F.col("t"))).collect()] == ["cafe noir a", "cafe noir a", None]
    assert [r[0] for r in df.select(text.entity_form(F.col("t"))).collect()] == ["café noir a", "café noir a", None]
    messages = {"at postgres://u:p@h/db now": "at [url] now", "x-api-key: abc, next": "x-api-key=[hidden], next", "MY_TOKEN=1;x": "MY_TOKEN=[hidden];x", "Bearer a.b-c d": "Bearer [hidden] d", "HTTPS://x.example/?a": "[url]"}
    df = spark.createDataFrame([(m,) for m in messages], "t string")
    assert [r[0] for r in df.select(text.safe_message(F.col("t"))).collect()] == list(messages.values())


def test_streaks(spark):
    rows = [
        ("a", day(1), "success", False), ("a", day(2), "failed", False), ("a", day(3), "running", False), ("a", day(4), "failed", True), ("a", day(5), "failed", None),
        ("b", day(1), "failed", False), ("b", day(2), "partial", False), ("c", None, "success", False), ("c", day(1), "failed", False), ("d", day(1), "skipped", False),
    ]
    runs = spark.createDataFrame(rows, "source string, started_at timestamp, status string, unreachable_only boolean")
    got = {r.source: (r.failures, r.last_failed_at) for r in schedule.failure_streaks(runs).collect()}
    assert got == {"a": (2, day(5)), "c": (1, day(1))}
    hours = spark.range(9).select(schedule.backoff_hours(F.col("id"))).collect()
    assert [h[0] for h in hours] == [0, 0, 0, 12, 24, 72, 168, 336, 336]


def test_identity_of_addresses(spark):
    wanted = {
        "https://www.Shop.example/p?x=1&idx=5#a": "shop.example#idx=5", "https://shop.example/product/슬러그/123/category/4/": "shop.example#product_no=123",
        "https://zara.com/KR/ko/shirt-p0123.html": "zara.com#zara_product=0123&locale=kr/ko", "https://zara.com/shirt-p9.html": "zara.com#zara_product=9&locale=unknown",
        "https://s.example/en-kr/products/Blue-1.json?variant=2&currency=EUR": "s.example#shopify_handle=blue-1&variant=2&currency=EUR",
        "https://s.example/products/a?variant=1&variant=2%203&x=&locale=": "s.example#shopify_handle=a&variant=1&variant=2%203&locale=", "https://s.example/item?idx=&product_no=%41+b": "s.example#product_no=A b",
        "https://s.example/a/b/products/x": None, "https://s.example/product//12": None, "https://s.example/product/x/12a": None, "https://other.example/kr/ko/a-p1.html": None,
        "not an address": None, "": None, None: None, "https://s.example/about": None,
    }
    df = spark.createDataFrame([(u,) for u in wanted], "u string")
    assert {r.u: r.k for r in df.select("u", urls.product_identity(F.col("u")).alias("k")).collect()} == wanted


def test_word_borders_are_ascii(spark):
    rule = [Rule("dress", text.ascii_word("dress"))]
    df = spark.createDataFrame([("여성dress",), ("dresses",), ("a dress",), (None,)], "t string")
    assert [r[0] for r in df.select(first_match(rule, F.col("t"))).collect()] == ["dress", None, "dress", None]


def test_rules(spark):
    rules = [Rule("a", "x"), Rule("b", "y", unless="z"), Rule("a", "w")]
    df = spark.createDataFrame([("xw",), ("xy",), ("yz",), ("",)], "t string")
    assert [(r.f, r.u, r.a) for r in df.select(first_match(rules, F.col("t"), F.lit("-")).alias("f"), unique_match(rules, F.col("t")).alias("u"), all_matches(rules, F.col("t")).alias("a")).collect()] == [("a", "a", ["a"]), ("a", None, ["a", "b"]), ("-", None, []), ("-", None, [])]


def test_fuzzy_best_against_all_pairs(spark):
    import random

    r = random.Random(2)
    names = ["".join(r.choice("abc ") for _ in range(r.randint(1, 9))) for _ in range(60)]
    left = spark.createDataFrame(list(enumerate(names[:30])), "l long, t string")
    right = spark.createDataFrame(list(enumerate(names[30:])), "r long, t string")

    def grams(s):
        return {s[k : k + 3] for k in range(max(1, len(s) - 2))}

    wanted = {}
    for i, a in enumerate(names[:30]):
        scored = [(-len(grams(a) & grams(b)) / len(grams(a) | grams(b)), k) for k, b in enumerate(names[30:])]
        s, k = min(scored)
        if -s >= 0.4:
            wanted[i] = k
    assert {x.l: x.r for x in matching.fuzzy_best(left, right, "l", "r", "t", 0.4).collect()} == wanted


def test_running_total(spark):
    df = spark.createDataFrame([(k * k, k) for k in range(50)], "k long, v long")
    got = [r.t for r in ordering.running_total(df, "k", F.col("v"), "t", ranges=7).orderBy("k").collect()]
    assert got == [sum(range(k + 1)) for k in range(50)]
    assert ordering.running_total(df.limit(0), "k", F.col("v"), "t").count() == 0
    clustered = spark.range(4000).select(F.when(F.col("id") < 10, F.col("id") * 10**15).otherwise(9 * 10**15 + F.col("id")).alias("k"), F.lit(1).alias("v"))
    assert sorted(r.t for r in ordering.running_total(clustered, "k", F.col("v"), "t", ranges=8).collect()) == list(range(1, 4001))
    ranges = ordering._ranged(clustered, 8, F.col("k").asc()).groupBy("_range").count().collect()
    assert max(r["count"] for r in ranges) < 1500


def test_gates(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 5)], "g string, v int")
    got = quality_gates.split_valid(df, {"v": F.col("v") > 0, "g": F.col("g") == "a"}).collect()
    assert [r.error for r in got] == [None, "v", "g"]
    q = {r.g: (r.total, r.missing_share, r.problems, r["pass"]) for r in quality_gates.batch_quality(df, ["g"], {"missing": F.col("v").isNull()}, {"missing": 20}).collect()}
    assert q == {"a": (2, 50.0, "missing", False), "b": (1, 0.0, "", True)}


def test_repair_is_dry_by_default_and_guarded(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    plan = repair.plan_repair(df, "k", "v", F.lit("a"))
    assert sorted((r.k, r.before, r.after) for r in plan.collect()) == [(2, "b", "a"), (3, None, "a")]
    moved = df.withColumn("v", F.when(F.col("k") == 2, "z").otherwise(F.col("v")))
    assert sorted((r.k, r.v, r.applied) for r in repair.apply_repair(moved, plan, "k", "v", dry_run=False).collect()) == [(1, "a", False), (2, "z", False), (3, "a", True)]
    assert sorted((r.k, r.v) for r in repair.apply_repair(df, plan, "k", "v").collect()) == [(1, "a"), (2, "b"), (3, None)]


def test_box_suppression(spark):
    boxes = spark.createDataFrame([("i", 1, 0.9, 0.0, 0.0, 10.0, 10.0), ("i", 2, 0.8, 1.0, 1.0, 10.0, 10.0), ("i", 3, 0.7, 20.0, 0.0, 30.0, 10.0), ("j", 1, 0.5, 0.0, 0.0, 1.0, 1.0)], "image string, box int, score double, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, images.suppress(boxes, "image", 0.5).collect())) == [("i", 1), ("i", 3), ("j", 1)]


def test_suppression_against_one_by_one(spark):
    import random

    r = random.Random(8)
    rows = [(k % 3, k, r.choice([0.1, 0.5, 0.9]), x := r.uniform(-50, 200), y := r.uniform(0, 60), x + r.choice([0, 20, 30]), y + 25) for k in range(240)]
    rows += [(9, k, 0.5, 0.0, 0.0, 10.0, 10.0) for k in range(50)]

    def iou(a, b):
        w, h = (max(0.0, min(a[k + 2], b[k + 2]) - max(a[k], b[k])) for k in (3, 4))
        area = [(c[5] - c[3]) * (c[6] - c[4]) for c in (a, b)]
        return w * h / (sum(area) - w * h) if sum(area) > w * h else 0.0

    kept = []
    for b in sorted(rows, key=lambda b: (-b[2], b[1])):
        if all(k[0] != b[0] or iou(k, b) <= 0.4 for k in kept):
            kept.append(b)
    df = spark.createDataFrame(rows, "image long, box long, score double, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, images.suppress(df, "image", 0.4).collect())) == sorted(b[:2] for b in kept)
    assert images.suppress(df.limit(0), "image", 0.4).count() == 0


def test_payloads(spark):
    page = '<script type="application/ld+json">{bad</script><script type="application/ld+json">{"@type":"Product","name":"N","offers":{"price":"12.5","availability":"https://schema.org/OutOfStock"}}</script>'
    df = spark.createDataFrame([(1, page), (2, "<p>"), (3, None)], "k long, html string")
    assert sorted(((r.k, r.name, r.price, r.in_stock) for r in payloads.structured_products(df, "k", "html").collect()), key=str) == [(1, "N", 12.5, False), (2, None, None, None), (3, None, None, None)]
    deep = spark.createDataFrame([(1, '{"a":[{"id":1,"name":"x","price":2}]}'), (2, "{"), (3, None)], "k long, p string")
    assert [tuple(r) for r in registry.payload_objects(deep, "k", "p").collect()] == [(1, "1", "x", 2.0)]
    item = '{"id":1,"name":"x","price":2}'
    deep = spark.createDataFrame([(4, '[{"a":' * 20 + item + "}]" * 20), (5, f"[{item},{item}]")], "k long, p string")
    assert sorted(r.k for r in registry.payload_objects(deep, "k", "p").collect()) == [4, 5, 5]


def test_payloads_of_a_large_product_are_bounded(spark):
    df = spark.range(5000).select(F.lit(1).alias("p"), F.floor(F.col("id") / 50).alias("o"), (F.col("id") % 50).alias("l"), (F.col("id") + 10.0).alias("x"))
    df = df.unionByName(spark.createDataFrame([(2, 7, 1, 9.0)], "p int, o long, l long, x double"))
    variant = F.struct((F.col("x") + (F.col("x") > 2000).cast("double")).alias("compare_at_price"), F.col("x").alias("price"), (F.col("x") == 5009).alias("available"))
    raw = payloads.shopify_payloads(df, "p", "o", "l", variant)
    assert raw.select(F.max(F.size(F.from_json("payload", payloads.VARIANTS)["variants"]))).first()[0] <= 1024
    assert sorted(map(tuple, payloads.shopify_variants(raw, "p", "payload").collect())) == [(1, 2001.0, 5000, True), (2, 9.0, 1, False)]


def test_parser_registry():
    r = registry.ParserRegistry()
    r.register("a", lambda df: df)
    assert r.has("a") and r.keys() == ["a"]
    with pytest.raises(KeyError, match="there are a"):
        r.resolve("b")
    with pytest.raises(ValueError):
        r.register("a", lambda df: df)


def test_product_files(spark, tmp_path):
    (tmp_path / "one-products.json").write_text('[{"name": "a"}, {"name": "b"}]')
    (tmp_path / "two-products.json").write_text('[{"name": "c"}]')
    got = payloads.scan_products(spark, f"file://{tmp_path}", "name string", ["one"])
    assert sorted(map(tuple, got.collect())) == [("a", "one"), ("b", "one")]
    with pytest.raises(ValueError, match="three"):
        payloads.scan_products(spark, f"file://{tmp_path}", "name string", ["one", "three"])


def test_cosine_distance(spark):
    arrays = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0], [-2.0]), ([1.0], [1.0, 2.0]), ([0.0], [1.0]), (None, [1.0])], "a array<double>, b array<double>")
    assert [r[0] for r in arrays.select(numbers.cosine_distance(F.col("a"), F.col("b"))).collect()] == [0.0, 2.0, None, None, None]


def test_scans_go_on_where_they_stopped(spark):
    pages = spark.createDataFrame([(s, c, p, f) for s, f in (("a", "x"), ("b", "y")) for c in (0, 1) for p in (1, 2, 3)], "site string, category_index int, page int, fingerprint string")
    cursors = spark.createDataFrame([("b", 0, 2, "old", False)], "site string, category_index int, page int, fingerprint string, complete boolean")
    seen = {"a": [], "b": []}
    for turn in range(3):
        taken, cursors = scans.scan_slice(pages, cursors, 4)
        for r in taken.collect():
            seen[r.site].append((turn, r.category_index, r.page))
        cursors = spark.createDataFrame(cursors.collect(), cursors.schema)
        if turn == 0:
            assert {r.site: (r.category_index, r.page, r.complete) for r in cursors.collect()} == {"a": (1, 1, False), "b": (1, 1, False)}
        if turn == 1:
            assert {r.site: r.complete for r in cursors.collect()} == {"a": True, "b": True}
    every = [(c, p) for c in (0, 1) for p in (1, 2, 3)]
    for own in seen.values():
        assert sorted((c, p) for t, c, p in own if t < 2) == every and sorted((c, p) for t, c, p in own if t == 2) == every[:4]


def test_boxes_of_any_size(spark):
    """Sizes from a thousandth to ten millions, two axes apart, copies: counts and pairs as over all pairs, few rows a box."""
    r = random.Random(9)
    rows = []
    for k in range(220):
        w, h = (10 ** r.uniform(-3, 7) for _ in "xy")
        x, y = r.uniform(-w, w), r.uniform(-h, h)
        rows.append((k % 2, k, r.random(), x, y, x + w, y + h))
        for _ in range(r.randrange(3)):
            dx, dy, sx, sy = (r.uniform(0, 0.4) for _ in range(4))
            rows.append((k % 2, 1000 + len(rows), r.random(), x + dx * w, y + dy * h, x + dx * w + w * (1 + sx), y + dy * h + h * (1 - sy)))
    rows += [(0, 5000 + k, 0.5, *rows[3][3:]) for k in range(40)] + [(0, 6000, 0.5, 1.0, 1.0, 1.0, 5.0)]

    def iou(a, b):
        w, h = (max(0.0, min(a[k + 2], b[k + 2]) - max(a[k], b[k])) for k in (3, 4))
        area = [(c[5] - c[3]) * (c[6] - c[4]) for c in (a, b)]
        return w * h / (sum(area) - w * h) if sum(area) > w * h else 0.0

    df = spark.createDataFrame(rows, "image long, box long, score double, x0 double, y0 double, x1 double, y1 double")
    for limit in (0.5, 0.12):
        heavy = {i: sum(iou(a, b) > limit for a in rows for b in rows if a[0] == b[0] == i and a[1] < b[1]) for i in (0, 1)}
        assert min(heavy.values()) > 20 and {x.image: x.heavy for x in images.overlap_counts(df, "image", limit).collect()} == heavy
    kept = []
    for b in sorted(rows, key=lambda b: (-b[2], b[1])):
        if all(k[0] != b[0] or iou(k, b) <= 0.5 for k in kept):
            kept.append(b)
    assert sorted(map(tuple, images.suppress(df, "image", 0.5).collect())) == sorted(b[:2] for b in kept)
    assert images.overlap_counts(df.limit(0), "image", 0.5).count() == 0


def test_places_in_groups(spark):
    r = random.Random(1)
    rows = [(k, r.choice(["a", "a", "a", "b", None]), r.randrange(50)) for k in range(1500)]
    df = spark.createDataFrame(rows, "k long, g string, v long").repartition(5)
    wanted = {}
    for group in ("a", "b", None):
        for place, row in enumerate(sorted((x for x in rows if x[1] == group), key=lambda x: (-x[2], x[0])), 1):
            wanted[row[0]] = place
    assert {x.k: x.place for x in ordering.placed_in(df, ["g"], F.desc("v"), F.asc("k"), ranges=16).collect()} == wanted


def test_gated_tables_appear_whole(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "k long, price double").repartition(3)
    gates = {"price": F.col("price") > 0, "key": F.col("k") < 3}
    path = f"file://{tmp_path}/out"
    now = lambda: sorted(r.k for r in gated.published(spark, path).collect())
    with pytest.raises(FileNotFoundError):
        gated.published(spark, path)
    assert [tuple(r) for r in gated.write_gated(df, path, gates).collect()] == [("price", 2)]
    assert now() == [1]
    assert [tuple(r) for r in gated.write_gated(df.withColumn("price", F.lit(-1.0)), path, gates).collect()] == [("price", 3)]
    assert now() == [1]  # nothing passed, so the old table stays
    before = gated.published(spark, path)
    gated.write_gated(df.withColumn("k", F.col("k") + 1), path, {"price": F.col("price") > 0})
    assert now() == [2] and [r.k for r in before.collect()] == [1]  # who reads the old table goes on reading it
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|raise_error|broken"):
        gated.write_gated(df.withColumn("price", F.when(F.col("k") == 3, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.lit(1.0))), path, {"price": F.col("price") > 0})
    assert now() == [2]  # a write that failed has published nothing
    gated.forget(path, keep=1)
    assert now() == [2] and len(list((tmp_path / "out" / "data").glob("*.parquet"))) == 1
    assert gated.write_gated(df.limit(0), path, gates).count() == 0 and now() == [2]
    with pytest.raises(ValueError, match="no store"):
        gated.write_gated(df, "ftp://host/x", gates)


def test_partners_without_pairs(spark):
    import random

    r = random.Random(4)
    rows = [(k, r.choice("ab"), r.choice(["x", "y", None]), r.randrange(3)) for k in range(150)]
    df = spark.createDataFrame(rows, "id long, name string, category string, host int")
    pairs = matching.candidate_pairs(df, ["name", "category"], "id", "host").groupBy("left_id").agg(F.count("*").alias("partners"), F.max("right_id").alias("last"))
    assert sorted(map(tuple, matching.candidate_partners(df, ["name", "category"], "id", "host").collect())) == sorted(map(tuple, pairs.collect()))
    assert matching.candidate_partners(df.limit(0), ["name", "category"], "id", "host").count() == 0
