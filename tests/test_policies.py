"""Rules on markets, stock, goods, sources and names against cases worked out by hand."""

import json

from loomcat.operators import market, policies
from loomcat.shipping import ship
from loomcat.sources.page_tree import Page, page_tree
from pyspark.sql import functions as F


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return [r[1] for r in sorted(df.select("k", column(F.col("t"))).collect())]


def test_names_of_goods(spark):
    cases = {
        "Beach Towel": True, "Towel Bag Shirt": False, "iPhone Case": True, "phone-cases jacket": True, "Umbrella": True, "Umbrella earrings": False, "Reflector": True, "Reflector pants": False, "Knitted reflector": False, "Mesh Baskets": True, "Folding mesh-basket bag": True,
        "Shoehorn": True, "볼펜": False, "펜": True, "펜 shirt": True, "Pen": True, "Pencil skirt": False, "Pen dress": False, "laundry basket tee": True, "Wool coat": False, "우산": True, "우산 귀걸이": False, "": False, "타월 hoodie": False, "메쉬 바스켓": False, "우산 메쉬 바스켓 귀걸이": True,
    }
    got = values(spark, list(cases), lambda t: policies.is_no_fashion(policies.goods().labels(t)))
    assert {n: (g, w) for (n, w), g in zip(cases.items(), got, strict=True) if g != w} == {}
    assert values(spark, ["Coat Sold-Out", "soldout", "품절 코트", "unsold outerwear", None], lambda t: F.size(policies.sold_out_names().labels(t)) > 0) == [True, True, True, False, False]


def test_stock(spark):
    option = lambda use="T", number=None, **more: {"use_stock": use, "stock_number": number, **more}
    cases = [([option(number=0), option(number="3")], True), ([option(number=0)], False), ([option(use=True, number=0), option(use=False)], True), ([option(number="")], None), ([option(number=0), option(number="x")], None), ([option(number=5, is_display="F")], False), ([option(number=5, is_selling="F"), option(number=1)], True), ([], None)]
    texts = [json.dumps({f"o{k}": o for k, o in enumerate(options)}) for options, _ in cases] + ["{", None]
    assert values(spark, texts, policies.option_stock) == [w for _, w in cases] + [None, None]
    ship(spark)
    pages = ["<a class='my_btn_buy_x'>b</a><i class='soldout'></i>", "<i class='sold-out'></i>", "<p>", None]
    df = spark.createDataFrame(list(enumerate(pages)), "k long, html string").withColumn("tree", page_tree(F.col("html")))
    assert [r[1] for r in sorted(df.select("k", policies.detail_stock(F.lit(None).cast("string"), Page(F.col("tree")))).collect())] == [True, False, None, None]


def test_sources(spark):
    rows = [("imported", None, None, True), ("blocked", "US", None, True), ("tech_detected", "KR", None, True), ("qc_failed", "US", "eligible_storefront", True), ("qc_failed", "US", "price_only", False), ("new", "KR", None, False), (None, "KR", None, False)]
    df = spark.createDataFrame(rows, "s string, o string, e string, w boolean")
    assert [r[0] == r.w for r in df.select(policies.has_config(*map(F.col, "soe")), "w").collect()] == [True] * len(rows)
    kinds = spark.createDataFrame([("cafe24", None), ("custom", "imweb"), ("custom", "other"), ("x", "imweb")], "k string, f string")
    assert [r[0] for r in kinds.select(policies.engine_of(F.col("k"), F.col("f"))).collect()] == ["cafe24", "imweb", None, None]
    runs = [("success", 0, None, False, False), ("pending", 9, None, False, True), ("exception", 1, "db_read_failed", False, True), ("exception", 3, "db_read_failed", False, False), ("exception", 1, "external_block", False, False), ("exception", 1, "external_block", True, True), ("exception", 1, None, False, False)]
    df = spark.createDataFrame(runs, "s string, a int, c string, r boolean, w boolean")
    assert [r[0] == r.w for r in df.select(policies.is_runnable(F.col("s"), F.col("a"), 3, F.col("c"), F.col("r")), "w").collect()] == [True] * len(runs)


def test_pages_and_names_of_products(spark):
    ship(spark)
    url = "https://shop.example/product/detail.html?product_no=7"
    pages = [("<link rel='canonical' href='/product/x/7/'>", True), ("<link rel=canonical href='https://shop.example/product/x/8/'>", False), ("<script>var iProductNo = 7;</script>", True), ("<script>var iProductNo = 8;</script>", False), ("<p>", False), (None, False)]
    df = spark.createDataFrame([(k, p, w) for k, (p, w) in enumerate(pages)], "k long, html string, w boolean").withColumn("tree", page_tree(F.col("html")))
    assert [r[1] == r.w for r in sorted(df.select("k", policies.page_is_products(Page(F.col("tree")), F.col("html"), F.lit(url)), "w").collect())] == [True] * len(pages)
    names = [("Product: Wool Coat!", "wool-coat", True), ("Wool Coat A", "Wool Coat", True), ("Wool Coat Long", "Wool Coat", False), ("abc", "abc", False), ("ＷＯＯＬ coat", "woolcoat", True), (None, "wool coat", False), ("coat wool", "wool coat", False)]
    df = spark.createDataFrame(names, "a string, b string, w boolean")
    assert [r[0] == r.w for r in df.select(policies.same_name(policies.name_core(F.col("a")), policies.name_core(F.col("b"))), "w").collect()] == [True] * len(names)


def test_market(spark):
    ship(spark)
    urls = {"https://s.example/kr": True, "https://s.example/en-kr/x": True, "https://s.example/KR_ko/": True, "https://s.example/kraft": False, "https://s.example/?country=KR": True, "https://s.example/?a=1&locale=ko-kr": True, "https://s.example/?country=krx": False, "kr": False}
    assert values(spark, list(urls), market.is_localized) == list(urls.values())
    html = "<a href='/en-kr/shop?x=1'>a</a><a href='https://other.example/kr'>b</a><link href='https://s.example/kr/'><a href='/fr'>c</a><a href='/en-kr/bags'>d</a><select class=country-selector><option value=US><option value=kr><option value=Korea></select><input name=country_code value=jp><script>{'iso_code': \"DE\"}</script>"
    page = Page(F.col("tree"))
    df = spark.createDataFrame([(html,), ("<option value=FR>",), (None,)], "html string").withColumn("tree", page_tree(F.col("html")))
    got = df.select(market.localized_links(page, F.lit("https://s.example/")), market.market_countries(page, F.col("html"))).collect()
    assert [tuple(r) for r in got] == [(["https://s.example/en-kr", "https://s.example/kr"], ["US", "JP", "DE"]), ([], []), ([], [])]
    offer = lambda **x: {"@type": "Offer", **x}
    data = [json.dumps({"@graph": [{"@type": "Product", "x": {"deep": [offer(price="5", priceCurrency="usd"), offer(price=0, priceCurrency="EUR")]}}, offer(price=5, priceCurrency="GBP")]}), "{", json.dumps([{"@type": "product", "offers": [offer(lowPrice=2, priceCurrency="KRW"), offer(price=3, priceCurrency="USD"), offer(price="x", priceCurrency="JPY"), offer(price=1, priceCurrency="w0n")]}])]
    df = spark.createDataFrame([(data,), ([],), (None,)], "d array<string>")
    assert [r[0] for r in df.select(market.offer_currencies(F.col("d"))).collect()] == [["USD", "KRW"], [], []]


def test_market_assessment(spark):
    probe = lambda context="default", url="https://s.example/", currency="USD", n=1, countries=(), status="ok": (context, url, currency, n, list(countries), status)
    krw = lambda **x: probe(**({"context": "localized_url", "currency": "KRW"} | x))
    cases = [
        (([probe()], "kr"), ("eligible_origin", "supported", "unknown", None, None, None)), (([probe(), krw(url="https://s.example/kr/")], "US"), ("eligible_storefront", "supported", "unknown", "KRW", "https://s.example/kr/", None)), (([probe(), krw(context="shopify_market")], None), ("eligible_storefront", "supported", "unknown", "KRW", "https://s.example/", None)),
        (([krw()], "US"), ("price_only", "unknown", "unknown", "KRW", "https://s.example/", None)), (([krw(url="https://s.example/kr", countries=("US", "JP"))], "US"), ("price_only", "supported", "unsupported", "KRW", "https://s.example/kr", None)), (([krw(countries=("KR",))], "US"), ("eligible_storefront", "supported", "supported", "KRW", "https://s.example/", None)),
        (([probe(countries=("US", "JP"))], "US"), ("unsupported", "unsupported", "unsupported", "USD", None, None)), (([probe(countries=("US",))], "US"), ("inconclusive", "unknown", "unknown", "USD", None, 24)), (([probe(status="network_error"), probe(status="network_error")], "US"), ("retryable_error", "unknown", "unknown", None, None, 24)), (([], "US"), ("inconclusive", "unknown", "unknown", None, None, 24)), ((None, None), ("inconclusive", "unknown", "unknown", None, None, 24)),
        (([krw(n=0)], "US"), ("inconclusive", "unknown", "unknown", None, None, 24)),
    ]
    df = spark.createDataFrame([(k, *c) for k, (c, _) in enumerate(cases)], f"k long, p array<{market.PROBE}>, o string")
    got = [tuple(r.a) for r in df.select("k", market.assess_market(F.col("p"), F.col("o")).alias("a")).orderBy("k").collect()]
    assert got == [w for _, w in cases]
