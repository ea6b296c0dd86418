"""Entries of listings against cases worked out by hand."""

import json

from loomcat.sources import listings as L
from pyspark.sql import functions as F


def short(e, *names):
    return None if e is None else tuple(e[n] for n in names)


def test_catalogue_items(spark):
    img = "https://image.shop.example/"
    items = [
        {"productId": "E1", "name": "Tee", "genderName": "WOMEN", "genderCategory": "w/tops", "prices": {"base": {"value": 29.9}, "promo": {"value": 19.9}}, "representative": {"sales": False, "color": {"displayCode": "09"}}, "sizes": [{"name": "S"}, {"name": ""}, {"name": "M"}],
         "images": {"main": {"30": {"image": img + "30"}, "09": {"image": img + "09"}, "9": {"image": img + "9"}, "x": {"image": "https://evil.example/x"}}, "sub": [{"image": img + "s"}, {"image": img + "30"}, {"image": None}]}},
        {"productId": "E2", "name": "Cap", "prices": {"base": {"value": 10}, "promo": {"value": 10}}}, {"productId": "E3"}, {"name": "no id"},
    ]
    df = spark.createDataFrame([(json.dumps({"result": {"items": items}}),), ("{",), (None,)], "p string")
    got = [r.e for r in df.select(F.explode(L.catalogue_items(F.col("p"), "https://shop.example/kr", "Brand", "KRW", ("image.shop.example",))).alias("e")).collect()]
    names = ("product_code", "price", "original_price", "sale_price", "state", "in_stock", "size_info", "gender")
    assert [short(e, *names) for e in got] == [("E1", 19.9, 29.9, 19.9, "sale", False, "S, M", ["women"]), ("E2", 10.0, 10.0, None, "regular", True, None, []), ("E3", None, None, None, "unknown", True, None, [])]
    assert got[0].images == [img + "09", img + "9", img + "30", img + "s"] and got[0].product_url == "https://shop.example/kr/products/E1" and got[2].name == ""


def test_widgets(spark):
    rows = [({"name": " Knit ", "code": "C1", "original_price": 46000, "price": 27599.99, "image_url": "https://i/1.jpg"}, "https://s/1", False), ({"name": "Bag", "original_price": "45,000원", "image_url": "/x"}, "https://s/2", True), ({"name": "Hat", "price": 0, "original_price": 0}, "https://s/3", False), ({"name": " ", "price": 5}, "https://s/4", None), ({"name": "Cap", "price": 5}, None, None)]
    df = spark.createDataFrame([(json.dumps(p), link, out) for p, link, out in rows] + [(None, "https://s", None)], "p string, link string, out boolean")
    got = [short(r.e, "brand", "name", "price", "original_price", "sale_price", "state", "in_stock", "images", "product_code") for r in df.select(L.widget_entry(F.col("p"), F.col("link"), F.col("out"), "House").alias("e")).collect()]
    assert got == [("House", "Knit", 27600.0, 46000.0, 27600.0, "sale", True, ["https://i/1.jpg"], "C1"), ("House", "Bag", 45000.0, 45000.0, None, "regular", False, [], None), None, None, None, None]


def test_two_versions_of_a_shop(spark):
    first = [
        {"id": 7, "name": "Ring ", "address": "ring", "thumbnails": ["", "/uploadedFiles/a.jpg"], "price": {"regularPrice": 100, "currency": "USD", "groupByGradeId": {"-1": {"salesPrice": 80}, "-2": {"salesPrice": 70}}}}, {"id": 8, "name": "Belt", "address": "belt", "soldOut": True, "thumbnails": ["/b.jpg"], "price": {"regularPrice": 100, "currency": "won", "groupByGradeId": {"-1": {"salesPrice": 120}}}},
        {"name": "x", "address": "x", "price": {"regularPrice": 0}}, {"name": "", "address": "x", "price": {"regularPrice": 5}},
    ]
    second = [{"name": "Ring", "slug": "ring", "managementCode": "M", "price": {"original": 100, "sale": 90}, "images": [{"url": " https://i/1 "}, {"url": ""}, {}]}, {"name": "Cap", "slug": "cap", "availability": "out-of-stock", "price": {"original": 10, "sale": 0}}, {"name": "Cap", "price": {"original": 10}}]
    names = ("product_url", "product_code", "price", "original_price", "sale_price", "currency", "in_stock", "images")
    df = spark.createDataFrame([(json.dumps(r),) for r in first], "p string")
    got = [short(r.e, *names) for r in df.select(L.graded_entry(F.col("p"), "https://s.example", "House").alias("e")).collect()]
    assert got == [("https://s.example/product/ring", "7", 70.0, 100.0, 70.0, "USD", True, ["https://contents.sixshop.com/uploadedFiles/a.jpg"]), ("https://s.example/product/belt", "8", 100.0, 100.0, None, "KRW", False, ["https://s.example/b.jpg"]), None, None]
    df = spark.createDataFrame([(json.dumps(r),) for r in second], "p string")
    got = [short(r.e, *names) for r in df.select(L.slugged_entry(F.col("p"), "https://s.example", "House").alias("e")).collect()]
    assert got == [("https://s.example/products/ring", "M", 90.0, 100.0, 90.0, "KRW", True, ["https://i/1"]), ("https://s.example/products/cap", None, 10.0, 10.0, None, "KRW", False, []), None]


def test_cards(spark):
    url, image = "https://www.mall.example/kr/x-item-123.aspx", "https://cdn.mall.example/1.jpg"
    rows = [(url, "B", "Coat", "₩1,050,000 ₩630,000", image), (url, "B", "Coat", "₩630,000", image), (url, "B", "Coat", "₩500", image), (url, "B", "Coat", "free", image), (url, None, "Coat", "₩5,000", image), ("https://evil.example/a-item-1.aspx", "B", "Coat", "₩5,000", image), ("https://www.mall.example/kr/x", "B", "Coat", "₩5,000", image), (url, "B", "Coat", "₩5,000", "https://evil.example/1.jpg"), (url, "B", "Coat", "₩5,000 ₩9,000", image)]
    df = spark.createDataFrame(rows, "href string, brand string, name string, price_text string, image_url string")
    card = F.struct(*df.columns)
    got = [short(r.e, "price", "original_price", "sale_price", "state", "product_code") for r in df.select(L.card_entry(card, "KRW", ("mall.example",), ("cdn.mall.example",)).alias("e")).collect()]
    assert got == [(630000.0, 1050000.0, 630000.0, "sale", "123"), (630000.0, 630000.0, None, "regular", "123"), None, None, None, None, None, None, (9000.0, 9000.0, None, "regular", "123")]
    assert spark.range(1).select(L.card_amounts(F.lit("was $ 1,200.50 now $9 or $0"), "USD")).first()[0] == [1200.5, 9.0]
