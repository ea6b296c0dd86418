"""Steps that must grow no faster than their input, and hold no more than a bounded part of it at once."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomcat.catalogue_queries import ORACLES, QUERIES
from loomcat.functions.numbers import least_above
from loomcat.shipping import ship
from loomcat.sources import page_tree as T

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_recovery_broadcasts_no_products(spark):
    for name in ("c11_recovery_actions", "c4_recovery", "c3_audit_manifest"):
        assert "BroadcastHashJoin [id" not in plan(QUERIES[name](spark, SMALL)), name
        assert "BroadcastHashJoin [product_id" not in plan(QUERIES[name](spark, SMALL)), name


PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@pytest.fixture(scope="module")
def odd_parts(spark, tmp_path_factory):
    """Many parts of few names, some without brand, name, size or price, prices at the very distance and next to it."""
    folder, at = tmp_path_factory.mktemp("parts"), random.Random(3)
    prices = [900.1, 950.1, math.nextafter(950.1, 0), math.nextafter(950.1, 999), -0.0, 0.0, 50.0, -49.99, 0.01, 1e18, math.nan, None]
    rows = [(k, at.choice(["a", "b", None]), at.choice(["x", "y", None]), at.choice(["s", "t"]), at.choice([1, 2, 6, 7, 8, 9, None]), at.choice(prices)) for k in range(600)]
    spark.createDataFrame(rows, PART).write.parquet(f"file://{folder}/part.parquet")
    return folder


def by_sql(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{folder}/part.parquet/*.parquet'")
    return sorted(con.execute(ORACLES[name]).fetchall())


def test_cross_shop_job_makes_no_pairs(spark, odd_parts):
    df = QUERIES["c6_cross_shop_job"](spark, f"file://{odd_parts}")
    assert sorted(map(tuple, df.collect())) == by_sql(odd_parts, "c6_cross_shop_job")
    assert "MergeJoin" not in plan(df) and "HashJoin" not in plan(df)


def test_decision_cascade_makes_no_pairs(spark, odd_parts):
    df = QUERIES["j6_decision_cascade"](spark, f"file://{odd_parts}")
    assert sorted(map(tuple, df.collect())) == by_sql(odd_parts, "j6_decision_cascade")
    assert "Join [name" not in plan(df)


def test_least_above_is_exact():
    values = np.array([900.1, 0.1, -49.99, -50.0, -0.0, 1e15, 1e300, *np.random.default_rng(5).uniform(-100, 1000, 2000)])
    ends = least_above(values, 50.0)
    assert (ends - values >= 50).all() and not (np.nextafter(ends, -np.inf) - values >= 50).any()


def test_lookup_meets_a_key_once(spark):
    found = plan(QUERIES["j8_unique_match"](spark, SMALL))
    assert "HashAggregate(keys=[_key" in found


def test_references_that_are_cut_off(spark):
    ship(spark)
    html = '<!-- <script>&amp --><h1 title="a&copy=1&lt;">x &amp;&#65; y&amp</h1><script type="application/ld+json">{"a": "&amp"}</script> & &nbsp'
    df = spark.createDataFrame([(html,), (None,)], "html string")
    cut, browsers = (df.select(T.page_tree(F.col("html"), closed=closed).alias("t")).first()["t"] for closed in (True, False))
    assert (cut["text"], browsers["text"].split("\n")[0]) == ("x &A y&amp\n& &nbsp", "x &A y&")
    assert cut["nodes"][0]["attributes"][0]["value"] == "a&copy=1<" and cut["data"] == browsers["data"] == ['{"a": "&amp"}']


def test_boxes_of_small_and_large_images(spark, monkeypatch):
    from loomcat.operators import images

    at = random.Random(7)
    rows = [(k % 3 + 3 * (k % 29 > 0), at.choice([*range(40), None]), at.random(), x := at.choice([0.0, 5.0, *range(20)]) * 1.0, 0.0, x + at.choice([0.0, 7.0, 10.0]), 10.0) for k in range(400)]
    df = spark.createDataFrame(rows, "image long, box long, score double, x0 double, y0 double, x1 double, y1 double").filter("box is not null")
    found = []
    for few in (0, 64, 1000):
        monkeypatch.setattr(images, "FEW", few)
        found.append([sorted(map(tuple, f(df, "image", 0.5).collect())) for f in (images.overlap_counts, images.suppress)])
    assert found[0] == found[1] == found[2] and found[0][0]


def test_pages_are_read_in_slices():
    import pyarrow as pa

    page = "<ul>" + "<li class='a b' id=x>y</li>" * 1000 + "</ul>"
    slices = list(T.read_slices(pa.array([page, None, ""] * 40)))
    assert len(slices) > 4 and sum(map(len, slices)) == 120 and max(map(len, slices)) <= 3 * (T.SLICE // len(page) + 2)
    text, nodes, data = T.read_tree(page)
    assert pa.concat_arrays(slices).to_pylist() == [{"text": text, "nodes": nodes, "data": data}, *[{"text": "", "nodes": [], "data": []}] * 2] * 40


def test_reviews_read_only_pages_that_are_asked_for(spark, monkeypatch):
    from loomcat.sources import reviews as R

    refuse = lambda html: F.when(F.contains(html, F.lit("unasked")), F.raise_error(F.lit("read"))).otherwise(html)
    monkeypatch.setattr(R, "page_tree", lambda html: T.page_tree(refuse(html)))
    at = "https://shop.example/"
    board = '<table><tr><td>1</td><td class="writer"><span class="name">u</span></td><td><div class="comment"><a href="/article/1">a word</a></div></td></tr></table>'
    html = {"p": '<a href="/board/product/list.html?link_product_no=1">Review (1)</a><a href="/article/review/2">x</a>', "board/product/list.html?link_product_no=1": board, "article/1": '<div class="board_content">many more words</div>', "article/review/2": '<div class="board_content">inline</div>', "q": "unasked"}
    pages = spark.createDataFrame([(at + k, v) for k, v in html.items()], "url string, html string")
    products = spark.createDataFrame([(f"{at}p",), (f"{at}gone",)], "url string")
    board, inline = R.board_reviews(products, pages, 9), R.inline_reviews(products, pages, 9)
    assert [r.text for r in board.reviews.collect()] == ["many more words"] and [r.text for r in inline.reviews.collect()] == ["inline"]
    assert sorted(r.status for r in board.collections.collect()) == ["failed", "succeeded"]


def test_payloads_of_small_and_large_products(spark):
    from loomcat.sources import payloads

    rows = [(1, 64 * k, 1, 5.0 + k) for k in range(1024)] + [(2, 40 * k, 16 * (k % 3), 9.0) for k in range(1025)] + [(None, 64 * k, 1, 3.0) for k in range(40)]
    df = spark.createDataFrame(rows, "p long, o long, l int, price double")
    variant = F.struct(F.lit(10.0).alias("compare_at_price"), "price", F.lit(True).alias("available"))
    raw = payloads.shopify_payloads(df, "p", "o", "l", variant)
    held = {(r.p, r.n) for r in raw.select("p", F.size(F.from_json("payload", payloads.VARIANTS)["variants"]).alias("n")).collect()}
    assert raw.filter("p = 1").count() == 1 and (1, 1024) in held and raw.filter("p = 2").count() > 600 and max(n for _, n in held) == 1024
    found = payloads.shopify_variants(raw, "p", "payload")
    assert set(map(tuple, found.collect())) == {(1, 5.0, 1024, True), (2, 9.0, 1025, True), (None, 3.0, 40, True)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_small_images_are_shuffled_once(spark):
    from loomcat.operators import images

    df = spark.range(200).select(F.floor(F.col("id") / 3).alias("image"), F.col("id").alias("box"), F.rand(1).alias("score"), *[F.lit(v).alias(k) for k, v in (("x0", 0.0), ("y0", 0.0), ("x1", 9.0), ("y1", 9.0))])
    found = images.suppress(df, "image", 0.5)
    assert plan(found).count("Exchange hashpartitioning(image") == 1 and found.count() == 67
