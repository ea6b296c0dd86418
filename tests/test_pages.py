"""Pages as trees, and what selectors, detail rules, review parsers and structured data read from them."""

import json
import time

import pytest
from loomcat.sources import page_tree as T
from loomcat.sources import registry
from loomcat.sources.details import DETAILS, page_details
from loomcat.sources.reviews import board_reviews, first_useful, inline_reviews, no_reviews
from loomcat.sources.structured_data import with_structured_product
from pyspark.sql import functions as F


def tree(df):
    return df.withColumn("tree", T.page_tree(F.col("html")))


def shown(html):
    return T.read_tree(html)[0]


def test_what_a_page_shows():
    assert shown("<html><head><title>t</title><style>x</style></head><body> a  <b>b</b>c<p>d<p>e<br>f &amp; g<script>no()</script></body>") == "a bc\nd\ne\nf & g"
    assert shown("<table><tr><td>BRAND<td>x</tr><tr><td>y</td></tr></table>z") == "BRAND\tx\ny\nz"
    assert shown("<ul><li>a<li>b</ul><noscript>n</noscript>") == "a\nb" and shown(None) == shown("") == "" and shown("plain") == "plain"


def test_elements_know_their_places():
    text, nodes, data = T.read_tree('<div id=a class="x y"><p>one<p>two <b>three</b></div><p hidden>four<script type="application/LD+json">{"a": "<b>"}</script>')
    by = [(n["tag"], n["parent"], n["last"], n["place"], text[n["begin"] : n["end"]].strip()) for n in nodes]
    assert by == [("div", -1, 3, 1, "one\ntwo three"), ("p", 0, 1, 1, "one"), ("p", 0, 3, 2, "two three"), ("b", 2, 3, 1, "three"), ("p", -1, 5, 2, "four"), ("script", 4, 5, 1, "")]
    assert nodes[0]["classes"] == ["x", "y"] and nodes[4]["attributes"] == [{"name": "hidden", "value": ""}] and data == ['{"a": "<b>"}']
    first, second = (T.read_tree(f"<ul><li class='b a'><i>{x}</i></li><li class='a b'><i>y</i></li></ul>")[1] for x in "xy")
    assert first[1]["shape"] == first[3]["shape"] == second[1]["shape"] != first[0]["shape"]


def test_trees_take_linear_time():
    for piece in ("<div>x", "<p>x<b>", "<li>", "<td><p>", "</p><div>", "<table><p><td><div>", "<a href=x>", "<!-- ", "<"):
        begin = time.time()
        T.read_tree(piece * 20_000)
        assert time.time() - begin < 8, piece


PAGE = """<body><div class="card big" data-id="7"><h2>One</h2><span>a</span></div><div class="card"><h2>Two</h2><ul><li>x</li><li class="last">y</li></ul></div>
<section id="s"><div class="card"><p>deep</p><a href="/article/9">go</a></div></section></body>"""


@pytest.mark.parametrize(
    ("selector", "texts"),
    [
        (".card h2", ["One", "Two"]), ("div.card.big > h2", ["One"]), ("body > h2", []), ("#s .card p", ["deep"]), ("li:first-child", ["x"]), ("li:nth-child(2), h2", ["One", "Two", "y"]), ("[data-id]", ["One\na"]), ('div[data-id="7"] span', ["a"]),
        ("a[href*='/article/']", ["go"]), ("a[href^=/art]", ["go"]), ("a[href$='8']", []), ("section *", ["deep\ngo", "deep", "go"]), ("ul>li.last", ["y"]), ("SECTION  .card", ["deep\ngo"]),
    ],
)
def test_selectors(spark, selector, texts):
    page = T.Page(F.col("tree"))
    df = tree(spark.createDataFrame([(PAGE,)], "html string"))
    assert df.select(F.transform(T.select(page.nodes, selector), lambda i: page.text(page.node(i)))).first()[0] == texts


def test_selectors_within_and_repeated(spark):
    page = T.Page(F.col("tree"))
    df = tree(spark.createDataFrame([(1, PAGE), (2, "<p>x"), (3, None), (4, "<ul>" + "".join(f"<li><b>{k}</b><i>x</i></li>" for k in range(4)) + "</ul><p><b>1</b></p><p><b>2</b></p>")], "k int, html string"))
    within = df.select(page.text_of("h2", page.first("div.card", nth=1)), page.text_of("nothing"), page.attribute(page.first("div"), "data-id"), F.size(T.select(page.nodes, "li", page.first("section")))).collect()
    assert tuple(within[0]) == ("Two", None, "7", 0)
    repeated = {r.k: r.v for r in df.select("k", F.transform(page.repeated(), lambda i: page.text(page.node(i))).alias("v")).collect()}
    assert repeated[4] == ["0x", "1x", "2x", "3x"] and repeated[2] == [] and repeated[3] == [] and repeated[1] == []


@pytest.mark.parametrize("selector", ["", "div >", "a[", "::before", "a,,b"])
def test_selectors_that_are_none(selector):
    with pytest.raises(ValueError):
        T.parse_selector(selector)


ADDITIONAL = '<div class="xans-product-additional">{}</div>'
SITES = {
    "8division": ("<div class='product-addinfo'>공지 5% Silk 제품정보 60% Wool, 40% Nylon 의 코트 배송 및 교환 3% Silk 매장 이용안내 x</div>", "60% Wool, 40% Nylon", None),
    "adekuver": ("<div class='item open'><div class='content'>Soft shirt - 100% CO - relaxed ABC123 X1 ABC12345</div></div>", "100% CO", "ABC123, ABC12345"),
    "anotheroffice": ("<div class='ec-base-tab'>a</div><div class='ec-base-tab'>교환 및 반품정보 제조국 : 한국 겉감 Cotton 95%, Poly 5% 드라이 크리닝</div>", "Cotton 95%, Poly 5%", None),
    "bastong": (ADDITIONAL.format("정보<br>겉감 : 면 100%<br>안감 : 면"), "면 100%", None),
    "blankroom": ("<div class='prd_code'>품번 : BK-1</div><div class='product-description'>A knit. Material : Wool 80%, Nylon 20% 으로 made</div>", "Wool 80%, Nylon 20%", "BK-1"),
    "chanceclothing": (ADDITIONAL.format("소재 Cotton 100% 원산지 KR<br>브랜드 품번 : CC-9"), "Cotton 100%", "CC-9"),
    "eastlogue": (ADDITIONAL.format("text - Outshell_1 : 100% Cotton - Lining : 100% Poly - other"), "Outshell_1 : 100% Cotton / Lining : 100% Poly", None),
    "etcseoul": ("<p>NEW</p><div>[MATERIAL]</div><div>Cotton 100%</div><div>[SIZE]</div>", "Cotton 100%", None),
    "fr8ight": ("<div class='xans-product-additional in description'>Tee - heavy - 100% Cotton knit - x</div>", "100% Cotton knit", None),
    "havati": ("<div>OUTSHELL : Nylon 100%</div><div>Shell</div><div>LINING: Poly 100%</div>", "OUTSHELL : Nylon 100%\nLINING: Poly 100%", None),
    "roughside": ("<ul class='prd-detail-desc-list'><li>Fit: loose</li><li>겉감 : 면 100%</li><li>Lining: 면</li></ul>", "겉감 : 면 100% / Lining: 면", None),
    "sculpstore": ("<p>혼용률 : Wool 70%, Nylon 30%</p><p>Code</p><p>SC-1</p>", "Wool 70%, Nylon 30%", "SC-1"),
    "shopamomento": (ADDITIONAL.format("Composition <br> Linen 100% Size Measurement 1"), "Linen 100%", None),
    "sienneboutique": ("<div class='tabs-content'>x</div><div class='tabs-content'>FABRIC * Shell: Poly 92% Care Guide wash</div>", "Shell: Poly 92%", None),
    "slowsteadyclub": (ADDITIONAL.format("소재 겉감 - 면 100% 안감 - 면 사이즈 M 상세설명 y"), "겉감 - 면 100% 안감 - 면", None),
    "swallowlounge": ("<ul><li data-name='color'><div>red</div></li><li data-name='material'><div> 면 100% </div></li></ul>", "면 100%", None),
    "takeastreet": ("<div class='detail_left'>A coat 컬러 : 블랙 Shell : Nylon 100% MODEL SIZE 180</div>", "Shell : Nylon 100%", None),
    "triplestore": (ADDITIONAL.format("원단<br>Cotton 60%<br>ab<br>Nylon 40%<br>more text"), "Cotton 60% / Nylon 40%", None),
    "visualaid": ("<div class='tab_wrap'>Fabric: none. A tee of Cotton 100% and more</div>", "Cotton 100%", None),
    "emis": ("<div><div class='accordion-list'><div class='accordion-content'>Fabric Cotton 100%, soft</div></div></div>", "Cotton 100%", None),
    "ojos": ("<div id='prdDetail'>too short</div><div class='detail_cont'>Soft skirt, 소재: 면 100% / 실크 5%</div>", "면 100% / 실크 5%", None),
    "unknown": ("<div class='cont_detail'>A coat without any composition</div><div class='product_code'>X 9</div>", None, "X 9"),
}


def test_details_of_sites(spark):
    assert set(SITES) - {"unknown"} >= set(DETAILS.keys()) - {"goyowear", "taats"}
    rows = [(site, page) for site, (page, _, _) in SITES.items()] + [(site, None) for site in ("eastlogue", "ojos")] + [(None, SITES["ojos"][0])]
    out = tree(spark.createDataFrame(rows, "site string, html string")).select("site", page_details(F.col("tree"), F.col("site")).alias("d"))
    got = [(r.site, r.d.material, r.d.product_code) for r in out.collect()]
    wanted = [(site, m, c) for site, (_, m, c) in SITES.items()] + [("eastlogue", None, None), ("ojos", None, None), (None, *SITES["ojos"][1:])]
    assert got == wanted


def test_long_sections_are_read_whole(spark):
    page = ADDITIONAL.format("filler words " * 20_000 + " 소재 Cotton 100% 원산지 KR")
    row = tree(spark.createDataFrame([("slowsteadyclub", page)], "site string, html string")).select(page_details(F.col("tree"), F.col("site")).alias("d")).first()
    assert row.d.material == "Cotton 100%"


def review_pages():
    shop = "https://shop.example"
    row = lambda k, link: f"<tr><td>{k}</td><td class='rwriter'><b class='name'>u{k}</b> on 2024-01-0{k}</td><td><p class='comment'>{link}</p><img src='https://i/review{k}.jpg'><img src='/review.jpg'></td></tr>"
    link = lambda k: f"<a href='/article/{k}'>short {k}</a>"
    return {
        f"{shop}/a": "<a href='/x'>Reviews of all</a><a href='/board/product/list.html?board_no=4&link_product_no=1'>Review 3</a>",
        f"{shop}/board/product/list.html?board_no=4&link_product_no=1": "<table><tr><td>a</td><td>b</td></tr>" + row(1, link(1)) + row(2, link(2)) + row(3, "just  text") + "</table>",
        f"{shop}/article/1": "<body>height: 171cm<div class='view-content'>a much longer text of review one</div></body>",
        f"{shop}/b": "<a href='/board/product/write.html?board_no=4&product_no=2'>WRITE</a><a href='/shop/board'>후기 0</a>",
        f"{shop}/shop/board": "<table></table>",
        f"{shop}/c": "<a href='/article/review/1'>r</a><a href='/article/review/1'>again</a><a href='/article/review/2'>r</a><a href='/article/review/3'>r</a>",
        f"{shop}/article/review/1": "<div class='board_view_info'><i class='name'>Ann</i> 2024-02-02</div><div class='fr-view'>weight 55kg, fits <img src='https://i/1.jpg'><img src='https://i/1.jpg'></div>",
        f"{shop}/article/review/2": "<div class='fr-view'>ok</div>",
        f"{shop}/d": "<p>nothing</p>",
    }


def test_reviews(spark):
    pages = spark.createDataFrame(list(review_pages().items()), "url string, html string")
    products = spark.createDataFrame([(f"https://shop.example/{k}",) for k in "abcde"], "url string")
    short = lambda url: url.removeprefix("https://shop.example/")
    listed = lambda r: sorted((short(x.url), x.place, x.author, x.date, x.text, x.photos, x.body and (x.body.height, x.body.weight)) for x in r.reviews.collect())
    totals = lambda r: {short(x.url): (x.review_count, x.status, x.confirmed_empty, x.error) for x in r.collections.collect()}
    board = board_reviews(products, pages, 10)
    photo = lambda k: [f"https://i/review{k}.jpg"]
    rows = [("a", 0, "u1", "2024-01-01", "a much longer text of review one", photo(1), ("171cm", None)), ("a", 1, "u2", "2024-01-02", "short 2", photo(2), None), ("a", 2, "u3", "2024-01-03", "just text", photo(3), None)]
    assert listed(board) == rows
    none = (0, "failed", False, "review board source not found")
    assert totals(board) == {"a": (3, "partial", False, "1 review detail(s) failed"), "b": (0, "succeeded", True, None), "c": none, "d": none, "e": none}
    inline = inline_reviews(products, pages, 3)
    assert listed(inline) == [("c", 0, "Ann", "2024-02-02", "weight 55kg, fits", ["https://i/1.jpg"], (None, "55kg"))]
    assert totals(inline)["c"] == (1, "partial", False, "1 inline review detail(s) failed") and totals(inline)["a"] == (0, "failed", False, "inline review source not found")
    best = first_useful(board, inline)
    assert listed(best) == rows + listed(inline)
    assert totals(best)["c"] == totals(inline)["c"] and totals(best)["b"] == (0, "succeeded", True, None) and totals(best)["d"] == (0, "failed", False, "review board source not found; inline review source not found")
    assert totals(first_useful(no_reviews(products), board))["a"] == (0, "not_requested", False, None)
    assert board_reviews(products, pages, 2).reviews.count() == 2 and totals(board_reviews(products.limit(0), pages, 2)) == {}


URL = "https://shop.example/products/a"
PRODUCT = {"@type": "Product", "name": " Coat ", "offers": {"price": "1,299.00", "priceCurrency": "USD", "availability": "https://schema.org/InStock"}, "image": ["/a.jpg", {"url": "https://x/b.jpg"}, "ftp://x"], "brand": {"name": "B"}, "sku": "S1", "description": "<b>x</b> &amp; y"}
COAT = ("Coat", "x & y", "B", 1299.0, "USD", ["https://shop.example/a.jpg", "https://x/b.jpg"], True, None, "S1", None)


def ld(x):
    return f'<script type="application/ld+json">{x if isinstance(x, str) else json.dumps(x)}</script>'


def og(**tags):
    return "".join(f'<meta property="{k.replace("__", ":")}" content="{v}">' for k, v in tags.items())


GRAPH = og(og__type="product", og__title="T", og__image="/o.jpg", product__price__amount="12.5", product__price__currency="EUR", product__availability="sold out")
STRUCTURED = {
    "one": (ld(PRODUCT), (*COAT, "jsonld")),
    "below a page in a graph": (ld({"@graph": [{"@type": "WebPage", "mainEntity": PRODUCT}]}), (*COAT, "jsonld")),
    "the one of this page": (ld({"itemListElement": [{"item": PRODUCT | {"name": "other", "url": "https://shop.example/products/b"}}, {"item": PRODUCT | {"url": URL}}]}), (*COAT[:-1], URL, "jsonld")),
    "two of any page": (ld([PRODUCT, PRODUCT]), None),
    "of another page": (ld(PRODUCT | {"url": "https://shop.example/products/b"}), None),
    "six steps down": (ld([[[[[[PRODUCT]]]]]]), (*COAT, "jsonld")),
    "seven steps down": (ld([[[[[[[PRODUCT]]]]]]]), None),
    "broken, but for a comma": (ld('{"@type": "product", "name": "N",} <!-- x -->'), ("N", None, None, None, None, [], None, None, None, None, "jsonld")),
    "broken": (ld("{") + ld(PRODUCT), (*COAT, "jsonld")),
    "offers of several kinds": (ld({"@type": ["Thing", "Product"], "name": 5, "productID": "P", "offers": [{"@type": "Offer"}, {"@type": "AggregateOffer", "lowPrice": 5, "priceCurrency": "KRW", "offers": [{"availability": "SoldOut"}]}]}), (None, None, None, 5.0, "KRW", [], False, None, "P", None, "jsonld")),
    "tags": (GRAPH, ("T", None, None, 12.5, "EUR", ["https://shop.example/o.jpg"], False, None, None, None, "og")),
    "both": (GRAPH + ld({"@type": "Product", "name": "N"}), ("N", None, None, 12.5, "EUR", ["https://shop.example/o.jpg"], False, None, None, None, "merged")),
    "tags of another page": (GRAPH + og(og__url="https://shop.example/products/b"), None),
    "the last block of tags": (og(og__type="website", og__title="Shop", og__image="/s.jpg") + GRAPH, ("T", None, None, 12.5, "EUR", ["https://shop.example/o.jpg"], False, None, None, None, "og")),
    "tags after the image begin a block": (og(og__url="https://shop.example/", og__title="Shop", og__image="/s.jpg", og__type="product") + og(og__url=URL, og__title="T", product__price__amount="3"), ("T", None, None, 3.0, None, [], None, None, None, URL, "og")),
    "tags of no product": (og(og__type="website", og__title="T"), None),
    "neither": ("<p>x", None),
    "no page": (None, None),
}


def test_structured_products(spark):
    df = tree(spark.createDataFrame([(k, page, URL) for k, (page, _) in STRUCTURED.items()], "k string, html string, url string"))
    got = {r.k: r["product"] and tuple(r["product"]) for r in with_structured_product(df, "tree", "url").select("k", "product").collect()}
    assert {k: (got[k], wanted) for k, (_, wanted) in STRUCTURED.items() if got[k] != wanted} == {}


def test_payloads_of_any_depth(spark):
    texts = ['{"a": [1, -2.5e3, "x\\n\\u00e9", null, true, {"b": {}}], "c": []}', "[]", '" s "', " 7 ", '{"a": 1, "a": 2}', "[[], [[]]]", '{"": false}']
    for text in texts:
        assert registry.deep_json(text) == json.loads(text)
    for text in ("", "[", "[1,]", '{"a"}', '{"a": }', "[1 2]", "1 2", "{1: 2}", '["a"', "]", '{"a": 1,}', "nul", "[01]", '"x', ","):
        with pytest.raises(ValueError):
            registry.deep_json(text)
    item = '{"id": 1, "name": "n", "price": 2, "seo": [{"id": "x", "name": "m", "price": 3.5}]}'
    deep = [(k, "[" * k + '{"a":' * k + item + "}" * k + "]" * k) for k in (1, 5_000, 100_000)]
    df = spark.createDataFrame([*deep, (2, "{"), (3, None), (4, "[" * 50_000)], "k long, p string")
    wanted = [x for k, _ in deep for x in ((k, "1", "n", 2.0), (k, "x", "m", 3.5))]
    assert sorted(map(tuple, registry.payload_objects(df, "k", "p").collect())) == wanted
