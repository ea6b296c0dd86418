"""Ladders and price texts against cases worked out by hand."""

import json
import random

import pytest
from loomcat.functions.text import ascii_word
from loomcat.operators.category import Taxonomy, by_source, resolve_category, resolve_subcategory
from loomcat.operators.gender import SiteRules, clean_genders, resolve_gender
from loomcat.rules import Rule, all_matches, first_match, unique_match
from loomcat.sources import price_text, shopify
from loomcat.vocabulary import Entry, Vocabulary
from pyspark.sql import functions as F

KINDS = "k long, gender array<string>, gender_source string, name string, category string, subcategory string, tags array<string>, product_url string, scope array<string>"
U = "https://shop.example/p/1"


def resolved(spark, cases, rules=SiteRules()):
    rows = []
    for k, c in enumerate(cases):
        rows.append((k, c.get("gender"), c.get("source", "engine"), c.get("name"), c.get("category"), None, c.get("tags"), c.get("url", U), c.get("scope")))
    df = spark.createDataFrame(rows, KINDS)
    got = resolve_gender(df, brand_scope="scope", rules=rules).collect()
    return [(r.resolved_gender, r.resolved_source, r.gender_conflict) for r in sorted(got, key=lambda r: r.k)]


def test_gender_ladder(spark):
    nobody, conflict = (None, None, False), (None, None, True)
    cases = {
        "stated": ({"gender": ["Men "], "name": "Shirt"}, ("men", "engine", False)),
        "stated, but the name says for whom": ({"gender": ["men"], "name": "Coat (Women's)"}, ("women", "text", False)),
        "a loose style name changes nothing": ({"gender": ["women"], "name": "Men's Tee"}, ("women", "engine", False)),
        "label against address": ({"gender": ["men"], "name": "Coat for women", "url": "https://s.example/men/coat"}, conflict),
        "label for both": ({"gender": ["men"], "name": "For men, for women"}, ("men", "engine", False)),
        "two stated count as none": ({"gender": ["men", "women"], "name": "Shirt"}, nobody),
        "address": ({"name": "Shirt", "url": "https://s.example/women/shirt"}, ("women", "url", False)),
        "encoded address": ({"name": "Shirt", "url": "https://s.example/f%C3%A9mme/1"}, ("women", "url", False)),
        "host does not count": ({"name": "Shirt", "url": "https://women.example/shirt"}, nobody),
        "query counts": ({"name": "Shirt", "url": "https://s.example/shirt?dep=mens"}, ("men", "url", False)),
        "address against text": ({"name": "Men shirt", "url": "https://s.example/women/shirt"}, conflict),
        "address against text, unisex stated": ({"gender": ["unisex"], "name": "Men shirt", "url": "https://s.example/women/shirt"}, ("unisex", "engine", False)),
        "definite address over unisex text": ({"name": "Shirt unisex", "url": "https://s.example/women/shirt"}, ("women", "url", False)),
        "definite text over unisex address": ({"name": "Women shirt", "url": "https://s.example/unisex/shirt"}, ("women", "text", False)),
        "definite text over unisex stated": ({"gender": ["unisex"], "name": "MEN'S jasper"}, ("men", "text", False)),
        "unisex stated": ({"gender": ["unisex"], "name": "Shirt"}, ("unisex", "engine", False)),
        "korean without borders": ({"name": "여성코트"}, ("women", "text", False)),
        "marks are stripped": ({"name": "Robe fémme"}, ("women", "text", False)),
        "parts of words do not count": ({"name": "Womenswear mention garment"}, nobody),
        "both and unisex": ({"name": "unisex for men and women"}, ("unisex", "text", False)),
        "both departments in tags": ({"name": "Shirt", "tags": ["Men", "Women"]}, ("unisex", "text", False)),
        "one tag": ({"name": "Shirt", "tags": ["mens", None]}, ("men", "text", False)),
        "children": ({"gender": ["women"], "name": "Kids tee"}, nobody),
        "children, adults named": ({"name": "Women tee", "tags": ["girls"]}, ("women", "text", False)),
        "children in the address": ({"name": "Tee", "url": "https://s.example/kids/tee"}, nobody),
        "default": ({"gender": ["men"], "source": "config_default", "name": "Shirt"}, ("men", "config_default", False)),
        "default below the address": ({"gender": ["men"], "source": "config_default", "url": "https://s.example/women/1"}, ("women", "url", False)),
        "unisex default is no evidence": ({"gender": ["unisex"], "source": "config_default", "name": "Shirt", "scope": ["men"]}, nobody),
        "brand": ({"name": "Shirt", "scope": ["women"]}, ("women", "brand_scope", False)),
        "brand of both": ({"name": "Shirt", "scope": ["women", "men"]}, nobody),
        "nothing": ({}, nobody),
    }
    got = dict(zip(cases, resolved(spark, [c for c, _ in cases.values()]), strict=True))
    assert {k: (got[k], w) for k, (_, w) in cases.items() if got[k] != w} == {}


def test_site_rules(spark):
    rules = SiteRules({"men": ["homme plus"], "women": [r"\bW-line\b"]}, {"men": ["dep-m"], "women": ["dep-w"], "unisex": ["dep-x"]}, ("(?i)girls campaign",), True)
    cases = [{"name": "HOMME PLUS homme plus"}, {"name": "W-line skirt"}, {"name": "Tee", "tags": ["DEP-M1"]}, {"name": "Tee", "tags": ["dep-m", "dep-w"]}, {"gender": ["unisex"], "source": "config_default", "name": "Tee Girls Campaign"}]
    assert resolved(spark, cases, rules) == [("men", "text", False), ("women", "text", False), ("men", "text", False), ("unisex", "text", False), ("unisex", "config_default", False)]


def test_clean_genders(spark):
    df = spark.createDataFrame([([" Men", "men", "x", None, "UNISEX"],), ([],), (None,)], "g array<string>")
    assert [r[0] for r in df.select(clean_genders(F.col("g"))).collect()] == [["men", "unisex"], [], []]


def values(spark, texts, column):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return [r[1] for r in sorted(df.select("k", column(F.col("t"))).collect())]


@pytest.mark.parametrize(
    ("text", "hint", "amount"),
    [
        ("판매가 : ₩140,000", "KRW", 140000), ("할인판매가 98,000원 판매가 140,000", "KRW", 98000), ("Price: KRW 12000", "KRW", 12000), ("9,800", "KRW", 9800), ("9,800.00", "KRW", 9800), ("980", "KRW", None),
        ("1997 Pants", "KRW", None), ("$9.12", "USD", 9.12), ("12.5", "USD", 12.5), ("&#36;9", None, 9.0), ("€ 79.00", None, 79.0), ("9800", None, None), ("", "KRW", None), (None, "KRW", None), ("£0", "GBP", None),
    ],
)
def test_price_candidate(spark, text, hint, amount):
    assert values(spark, [text], lambda t: price_text.price_candidate(t, hint)) == [amount]


def test_other_price_texts(spark):
    assert values(spark, ["12 USD", "a$", "EUROPE", "5 €", "￦1", None], price_text.infer_currency) == ["USD", "USD", None, "EUR", "KRW", None]
    both = "소비자가 200,000 할인판매가 98,000"
    assert values(spark, [both], lambda t: price_text.labelled_price(t, "sale")) == [98000] and values(spark, [both], lambda t: price_text.labelled_price(t, "original")) == [200000]
    assert values(spark, ["할인판매가 98,000"], lambda t: price_text.labelled_price(t, "original")) == [None]
    assert values(spark, ["₩140,000 → ₩98,000 (10%)", "no", None], price_text.price_candidates) == [[140000.0, 98000.0], [], []]
    assert values(spark, ["$5 or $7.50"], lambda t: price_text.price_candidates(t, None)) == [[5.0, 7.5]]
    like = ["₩140,000", "140,000원", "KRW 140,000", "$9.12", "판매가 : ₩140,000", "할인판매가 : 98,000원", "9800", "10%"]
    unlike = ["HOMME PLUS 1997 Pants", "1997 Pants", "26SS Wool Coat", "", "   ", None, "1" * 81]
    assert values(spark, like + unlike, price_text.is_price_like) == [True] * len(like) + [False] * len(unlike)


def test_shopify_pages(spark):
    page = {
        "products": [
            {"title": "Shirt", "handle": "shirt", "vendor": "Acme", "product_type": "Tops", "tags": ["Womens", "t" * 120], "options": [{"name": "Colour", "position": 1}, {"name": "EU Size", "position": 2}],
             "images": [{"src": "https://cdn.shopify.com/a.jpg"}, {"src": "http://cdn.shopify.com/b.jpg"}, {"src": "https://shop.example/c.jpg"}, {"src": "https://evil.example/d.jpg"}, {"src": None}, {"src": "https://x.myshopify.com/e.jpg"}],
             "variants": [{"price": "59.90", "compare_at_price": "80.00", "available": True, "option1": "Red", "option2": "S"}, {"price": "49.90", "compare_at_price": None, "available": True, "option1": "Red", "option2": "M"}, {"price": "9.90", "compare_at_price": "80", "available": False, "option1": "Blue", "option2": "M"}]},
            {"title": "Plain", "handle": "plain", "vendor": "", "tags": [], "images": [], "variants": [{"price": "19.99", "compare_at_price": "19.99", "available": True, "option1": "Default Title"}], "options": [{"name": "Size", "position": 1}]},
            {"title": "Sold", "handle": "sold", "vendor": "A", "variants": [{"price": "5", "available": False}]},
            {"title": "Lookbook SS", "handle": "l", "vendor": "A", "variants": [{"price": "5", "available": True}]}, {"title": "Big Gift Card", "handle": "g", "vendor": "A", "variants": [{"price": "5", "available": True}]},
            {"title": "Card", "handle": "c", "vendor": "Rise.ai", "variants": [{"price": "5", "available": True}]}, {"title": "Bad", "handle": "../x", "vendor": "A", "variants": [{"price": "5", "available": True}]},
            {"title": "Free", "handle": "free", "vendor": "A", "variants": [{"price": "0.00", "available": True}]}, {"title": "Tagged", "handle": "tagged", "vendor": "A", "tags": [" HIDE "], "variants": [{"price": "5", "available": True}]},
        ]
    }
    df = spark.createDataFrame([(1, json.dumps(page)), (2, "{"), (3, None), (4, '{"products": []}')], "k long, p string")
    got = {r.handle: r for r in shopify.parse_products(df, "k", "p", "https://shop.example", excluded_tags=["hide"], brand_fallback="House").collect()}
    assert set(got) == {"shirt", "plain"}
    r = got["shirt"]
    assert (r.product_url, r.brand, r.in_stock, r.size_info) == ("https://shop.example/products/shirt", "Acme", True, "S, M")
    assert (r.pricing.price, r.pricing.original_price, r.pricing.sale_price, r.pricing.state) == (59.9, 80.0, 59.9, "sale")
    assert r.images == ["https://cdn.shopify.com/a.jpg", "https://shop.example/c.jpg", "https://x.myshopify.com/e.jpg"] and r.image_url == r.images[0] and r.tags == ["Womens", "t" * 100]
    r = got["plain"]
    assert (r.brand, r.size_info, r.image_url, r.pricing.price, r.pricing.sale_price, r.pricing.state) == ("House", None, "", 19.99, None, "regular")
    assert "sold" in {r.handle for r in shopify.parse_products(df, "k", "p", "https://shop.example", keep_sold_out=True).collect()}


WORD = lambda *w: r"(?i)\b(?:" + "|".join(w) + r")s?\b"
TAXONOMY = Taxonomy(
    canonical={"tops": ("t-shirt", "shirt"), "dresses": ("midi",), "swimwear": (), "underwear": (), "jewelry": ("ring",), "other": ()},
    spellings={"top": "tops", "t shirts": "tops", "one piece": "dresses"},
    priority=(Rule("swimwear", WORD("swim", "bikini")),),
    aliases=(Rule("tops", WORD("shirt", "tee")), Rule("dresses", WORD("dress", "dresses")), Rule("underwear", WORD("brief")), Rule("jewelry", WORD("ring"))),
    subcategories={"tops": (Rule("t-shirt", WORD("tee", "t shirt")), Rule("shirt", WORD("shirt"))), "jewelry": (Rule("ring", WORD("ring")),)},
    noise=(r"\bdress[\s_-]+blues?\b",),
    noisy=("dresses",),
    foreign="(?i)shipping",
    stronger=(("swimwear", "underwear"),),
)


def test_category_ladder(spark):
    cases = [
        ("tops", "Shirt", False, ("tops", None, 0.9, False)), ("T-Shirts", "Shirt", False, ("tops", "category_canonicalized", 0.9, False)), ("", "Blue shirt", False, ("tops", "category_missing_text_fallback", 0.84, False)), (None, "Thing", False, (None, "category_missing", 0.0, True)),
        ("SALE 30%", "Ring", False, ("jewelry", "category_noise_text_fallback", 0.8, False)), ("SALE", "Ring shirt", False, ("other", "category_unresolved_other_fallback", 0.2, False)), ("tops", "Bikini top", False, ("swimwear", "category_priority_text_override", 0.9, False)), ("tops", "Bikini top", True, ("tops", None, 0.9, False)),
        ("tops", "Ring", False, ("jewelry", "category_text_conflict", 0.5, True)), ("tops", "Ring", True, ("tops", None, 0.9, False)), ("other", "Ring", True, ("jewelry", "category_other_text_fallback", 0.8, False)), ("swimwear", "Swimless brief", False, ("swimwear", None, 0.9, False)),
        ("dresses", "Dress blues shirt", False, ("tops", "category_keyword_noise_override", 0.95, False)), ("dresses", "Dress blues", True, ("other", "category_keyword_noise_override", 0.95, False)), ("tops", "Shipping ring", False, ("other", "category_non_fashion_name", 0.99, False)), ("tops", "Dress", True, ("dresses", "category_trusted_title_override", 0.9, False)),
    ]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k long, category string, name string, trusted boolean")
    got = df.select("k", resolve_category(TAXONOMY, F.col("category"), F.col("name"), F.col("trusted"), ("dresses",)).alias("r")).orderBy("k").collect()
    assert [tuple(r.r) for r in got] == [c[3] for c in cases]


def test_subcategories_and_sources(spark):
    cases = [("tops", "shirt", "", ("shirt", None)), ("tops", "Tees!", "", ("t-shirt", "canonicalized")), ("tops", None, "S/S SHIRT_IVORY", ("shirt", "text_fallback")), ("tops", "junk", "", (None, "noncanonical_dropped")), ("tops", "", "", (None, None)), (None, "shirt", "", (None, "no_category")), ("other", "", "shirt", (None, None)), ("dresses", "ring", "ring", (None, "noncanonical_dropped"))]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(cases)], "k long, category string, sub string, t string")
    assert [tuple(r.r) for r in df.select("k", resolve_subcategory(TAXONOMY, F.col("category"), F.col("sub"), F.col("t")).alias("r")).orderBy("k").collect()] == [c[3] for c in cases]
    sources = [("Shirts", [], "Ring", "tops"), ("All", ["ring"], "Shirt", "jewelry"), ("", [], "CARDIGAN_shirt", "tops"), ("other", ["ring"], "x", "other"), ("Dress", [], "Shirt dress", "tops"), ("", [], "Icon chain", "jewelry"), ("", [], "Chain thing", None), ("", ["dress blues"], "x", None)]
    df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(sources)], "k long, kind string, tags array<string>, title string")
    column = by_source(TAXONOMY.aliases, TAXONOMY, F.col("kind"), F.col("tags"), F.col("title"), ("all",), {"dresses": (Rule("tops", "shirt"),)}, (Rule("jewelry", "chain$"),))
    assert [r.c for r in df.select("k", column.alias("c")).orderBy("k").collect()] == [c[3] for c in sources]


def test_a_vocabulary_finds_what_rules_find(spark):
    """A table of 1,000 words against the compiled rules of the same words, on random texts."""
    r = random.Random(3)
    syllables = ["ta", "no", "ri", "coat", "be", "lu", "ne", "shirt", "so", "ka"]
    words = sorted({"".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(1400)} | {f"{a} {b}" for a in syllables for b in syllables[:3]})[:1000]
    labels = [f"l{k % 12}" for k in range(12)]
    entries = [Entry(label, tuple(w for k, w in enumerate(words) if k % 12 == j)) for j, label in enumerate(labels)]
    rules = [Rule(e.label, "(?i)" + ascii_word("|".join(sorted(e.words, key=len, reverse=True)))) for e in entries]
    bits = [*words[:300], "x", "COAT", "coats", "é", "9", ".", "漢字", "tano1"]
    texts = [r.choice(["", " ", "."]).join(r.choice(bits) + r.choice([" ", " ", "-", ""]) for _ in range(r.randint(0, 5))) for _ in range(300)] + ["", None]
    v, plain = Vocabulary(entries), lambda t: F.regexp_replace(F.translate(t, "_-", "  "), r"\s+", " ")
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = df.select(first_match(v, F.col("t")), first_match(rules, plain(F.col("t"))), unique_match(v, F.col("t")), unique_match(rules, plain(F.col("t"))), all_matches(v, F.col("t")), all_matches(rules, plain(F.col("t")))).collect()
    assert sum(r[0] is not None for r in got) > 100 and sum(r[2] is not None for r in got) > 20
    assert [(r[0], r[2], r[4]) for r in got] == [(r[1], r[3], r[5]) for r in got]


def test_entries_of_a_vocabulary(spark):
    v = Vocabulary([Entry("bottoms", ("short", "shorts", "cargo"), ("바지",), ("sleeve", "-sleeves")), Entry("tops", ("t-shirt", "tank top")), Entry("accessories", ("tie",), (), ("dye",))])
    cases = {"Short Sleeve T_SHIRT": ["tops"], "Short-sleeve shorts": ["bottoms"], "shortsleeve": [], "면바지 tank  top": ["bottoms", "tops"], "Tie dye cargo": ["bottoms"], "tie-dye": [], "TIE": ["accessories"], "necktie": [], "": [], None: []}
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r[0] for r in df.select(v.labels(F.col("t"))).collect()] == list(cases.values())
    assert df.select(first_match(Vocabulary([]), F.col("t"), F.lit("none"))).first()[0] == "none"
    with pytest.raises(ValueError):
        Vocabulary([Entry("x", (" ",))])


def test_a_taxonomy_takes_vocabularies(spark):
    nouns = Vocabulary([Entry("tops", ("shirt", "shirts", "tee")), Entry("jewelry", ("ring",)), Entry("underwear", ("brief",)), Entry("dresses", ("dress",))])
    taxonomy = Taxonomy(canonical=TAXONOMY.canonical, spellings=TAXONOMY.spellings, aliases=nouns, subcategories={"tops": Vocabulary([Entry("t-shirt", ("tee",)), Entry("shirt", ("shirt",))])})
    df = spark.createDataFrame([("", "Blue shirt", "x"), ("SALE", "Ring shirt", "x"), ("other", "Ring", "x"), ("tops", "Ring", "tee shirt")], "category string, name string, t string")
    got = df.select(resolve_category(taxonomy, F.col("category"), F.col("name")).alias("c"), resolve_subcategory(taxonomy, F.lit("tops"), F.lit(""), F.col("t")).alias("s")).collect()
    assert [(r.c.value, r.c.reason, r.s.value) for r in got] == [("tops", "category_missing_text_fallback", None), ("other", "category_unresolved_other_fallback", None), ("jewelry", "category_other_text_fallback", None), ("jewelry", "category_text_conflict", "t-shirt")]
