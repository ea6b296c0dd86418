"""Operators that build on earlier runs or on another writer, against plain simulations."""

import datetime as dt
import random

from loomcat.operators import cross_shop, identity, ordering, rates, retries
from loomcat.scratch import materialise
from pyspark.sql import functions as F

ROWS = "id long, offer_key string, brand string, kind string, namespace string, number string, trust double, colour string, category string"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def plain_sync(rows, products, variants, offers):
    """One row after the other, on dictionaries: products' categories, variants' successors, offers' targets."""
    out = []
    for i, offer, brand, kind, space, number, trust, colour, category in sorted(rows, key=lambda r: r[0]):
        proven = kind in ("gtin", "mpn", "model_id", "product_group_id") and trust is not None and trust >= (0.99 if kind == "gtin" else 0.8) and colour and number
        product = f"trusted:{brand or ''}:{kind}:{space or ''}:{number}" if proven else None
        if product and products.get(product) and category and products[product] != category:
            product = None
        variant = f"{product}:color:{colour}" if product else None
        there, previous = variant in variants, offers.get(offer)
        kept = product is None and previous is not None and previous.startswith(("trusted:", "cross-shop:"))
        target = previous if kept else variant or f"source:{i}:color:unknown"
        if not kept:
            products[product or f"source:{i}"] = category
            variants[target] = None
        superseded = previous if previous and previous != target and previous.startswith("source:") else None
        if superseded:
            variants[superseded] = target
        attached = product is not None and there
        confidence = (1.0 if kind == "gtin" else 0.995) if attached and previous != target else None
        offers[offer] = target
        out.append((i, target, "kept" if kept else "trusted" if product else "singleton", attached, superseded, confidence))
    return out


def test_identity_sync_over_runs(spark):
    r = random.Random(4)
    catalogue, products, variants, offers = None, {}, {}, {}
    for turn in range(3):
        ids = range(turn * 10, 150 + turn * 25)
        rows = [(i, f"o{i}", r.choice(["a", "b", None]), r.choice(["gtin", "gtin", "mpn", "source_item_id", None]), r.choice(["n", None]), r.choice(["1", "2", "3", None]), r.choice([0.5, 0.9, 1.0, 1.0, None]), r.choice(["red", "blue", "", None]), r.choice(["tops", "tops", "bags", None])) for i in ids]
        df = spark.createDataFrame(rows, ROWS).repartition(4)
        df = df.withColumn("product_key", identity.product_key(*map(F.col, ("brand", "kind", "namespace", "number", "trust", "colour"))))
        catalogue = catalogue or identity.empty_catalogue(df)
        synced = materialise(identity.sync_identities(df, catalogue), "synced")
        wanted = plain_sync(rows, products, variants, offers)
        assert sorted((x.id, x.target, x.seed, x.attached, x.superseded, x.confidence) for x in synced.collect()) == wanted
        catalogue = identity.Catalogue(*[materialise(t, "catalogue") for t in identity.catalogue_after(synced, catalogue)])
        assert {x.identity_key: x.category for x in catalogue.products.collect()} == products
        assert {x.identity_key: x.merged_into for x in catalogue.variants.collect()} == variants
        assert {x.offer_key: x.target for x in catalogue.offers.collect()} == offers
    assert {w[2] for w in wanted} == {"kept", "trusted", "singleton"} and any(w[4] for w in wanted) and any(w[5] for w in wanted)
    assert identity.sync_identities(df.limit(0), catalogue).count() == 0


SHOP = "id long, brand string, name string, category string, platform string, host string, colour string, ready boolean, official boolean, retailer boolean, numbers array<string>, embedding array<float>"


def test_cross_shop_against_all_pairs(spark):
    import numpy as np

    r = random.Random(6)
    base = [np.random.default_rng(k).normal(size=16) for k in range(4)]
    rows = []
    for i in range(240):
        official = r.random() < 0.5
        e = base[r.randrange(4)] * r.choice([1, 3]) + np.random.default_rng(i).normal(size=16) * r.choice([0, 0.02, 0.05, 0.1, 0.3])
        rows.append((i, r.choice("ab"), "hot" if r.random() < 0.7 else r.choice("xy"), r.choice(["c", None]) if r.random() < 0.1 else "c", r.choice(["own1", "own2"]) if official else r.choice(["shop1", "shop2"]), r.choice(["h1", "h2", "h3"]), r.choice(["red", "blue", None]), r.random() < 0.9, official, not official, r.sample(["10001", "10002", "AB12345678"], r.randrange(3)), r.choice([e.tolist()] * 9 + [None, [0.0] * 16])))
    rows += [(1000 + k, *rows[7][1:]) for k in range(30)]  # copies of one row
    df = spark.createDataFrame(rows, SHOP).repartition(3)
    near = lambda a, b: a is not None and b is not None and any(a) and any(b) and 1 - np.dot(np.float32(a).astype(float), np.float32(b).astype(float)) / np.linalg.norm(np.float32(a).astype(float)) / np.linalg.norm(np.float32(b).astype(float)) <= 0.01
    pairs = [(a, b) for a in rows for b in rows if a[8] and b[9] and None not in a[1:4] and a[1:4] == b[1:4] and a[5] != b[5]]
    coloured = [(a, b) for a, b in pairs if a[6] and a[6] == b[6]]
    ready = [(a, b) for a, b in coloured if a[7] and b[7]]
    matched = {(a[0], b[0]) for a, b in ready if set(a[10]) & set(b[10]) and near(a[11], b[11])}
    matches = materialise(cross_shop.cross_shop_matches(df, 16), "matches")
    assert tuple(cross_shop.cascade(df, matches).first()) == (len(pairs), len(coloured), len(ready), len(matched))
    found = {(x.official_id, x.retailer_id) for x in matches.collect()}
    assert found <= matched and len(found) > 10
    copies = {x[0] for x in rows if x[0] >= 1000} | {7}
    whole = {(a if a not in copies else 7, b if b not in copies else 7) for a, b in matched}
    assert found == whole and all(x.distance <= 0.01 for x in matches.collect())
    assert cross_shop.cross_shop_matches(df.limit(0), 16).count() == 0


def test_source_numbers_and_decisions(spark):
    urls = {"https://s.example/product/x/12345/?product_no=99999&a=1": ["99999", "12345"], "https://s.example/p/ab-12345678/abcdefgh/1234": ["AB-12345678"], "https://s.example/p?productNo=777777": ["777777"], "nothing": [], None: None}
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(cross_shop.source_numbers(F.col("u"))).collect()] == list(urls.values())
    lit = lambda *values: [F.lit(v) for v in values]
    cases = [
        ((False, "a", "b", "h", "g", "r", "r", True, True, True, True, "1", 0.0), ("reject", "brand_conflict")), ((True, "a", "a", "h", "g", "r", "r", True, True, True, True, "1", 0.0), ("reject", "same_platform")), ((True, "a", "b", "h", "h", "r", "r", True, True, True, True, "1", 0.0), ("reject", "not_cross_shop")),
        ((True, "a", "b", "h", "g", None, "r", True, True, True, True, "1", 0.0), ("review", "color_evidence_missing")), ((True, "a", "b", "h", "g", "b", "r", True, True, True, True, "1", 0.0), ("reject", "color_conflict")), ((True, "a", "b", "h", "g", "r", "r", True, False, True, True, "1", 0.0), ("review", "pending_image_selection")),
        ((True, "a", "b", "h", "g", "r", "r", True, True, False, True, "1", 0.0), ("reject", "product_description_conflict")), ((True, "a", "b", "h", "g", "r", "r", True, True, True, True, "1", 0.01), ("auto", "cross_shop_source_token_and_image_exact")), ((True, "a", "b", "h", "g", "r", "r", True, True, True, True, None, None), ("review", "cross_shop_corroboration_missing")),
    ]
    columns = []
    for k, ((brand, p1, p2, h1, h2, c1, c2, r1, r2, name, category, shared, distance), _) in enumerate(cases):
        p, h, c, ready = lit(p1, p2), lit(h1, h2), lit(c1, c2), lit(r1, r2)
        columns.append(cross_shop.cross_shop_decision(F.lit(brand), tuple(p), tuple(h), tuple(x.cast("string") for x in c), tuple(ready), F.lit(name), F.lit(category), F.lit(shared).cast("string"), F.lit(distance).cast("double")).alias(f"c{k}"))
    got = spark.range(1).select(*columns).first()
    assert [(d.status, d.reason) for d in got] == [w for _, w in cases] and got[7].confidence == 0.999 and got[8].confidence == 0.7


def test_carried_values(spark):
    r = random.Random(2)
    rows = [(k, r.choice([None, None, None, k])) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    held, wanted = None, {}
    for k, v in rows:
        held = v if v is not None else held
        wanted[k] = held
    assert {x.k: x.last for x in ordering.carried(df, F.col("v"), "last", F.asc("k"), ranges=16).collect()} == wanted


def test_rates_in_force(spark):
    r = random.Random(8)
    snapshots = [(r.choice(["USD", "USD", "EUR", None]), at(r.randrange(500)), r.choice([1.5, 2.0, 0.0, -1.0, None, r.random() + 1])) for _ in range(60)]
    observations = [(k, r.choice(["USD", "EUR", "JPY", "XXX", None]), r.choice([None, *[at(r.randrange(600))] * 9])) for k in range(400)]
    df = spark.createDataFrame(observations, "k long, currency string, observed_at timestamp")
    committed = F.create_map(F.lit("EUR"), F.lit(9.0), F.lit("JPY"), F.lit(7.0))
    got = rates.rates_in_force(df, spark.createDataFrame(snapshots, "currency string, taken_at timestamp, rate double"), 2, committed)
    last = {"EUR": 9.0, "JPY": 7.0}
    for row in got.collect():
        _, currency, seen = observations[row.k]
        fit = [(t, v) for c, t, v in snapshots if c == currency and c and v and v > 0 and seen and t <= seen]
        t, v = max(fit, default=(None, None))
        live = t is not None and seen - t <= dt.timedelta(days=2)
        assert (row.rate, row.rate_at, row.rate_source) == ((v, t, "live") if live else (last[currency], None, "committed") if currency in last else (None, None, None))
    assert got.count() == 400 and {x.rate_source for x in got.collect()} == {"live", "committed", None}


def test_compare_and_set_beside_a_rival(spark):
    """A rival that changes some rows between every read and write; outcomes by round are those of a plain simulation."""
    store = {k: {"version": 1, "observed_at": at(k % 3), "price": float(k)} for k in range(40)}
    plan = {turn: [k for k in range(40) if k % 10 < 5 - turn] for turn in (1, 2, 3)}  # what the rival is faster with
    rival_at = {1: 1, 2: 1, 3: 1}
    fields, turn = "id long, version long, observed_at timestamp, price double", 0
    updates = [(k, 1 if k % 7 else 0, at(2), float(k) if k % 5 == 4 else k + 0.5) for k in range(45)]

    def read():
        return spark.createDataFrame([(k, v["version"], v["observed_at"], v["price"]) for k, v in store.items()], fields)

    def write(rows):
        nonlocal turn
        turn += 1
        for k in plan[turn]:
            store[k] = {"version": store[k]["version"] + 1, "observed_at": at(rival_at[turn] if k % 10 else 5), "price": -1.0}
        done = []
        for row in rows.collect():
            if store[row.id]["version"] == row.version:
                store[row.id] = {"version": row.version + 1, "observed_at": row.observed_at, "price": row.price}
                done.append((row.id,))
        return spark.createDataFrame(done, "id long")

    wanted, mine = {}, {k: {"version": 1, "observed_at": at(k % 3), "price": float(k)} for k in range(40)}
    left = {k: (v, t, p) for k, v, t, p in updates}
    for now in (1, 2, 3):
        tries = {}
        for k, (version, seen, price) in left.items():
            held = mine.get(k)
            outcome = "gone" if held is None else "unchanged" if held["price"] == price else "abandoned" if held["observed_at"] > seen else None
            if outcome:
                wanted[k] = (outcome, now)
            elif now > 1 or version == held["version"]:
                tries[k] = held["version"]
        for k in plan[now]:
            mine[k] = {"version": mine[k]["version"] + 1, "observed_at": at(rival_at[now] if k % 10 else 5), "price": -1.0}
        for k, version in tries.items():
            if mine[k]["version"] == version:
                wanted[k] = ("written", now)
                mine[k] = {"version": version + 1, "observed_at": left[k][1], "price": left[k][2]}
        left = {k: v for k, v in left.items() if k not in wanted}
    wanted |= {k: ("conflicted", 3) for k in left}
    got = retries.compare_and_set(spark.createDataFrame(updates, fields), ["price"], read, write)
    assert {x.id: (x.outcome, x["round"]) for x in got.collect()} == wanted
    assert {x[0] for x in wanted.values()} == {"gone", "unchanged", "abandoned", "written", "conflicted"} and {x[1] for x in wanted.values()} == {1, 2, 3}
