import numpy as np
from loomcat.llm import near_dedup as nd
from pyspark.sql import functions as F

from samples import documents, empty, odd, prose


def shingle_set(text):
    w = nd.words_of(text or "")
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    """(n_shingles, component) by row, from all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, _) in enumerate(rows):
        for j, (m, _) in enumerate(rows[:k]):
            both = len(sets[k] & sets[j])
            if i is not None and m is not None and both and 100 * both >= 85 * len(sets[k] | sets[j]):
                a, b = find(i), find(m)
                root[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else find(i), True if i is None else find(i) == i) for (i, _), s in zip(rows, sets, strict=True)]


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    got = nd.near_duplicates(docs, **options).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_against_all_pairs(spark):
    check(documents(spark, seed=4).unionByName(odd(spark)))


def test_chains_and_large_groups(spark):
    import random

    r = random.Random(3)
    base = prose(r, 120).split(" ")
    chain, rows = list(base), []
    for k in range(40):  # each text is like the one before, the ends aren't alike
        chain = list(chain)
        chain[(k * 7) % 120] = f"new{k}"
        rows.append((1000 - k, " ".join(chain)))
    for k in range(90):
        words = list(base)
        words[r.randrange(120)] = f"other{k % 30}"
        rows.append((2000 + k, " ".join(words)))
    common = prose(r, 30)
    rows += [(3000 + k, common + " " + prose(r, 60)) for k in range(80)]  # a passage that many share
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_few_bands_leave_open_buckets(spark):
    """Buckets whose pivot isn't like all members are settled by the later steps."""
    import random

    r = random.Random(5)
    rows = []
    for g in range(4):
        base = prose(r, 60).split(" ")
        for k in range(30):
            words = list(base)
            for _ in range(3):
                words[r.randrange(60)] = f"w{r.randrange(10**6)}"
            rows.append((g * 100 + k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, bins=240, bands=120)
    check(docs, bins=240, bands=120, slack=None)


def test_block_pairs_lose_nothing(spark, monkeypatch):
    """One bucket, many members of their own components, blocks smaller than it."""
    import random

    r = random.Random(7)
    base = prose(r, 200).split(" ")
    texts = {}
    for k in range(150):
        words = list(base)
        for at in r.sample(range(0, 200, 7), r.choice([1, 2, 4, 6])):
            words[at] = f"w{r.randrange(40)}x{at}"
        texts[k] = " ".join(words)
    docs = spark.createDataFrame(sorted(texts.items()), "id long, text string")
    seen = nd.sketches(docs, bins=60, bands=60)
    members = docs.select(F.lit(None).cast("long").alias("key"), "id", F.col("id").alias("c"), F.lit(150).alias("size"))
    first = seen.select("id", "n_shingles", "marks", F.expr("array(7L)").alias("keys"))
    members = members.drop("key").join(first.select("id", "n_shingles"), "id").withColumn("key", F.lit(7).cast("long"))
    found = nd.cross_links(members, first.select("id", "marks", "keys"), docs, 5, 85, 0.0, block=20, text_block=4)
    sets = {k: shingle_set(t) for k, t in texts.items()}
    wanted = sorted((a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert len(wanted) > 100 and sorted(map(tuple, found.collect())) == wanted


def test_pairs_of_any_sizes(spark):
    """One bucket of texts of very different lengths: every pair that sizes allow is compared, however classes fall."""
    import random

    r = random.Random(13)
    base = prose(r, 400).split(" ")
    texts = {k: " ".join(base[: 20 + k * 380 // 160] + [f"end{k % 3}"] * (k % 2)) for k in range(160)}
    docs = spark.createDataFrame(sorted(texts.items()), "id long, text string")
    first = nd.sketches(docs, bins=60, bands=60).select("id", "n_shingles", "marks", F.expr("array(7L)").alias("keys"))
    members = first.select(F.lit(7).cast("long").alias("key"), "id", F.col("id").alias("c"), F.lit(160).alias("size"), "n_shingles")
    sets = {k: shingle_set(t) for k, t in texts.items()}
    for percent in (85, 60, 100):
        found = nd.cross_links(members, first.select("id", "marks", "keys"), docs, 5, percent, 0.0, block=9, text_block=4)
        wanted = sorted((a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]))
        assert sorted(map(tuple, found.collect())) == wanted and (wanted or percent == 100)


def test_recall_just_above_the_threshold(spark):
    """Of pairs between 0.85 and 0.87, at most one in a thousand may be lost; none of these is."""
    import random

    r = random.Random(11)
    rows, wanted = [], set()
    while len(wanted) < 400:
        base = prose(r, 150).split(" ")
        other = list(base)
        for at in r.sample(range(150), 3):
            other[at] = f"new{r.randrange(10**9)}"
        x, y = shingle_set(" ".join(base)), shingle_set(" ".join(other))
        if 0.85 <= len(x & y) / len(x | y) <= 0.87 or 0.8 < len(x & y) / len(x | y) < 0.85 and r.random() < 0.2:
            k = len(rows)
            rows += [(k, " ".join(base)), (k + 1, " ".join(other))]
            if len(x & y) / len(x | y) >= 0.85:
                wanted.add(k)
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).filter("not kept").collect()
    assert {r.component_id for r in got} == wanted and len(got) == len(wanted)


def test_sketch_estimates_similarity_and_fills():
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 400).astype(np.uint64)
    b = np.concatenate([a[:300], r.integers(0, 2**63, 100).astype(np.uint64)])
    got = np.mean([(nd.sketch(a + np.uint64(k), 324) == nd.sketch(b + np.uint64(k), 324)).mean() for k in range(20)])
    assert abs(got - 300 / 500) < 0.03
    assert (nd.sketch(a[:1], 324) < np.uint64(2**64 - 1)).all()


def test_only_what_the_result_reads_stays(spark):
    from pathlib import Path

    from loomcat.scratch import discarding, shared_folder

    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir()) if folder.exists() else set()
    with discarding(spark):
        out = nd.near_duplicates(documents(spark, seed=5))
        left = {p.name.rsplit("-", 1)[0] for p in set(folder.iterdir()) - before}
        assert left == {"rows", "components"} and out.count() == 120
    assert set(folder.iterdir()) == before


def test_keep_one(spark):
    docs = documents(spark, seed=4).unionByName(odd(spark))
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    rows = docs.select("doc_id", "text").collect()
    wanted = {(i, t) for (i, t), (_, _, _, k) in zip(rows, brute(rows), strict=True) if k}
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(str(x) for x in spark.createDataFrame(list(wanted), "doc_id long, text string").collect())
    assert nd.keep_one(empty(spark)).count() == 0 and nd.near_duplicates(empty(spark)).count() == 0
    assert nd.near_duplicates(docs.filter(F.col("doc_id") < 4)).count() == 3
