import zlib
from collections import defaultdict

from loomcat.llm import sharding
from loomcat.llm.common import materialise
from loomcat.llm.sharding import shard
from pyspark.sql import functions as F

from samples import documents, empty, odd


def check(docs, shards, **options):
    rows = docs.collect()
    got = shard(docs, shards, **options).collect()
    assert len(got) == len(rows)
    by, sizes = defaultdict(list), defaultdict(int)
    for r in got:
        text = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 16, zlib.crc32(text), "bytes", None)
        by[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(shards))
    total, largest = sum(sizes.values()), max((r.size for r in got), default=0)
    assert all(abs(sizes[k] - total / shards) <= largest + 1 for k in range(shards))
    return got


def test_equal_bytes(spark):
    docs = documents(spark, count=300)
    got = check(docs, 7, most_ranges=64)
    assert sorted(map(str, (r[2:5] for r in got))) == sorted(map(str, (r[2:5] for r in docs.collect())))


def test_odd_rows_keep_clashing_columns(spark):
    docs = odd(spark).unionByName(documents(spark, count=30))
    assert {r["_size"] for r in check(docs, 3)} == {"_z"}


def test_one_key_holds_a_third(spark):
    docs = documents(spark, count=90)
    hot = docs.withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, 5).otherwise(F.col("doc_id")))
    check(hot, 5)


def test_one_row_repeated_makes_a_third(spark):
    """Rows equal in id and text are cut as well: their range is subdivided by row numbers."""
    docs = documents(spark, count=200).select("doc_id", "text")
    same = spark.range(100).select(F.lit(7).cast("long").alias("doc_id"), F.lit("equal rows " * 40).alias("text"))
    both = docs.union(same)
    check(both, 9, most_ranges=144)
    rows = materialise(sharding.keyed(both, "doc_id", "text", []), "keys")
    total = rows.agg(F.sum("_size")).first()[0]
    _, _, totals = sharding.splitters_for(rows, total, 60)
    assert all(r.bytes <= 2 * total / 60 or r.n == 1 for r in totals.collect())


def test_only_columns_asked_for(spark):
    docs = documents(spark, count=30)
    assert shard(docs, 3, columns=["doc_id"]).columns == ["doc_id", *sharding.ADDED]
    assert sorted(r.doc_id for r in shard(docs, 3, columns=["doc_id"]).collect()) == sorted(r.doc_id for r in docs.collect())


def test_empty(spark):
    assert shard(empty(spark)).count() == 0
