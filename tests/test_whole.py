"""Queries over whole tables and texts, against rows worked out by hand."""

import hashlib

from loomcat.catalogue_queries import QUERIES
from loomcat.operators.ordering import placed
from pyspark.sql import functions as F


def rows(spark, folder, name):
    return sorted(map(tuple, QUERIES[name](spark, f"file://{folder}").collect()), key=str)


def test_whole_texts(spark, tmp_path):
    texts = {1: ("es", "x " * 300 + "\uff21\ufb01\u00c9 the token=abc De"), 2: ("fr", ""), 3: ("en", None), 4: ("de", "y" * 3000)}
    spark.createDataFrame([(k, *v) for k, v in texts.items()], "doc_id long, lang string, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    folded = {1: "x " * 300 + "afie the token=abc de", 2: "", 4: "y" * 3000}
    assert rows(spark, tmp_path, "x1_compatible_fold") == [(k, hashlib.sha256(folded[k].encode()).hexdigest() if k in folded else None) for k in texts]
    assert rows(spark, tmp_path, "x19_array_cleaning") == [(1, "de,the"), (2, ""), (3, None), (4, "")]
    assert rows(spark, tmp_path, "x7_safe_message") == [(1, texts[1][1].replace("abc", "[hidden]")), (2, ""), (3, None), (4, "y" * 2000)]


def test_places_over_all_rows(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.col("id") % 7).alias("a"), "id")
    order = sorted(range(3000), key=lambda k: (k % 3 != 0, k % 7 if k % 3 else 0, -k))
    got = {r.id: r.place for r in placed(df, F.asc_nulls_first("a"), F.desc("id")).collect()}
    assert got == {k: n for n, k in enumerate(order, 1)}
    assert placed(df.limit(0), F.asc("id")).count() == 0


def test_scan_says_where_ids_do_not_increase(spark, tmp_path):
    spark.createDataFrame([(k, float(k)) for k in range(1, 801)] + [(50, 60.0)], "o_orderkey long, o_totalprice double").write.parquet(f"file://{tmp_path}/orders.parquet")
    got = rows(spark, tmp_path, "s3_keyset_scan")
    assert len(got) == 801 and [r for r in got if not r[3]] == [(50, 60.0, 51, False)]


def test_all_suppliers(spark, tmp_path):
    write = lambda name, data, kinds: spark.createDataFrame(data, kinds).write.parquet(f"file://{tmp_path}/{name}.parquet")
    write("supplier", [(k,) for k in range(1, 62) if k != 29], "s_suppkey long")
    write("part", [(1, "Brand#1", "a"), (2, "Brand#28", "Red Widget-58"), (3, "Brand#29", "b"), (4, "Brand#60", "Red Widget-61"), (5, "Brand#99", "c")], "p_partkey long, p_brand string, p_name string")
    write("embeddings", [(1, "x")], "vec_id long, label string")
    write("conversations", [(1, 0), (1, 1)], "conv_id long, turn int")
    assert rows(spark, tmp_path, "j8_unique_match") == [(1, None), (2, None), (3, 59), (4, 61), (5, None)]
    assert rows(spark, tmp_path, "j16_audit_joins") == [(1, True, 2, 3, 1), (2, False, 0, 0, None), (3, False, 0, 0, None), (4, False, 0, 0, None), (5, False, 0, 0, None)]
    assert rows(spark, tmp_path, "c7_brand_nodes") == [("Brand#1", "node"), ("Brand#28", "node"), ("Brand#29", "create"), ("Brand#60", "node"), ("Brand#99", "create")]
