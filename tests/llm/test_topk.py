import math
from fractions import Fraction

import numpy as np
import pytest
from loomcat.llm.topk import in_order, top_k
from pyspark.sql import functions as F


def brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in ok:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for j, c in ok if j != i and len(c) == len(q))[:k]
            out += [(i, r + 1, j, max(-(2**63), min(2**63 - 1, -s))) for r, (s, j) in enumerate(found)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, top_k(df.withColumn("score", F.lit("x")).withColumn("n", F.lit(1)), F.col("id") % 50 == 0, **options).collect()))


def test_against_brute_force_in_several_blocks(spark):
    r = np.random.default_rng(0)
    rows = [(k, r.normal(0, 0.2, 8).astype(np.float32).tolist()) for k in range(400)]
    assert run(spark, rows, query_block=3, bins=16) == brute(rows)


def test_ties_copies_and_unusable_vectors(spark):
    rows = [(k, [0.5, 0.25]) for k in range(1, 120)]
    rows += [(200, None), (201, [None, 0.5]), (202, [float("nan"), 1.0]), (203, [float("inf"), 1.0]), (None, [1.0, 1.0]), (204, []), (250, [0.5]), (251, [0.25]), (300, [-1.0, 0.125])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, bins=2) == brute(rows)


def test_repeated_query_rows_have_results_of_their_own(spark):
    got = run(spark, [(50, [1.0]), (50, [1.0]), (51, [0.5])])
    assert got == [(50, 1, 51, 32768), (50, 1, 51, 32768)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(50, [1.0])]])
def test_few_or_no_rows(spark, rows):
    assert run(spark, rows) == []


def test_vectors_beyond_64_bits_are_ranked_exactly(spark):
    f = lambda *v: [float(np.float32(x)) for x in v]
    rows = [(k, f(k / 7, -k)) for k in range(1, 160)]
    rows += [(200, f(1e17, 1)), (201, f(-1e17, 1)), (202, f(3e38, 3e38)), (203, f(3e38, -3e38)), (204, f(1e17, 1)), (250, f(0, 0)), (300, f(1e-30, 0)), (350, f(-1e30, 1e30))]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, bins=16, query_block=2) == brute(rows)


def test_bytes_in_the_order_of_numbers():
    numbers = sorted({s * (1 << k) + d for k in (0, 7, 8, 63, 64, 300) for d in (-1, 0, 1) for s in (-1, 1)})
    assert sorted(map(in_order, numbers)) == list(map(in_order, numbers))
