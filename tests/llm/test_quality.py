import re
import string
import unicodedata
import zlib

import numpy as np
from loomcat.llm import quality
from pyspark.sql import functions as F

from samples import documents, empty, odd


def labels_of(docs):
    junk = F.col("text").rlike(r"!!") | F.col("text").rlike(r"^(\w+)( \1)+$")
    return docs.select("doc_id", F.when(junk, 0).otherwise(1).alias("quality"))


def test_held_out_documents(spark):
    docs = documents(spark, seed=3, count=400)
    labels = labels_of(docs).toPandas().set_index("doc_id").quality
    got = quality.score(docs, quality.fit(docs, labels_of(docs))).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert len(held) > 50 and (held.predicted == labels[held.doc_id].to_numpy()).mean() > 0.95
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_rules_as_columns_and_in_numpy_agree(spark):
    docs = documents(spark, seed=5)
    model = quality.fit(docs, labels_of(docs))
    stats = quality.with_statistics(docs.select("doc_id", "text")).toPandas().sort_values("doc_id")
    x = stats[list(quality.STATISTICS)].to_numpy()
    total = model.intercept + quality.holds([r for r, _ in model.rules], x) @ np.array([w for _, w in model.rules])
    got = quality.score(docs, model).orderBy("doc_id").toPandas().score
    assert np.allclose(got, 1 / (1 + np.exp(-total)))


def test_held_out_labels_do_not_matter(spark):
    docs = documents(spark, seed=6)
    labels = labels_of(docs)
    flipped = labels.withColumn("quality", F.when(quality.is_held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.fit(docs, labels).describe() == quality.fit(docs, flipped).describe()


def test_odd_rows_and_missing_labels(spark):
    docs = odd(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (6, 7), (99, 1)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (6, 7, None)}) == 1
    bare = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, bare).collect()} == {0.5}
    kept = quality.keep_good(docs, quality.RuleModel(9.0, []))
    assert kept.schema == docs.schema and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert quality.keep_good(docs, quality.RuleModel(-9.0, [])).count() == 0
    assert quality.score(empty(spark), quality.fit(empty(spark), labels)).count() == 0


def recounted(text):
    """The statistics as their description reads, without Spark."""
    text = text or ""
    words = [] if not text.strip(" ") else re.split(r"[ \t\n\x0b\f\r]+", text.lower())
    lines = re.split(r"\n+", text)
    upper = sum(c in string.ascii_uppercase or "À" <= c <= "Þ" and c != "×" for c in text)
    digits = sum(c in string.digits for c in text)
    plain = set(".,;:'\"()- \t\n\x0b\f\r")
    symbols = sum(not (unicodedata.category(c)[0] in "LN" or c in plain) for c in text)
    stops = sum(c in ".?!" and (k + 1 == len(text) or text[k + 1] in " \t\n\x0b\f\r") for k, c in enumerate(text))
    share = lambda a, b: a / b if b else 0.0
    repeated = lambda x: 1 - len(set(x)) / len(x) if x else 0.0
    return [len(words), repeated(words), repeated(lines), share(len(text), len(words)), share(upper, len(text)), share(digits, len(text)), share(symbols, len(words)), share(stops, len(words))]


def test_statistics_recounted(spark):
    extra = spark.createDataFrame([(901, "A! b? c.d\n\nA! b?\n"), (902, " lead  and tail "), (903, "ÀÉ×ÞΩ 12½ #@~ 漢字. \t end!"), (904, "...\n...\n")], "doc_id long, text string")
    docs = documents(spark, seed=7).unionByName(odd(spark)).select("doc_id", "text").unionByName(extra)
    got = quality.with_statistics(docs, keep_text=True).collect()
    assert len(got) == docs.count()
    for r in got:
        assert np.allclose([r[c] for c in quality.STATISTICS], recounted(r.text)), r.text
