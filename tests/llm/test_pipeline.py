import corpus_pipeline
import numpy as np
from loomcat.llm import quality, secrets
from pyspark.sql import functions as F

from samples import documents, odd
from test_near_dedup import brute
from test_packing import check


def write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    junk = F.col("text").rlike(r"!!") | F.col("text").rlike(r"^(\w+)( \1)+$")
    docs.filter("doc_id % 5 < 4").select("doc_id", F.when(junk, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    return f"file://{folder}"


def test_stages_against_brute_force(spark, tmp_path):
    folder = write(spark, tmp_path, documents(spark, seed=8, count=160).unionByName(odd(spark)))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "secrets", "packing"]

    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = stages["quality"](spark, docs, folder)
    stats = quality.with_statistics(docs.select("doc_id", "text"), keep_text=True).toPandas()
    total = model.intercept + quality.holds([r for r, _ in model.rules], stats[list(quality.STATISTICS)].to_numpy()) @ np.array([w for _, w in model.rules])
    assert good.columns == docs.columns
    assert sorted(map(str, (r.text for r in good.select("text").collect()))) == sorted(map(str, stats.text[1 / (1 + np.exp(-total)) >= 0.7]))
    clean = docs.filter("doc_id >= 100").filter(~F.col("text").rlike(r"!!") & ~F.col("text").rlike(r"^(\w+)( \1)+$"))
    assert clean.join(good, "doc_id", "left_anti").count() <= 0.03 * clean.count()

    one = stages["near_dedup"](spark, good, folder)
    rows = good.select("doc_id", "text").collect()
    assert one.columns == docs.columns
    assert sorted(map(str, one.select("doc_id", "text").collect())) == sorted({str(r) for r, b in zip(rows, brute(rows), strict=True) if b[3]})

    masked = stages["secrets"](spark, one, folder)
    field = secrets.Field(secrets.trained())
    wanted = [None if t is None else secrets.masked(t, secrets.all_spans(t, field)[1]) for (t,) in one.select("text").collect()]
    assert masked.columns == docs.columns and sorted(map(str, (r.text for r in masked.select("text").collect()))) == sorted(map(str, wanted))

    check(masked, 2048)
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert result.select("doc_id").distinct().count() == masked.select("doc_id").distinct().count()


def test_an_empty_table(spark, tmp_path):
    folder = write(spark, tmp_path, documents(spark, count=1).limit(0))
    assert corpus_pipeline.run(spark, folder).count() == 0
