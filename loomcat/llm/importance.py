"""Target-distribution importance resampling: draw the documents that look most like a target
corpus, with noise that makes the draw a sample by importance weight.

1. Hashed n-gram counts of the source and of the target: each task adds up an array of
   ``buckets`` counts over its rows and hands on that array only.
2. The gains of the buckets, one array (``buckets`` whole numbers, a fixed size), score every
   document in one narrow pass; the noise is a hash of seed and id.
3. Scores are whole numbers, so a histogram of them is exact. Running sums over it from the
   highest score down give the rank at which each score begins, and the score at which the
   draw ends. Only documents at or above that score are numbered, by id within their score.

The histogram may have as many scores as the table has rows, so its running sums are made by
ranges of scores (``ordering.running_total``); the driver sees the number of eligible documents
and the cutoff score only. A score that many documents share is numbered by ranges of ids, and
their counts, so no score is one task's work.

Defined results: a null text has no words; a document with fewer than ``least_words`` words
is scored but never drawn; ``share`` of no documents is none; a null id takes its noise from
the empty string and stands before other ids of its score; repeated ids of one score take
different ranks in any order; an empty target or source counts as counts of zero; very long
texts are read whole; columns other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import range_numbers, running_total
from .common import map_batches, materialise, ship, table, text_or_empty
from .tokens import _Memo

#: Digits, lower-case letters and all bytes of characters outside ASCII stay; A-Z become lower case; what remains separates words.
WORD_BYTES = bytes(b if chr(b).isdigit() or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


@dataclass(frozen=True)
class Importance:
    """Parameters: features are runs of 1 to ``longest`` words; ``share`` is a percentage."""

    seed: int = 2024
    longest: int = 1
    buckets: int = 10_000
    least_words: int = 20
    share: int = 10


class Features:
    """The feature buckets of texts, by a bounded memo of words (or runs of words)."""

    def __init__(self, rule: Importance, limit: int = 400_000):
        self.longest = rule.longest
        self.memo = _Memo(lambda feature: zlib.crc32(feature) % rule.buckets, limit)

    def of(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every feature."""
        words = text.encode().translate(WORD_BYTES).split()
        found = list(map(self.memo.__getitem__, words))
        for n in range(2, self.longest + 1):
            found += [self.memo[b" ".join(words[k : k + n])] for k in range(len(words) - n + 1)]
        return len(words), np.array(found, np.int64)


def bucket_counts(df: DataFrame, rule: Importance, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts. A task sends one row a bucket that it has
    seen, so the driver and the shuffle get at most ``buckets`` numbers a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, total = Features(rule), np.zeros(rule.buckets, np.int64)
        for batch in batches:
            waiting, held = [], 0
            for text in batch["text"]:
                waiting.append(features.of(text)[1])
                held += len(waiting[-1])
                if held > 100_000:
                    total += np.bincount(np.concatenate(waiting), minlength=rule.buckets)
                    waiting, held = [], 0
            if waiting:
                total += np.bincount(np.concatenate(waiting), minlength=rule.buckets)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": seen, "n": total[seen]})

    ship(df.sparkSession)
    rows = df.select(text_or_empty(text_col).alias("text")).mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most `buckets` rows
    out = np.zeros(rule.buckets, np.int64)
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one occurrence of each bucket's features adds to a weight."""
    buckets = len(source)
    s_all, t_all = float(source.sum()), float(target.sum())
    ratio = lambda s, t: (t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))
    return np.array([math.floor(1000 * math.log(ratio(s, t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, key: str) -> int:
    """Gumbel noise in thousandths, from the id alone."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, rule: Importance, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_features, weight, score`` a row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = Features(rule)
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"], strict=True):
                n, found = features.of(text)
                weight = int(gain[found].sum())
                rows.append((n, len(found), weight, weight + noise(rule.seed, key)))
            out = pd.DataFrame(rows, columns=["n_words", "n_features", "weight", "score"])
            out.insert(0, "id", batch["id"].array)
            yield out

    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("key"), text_or_empty(text_col).alias("text"))
    return map_batches(source, run, "n_words long, n_features long, weight long, score long").withColumnRenamed("id", id_col)


def draw(scored: DataFrame, rule: Importance, id_col: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``, null for what is not drawn; ``scored`` must be a written table."""
    spark = scored.sparkSession
    open_ = scored.filter(F.col("n_words") >= rule.least_words)
    count = open_.count()
    wanted = rule.share * count // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    histogram = open_.groupBy((-F.col("score")).alias("down")).agg(F.count("*").alias("n"))
    offsets = running_total(histogram, "down", F.col("n"), "upto").select((-F.col("down")).alias("score"), (F.col("upto") - F.col("n")).alias("before"))
    offsets = materialise(offsets.filter(F.col("before") < wanted), "offsets")
    cutoff = offsets.agg(F.min("score")).first()[0]
    kept = (F.col("n_words") >= rule.least_words) & (F.col("score") >= cutoff)
    # a part: the documents of one score whose ids lie in one range
    parts = range_numbers(scored.filter(kept), F.col(id_col).asc_nulls_first(), name="part")
    sizes = parts.groupBy("score", "part").agg(F.count("*").alias("n")).join(offsets, "score")
    begin = sizes.withColumn("begin", F.col("before") + F.sum("n").over(Window.partitionBy("score").orderBy("part")) - F.col("n")).select("score", "part", "begin")
    within = F.row_number().over(Window.partitionBy("score", "part").orderBy(F.col(id_col).asc_nulls_first()))
    ranked = parts.withColumn("within", within).join(begin, ["score", "part"]).withColumn("rank", F.col("begin") + F.col("within"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.filter(~F.coalesce(kept, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return rest.unionByName(ranked.select(rest.columns))


def resample(docs: DataFrame, target: DataFrame, rule: Importance | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_features, weight, score, rank`` a row of ``docs``."""
    rule = rule or Importance()
    gain = gains(bucket_counts(docs, rule, text_col), bucket_counts(target, rule, text_col))
    scored = materialise(score(docs, gain, rule, id_col, text_col), "scored")
    return draw(scored, rule, id_col)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
    WITH tab AS (
        SELECT list(list_reduce([c::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) ORDER BY c) AS t FROM range(256) AS x(c)),
    low AS (
        SELECT 'd' AS side, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
        UNION ALL SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
    w AS (SELECT side, id, unnest(words) AS word FROM low),
    words AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, strlen(hex(encode(word))) // 2), lambda k: ('0x' || hex(encode(word))[2 * k + 1:2 * k + 2])::BIGINT)),
                 lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM w), tab),
    c AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM w JOIN words USING (word) GROUP BY bucket),
    total AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM c),
    g AS (SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * (s_all + 10000) / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain FROM c, total),
    weights AS (SELECT id AS doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM w JOIN words USING (word) JOIN g USING (bucket) WHERE side = 'd' GROUP BY id),
    scored AS (
        SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || d.doc_id::VARCHAR)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM documents d LEFT JOIN weights USING (doc_id)),
    ranked AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place FROM scored)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * (SELECT count(*) FROM ranked WHERE n_features >= 20) // 100 THEN place END AS rank FROM ranked"""
