import hashlib
import math
import re
import zlib
from collections import Counter

from loomcat.llm.importance import Importance, resample

from samples import CLASH, SCHEMA, documents, empty, odd

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    return len(words), [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def plain_version(rows, target, rule):
    bucket = lambda f: zlib.crc32(f.encode()) % rule.buckets
    s = Counter(bucket(f) for _, text in rows for f in features(text, rule.longest)[1])
    t = Counter(bucket(f) for text in target for f in features(text, rule.longest)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + rule.buckets) / ((s[b] + 1) * (t_all + rule.buckets))))
    out = []
    for i, text in rows:
        n, found = features(text, rule.longest)
        weight = sum(gain(bucket(f)) for f in found)
        h = int(hashlib.sha256(f"{rule.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    open_ = sorted((x for x in out if x[1] >= rule.least_words), key=lambda x: (-x[4], -1 if x[0] is None else x[0]))
    for k, x in enumerate(open_[: rule.share * len(open_) // 100]):
        x[5] = k + 1
    return sorted(map(str, map(tuple, out)))


def check(docs, target, rule):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    wanted = plain_version(rows, [r[0] for r in target.select("text").collect()], rule)
    assert sorted(map(str, map(tuple, resample(docs, target, rule).collect()))) == wanted


def test_rows(spark):
    target = documents(spark, seed=4, count=20)
    docs = documents(spark, seed=1, count=100).unionByName(odd(spark))
    check(docs, target, Importance())
    check(docs, target, Importance(seed=1, longest=3, buckets=97, least_words=1, share=55))
    check(docs, target, Importance(share=100, least_words=0))
    check(docs, empty(spark), Importance(share=50))


def test_nothing_to_draw_from(spark):
    assert resample(empty(spark), documents(spark, count=5)).count() == 0
    few = spark.createDataFrame([(1, "a few words", "en", "s", 1, *CLASH), (2, None, "en", "s", 1, *CLASH)], SCHEMA)
    assert [r["rank"] for r in resample(few, few).collect()] == [None, None]


def test_many_documents_of_one_score(spark):
    """No bucket tells words apart, so weights depend on the length alone, and ids repeat the noise."""
    text = "same words " * 15
    rows = [(k % 700, text, "en", "s", 1, *CLASH) for k in range(2100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = resample(docs, docs, Importance(buckets=1, share=40)).collect()
    drawn = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in drawn] == list(range(1, 841))
    assert [(-r["score"], r["doc_id"]) for r in drawn] == sorted((-r["score"], r["doc_id"]) for r in out)[:840]
