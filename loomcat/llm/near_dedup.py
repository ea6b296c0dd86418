"""Near-duplicate groups by fast similarity sketching.

1. One pass over the texts: the set of distinct word shingles (64-bit hashes of the
   lower-cased words), the sketch, its band keys, one byte of each coordinate (``marks``)
   and a digest of the word sequence. The sketch throws every shingle into one of
   ``bins`` bins, round after round, until all bins are filled; round and hash value of
   the first arrival are the coordinate. Rounds beyond ``bins`` serve one fixed bin each,
   so every coordinate fills.
2. Texts with equal word sequences form a class; one of each goes on.
3. In each bucket (equal band key) the smallest id is the pivot, paired with every member.
   Pairs whose set sizes exclude the similarity go, then those whose sketches agree in so
   few places that the concentration bound excludes it (``SLACK`` deviations); what is
   left is compared on the full shingle sets, read from the texts: first one pair a
   member, then those that still join different components.
4. A bucket whose members are in one component by then is settled: no further link
   there can change a component. Where members are in several, a member of another
   component becomes the pivot once; what is still open is compared block by block, all
   pairs of different components whose sizes lie in the same or neighbouring classes (no others
   can be alike): sizes and sketches first, and only the members of pairs
   that these allow go on with their texts. So no bucket is capped.

A bucket or class of any size is met only by joins that adaptive execution can split
and by aggregates that are partial on the map side. With ``slack=None`` no pair that
shares a band is left to the sketch bound: all that sizes allow are compared in full.

Defined results: a null or blank text has no shingles and links with nothing; fewer
words than ``words`` make one shingle; repeated rows link with each other; rows that share an id
but not the text each follow their own text's class, and a link of that id holds for
both; rows without an id take no part (no component, kept); an empty table gives an
empty result; very long texts are compared whole; columns other than the id and the text
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, discarding, map_batches, materialise, ship, table, text_or_empty
from .tokens import _Memo

WORDS = 5
BINS, BANDS = 324, 36
PERCENT = 85
BLOCK, TEXT_BLOCK = 256, 64
SLACK = 5

_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


_words = _Memo(xxhash.xxh64_intdigest, 300_000)


def words_of(text: str) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z lower-cased (as bytes methods do)."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; of all words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _MIX[0] + w[i : len(w) - k + 1 + i]
    return np.unique(mix(h))


def sketch(items: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Fast similarity sketch of a non-empty set: (round << 48 | value) by bin."""
    out = np.full(bins, np.uint64(2**64 - 1))
    size = np.uint64(bins)
    done, step = 0, max(1, 6 * bins // len(items))
    while done < bins:
        rounds = np.arange(done, min(bins, done + step), dtype=np.uint64)
        h = mix(items[:, None] + mix((rounds + np.uint64(1)) * _MIX[3])[None, :])
        value = (rounds[None, :] << np.uint64(48)) | (h >> np.uint64(16))
        np.minimum.at(out, (h % size).astype(np.int64).ravel(), value.ravel())
        done += len(rounds)
        if out.max() < np.uint64(2**64 - 1):
            return out
    for b in np.flatnonzero(out == np.uint64(2**64 - 1)):
        i = np.uint64(bins + int(b))
        out[b] = (i << np.uint64(48)) | (mix(items + mix(np.array([i + np.uint64(1)]) * _MIX[3])) >> np.uint64(16)).min()
    return out


def band_keys(coordinates: np.ndarray, bands: int = BANDS) -> np.ndarray:
    rows = mix(coordinates).reshape(bands, -1)
    powers = np.cumprod(np.full(rows.shape[1], _MIX[0]))
    return mix((rows * powers).sum(axis=1) + np.arange(1, bands + 1, dtype=np.uint64) * _MIX[4]).view(np.int64)


def sketches(docs: DataFrame, width: int = WORDS, bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """``id, n_shingles, word_digest, keys, marks`` a row of ``id, text``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = words_of(text)
                if not words:
                    rows.append((0, None, None, None))
                    continue
                items = shingles(words, width)
                coordinates = sketch(items, bins)
                rows.append((len(items), hashlib.sha256(b" ".join(words)).digest(), band_keys(coordinates, bands), coordinates.astype(np.uint8).tobytes()))
            out = pd.DataFrame(rows, columns=["n_shingles", "word_digest", "keys", "marks"])
            out.insert(0, "id", batch["id"].array)
            yield out

    return map_batches(docs, run, "n_shingles long, word_digest binary, keys array<long>, marks binary")


def least_agreement(percent: int, bins: int, slack: float | None = SLACK) -> float:
    """The share of equal coordinates that alike sets fall below with a chance of ``slack`` deviations."""
    s = percent / 100
    return 0.0 if slack is None else s - slack * (s * (1 - s) / bins) ** 0.5


def sizes_allow(a: str, b: str, percent: int) -> Column:
    return F.least(F.col(a), F.col(b)) * 100 >= F.greatest(F.col(a), F.col(b)) * percent


def plausible(pairs: DataFrame, marks: DataFrame, least: float) -> DataFrame:
    """The ``a, b`` whose sketches do not exclude that they are alike."""

    @F.pandas_udf("boolean")
    def close(left: pd.Series, right: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(v), np.uint8).reshape(len(v), -1) for v in (left, right))
        return pd.Series((x == y).mean(axis=1) >= least) if len(left) else pd.Series([], dtype=bool)

    joined = pairs.join(marks.select(F.col("id").alias("b"), F.col("marks").alias("_right")), "b").join(marks.select(F.col("id").alias("a"), F.col("marks").alias("_left")), "a")
    return joined.filter(close("_left", "_right")).select("a", "b").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The ``a, b`` whose full shingle sets are alike enough."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        out, last, items = [], None, None
        for i, x, y in zip(a, left, right, strict=True):
            if items is None or (i, x) != last:
                last, items = (i, x), shingles(words_of(x), width)
            other = shingles(words_of(y), width)
            both = len(np.intersect1d(items, other, assume_unique=True))
            out.append(100 * both >= percent * (len(items) + len(other) - both))
        return pd.Series(out, dtype=bool)

    joined = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("_right")), "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("_left")), "a")
    return joined.filter(alike("a", "_left", "_right")).select("a", "b")


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component`` for every node of ``a, b``, by large-star and small-star steps.

    Each step keeps one row a link; the neighbours of a node never meet in one list."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, edges = edges, materialise(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(links.sparkSession, last)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def with_component(rows: DataFrame, id_: str, components: DataFrame, name: str) -> DataFrame:
    found = components.select(F.col("id").alias(id_), F.col("component").alias("_found"))
    return rows.join(found, id_, "left").withColumn(name, F.coalesce("_found", id_)).drop("_found")


def open_buckets(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of buckets that span several components: their component ``c`` and a pivot
    of the bucket's largest one."""
    labelled = materialise(with_component(members.select("key", "id", "n_shingles"), "id", components, "c"), "labelled")
    top = F.max(F.struct("c", "id", "n_shingles"))
    spans = labelled.groupBy("key").agg(F.min("c").alias("_low"), top.alias("_top"), F.count("*").alias("size")).filter("_low < _top.c and size > 2")
    spans = materialise(spans.select("key", "size", F.col("_top.c").alias("pivot_c"), F.col("_top.id").alias("pivot"), F.col("_top.n_shingles").alias("pivot_n")), "spans")
    # both sides are written tables and the join is a merge at every size, so a hot bucket can be split
    found = materialise(labelled.join(spans.hint("merge"), "key"), "open")
    discard(members.sparkSession, labelled, spans)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, percent: int = PERCENT, bins: int = BINS, bands: int = BANDS, slack: float | None = SLACK) -> DataFrame:
    """``id, n_shingles, component_id, kept`` a row of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    least = least_agreement(percent, bins, slack)
    with discarding(spark) as kept:
        source = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
        seen = materialise(sketches(source, width, bins, bands), "sketches")
        # written before they are joined, so that adaptive execution can split a hot class or bucket
        classes = materialise(seen.filter("id is not null and word_digest is not null").groupBy("word_digest").agg(F.min("id").alias("rep"), F.count("*").alias("n")).filter("n > 1").drop("n"), "classes")
        own = lambda c: F.when(F.col("id") == F.col("rep"), F.col(c)).alias(c)
        rep = F.when(F.col("word_digest").isNotNull(), F.coalesce("rep", "id"))
        with_rep = seen.join(classes.hint("merge"), "word_digest", "left").withColumn("rep", F.when(F.col("id").isNotNull(), rep))
        rows = materialise(with_rep.select("id", "n_shingles", "rep", own("keys"), own("marks")), "rows")

        keys = rows.filter("keys is not null").select("id", "n_shingles", F.explode("keys").alias("key"))
        buckets = keys.groupBy("key").agg(F.min(F.struct("id", "n_shingles")).alias("_first"), F.max("id").alias("_last"), F.count("*").alias("size")).filter("_first.id < _last")
        buckets = materialise(buckets.select("key", "size", F.col("_first.id").alias("pivot"), F.col("_first.n_shingles").alias("pivot_n")), "buckets")
        members = materialise(keys.join(buckets.hint("merge"), "key"), "members")
        ids = members.select("id").distinct()
        marks = materialise(rows.filter("keys is not null").select("id", "marks", "keys").join(ids, "id", "left_semi"), "marks")
        # the ids grow with the input, so this is a merge join at every size
        texts = materialise(source.join(ids.hint("merge"), "id", "left_semi"), "texts")

        def linked(pairs: DataFrame) -> DataFrame:
            return materialise(confirmed(pairs, texts, width, percent), "links")

        def joining(pairs: DataFrame, components: DataFrame) -> DataFrame:
            """The pairs whose ends are in different components."""
            return with_component(with_component(pairs, "a", components, "_ca"), "b", components, "_cb").filter("_ca <> _cb").select("a", "b")

        def grown(components: DataFrame, links: DataFrame) -> DataFrame:
            if links.isEmpty():
                return components
            return materialise(connected_components(links.union(components.select("id", "component"))), "components")

        star = members.filter("id <> pivot").filter(sizes_allow("n_shingles", "pivot_n", percent)).select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
        pairs = materialise(plausible(star, marks, least), "pairs")
        first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
        components = materialise(connected_components(linked(first)), "components")
        rest = joining(pairs.join(first, ["a", "b"], "left_anti"), components)
        components = grown(components, linked(rest))

        left = open_buckets(members.filter("size > 2"), components)
        if not left.isEmpty():
            star = left.filter("c <> pivot_c").filter(sizes_allow("n_shingles", "pivot_n", percent)).select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
            components = grown(components, linked(plausible(star, marks, least)))
            left = open_buckets(left, components)
            if not left.isEmpty():
                components = grown(components, materialise(cross_links(left, marks, texts, width, percent, least), "links"))
        kept += [rows, components]
    out = rows.join(components.withColumnRenamed("id", "rep"), "rep", "left")
    return out.select(
        F.col("id").alias(id_col),
        "n_shingles",
        F.coalesce("component", "rep", "id").alias("component_id"),
        F.expr("id <=> coalesce(component, rep, id)").alias("kept"),
    )


def cross_links(members: DataFrame, marks: DataFrame, texts: DataFrame, width: int, percent: int, least: float, block: int = BLOCK, text_block: int = TEXT_BLOCK) -> DataFrame:
    """The alike ``a, b`` among a bucket's members in different components.

    The members of a bucket are divided into classes by size, so that alike ones are in the same
    or neighbouring classes. A class of n members is split into n / block blocks, and each pair of
    blocks is a group of its own, so a group holds about two blocks whatever the bucket's size. Groups
    hold sizes and sketches; the pairs that these allow make up cells of at most
    two text blocks of ids, to which the texts are then joined. A pair that shares several
    buckets is compared in that of its first common key only."""
    return compared(candidate_cells(members, marks, percent, least, block, text_block), texts, width, percent)


def candidate_cells(members: DataFrame, marks: DataFrame, percent: int, least: float, block: int = BLOCK, text_block: int = TEXT_BLOCK) -> DataFrame:
    """``cell, ids, x, y``: ids of a cell and, as places among them, its pairs that sizes and sketches allow."""
    own = ["id", "c", "n_shingles", "marks", "keys"]
    # sizes of alike sets differ by a factor of 100 / percent at most; a little more takes up what rounding does
    sized = members.withColumn("s", F.floor(F.log("n_shingles") / (max(math.log(100 / percent), 1e-12) * (1 + 1e-9))))
    count = materialise(sized.groupBy("key", "s").agg(F.ceil(F.count("*") / block).cast("int").alias("m")), "size-classes")
    beside = lambda step, name: count.select("key", (F.col("s") + step).alias("s"), F.col("m").alias(name))
    count = count.join(beside(-1, "above"), ["key", "s"], "left").join(beside(1, "below"), ["key", "s"], "left")
    blocks = sized.join(count, ["key", "s"]).join(marks, "id").withColumn("i", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
    group = lambda s, step, lo, hi, x, y: F.struct(s.alias("s"), F.lit(step).alias("step"), lo.alias("lo"), hi.alias("hi"), x.alias("left"), y.alias("right"))
    each = lambda n, use: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), use)).otherwise(F.array())
    i, yes, no = F.col("i"), F.lit(True), F.lit(False)
    groups = F.concat(
        each(F.col("m"), lambda j: group(F.col("s"), 0, F.least(i, j), F.greatest(i, j), i <= j, i >= j)),
        each(F.col("above"), lambda j: group(F.col("s"), 1, i, j, yes, no)),
        each(F.col("below"), lambda j: group(F.col("s") - 1, 1, j, i, no, yes)),
    )
    cells = blocks.select("key", *own, F.explode(groups).alias("g")).select("key", "g.s", "g.step", "g.lo", "g.hi", "g.left", "g.right", *own)
    grouped = cells.groupBy("key", "s", "step", "lo", "hi").agg(F.collect_list(F.struct("left", "right", *own)).alias("rows"))

    @F.pandas_udf("array<struct<ids: array<long>, x: array<int>, y: array<int>>>")
    def allowed(key: pd.Series, rows: pd.Series) -> pd.Series:
        out = []
        for k, cell in zip(key, rows, strict=True):
            left, right, ids, c, n = (np.array([r[f] for r in cell], np.int64) for f in ("left", "right", "id", "c", "n_shingles"))
            seen = np.frombuffer(b"".join(r["marks"] for r in cell), np.uint8).reshape(len(cell), -1)
            keys = np.array([r["keys"] for r in cell], np.int64)
            found = [np.empty((0, 2), np.int64)]
            for x in np.flatnonzero(left):
                ok = (right == 1) & (c != c[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
                y = np.flatnonzero(ok & ((ids > ids[x]) | (left == 0)))  # both ways round only once
                y = y[(seen[y] == seen[x]).mean(axis=1) >= least]
                same = keys[y] == keys[x]
                y = y[keys[x][same.argmax(axis=1)] == k]  # the first key that both have
                found.append(np.stack([np.full(len(y), x), y], axis=1))
            pairs = np.concatenate(found)
            parts = []
            if len(pairs):
                tile = pairs // text_block
                _, which = np.unique(tile[:, 0] * len(cell) + tile[:, 1], return_inverse=True)
                for t in range(which.max() + 1):
                    own_pairs = pairs[which == t]
                    rows_, at = np.unique(own_pairs, return_inverse=True)
                    at = at.reshape(own_pairs.shape)
                    parts.append({"ids": ids[rows_].tolist(), "x": at[:, 0].tolist(), "y": at[:, 1].tolist()})
            out.append(parts)
        return pd.Series(out)

    found = grouped.select("key", "s", "step", "lo", "hi", F.posexplode(allowed("key", "rows")).alias("t", "p"))
    return materialise(found.select(F.struct("key", "s", "step", "lo", "hi", "t").alias("cell"), "p.ids", "p.x", "p.y"), "cells")


def compared(cells: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The alike ``a, b`` of the cells' pairs, on their full shingle sets."""

    @F.pandas_udf("array<struct<a: long, b: long>>")
    def alike(ids: pd.Series, x: pd.Series, y: pd.Series, rows: pd.Series) -> pd.Series:
        out = []
        for own, left, right, texts_ in zip(ids, x, y, rows, strict=True):
            sets = {r["id"]: shingles(words_of(r["text"]), width) for r in texts_}
            links = []
            for a, b in zip(own[left].tolist(), own[right].tolist(), strict=True):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append({"a": min(a, b), "b": max(a, b)})
            out.append(links)
        return pd.Series(out)

    wanted = cells.select("cell", F.explode("ids").alias("id")).join(texts.hint("merge"), "id").groupBy("cell").agg(F.collect_list(F.struct("id", "text")).alias("rows"))
    found = cells.join(wanted, "cell").select(F.explode(alike("ids", "x", "y", "rows")).alias("p"))
    return found.select("p.a", "p.b").distinct()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that aren't kept; of rows equal in id and text, one stays."""
    found = materialise(near_duplicates(docs.select(id_col, text_col), id_col, text_col, **options), "found")
    ids = found.filter(F.col(id_col).isNotNull())
    gone = ids.filter("not kept").select(id_col).distinct()
    kept = docs.join(gone.hint("merge"), id_col, "left_anti")  # the ids grow with the input
    repeated = materialise(ids.groupBy(id_col).count().filter("count > 1").select(id_col), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, id_col, "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(repeated, id_col, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
