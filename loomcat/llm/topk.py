"""Exact top-k search by distributed histogram selection.

Components become ``floor(scale * x)``, ``x`` as double, so scores are whole numbers.

1. The queries are taken in blocks of bounded size; each block is scored against all rows.
2. Every task counts its scores by bin between a query's bounds; the counts of all tasks,
   summed, tell the bin of the kth best score, whose borders are the next bounds. This is
   repeated until the kth value is known or few scores reach the lower bound. A task
   reports no bin below its own kth score: the kth of all is at least that.
3. A last pass keeps the scores that reach the bound. Ties go to the smaller id; a task
   sends no more than its own k best, so any number of equal vectors stays local.

The driver holds the bounds of one block of queries, never scores of rows.

Vectors too long for 64-bit products (``WIDE``) take the same steps in whole numbers of any
size, apart from the others: they are few, and nothing is left out or rounded.

Defined results: vectors that are null or hold a null or non-finite component and rows
without an id take no part; only vectors of equal length have a score; a row is no
candidate for a query with its id; repeated rows are queries and candidates of their own;
an empty table gives an empty result; columns other than the id and the vector are
ignored. Ranks follow the exact scores; ``score`` itself is a long, so a score beyond 64
bits is given as the nearest long.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, materialise, shared_folder, ship, table

SCALE, K, EVERY = 256, 5, 50
QUERY_BLOCK, BINS, CELLS = 2048, 512, 1 << 21
#: From this squared norm on, a vector is wide; the product of two others stays below 2 ** 60.
WIDE = 2.0**60


def usable_rows(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id, v, norm, wide`` of the rows that take part: components as doubles, not yet
    scaled, and the squared norm of what they become."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & finite).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(F.abs(x) * scale + 1, F.lit(2.0)))
    return rows.withColumn("norm", norm).withColumn("wide", ~(F.col("norm") < WIDE))


class QueryBlock:
    """Queries of one block, by vector length; ``wide`` ones count in whole numbers of any size."""

    def __init__(self, numbers: list[int], ids: list[int], vectors: list[np.ndarray], scale: int, wide: bool):
        self.numbers, self.ids, self.scale, self.wide = np.array(numbers, np.int64), np.array(ids, np.int64), scale, wide
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(v) for v in vectors])
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            self.by_length[int(n)] = (at, self.whole(np.array([vectors[i] for i in at], float).reshape(len(at), n)))

    def whole(self, x: np.ndarray) -> np.ndarray:
        """``floor(scale * x)``: 64-bit numbers, or Python's if wide."""
        if not self.wide:
            return np.floor(x * self.scale).astype(np.int64)
        exact = [math.floor(v * self.scale) if abs(v) < 2.0**52 else int(v) * self.scale for v in x.ravel().tolist()]
        out = np.empty(len(exact), object)
        out[:] = exact
        return out.reshape(x.shape)

    def reach(self, longest: float, largest: float) -> np.ndarray:
        """What no score of a query exceeds, given the longest vector's squared norm or,
        for wide ones, the largest component of all candidates."""
        out = np.zeros(len(self.ids), object if self.wide else np.int64)
        for n, (at, q) in self.by_length.items():
            if self.wide:
                out[at] = [n * max([abs(x) for x in row], default=0) * (int(largest) + 1) * self.scale + 1 for row in q.tolist()]
            else:
                norms = np.sqrt(np.square(q.astype(float)).sum(axis=1))
                out[at] = np.ceil(norms * np.sqrt(longest) * (1 + 1e-9)).astype(np.int64) + 1
        return out

    def scores(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks ``(queries, candidate ids, scores, is it another row's)``."""
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lists = batch.column("v")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for n, (at, q) in self.by_length.items():
                rows = np.flatnonzero(lengths == n)
                step = max(1, CELLS // len(at) >> (6 * self.wide))
                for begin in range(0, len(rows), step):
                    part = rows[begin : begin + step]
                    c = self.whole(flat[offsets[part][:, None] + np.arange(n)[None, :]] if n else np.zeros((len(part), 0)))
                    if n == 0:
                        s = np.zeros((len(at), len(part)), q.dtype)
                    elif self.wide:
                        s = q @ c.T
                    else:
                        most = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * n
                        s = (q.astype(float) @ c.T.astype(float)).astype(np.int64) if most < 1 << 53 else q @ c.T
                    yield at, ids[part], s, self.ids[at][:, None] != ids[part][None, :]


def histograms(rows: DataFrame, block: QueryBlock, low: np.ndarray, width: np.ndarray, high: np.ndarray, k: int, bins: int) -> DataFrame:
    """``q, bin, n``: how many scores of query ``q`` lie in each bin of its bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(low), bins), np.int64)
        for at, _, s, other in block.scores(batches):
            inside = other & (s >= low[at][:, None]) & (s <= high[at][:, None])
            row, col = np.nonzero(inside)
            where = at[row] * bins + ((s[row, col] - low[at[row]]) // width[at[row]]).astype(np.int64)
            counts += np.bincount(where, minlength=counts.size).reshape(counts.shape)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(b), pa.array(counts[q, b])], names=["q", "bin", "n"])

    return rows.mapInArrow(run, "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))


def locate_kth(rows: DataFrame, block: QueryBlock, reach: np.ndarray, k: int, bins: int) -> np.ndarray:
    """A lower bound of each query's kth score that few other scores reach, if ties allow."""
    low, high = -reach, reach.copy()
    needed = np.full(len(low), k)  # how many of the bounds' best are still wanted
    while True:
        width = -(-(high - low + 1) // bins)
        found = histograms(rows, block, low, width, high, k, bins)
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        need = F.get(F.lit([int(x) for x in needed]), F.col("q").cast("int"))
        kth = found.withColumn("upto", F.sum("n").over(down)).withColumn("need", need).filter("upto >= need and upto - n < need")
        got = kth.select("q", "bin", "n", "upto").collect()  # a row a query of the block
        settled = np.ones(len(low), bool)
        for q, b, n, upto in got:
            needed[q] -= upto - n
            settled[q] = width[q] == 1 or n <= 4 * k
            low[q], high[q] = low[q] + b * width[q], min(high[q], low[q] + (b + 1) * width[q] - 1)
        missing = np.setdiff1d(np.arange(len(low)), [r[0] for r in got])
        high[missing] = low[missing]  # fewer than k candidates: all of them are wanted
        if settled.all():
            return low
        high[settled] = low[settled]


def best(rows: DataFrame, block: QueryBlock, low: np.ndarray, k: int) -> DataFrame:
    """``q, query_id, vec_id, score, exact``: each task's k best scores from ``low`` on;
    ``exact`` are bytes in the order of the scores where these can exceed 64 bits."""

    def top(q: np.ndarray, i: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = np.unique(s, return_inverse=True)[1] if block.wide and len(s) else s
        order = np.lexsort((i, -place, q))
        q, i, s = q[order], i[order], s[order]
        first = np.searchsorted(q, q, "left")
        keep = np.arange(len(q)) - first < k
        return q[keep], i[keep], s[keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, object if block.wide else np.int64))
        for at, ids, s, other in block.scores(batches):
            row, col = np.nonzero(other & (s >= low[at][:, None]))
            new = top(at[row], ids[col], s[row, col])
            held = top(*(np.concatenate(x) for x in zip(held, new, strict=True)))
        q, i, s = held
        score = pa.array([max(-(2**63), min(2**63 - 1, int(x))) for x in s], pa.int64())
        exact = pa.array([in_order(int(x)) for x in s], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(block.numbers[q]), pa.array(block.ids[q]), pa.array(i), score, exact], names=["q", "query_id", "vec_id", "score", "exact"])

    return rows.mapInArrow(run, "q long, query_id long, vec_id long, score long, exact binary")


def in_order(x: int) -> bytes:
    """Bytes that sort as whole numbers do: sign, length and digits, complemented for negative ones."""
    digits = abs(x).to_bytes((abs(x).bit_length() + 7) // 8, "big")
    out = len(digits).to_bytes(3, "big") + digits
    return b"\1" + out if x >= 0 else b"\0" + bytes(255 - b for b in out)


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, query_block: int = QUERY_BLOCK, bins: int = BINS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows for which ``is_query`` (a column over
    the id, named ``id``) holds."""
    spark = vectors.sparkSession
    ship(spark)
    rows = materialise(usable_rows(vectors, id_col, vec_col, scale), "vectors")
    queries = materialise(rows.filter(is_query).withColumn("n", F.monotonically_increasing_id()), "queries")
    size = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    longest, largest, wide = rows.agg(F.max(F.when(~F.col("wide"), F.col("norm"))), F.max(size), F.coalesce(F.bool_or("wide"), F.lit(False))).first()
    blocks = -(-queries.count() // query_block)
    path = f"{shared_folder(spark)}/best-{uuid.uuid4().hex}"
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for turn in range(blocks):
        own = queries.filter(F.pmod(F.xxhash64("n"), F.lit(blocks)) == turn).orderBy("id", "n").select("id", "v", "wide").collect()

        def found(which: list[int], candidates: DataFrame, any_size: bool) -> list[DataFrame]:
            if not which:
                return []
            block = QueryBlock(which, [own[j][0] for j in which], [np.array(own[j][1], float) for j in which], scale, any_size)  # noqa: B023
            low = locate_kth(candidates, block, block.reach(longest or 0.0, largest or 0.0), k, bins)
            return [best(candidates, block, low, k)]

        plain = [j for j, r in enumerate(own) if not r[2]]
        parts = found(plain, rows.filter("not wide"), False)
        if wide:
            parts += found(plain, rows.filter("wide"), True) + found([j for j, r in enumerate(own) if r[2]], rows, True)
        if not parts:
            continue
        order = Window.partitionBy("q").orderBy(F.desc("exact"), "vec_id") if wide else Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        ranked = functools.reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
    discard(spark, rows, queries)
    return spark.read.schema(schema).parquet(path)


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)
