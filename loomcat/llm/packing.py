"""Best-fit packing by linear grouping.

1. Documents become pieces of at most ``capacity`` tokens (the tokenizer's ids and
   one end id); only longer documents are cut.
2. Pieces longer than ``capacity / 3`` are sorted by length and split into groups
   of equal cardinality; within a group every length counts as the largest one.
3. For these few sizes, column generation finds the best mix of configurations
   (multisets of sizes that fit one sequence); what rounding down leaves over is
   placed by best fit.
4. The actual pieces replace the rounded ones, which leaves known gaps.
5. Short pieces go, longest first, into the tightest gap that holds them.

The driver sees only the count of pieces by (length, salt), whose size does not
grow with the input. The plan is a list of runs of consecutive ranks, so its size
follows the number of distinct lengths, not that of documents. Ranks come from
windows over salted lengths, so a length that a third of all pieces share does
not meet in one task.

Defined results: a null text counts as empty; an empty text is one piece that
holds only the end id; repeated rows are packed once each; pieces of equal length change
places freely, as the number of sequences depends on lengths only, and their order is that of their
ranks; very long texts are encoded whole and cut; an empty table gives an empty result; columns
other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches, materialise, ship, table, text_or_empty, tokenizer_file
from .tokens import WordBpe

CAPACITY = 2048
GROUPS = 128
#: A piece is large if longer than this part of the capacity. A larger threshold leaves more short pieces to fill the gaps that rounding makes.
SMALL_PART = 3


@functools.lru_cache(1)
def encoder(path: str) -> WordBpe:
    """One encoder a worker process, so that its memos outlive a task."""
    return WordBpe(path)


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` a piece, plus ``ids`` if asked."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe, end = encoder(tokenizer_file(tokenizer)), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for i, text in zip(batch["id"], batch["text"], strict=True):
                data = bpe.encode(text) + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    row = (i, k, at // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int64)) if with_ids else row)
            yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids])

    source = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return map_batches(source, run, "piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids)


def best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes that fits ``capacity`` with the largest sum of values."""
    best = np.zeros(capacity + 1)
    choice: list[np.ndarray] = []
    for _ in range(int(capacity // sizes.min())):
        new, pick = best.copy(), np.full(capacity + 1, -1)
        for i, (s, v) in enumerate(zip(sizes, values, strict=True)):
            take = best[: capacity + 1 - s] + v
            better = take > new[s:] + 1e-12
            new[s:][better] = take[better]
            pick[s:][better] = i
        if (pick < 0).all():
            break
        best = new
        choice.append(pick)
    counts, c = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(choice):
        if pick[c] >= 0:
            counts[pick[c]] += 1
            c -= sizes[pick[c]]
    return float(best[capacity]), counts


def optimise_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 1500) -> list[tuple[np.ndarray, int]]:
    """Whole multiplicities of configurations, from the linear programme's optimum
    rounded down; at most ``demand`` of each size is used."""
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    x = demand / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, counts = best_configuration(sizes, np.maximum(prices, 0), capacity)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, counts.astype(float))
        ratio = np.where(direction > 1e-9, x / np.maximum(direction, 1e-12), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        step = ratio[leave]
        x = np.maximum(x - step * direction, 0)
        x[leave] = step
        basis[:, leave] = counts
    out = [(basis[:, k].astype(np.int64), int(x[k] + 1e-6)) for k in range(n)]
    left = demand.astype(np.int64).copy()
    kept = []
    for counts, m in out:
        used = counts > 0
        m = min(m, int((left[used] // counts[used]).min())) if used.any() else 0
        if m > 0:
            left -= m * counts
            kept.append((counts, m))
    return kept


class _Gaps:
    """Runs of sequences by what room they have: ``[first, count]`` by gap."""

    def __init__(self) -> None:
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.order: list[int] = []

    def add(self, gap: int, first: int, count: int) -> None:
        if gap <= 0 or count <= 0:
            return
        if gap not in self.runs:
            self.runs[gap] = []
            insort(self.order, gap)
        self.runs[gap].append((first, count))

    def take(self, least: int, count: int) -> tuple[int, int, int] | None:
        """(gap, first, count) of a run with the smallest gap of ``least`` or more."""
        k = bisect_left(self.order, least)
        if k == len(self.order):
            return None
        gap = self.order[k]
        first, n = self.runs[gap].pop()
        if n > count:
            self.runs[gap].append((first + count, n - count))
            n = count
        if not self.runs[gap]:
            del self.runs[gap]
            self.order.pop(k)
        return gap, first, n


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small_part: int = SMALL_PART) -> tuple[np.ndarray, int]:
    """Runs ``(rank, sequence, offset)``, by rank, and the number of sequences.

    Pieces are ranked from the longest; piece ``rank + k`` of a run goes to
    ``sequence + k`` at ``offset``."""
    lengths = np.array(sorted((k for k, n in counts.items() if n), reverse=True), np.int64)
    number = np.array([counts[k] for k in lengths], np.int64)
    ends = np.cumsum(number)
    begins = ends - number
    runs: list[tuple[int, int, int]] = []
    gaps, sequence = _Gaps(), 0
    full = int(number[lengths == capacity].sum())
    if full:
        runs.append((0, 0, 0))
        sequence = full
    large = int(number[lengths > capacity // small_part].sum()) - full
    leftover: list[tuple[int, int]] = []  # (first rank, number), all of one length

    def spans(first: int, n: int) -> Iterator[tuple[int, int, int]]:
        """(rank, number, length) of the stretches of one length in some ranks."""
        while n > 0:
            k = int(np.searchsorted(ends, first, "right"))
            m = min(n, int(ends[k]) - first)
            yield first, m, int(lengths[k])
            first, n = first + m, n - m

    if large:
        edges = np.unique(full + (np.arange(groups + 1) * large) // groups)
        sizes = lengths[np.searchsorted(ends, edges[:-1], "right")]
        demand = np.diff(edges)
        distinct = np.unique(sizes)[::-1]  # groups that round to one size count as one
        merged = [np.flatnonzero(sizes == s) for s in distinct]
        first = np.array([edges[g[0]] for g in merged])
        total = np.array([demand[g].sum() for g in merged])
        used = np.zeros(len(distinct), np.int64)
        for configuration, m in optimise_configurations(distinct, total, capacity):
            slots = []
            for g in np.flatnonzero(configuration):
                for _ in range(configuration[g]):
                    slots.append(list(spans(int(first[g] + used[g]), m)))
                    used[g] += m
            cuts = sorted({0, m, *(int(r - s[0][0]) for s in slots for r, _, _ in s)})
            at = [0] * len(slots)
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                offset = 0
                for k, s in enumerate(slots):
                    while s[at[k]][0] + s[at[k]][1] <= s[0][0] + lo:
                        at[k] += 1
                    runs.append((s[0][0] + lo, sequence + lo, offset))
                    offset += s[at[k]][2]
                gaps.add(capacity - offset, sequence + lo, hi - lo)
            sequence += m
        for g in range(len(distinct)):
            leftover += [(r, n) for r, n, _ in spans(int(first[g] + used[g]), int(total[g] - used[g]))]
    small = int(full + large)
    leftover += [(r, n) for r, n, _ in spans(small, int(ends[-1]) - small)] if len(ends) else []
    for rank, n in sorted(leftover):
        size = int(lengths[np.searchsorted(ends, rank, "right")])
        while n > 0:
            got = gaps.take(size, n)
            if got is None:
                new = -(-n // (capacity // size))
                gaps.add(capacity, sequence, new)
                sequence += new
                continue
            gap, start, m = got
            runs.append((rank, start, capacity - gap))
            gaps.add(gap - size, start, m)
            rank, n = rank + m, n - m
    return np.array(sorted(runs), np.int64).reshape(-1, 3), sequence


def pack(parts: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (their ids, if there, are kept).

    ``parts`` is read twice; give a written table."""
    total = parts.count()
    salts = int(min(1024, max(32, total // 1_000_000)))
    salted = parts.withColumn("_salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)).cast("int"))
    table_ = salted.groupBy("length", "_salt").agg(F.count("*").alias("n")).toPandas()  # at most capacity * salts rows
    table_ = table_.sort_values(["length", "_salt"], ascending=[False, True])
    first_rank = np.zeros((capacity + 1, salts), np.int64)
    first_rank[table_["length"], table_["_salt"]] = table_["n"].cumsum() - table_["n"]
    runs, _ = plan(table_.groupby("length")["n"].sum().to_dict(), capacity, groups)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, salt: pd.Series, row: pd.Series) -> pd.DataFrame:
        rank = first_rank[length, salt] + row.to_numpy() - 1
        run = runs[np.searchsorted(runs[:, 0], rank, "right") - 1]
        return pd.DataFrame({"sequence_id": run[:, 1] + rank - run[:, 0], "offset": run[:, 2]})

    order = Window.partitionBy("length", "_salt").orderBy("id", "piece", "ids_crc32")
    placed = salted.withColumn("_row", F.row_number().over(order).cast("long")).withColumn("_at", place("length", "_salt", "_row"))
    return placed.select(*parts.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    parts = materialise(pieces(docs, id_col, text_col, tokenizer, capacity, end_id, with_ids), "pieces")
    return pack(parts, capacity).withColumnRenamed("id", id_col)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
