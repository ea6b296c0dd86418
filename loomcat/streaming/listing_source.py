"""Listings as a stream whose offset is the cursor.

A site's listing is its categories, a number of pages each. A slice takes the next ``budget`` pages of
every site; the offset says for each site which cycle it is in, which categories that cycle
counts on (a fingerprint) and how many of its pages are taken. The stream's checkpoint keeps
the offset, so a stopped run goes on where it stopped, without losing or repeating a page. A site
whose categories have changed starts over in a new cycle; a finished cycle is followed by a new one.

``plan``, a small Parquet table of ``site, category_index, pages``, is read on the driver at every slice; the
pages themselves, ``site, category_index, page, payload``, are read by tasks, a slice of a
site each. A page that is not there is a failed one (``payload`` null), and its cycle degraded.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import dataset
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..shipping import ship
from ..sources.gated import store_of

FORMAT = "loomcat_listing"
SCHEMA = "site string, cycle long, category_index int, page int, payload string, failed boolean, cycle_pages long"


def fingerprint(categories: list[tuple[int, int]]) -> str:
    return hashlib.sha256(json.dumps(categories).encode()).hexdigest()[:16]


def read_plan(path: str) -> dict[str, list[tuple[int, int]]]:
    """``category_index, pages`` of every site, in order."""
    store, root = store_of(path)
    out: dict[str, list[tuple[int, int]]] = {}
    for row in dataset.dataset(root, filesystem=store, format="parquet").to_table(columns=["site", "category_index", "pages"]).to_pylist():
        if row["site"] is not None and (row["pages"] or 0) > 0:
            out.setdefault(row["site"], []).append((int(row["category_index"]), int(row["pages"])))
    return {site: sorted(categories) for site, categories in out.items()}


def next_cursor(cursor: dict | None, categories: list[tuple[int, int]], budget: int) -> dict:
    """The cursor after a slice: ``cycle, mark, taken, pages`` and the ``begin`` of the slice within its cycle."""
    mark, pages = fingerprint(categories), sum(n for _, n in categories)
    cycle, begin = (cursor["cycle"], cursor["taken"]) if cursor else (0, 0)
    if cursor and (cursor["mark"] != mark or begin >= cursor["pages"]):
        cycle, begin = cycle + 1, 0
    return {"cycle": cycle, "mark": mark, "begin": begin, "taken": min(pages, begin + budget), "pages": pages, "categories": categories}


@dataclass
class Slice(InputPartition):
    site: str
    cycle: int
    pages: int
    wanted: list[tuple[int, int, int]]  # category, first and last page


def wanted_pages(cursor: dict) -> list[tuple[int, int, int]]:
    """The pages of a slice, from 1 on in each category."""
    out, at = [], 0
    for category, n in cursor["categories"]:
        low, high = max(cursor["begin"], at), min(cursor["taken"], at + n)
        if low < high:
            out.append((category, low - at + 1, high - at))
        at += n
    return out


class _Reader(DataSourceStreamReader):
    def __init__(self, plan: str, pages: str, budget: int):
        self.plan, self.pages, self.budget = plan, pages, budget
        self.at: dict[str, dict] | None = None  # where the stream stands

    def initialOffset(self) -> dict:
        return {"sites": "{}"}

    def latestOffset(self) -> dict:
        plan, now = read_plan(self.plan), self.at or {}
        after = {site: next_cursor(now.get(site), categories, self.budget) for site, categories in plan.items()}
        return {"sites": json.dumps({site: c for site, c in now.items() if site not in plan} | after, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        before, after = json.loads(start["sites"]), json.loads(end["sites"])
        self.at = after
        return [Slice(site, c["cycle"], c["pages"], wanted_pages(c)) for site, c in sorted(after.items()) if c != before.get(site)]

    def commit(self, end: dict) -> None:
        self.at = json.loads(end["sites"])

    def read(self, partition: Slice) -> Iterator[tuple]:
        store, root = store_of(self.pages)
        pages = dataset.dataset(root, filesystem=store, format="parquet")
        field = dataset.field
        for category, first, last in partition.wanted:
            there = (field("site") == partition.site) & (field("category_index") == category) & (field("page") >= first) & (field("page") <= last)
            found = pages.to_table(columns=["page", "payload"], filter=there & field("payload").is_valid())
            payloads = dict(zip(found.column("page").cast(pa.int64()).to_pylist(), found.column("payload").to_pylist(), strict=True))
            for page in range(first, last + 1):
                yield partition.site, partition.cycle, category, page, payloads.get(page), page not in payloads, partition.pages


class ListingSource(DataSource):
    """Options: ``plan`` and ``pages``, folders of Parquet, and ``budget``, pages a site and slice."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["plan"], self.options["pages"], int(self.options.get("budget", "100")))


def listing_stream(spark: SparkSession, plan: str, pages: str, budget: int = 100) -> DataFrame:
    """``SCHEMA``: a slice of every site a micro-batch."""
    ship(spark)
    spark.dataSource.register(ListingSource)
    return spark.readStream.format(FORMAT).options(plan=plan, pages=pages, budget=str(budget)).load()


def cycles(stream: DataFrame) -> DataFrame:
    """``site, cycle, pages, failed, state`` of every cycle that a batch has touched (output mode ``update``):
    ``open``, and once all its pages are taken ``final``, or ``degraded`` if some have failed. Only what a final
    cycle has not seen may count as missing."""
    seen = stream.groupBy("site", "cycle").agg(F.count("*").alias("pages"), F.count_if("failed").alias("failed"), F.max("cycle_pages").alias("_all"))
    state = F.when(F.col("pages") < F.col("_all"), "open").when(F.col("failed") > 0, "degraded").otherwise("final")
    return seen.select("site", "cycle", "pages", "failed", state.alias("state"))
