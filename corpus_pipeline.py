"""The corpus pipeline: quality, near-duplicates, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``docs``; what a stage decides, it does: rejected documents and all but one of a group
go, secrets are masked, and the last stage gives every piece its place in a sequence.
``run`` writes each stage's rows as Parquet and reads them back as the next one's; what the
stage has read and written besides is removed then.

``ORACLE_SQL`` is None: SQL can't express the stages; ``tests/llm`` holds them against
brute-force versions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomcat.llm import near_dedup, packing, quality, secrets
from loomcat.llm.common import discard, discarding, materialise, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps; it learns from the labelled ones of the input."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id."""
    return near_dedup.keep_one(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked; ``n_chars`` follows a text that changes."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with discarding(spark) as kept:
            done = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
            kept.append(done)
        discard(spark, docs)  # what the stage before has written
        docs = done
    return docs
