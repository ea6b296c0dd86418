"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import clean_scratch, discard, discarding, materialise, shared_folder
from ..shipping import ship

__all__ = ["clean_scratch", "discard", "discarding", "map_batches", "materialise", "shared_folder", "ship", "table", "text_or_empty", "tokenizer_file"]


def map_batches(source: DataFrame, run, columns: str) -> DataFrame:
    """``mapInPandas`` over a frame with a column ``id``, which comes first in the result.
    Whole-number ids travel as texts: pandas makes numbers with nulls among them inexact."""
    kind = source.schema["id"].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        return source.mapInPandas(run, f"id {kind}, {columns}")
    out = source.withColumn("id", F.col("id").cast("string")).mapInPandas(run, f"id string, {columns}")
    return out.withColumn("id", F.col("id").cast(kind))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name_or_path: str) -> str:
    """A tokenizer file: a path as it is, else a name that the public tokenizer
    package of the machine the task runs on resolves."""
    if os.path.exists(name_or_path):
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
