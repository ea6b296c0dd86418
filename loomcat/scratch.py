"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import threading
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share, one an application: inside
    ``spark.checkpoint.dir`` of the session. Where that is unset, inside the warehouse, but on a
    cluster not inside one that is a machine's own folder: that fails.

    ``clean_scratch`` removes what an application has written here."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if folder.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share; the warehouse, {folder}, is a folder of each machine")
    return f"{folder.rstrip('/')}/loomcat-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage, so a lost executor costs no recomputation, and a
    result that several later steps read is computed once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _folders[out] = path
    if held := getattr(_blocks, "held", None):
        held[-1].append(out)
    return out


_blocks = threading.local()


@contextmanager
def discarding(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Removes at its end what ``materialise`` wrote within, but for the frames that the block puts
    into the list it is given. Nothing that goes on may read from the rest."""
    held: list[DataFrame] = []
    kept: list[DataFrame] = []
    _blocks.held = [*getattr(_blocks, "held", []), held]
    try:
        yield kept
    finally:
        _blocks.held = _blocks.held[:-1]
        stay = [df for df in held if any(df is k for k in kept)]
        if _blocks.held:
            _blocks.held[-1] += stay
        discard(spark, *[df for df in held if not any(df is k for k in stay)])


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(spark: SparkSession, *frames: DataFrame) -> None:
    """Remove written tables that ``materialise`` gave and that nothing will read any more."""
    for df in frames:
        if folder := _folders.pop(df, None):
            remove(spark, folder)


def clean_scratch(spark: SparkSession) -> None:
    """Remove all that the operators of this application have written into the shared
    folder. Their results read from there: write or collect these first."""
    remove(spark, shared_folder(spark))


def file_path(spark: SparkSession, folder: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)


def remove(spark: SparkSession, folder: str) -> None:
    path = file_path(spark, folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
