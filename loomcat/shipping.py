"""The package itself, for the executors' Python workers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once an application. The archive stays
    on the driver, whose file server hands it out, until the process ends."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix=f"{package.name}-")
    atexit.register(shutil.rmtree, folder, True)
    path = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over two tasks a core: before work that takes long for a row, as a file of few bytes, or of one row
    group, is a single task's however many rows it has. More tasks would each read rules and selectors anew."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
