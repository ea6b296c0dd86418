"""The life of refresh candidates: as a batch replay and as a stateful stream."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..scratch import file_path, remove

MOVES = ("click", "purchase", "error")


def replay(events: DataFrame, most: int) -> DataFrame:
    """``user_id, status, attempts`` after all events; the last one decides, an error is
    a retry until ``most`` attempts have failed. Partial aggregates only, so a hot key
    costs one row a task."""
    moves = events.filter(F.col("event_type").isin(*MOVES))
    last = F.max_by("event_type", F.struct("ts", "event_id"))
    g = moves.groupBy("user_id").agg(last.alias("_last"), F.count_if(F.col("event_type") == "error").alias("attempts"))
    status = F.when(F.col("_last") == "purchase", "imported").when(F.col("_last") == "error", F.when(F.col("attempts") >= most, "rejected").otherwise("retry")).otherwise("claimed")
    return g.select("user_id", status.alias("status"), "attempts")


def track(stream: DataFrame, most: int, lease: str = "4 hours", late: str = "1 day") -> DataFrame:
    """The same over a stream of ``user_id, ts, event_id, event_type``, in event time; a
    claim whose lease ends without a further event is released."""
    seconds = int(pd.Timedelta(lease).total_seconds())

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        status, attempts, ts, event = state.get if state.exists else ("", 0, 0, -1)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "status": ["released"], "attempts": [attempts]})
            return
        for batch in batches:
            for kind, when, i in zip(batch["event_type"], batch["ts"].astype("int64"), batch["event_id"], strict=True):
                attempts += kind == "error"
                if (when, i) >= (ts, event):
                    ts, event = int(when), int(i)
                    status = kind
        name = {"purchase": "imported", "click": "claimed"}.get(status, "rejected" if attempts >= most else "retry")
        state.update((status, attempts, ts, event))
        if name == "claimed":
            state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, ts // 10**6 + seconds * 1000))
        yield pd.DataFrame({"user_id": [key[0]], "status": [name], "attempts": [attempts]})

    moves = stream.filter(F.col("event_type").isin(*MOVES)).withWatermark("ts", late)
    return moves.groupBy("user_id").applyInPandasWithState(step, "user_id long, status string, attempts long", "status string, attempts long, ts long, event long", "update", GroupStateTimeout.EventTimeTimeout)


def windowed(stream: DataFrame, size: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Counts by event type and tumbling window; rows later than ``late`` are dropped."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select("w.start", "event_type", "n")


def merge_batch(path: str, keys: list[str], every: int = 16):
    """A ``foreachBatch`` writer that upserts each batch into a table under ``path``.

    A batch costs what it holds: its rows become a folder of their own, named by the batch,
    so that one that is retried writes the same folder again. Each ``every`` batches the
    folders are merged into a new base, and what only the base before it needed is removed."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/delta/{batch_id}")
        if (batch_id + 1) % every:
            return
        merged_table(spark, path, keys, batch.schema, batch_id).write.mode("overwrite").parquet(f"{path}/base/{batch_id}")
        before = batch_id - every  # a reader may still use the base before, so the one before that goes
        for k in range(max(0, before - every + 1), before + 1):
            remove(spark, f"{path}/delta/{k}")
        if before - every >= 0:
            remove(spark, f"{path}/base/{before - every}")

    return write


def merged_table(spark: SparkSession, path: str, keys: list[str], schema, upto: int) -> DataFrame:
    """The table after batch ``upto``: of each key the row of the newest batch; of one batch,
    the last by all columns. Reads the newest base before ``upto`` and the batches since."""
    exists = lambda p: _exists(spark, p)
    base = next((k for k in range(upto - 1, -1, -1) if exists(f"{path}/base/{k}")), -1)
    parts = [spark.read.schema(schema).parquet(f"{path}/base/{base}").withColumn("_batch", F.lit(-1))] if base >= 0 else []
    parts += [spark.read.schema(schema).parquet(f"{path}/delta/{k}").withColumn("_batch", F.lit(k)) for k in range(base + 1, upto + 1) if exists(f"{path}/delta/{k}")]
    values = [c for c in (f.name for f in schema.fields) if c not in keys]
    rows = functools.reduce(DataFrame.unionByName, parts)
    newest = rows.groupBy(*keys).agg(F.max(F.struct("_batch", *values)).alias("_row"))  # partial on the map side, so a hot key is one row a task
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in (f.name for f in schema.fields)])


def _exists(spark: SparkSession, folder: str) -> bool:
    path = file_path(spark, folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
