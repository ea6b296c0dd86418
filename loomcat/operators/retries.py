"""Updates that another writer may get in the way of: compare, set, and look again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def compare_and_set(updates: DataFrame, fields: list[str], read: Callable[[], DataFrame], write: Callable[[DataFrame], DataFrame], rounds: int = 3) -> DataFrame:
    """``id, outcome, round`` of every update.

    ``updates`` has ``id``, ``version`` (that the update was decided on), ``observed_at`` and ``fields``. ``read`` gives the
    store as it is, ``id, version, observed_at`` and ``fields``; ``write`` takes rows ``id, version`` and what to set, sets
    those whose stored version is still that one, and gives the ``id`` of these.

    A round takes the rows that are left only, and reads the store anew: a row is ``gone``, is ``unchanged`` (the store
    holds the same already), is ``abandoned`` (the store has seen the product later), or is written against
    the version that it finds (in the first round, the one it was decided on). What another writer was faster with is left for
    the next round, and after the last one ``conflicted``."""
    left = materialise(updates.select("id", "version", "observed_at", *fields), "updates")
    done: DataFrame | None = None

    def settle(rows: DataFrame) -> None:
        nonlocal done
        done = rows if done is None else done.unionByName(rows)

    for turn in range(1, rounds + 1):
        now = read().select("id", F.col("version").alias("_version"), F.col("observed_at").alias("_seen"), F.struct(*fields).alias("_fields"))
        same = F.struct(*fields).eqNullSafe(F.col("_fields"))
        verdict = F.when(F.col("_version").isNull(), "gone").when(same, "unchanged").when(F.col("_seen") > F.col("observed_at"), "abandoned")
        # decided on a version that is no longer there: the row is decided again on the one that is
        judged = materialise(left.join(now, "id", "left").withColumn("outcome", verdict).withColumn("_stale", F.lit(turn == 1) & ~F.col("version").eqNullSafe(F.col("_version"))), "judged")
        settle(judged.filter("outcome is not null").select("id", "outcome", F.lit(turn).alias("round")))
        open_ = judged.filter("outcome is null")
        wrote = materialise(write(open_.filter("not _stale").select("id", F.col("_version").alias("version"), "observed_at", *fields)).select("id"), "written")
        settle(wrote.select("id", F.lit("written").alias("outcome"), F.lit(turn).alias("round")))
        left = materialise(open_.join(wrote, "id", "left_anti").select("id", F.col("_version").alias("version"), "observed_at", *fields), "updates")
        if left.isEmpty():
            return done
    return done.unionByName(left.select("id", F.lit("conflicted").alias("outcome"), F.lit(rounds).alias("round")))
