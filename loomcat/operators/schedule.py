"""Failure streaks, backoff, retries and worklists."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import placed_in

# From so many failures in a row on, a source rests for so many hours.
BACKOFF_HOURS = ((7, 336), (6, 168), (5, 72), (4, 24), (3, 12))


def failure_streaks(runs: DataFrame, source: str = "source") -> DataFrame:
    """``source, failures, last_failed_at`` of sources whose newest decided runs failed.

    A success or partial run ends the streak; running and skipped ones neither count nor
    end it, nor do failures of our own network or store (``unreachable_only``, and
    ``db_partial_only`` if the log has it). A run without a time is the oldest."""
    ended = F.col("status").isin("success", "partial")
    since = runs.groupBy(source).agg(F.max(F.when(ended, F.coalesce("started_at", F.lit("0001-01-01").cast("timestamp")))).alias("_ended"))
    own = [F.coalesce(F.col(c), F.lit(False)) for c in ("unreachable_only", "db_partial_only") if c in runs.columns]
    failed = runs.filter(functools.reduce(lambda a, x: a & ~x, own, F.col("status") == "failed"))
    after = failed.join(since, source).filter(F.col("_ended").isNull() | (F.col("started_at") > F.col("_ended")))
    return after.groupBy(source).agg(F.count("*").alias("failures"), F.max("started_at").alias("last_failed_at"))


def backoff_hours(failures: Column) -> Column:
    out = None
    for least, hours in BACKOFF_HOURS:
        out = F.when(failures >= least, hours) if out is None else out.when(failures >= least, hours)
    return out.otherwise(0)


def resting(streaks: DataFrame, now: Column) -> DataFrame:
    """With ``wait_hours`` and ``rest_seconds``, what is left of the wait at ``now``."""
    waited = F.unix_timestamp(now) - F.unix_timestamp(F.col("last_failed_at"))
    out = streaks.withColumn("wait_hours", backoff_hours(F.col("failures")))
    return out.withColumn("rest_seconds", F.greatest(F.col("wait_hours") * 3600 - waited, F.lit(0)).cast("long"))


def breaker(streaks: DataFrame, now: Column, least: int = 3) -> DataFrame:
    """With ``breaker``: ``closed`` while a source fails less than ``least`` times in a row, ``open`` while it rests, then
    ``half_open``: its next run decides, a failure lengthens the streak and the rest, a success ends both."""
    state = F.when(F.col("failures") < least, "closed").when(F.col("rest_seconds") > 0, "open").otherwise("half_open")
    return resting(streaks, now).withColumn("breaker", state)


def round_robin(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """With ``turn``: the row's place in its group (``order`` has no ties); rows of one turn come before the next."""
    return placed_in(df, [group], *order, name="turn")


def diverse_top(df: DataFrame, brand: str, category: str, k: int, *order: Column) -> DataFrame:
    """The ``k`` rows of each brand that take turns over its categories, largest first."""
    turn = df.withColumn("turn", F.row_number().over(Window.partitionBy(brand, category).orderBy(*order))).filter(F.col("turn") <= k)  # no later row can be picked
    sized = turn.join(df.groupBy(brand, category).agg(F.count("*").alias("_n")), [brand, category])
    pick = Window.partitionBy(brand).orderBy("turn", F.desc("_n"), category)
    return sized.withColumn("pick", F.row_number().over(pick)).filter(F.col("pick") <= k).drop("_n")


def worklist(sources: DataFrame, streaks: DataFrame, counts: DataFrame, source: str, least: int) -> DataFrame:
    """Every source with ``skip``: null if it is to run, else why not."""
    joined = sources.join(streaks, source, "left").join(counts, source, "left")
    skip = F.when(~F.col("enabled"), "disabled").when(F.coalesce("failures", F.lit(0)) >= 3, "resting").when(F.coalesce("rows", F.lit(0)) < least, "too_few_rows")
    return joined.withColumn("skip", skip)


def retry_at(reason: Column, now: Column, requested: Column) -> Column:
    """The later of the reason's delay and what was asked for."""
    minutes = F.when(reason == "rate_limited", 60).when(reason == "blocked", 1440).otherwise(30)
    return F.greatest(F.timestamp_seconds(F.unix_timestamp(now) + minutes * 60), F.coalesce(requested, now))


# Words of messages, and the cause that they tell.
CAUSE_WORDS = {
    "robots_unread": ("robots.txt fetch failed", "robots.txt body read failed"),
    "barred": ("robots", "disallow"),
    "exhausted": ("timeout", "fetch failed"),
    "moved": ("category", "catalog"),
}
# The code of each cause, the most telling cause first.
CAUSE_CODES = {
    "robots_unread": "transient_exhausted",
    "barred": "external_block",
    "gone": "endpoint_removed",
    "exhausted": "transient_exhausted",
    "read": "db_read_failed",
    "write": "db_write_failed",
    "guard": "coverage_guard",
    "moved": "config_drift",
    "unknown": "source_failed",
}


def message_causes(message: Column) -> Column:
    """What a message tells: by the status numbers that it names after ``http``, and by its words."""
    low = F.lower(message)
    numbers = F.transform(F.regexp_extract_all(low, F.lit(r"http ([0-9]{3})"), 1), lambda x: x.cast("int"))
    named = lambda test: F.exists(numbers, test)
    by_number = {"barred": named(lambda n: n == 403), "gone": named(lambda n: n.isin(404, 410)), "exhausted": named(lambda n: (n == 429) | n.between(500, 599))}
    told = lambda cause: functools.reduce(lambda a, w: a | F.contains(low, F.lit(w)), CAUSE_WORDS.get(cause, ()), by_number.get(cause, F.lit(False)))
    return F.array_compact(F.array(*[F.when(told(cause), cause) for cause in dict.fromkeys([*CAUSE_WORDS, *by_number])]))


def exception_code(status: Column, errors: Column, read_failed: Column, write_failed: Column, guarded: Column) -> Column:
    """Why a run of a source failed; null if it didn't. The causes that its messages tell and
    those that it knows of itself are one set; the most telling of them decides."""
    own = {"read": read_failed, "write": write_failed, "guard": guarded | (status == "skipped")}
    known = F.array_compact(F.array(*[F.when(flag, cause) for cause, flag in own.items()], F.lit("unknown")))
    causes = F.concat(F.flatten(F.transform(F.array_compact(errors), message_causes)), known)
    order, codes = (F.array(*map(F.lit, x)) for x in (CAUSE_CODES, CAUSE_CODES.values()))
    best = F.array_min(F.transform(causes, lambda c: F.array_position(order, c)))
    return F.when(~status.isin("success", "partial"), F.element_at(codes, best.cast("int")))


def pairs(message: Column, name: str) -> Column:
    """The values of the pairs ``name=value`` in a message, the name in any case, at the beginning of a word."""
    begins = F.array_remove(F.split(F.regexp_replace(message, f"(?i)(?<![A-Za-z0-9_]){name}=", "\n\u0000"), "[\\s|]"), "")
    return F.transform(F.filter(begins, lambda w: F.startswith(w, F.lit("\u0000"))), lambda w: F.substring(w, 2, 2**31 - 1))


def retry_from(errors: Column) -> Column:
    """The first usable time of the pairs ``retry_at=time`` in some messages."""
    times = F.transform(F.flatten(F.transform(F.array_compact(errors), lambda e: pairs(e, "retry_at"))), lambda v: v.try_cast("timestamp"))
    return F.get(F.array_compact(times), 0)


def http_class(status: Column) -> Column:
    gone, barred = status.isin(404, 410), status.isin(401, 403)
    return F.when(gone, "removed").when(barred, "blocked").when((status == 429) | (status >= 500), "transient").when(status.between(200, 399), "confirmed").otherwise("unreadable")
