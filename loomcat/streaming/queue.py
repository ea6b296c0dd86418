"""A queue of refresh candidates: observations, leased claims, checkpoints and outcomes.

Commands are rows ``id, at, seq, kind, revision, token, outcome, matched``; ``apply`` says
what one does to a candidate. ``replay`` runs a table of commands, ``serve`` a stream of
them with the same function, where a lease that ends without a word releases the claim.

| kind | what it does |
|---|---|
| ``observe`` | a newer revision starts over (``discovered``, or ``brand_unmatched`` unless ``matched``); an older one is ``stale`` |
| ``claim`` | takes a candidate that is open or whose lease has ended, for ``lease`` long; after ``most`` attempts it is ``blocked`` |
| ``heartbeat`` | renews the lease of its own claim |
| ``checkpoint`` | keeps the prepared revision (``ready``) if it is still the newest |
| ``publish`` | ``imported``, if the newest revision is prepared |
| ``finish`` | ``retry`` (``failed``, at last ``blocked``), ``rejected``, ``release`` (as before the claim), ``stale`` (``awaiting_observation``) |

A command whose token doesn't hold the claim, or comes after its lease, is ``lost_claim``
and changes nothing; one of an old revision is ``stale``.

A worker that wants ``n`` candidates reads the queue's own state (``stream_states`` or
``states``), takes the oldest open ones over all keys (``next_claims``) and sends their claims as commands; of
two workers that want the same one the queue gives it to the first. What a worker has claimed but not begun
when its time is up it lets go (``releases``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# What can be claimed, by status.
OPEN = ("discovered", "ready", "failed")
COMMANDS = "id long, at timestamp, seq long, kind string, revision long, token string, outcome string, matched boolean"
STATE = "status string, revision long, prepared long, token string, lease_until long, attempts int, since long"
RESULTS = "id long, seq long, outcome string, status string, revision long, attempts int"


@dataclass
class Candidate:
    status: str = ""
    revision: int = -1
    prepared: int = -1
    token: str = ""
    lease_until: int = 0  # milliseconds
    attempts: int = 0
    since: int = 0  # milliseconds, when the newest revision was observed

    def open_status(self) -> str:
        return "ready" if self.prepared == self.revision >= 0 else "discovered"

    def let_go(self, status: str) -> None:
        self.status, self.token, self.lease_until = status, "", 0


def apply(c: Candidate, now: int, kind: str, revision: int, token: str, outcome: str, matched: bool, lease: int, most: int) -> str:
    """Change ``c`` by a command at ``now`` (milliseconds) and say what came of it."""
    if kind == "observe":
        if revision <= c.revision:
            return "unchanged" if revision == c.revision else "stale"
        c.revision, c.attempts, c.since = revision, 0, now
        c.let_go("discovered" if matched else "brand_unmatched")
        return "observed"
    if c.revision < 0:
        return "unknown"
    if kind == "claim":
        if c.status not in OPEN and not (c.token and now >= c.lease_until):
            return "not_open"
        if c.attempts >= most:
            c.let_go("blocked")
            return "blocked"
        c.status, c.token, c.lease_until, c.attempts = "enriching", token, now + lease, c.attempts + 1
        return "claimed"
    if not token or token != c.token or now >= c.lease_until:
        return "lost_claim"
    if kind == "heartbeat":
        c.lease_until = now + lease
        return "alive"
    if kind == "finish":
        if outcome == "retry":
            c.let_go("blocked" if c.attempts >= most else "failed")
        elif outcome == "rejected":
            c.let_go("rejected")
        elif outcome == "release":
            c.attempts -= 1
            c.let_go(c.open_status())
        elif outcome == "stale":
            c.let_go("awaiting_observation")
        else:
            return "unknown"
        return outcome
    if revision != c.revision:
        return "stale"
    if kind == "checkpoint":
        c.status, c.prepared = "ready", revision
        return "kept"
    if kind == "publish":
        if c.prepared != revision:
            return "not_prepared"
        c.let_go("imported")
        return "imported"
    return "unknown"


def _columns(batch: pd.DataFrame) -> Iterator[tuple]:
    """The commands of a batch as ``apply`` takes them, after id and seq."""
    at = batch["at"].astype("datetime64[us]").astype("int64") // 1000
    plain = lambda c, none: batch[c].where(batch[c].notna(), none)
    return zip(batch["id"], batch["seq"], at.tolist(), batch["kind"], plain("revision", -1).astype("int64").tolist(), plain("token", ""), plain("outcome", ""), plain("matched", False).astype(bool).tolist(), strict=True)


def replay(commands: DataFrame, lease_seconds: int = 14_400, most: int = 3) -> DataFrame:
    """``id, seq, outcome, status, revision, attempts`` after each command, by time and ``seq``.

    Commands are sorted by candidate inside partitions and pass one after the other, so a
    task holds one candidate's state however many commands it has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, c = None, Candidate()
        for batch in batches:
            out = []
            for i, seq, *command in _columns(batch):
                if i != last:
                    last, c = i, Candidate()
                said = apply(c, *command, lease_seconds * 1000, most)
                out.append((i, seq, said, c.status, c.revision, c.attempts))
            yield pd.DataFrame(out, columns=["id", "seq", "outcome", "status", "revision", "attempts"])

    return _by_candidate(commands).mapInPandas(run, RESULTS)


def _by_candidate(commands: DataFrame) -> DataFrame:
    known = commands.filter("id is not null and at is not null").select(*[x.split()[0] for x in COMMANDS.split(", ")])
    return known.repartition("id").sortWithinPartitions("id", "at", "seq")


def states(commands: DataFrame, lease_seconds: int = 14_400, most: int = 3) -> DataFrame:
    """``id`` and ``STATE`` of every candidate after all commands."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["id", *[x.split()[0] for x in STATE.split(", ")]]
        last, c = None, Candidate()
        for batch in batches:
            out = []
            for i, _, *command in _columns(batch):
                if i != last:
                    out += [(last, *astuple(c))] if last is not None else []
                    last, c = i, Candidate()
                apply(c, *command, lease_seconds * 1000, most)
            yield pd.DataFrame(out, columns=names)
        if last is not None:
            yield pd.DataFrame([(last, *astuple(c))], columns=names)

    return _by_candidate(commands).mapInPandas(run, f"id long, {STATE}")


def stream_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``id`` and ``STATE`` of every candidate of a stream of ``serve``, as of its last batch, read from its state store."""
    read = spark.read.format("statestore").option("stateVarName", "candidate").load(checkpoint)
    return read.select("key.id", "value.*")


def next_claims(held: DataFrame, n: int, now: Column, most: int = 3) -> DataFrame:
    """The ``n`` candidates that were observed first (ties: by id) of those that can be claimed at
    ``now``: open, or with a lease that has ended, and not tried ``most`` times yet. The best of every
    task meet in one, ``n`` a task."""
    at = F.unix_millis(now)
    free = F.col("status").isin(*OPEN) | ((F.col("token") != "") & (F.col("lease_until") <= at))
    return held.filter(free & (F.col("attempts") < most)).orderBy("since", "id").limit(n).select("id", "revision", "since")


def claim_commands(chosen: DataFrame, token: str, now: Column, first_seq: int) -> DataFrame:
    """The commands by which a worker claims ``chosen``."""
    none = F.lit(None).cast("string")
    order = F.row_number().over(Window.orderBy("since", "id")) - 1  # as few rows as a worker asks for
    return chosen.select("id", now.alias("at"), (order + first_seq).cast("long").alias("seq"), F.lit("claim").alias("kind"), F.col("revision").cast("long"), F.lit(token).alias("token"), none.alias("outcome"), F.lit(None).cast("boolean").alias("matched"))


def releases(held: DataFrame, token: str, begun: DataFrame, now: Column, first_seq: int) -> DataFrame:
    """The commands by which a worker lets go what it holds and has not begun (``begun`` has ``id``)."""
    mine = held.filter((F.col("token") == token) & (F.col("lease_until") > F.unix_millis(now))).join(begun.select("id"), "id", "left_anti")
    return claim_commands(mine, token, now, first_seq).withColumns({"kind": F.lit("finish"), "outcome": F.lit("release")})


class QueueProcessor(StatefulProcessor):
    """The queue as a stream: state by candidate, and a timer for each lease."""

    def __init__(self, lease_seconds: int, most: int):
        self.lease, self.most = lease_seconds * 1000, most

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("candidate", STATE)

    def _row(self, key: tuple, seq: int, said: str, c: Candidate) -> pd.DataFrame:
        return pd.DataFrame({"id": [key[0]], "seq": [seq], "outcome": [said], "status": [c.status], "revision": [c.revision], "attempts": [c.attempts]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        c = Candidate(*self.state.get()) if self.state.exists() else Candidate()
        for batch in rows:
            for _, seq, *command in _columns(batch.sort_values(["at", "seq"])):
                yield self._row(key, seq, apply(c, *command, self.lease, self.most), c)
        self.state.update(astuple(c))
        if c.token:
            self.handle.registerTimer(max(c.lease_until, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        c = Candidate(*self.state.get()) if self.state.exists() else Candidate()
        if c.token and c.lease_until <= expiredTimerInfo.getExpiryTimeInMs():
            c.let_go(c.open_status())
            self.state.update(astuple(c))
            yield self._row(key, -1, "expired", c)

    def close(self) -> None:
        pass


def serve(stream: DataFrame, lease_seconds: int = 14_400, most: int = 3, late: str = "1 day") -> DataFrame:
    """``replay`` over a stream, in event time. The session's state store must be RocksDB
    (``spark.sql.streaming.stateStore.providerClass``)."""
    known = stream.filter("id is not null and at is not null").withWatermark("at", late)
    return known.groupBy("id").transformWithStateInPandas(QueueProcessor(lease_seconds, most), RESULTS, "Update", "EventTime")


def final_status(results: DataFrame) -> DataFrame:
    """``id, status, attempts, commands`` of every candidate, from ``replay``'s rows in order of ``seq``."""
    last = F.max(F.struct("seq", "status", "attempts"))
    return results.groupBy("id").agg(last.alias("last"), F.count("*").alias("commands")).select("id", "last.status", "last.attempts", "commands")
