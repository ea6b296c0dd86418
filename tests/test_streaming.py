import datetime as dt

from loomcat.streaming import candidates, listing_source, queue
from pyspark.sql import functions as F

SCHEMA = "user_id long, ts timestamp, event_id long, event_type string"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def feed(spark, folder, batches):
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/in/{k}")
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{folder}/in")


def run(stream, folder, mode, sink):
    q = stream.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


BATCHES = [
    [(1, at(0), 1, "click"), (2, at(0), 2, "error"), (3, at(1), 3, "click")],
    [(1, at(2), 4, "purchase"), (2, at(3), 5, "error"), (2, at(1), 6, "click"), (4, at(2), 7, "view")],
]


def test_tracking_agrees_with_the_replay(spark, tmp_path):
    seen = {}

    def sink(df, _):
        seen.update({r.user_id: (r.status, r.attempts) for r in df.collect() if r.status != "released"})

    run(candidates.track(feed(spark, f"file://{tmp_path}", BATCHES), most=2), f"file://{tmp_path}", "update", sink)
    rows = [r for b in BATCHES for r in b]
    wanted = {r.user_id: (r.status, r.attempts) for r in candidates.replay(spark.createDataFrame(rows, SCHEMA), most=2).collect()}
    assert seen == wanted == {1: ("imported", 0), 2: ("rejected", 2), 3: ("claimed", 0)}


def test_a_lease_that_ends_releases_the_claim(spark, tmp_path):
    out = []
    batches = [[(3, at(0), 1, "click")], [(9, at(80), 2, "purchase")], [(9, at(81), 3, "purchase")]]
    run(candidates.track(feed(spark, f"file://{tmp_path}", batches), most=2), f"file://{tmp_path}", "update", lambda df, _: out.extend((r.user_id, r.status) for r in df.collect()))
    assert (3, "released") in out and out.index((3, "claimed")) < out.index((3, "released"))


def test_windows_drop_late_rows(spark, tmp_path):
    batches = [[(1, at(0), 1, "view"), (1, at(1), 2, "view")], [(1, at(100), 3, "view")], [(1, at(100), 7, "view")], [(1, at(2), 4, "view"), (1, at(101), 5, "view")], [(1, at(300), 6, "view")]]
    out = {}
    run(candidates.windowed(feed(spark, f"file://{tmp_path}", batches)), f"file://{tmp_path}", "append", lambda df, _: out.update({(r.start, r.event_type): r.n for r in df.collect()}))
    assert out[(at(0), "view")] == 2  # the row of hour 2 came after the watermark had passed its window


def test_merged_batches(spark, tmp_path):
    folder = f"file://{tmp_path}"
    batches = [[(1, at(0), 1, "a"), (2, at(0), 2, "b")], [(1, at(1), 3, "c")], [(3, at(1), 4, "d")], [(2, at(2), 5, "e")], [(1, at(2), 6, "f")]]
    stream = feed(spark, folder, batches)
    run(stream, folder, "append", candidates.merge_batch(f"{folder}/table", ["user_id"], every=2))
    schema = stream.schema
    table = lambda k: sorted((r.user_id, r.event_type) for r in candidates.merged_table(spark, f"{folder}/table", ["user_id"], schema, k).collect())
    assert table(4) == [(1, "f"), (2, "e"), (3, "d")] and table(3) == [(1, "c"), (2, "e"), (3, "d")]
    kept = {p.name for p in (tmp_path / "table" / "delta").iterdir()}
    assert kept == {"2", "3", "4"} and {p.name for p in (tmp_path / "table" / "base").iterdir()} == {"1", "3"}
    spark.read.parquet(f"{folder}/table/delta/4").write.mode("overwrite").parquet(f"{folder}/again")
    candidates.merge_batch(f"{folder}/table", ["user_id"], every=2)(spark.read.parquet(f"{folder}/again"), 4)  # a batch that is retried
    assert table(4) == [(1, "f"), (2, "e"), (3, "d")]


COMMANDS = [  # id, hour, kind, revision, token, outcome, matched, what comes of it, status after it
    (1, 0, "claim", 1, "a", None, None, "unknown", ""), (1, 1, "observe", 1, None, None, True, "observed", "discovered"), (1, 2, "claim", None, "a", None, None, "claimed", "enriching"),
    (1, 2, "claim", None, "b", None, None, "not_open", "enriching"), (1, 3, "heartbeat", None, "b", None, None, "lost_claim", "enriching"), (1, 5, "heartbeat", None, "a", None, None, "alive", "enriching"),
    (1, 8, "checkpoint", 1, "a", None, None, "kept", "ready"), (1, 8, "publish", 1, "a", None, None, "imported", "imported"), (1, 8, "publish", 1, "a", None, None, "lost_claim", "imported"),
    (2, 0, "observe", 5, None, None, False, "observed", "brand_unmatched"), (2, 1, "claim", None, "a", None, None, "not_open", "brand_unmatched"), (2, 2, "observe", 4, None, None, True, "stale", "brand_unmatched"),
    (2, 3, "observe", 6, None, None, True, "observed", "discovered"), (2, 4, "claim", None, "a", None, None, "claimed", "enriching"), (2, 4, "checkpoint", 5, "a", None, None, "stale", "enriching"),
    (2, 5, "finish", None, "a", "stale", None, "stale", "awaiting_observation"), (3, 0, "observe", 1, None, None, True, "observed", "discovered"), (3, 1, "claim", None, "a", None, None, "claimed", "enriching"),
    (3, 1, "finish", None, "a", "retry", None, "retry", "failed"), (3, 2, "claim", None, "b", None, None, "claimed", "enriching"), (3, 2, "finish", None, "b", "retry", None, "retry", "blocked"),
    (4, 0, "observe", 1, None, None, True, "observed", "discovered"), (4, 1, "claim", None, "a", None, None, "claimed", "enriching"), (4, 2, "finish", None, "a", "release", None, "release", "discovered"),
    (4, 3, "claim", None, "a", None, None, "claimed", "enriching"), (4, 9, "publish", 1, "a", None, None, "lost_claim", "enriching"), (4, 10, "claim", None, "b", None, None, "claimed", "enriching"),
    (4, 10, "finish", None, "b", "rejected", None, "rejected", "rejected"),
]


def commands(spark):
    rows = [(i, at(h), k, kind, rev, token, out, ok) for k, (i, h, kind, rev, token, out, ok, _, _) in enumerate(COMMANDS)]
    return spark.createDataFrame(rows, queue.COMMANDS)


def test_queue_replay(spark):
    got = sorted((r.seq, r.outcome, r.status) for r in queue.replay(commands(spark).repartition(3), 4 * 3600, most=2).collect())
    assert got == [(k, c[7], c[8]) for k, c in enumerate(COMMANDS)]
    assert queue.replay(commands(spark).limit(0)).count() == 0
    last = {r.id: (r.status, r.attempts) for r in queue.final_status(queue.replay(commands(spark), 4 * 3600, most=2)).collect()}
    assert last == {1: ("imported", 1), 2: ("awaiting_observation", 1), 3: ("blocked", 2), 4: ("rejected", 2)}


def test_queue_stream_agrees_and_releases(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out, rows = [], commands(spark).collect()
    late = [r for r in rows if r.at >= at(5)]
    batches = [[r for r in rows if r.at < at(5)], late, [(8, at(20), 90, "observe", 1, None, None, True), (8, at(20), 91, "claim", None, "a", None, None)], [(9, at(90), 92, "observe", 1, None, None, True)], [(9, at(95), 93, "observe", 2, None, None, True)]]
    for k, b in enumerate(batches):
        spark.createDataFrame(b, queue.COMMANDS).coalesce(1).write.parquet(f"file://{tmp_path}/in/{k}")
    stream = spark.readStream.schema(queue.COMMANDS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/in")
    try:
        run(queue.serve(stream, 4 * 3600, most=2), f"file://{tmp_path}", "update", lambda df, _: out.extend((r.seq, r.outcome, r.status, r.id) for r in df.collect()))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert sorted(r[:3] for r in out if 0 <= r[0] < 90) == [(k, c[7], c[8]) for k, c in enumerate(COMMANDS)]
    assert (-1, "expired", "discovered", 8) in out


def test_claims_over_all_keys(spark, tmp_path):
    """Two workers that ask at once, from the stream's own state, against a plain simulation."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    folder, out = f"file://{tmp_path}", []
    observed = [(k, at((7 * k) % 13), k, "observe", 1, None, None, k % 5 != 0) for k in range(30)]
    early = [(3, at(14), 100, "claim", None, "z", None, None), (4, at(14), 101, "claim", None, "z", None, None), (4, at(15), 102, "finish", None, "z", "retry", None)]
    now, lease = F.lit(at(20)).cast("timestamp"), 3600

    def put(name, rows):
        (rows if hasattr(rows, "write") else spark.createDataFrame(rows, queue.COMMANDS)).select(*[x.split()[0] for x in queue.COMMANDS.split(", ")]).coalesce(1).write.parquet(f"{folder}/in/{name}")

    def serve():
        stream = spark.readStream.schema(queue.COMMANDS).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        run(queue.serve(stream, lease, most=2), folder, "update", lambda df, _: out.extend((r.seq, r.id, r.outcome) for r in df.collect() if r.seq >= 0))

    try:
        put("0", observed + early)
        serve()
        held = queue.stream_states(spark, f"{folder}/checkpoint")
        wanted = sorted((at((7 * k) % 13), k) for k in range(30) if k % 5)  # the lease of 3 has ended, 4 has failed once
        batch = {r.id: tuple(r) for r in queue.states(spark.createDataFrame(observed + early, queue.COMMANDS), lease, most=2).collect()}
        assert {r.id: tuple(r) for r in held.select("id", *[x.split()[0] for x in queue.STATE.split(", ")]).collect()} == batch
        ask = lambda n: queue.next_claims(held, n, now, most=2)
        assert [r.id for r in ask(10).collect()] == [k for _, k in wanted[:10]]
        a, b = (queue.claim_commands(ask(n), token, now, seq) for n, token, seq in ((6, "a", 200), (9, "b", 300)))
        put("1", a.unionByName(b))
        out.clear()
        serve()
        assert sorted((i, said) for seq, i, said in out if seq < 300) == sorted((k, "claimed") for _, k in wanted[:6])
        assert sorted((i, said) for seq, i, said in out if seq >= 300) == sorted([(k, "not_open") for _, k in wanted[:6]] + [(k, "claimed") for _, k in wanted[6:9]])
        held = queue.stream_states(spark, f"{folder}/checkpoint")
        begun = spark.createDataFrame([(k,) for _, k in wanted[:2]], "id long")
        put("2", queue.releases(held, "a", begun, F.lit(at(20) + dt.timedelta(minutes=5)).cast("timestamp"), 400))
        out.clear()
        serve()
        assert sorted((i, said) for _, i, said in out) == sorted((k, "release") for _, k in wanted[2:6])
        held = queue.stream_states(spark, f"{folder}/checkpoint")
        assert [r.id for r in queue.next_claims(held, 5, now, most=2).collect()] == [k for _, k in wanted[2:6] + wanted[9:10]]
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_a_listing_as_a_stream(spark, tmp_path):
    """Stopped and started again after every slice: no page is lost or repeated; changed categories start over; a degraded cycle is not final."""
    folder = f"file://{tmp_path}"

    def plan(name, **sites):
        spark.createDataFrame([(s, c, n) for s, categories in sites.items() for c, n in enumerate(categories)], "site string, category_index int, pages int").coalesce(1).write.mode("overwrite").parquet(f"{folder}/plan")

    missing = {("b", 1, 2)}
    pages = [(s, c, p, f"{s}{c}-{p}") for s in "abc" for c in range(4) for p in range(1, 8) if (s, c, p) not in missing]
    spark.createDataFrame(pages, "site string, category_index int, page int, payload string").repartition(3).write.parquet(f"{folder}/pages")
    rows, states = [], {}

    def run_slice():
        stream = listing_source.listing_stream(spark, f"{folder}/plan", f"{folder}/pages", budget=4)
        q = stream.writeStream.foreachBatch(lambda df, _: rows.extend(map(tuple, df.collect()))).option("checkpointLocation", f"{folder}/rows-checkpoint").trigger(availableNow=True).start()
        q.awaitTermination(300)
        q = listing_source.cycles(listing_source.listing_stream(spark, f"{folder}/plan", f"{folder}/pages", budget=4)).writeStream.outputMode("update").foreachBatch(lambda df, _: states.update({(r.site, r.cycle): (r.pages, r.failed, r.state) for r in df.collect()})).option("checkpointLocation", f"{folder}/cycle-checkpoint").trigger(availableNow=True).start()
        q.awaitTermination(300)

    plan("first", a=[3, 2], b=[2, 3], c=[1])
    run_slice()
    assert states == {("a", 0): (4, 0, "open"), ("b", 0): (4, 1, "open"), ("c", 0): (1, 0, "final")}
    run_slice()
    assert states == {("a", 0): (5, 0, "final"), ("b", 0): (5, 1, "degraded"), ("c", 0): (1, 0, "final"), ("c", 1): (1, 0, "final")}
    plan("second", a=[3, 2], b=[2, 3, 7], c=[1])
    run_slice()
    assert states[("a", 1)] == (4, 0, "open") and states[("b", 1)] == (4, 1, "open")
    plan("third", a=[6], b=[2, 3, 7])
    run_slice()
    assert states[("a", 1)] == (4, 0, "open") and states[("a", 2)] == (4, 0, "open") and states[("b", 1)] == (8, 1, "open") and ("c", 3) not in states
    by_cycle = {}
    for site, cycle, category, page, payload, failed, _ in rows:
        by_cycle.setdefault((site, cycle), []).append((category, page))
        assert payload == (None if failed else f"{site}{category}-{page}") and failed == ((site, category, page) in missing)
    assert {k: sorted(v) for k, v in by_cycle.items()} == {
        ("a", 0): [(0, 1), (0, 2), (0, 3), (1, 1), (1, 2)], ("b", 0): [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3)], ("c", 0): [(0, 1)], ("c", 1): [(0, 1)], ("c", 2): [(0, 1)],
        ("a", 1): [(0, 1), (0, 2), (0, 3), (1, 1)], ("a", 2): [(0, 1), (0, 2), (0, 3), (0, 4)], ("b", 1): [(0, 1), (0, 2), (1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)],
    }
