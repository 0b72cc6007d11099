"""Crashes and restarts of logs and streams, and the greedy keyed scans and
the prefix scan on inputs that are not kind."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.plans import prefix
from eddy.sources import tables, topiclog
from eddy.streaming import control, delivery, staging, stateful

from .conftest import SF_SMALL
from .test_log_tables import _recs

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


class Crash(RuntimeError):
    pass


def crash_at(monkeypatch, name, at):
    """Let a method of the log crash at its ``at``-th call."""
    real, calls = getattr(topiclog.TopicLog, name), {"n": 0}

    def method(self, *a):
        calls["n"] += 1
        if calls["n"] == at:
            raise Crash(name)
        return real(self, *a)

    monkeypatch.setattr(topiclog.TopicLog, name, method)


def places(df):
    return sorted((r["partition"], r["offset"], r["value"].decode()) for r in df.collect())


def test_crashed_batch_is_never_read(spark, scratch, monkeypatch):
    """Batch 1 crashes before its mark, batch 2 commits: no row of batch 1 is
    seen, and the offsets of batch 2 follow batch 0's."""
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    log.append(_recs(spark, 4), ["i"], batch_id=0)
    crash_at(monkeypatch, "_commit", 1)
    with pytest.raises(Crash):
        log.append(_recs(spark, 4, start=100), ["i"], batch_id=1)
    log.append(_recs(spark, 2, start=200), ["i"], batch_id=2)
    want = [(0, 0, "v0"), (0, 1, "v2"), (0, 2, "v200"), (1, 0, "v1"), (1, 1, "v3"), (1, 2, "v201")]
    assert places(log.read()) == want
    out = f"{scratch}/out"
    q = log.read_stream().writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ckpt").trigger(
        availableNow=True).start(out)
    q.awaitTermination()
    assert places(spark.read.parquet(out)) == want


def test_next_append_after_a_crash_keeps_nothing_of_it(spark, scratch, monkeypatch):
    """The next append takes the same id but other partitions."""
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    log.append(_recs(spark, 4), ["i"])
    crash_at(monkeypatch, "_commit", 1)
    with pytest.raises(Crash):
        log.append(_recs(spark, 4, start=100), ["i"])
    log.append(_recs(spark, 4, start=200).filter("partition = 0"), ["i"])
    assert [v for p, _, v in places(log.read()) if p == 1] == ["v1", "v3"]


def test_crash_between_mark_and_move_is_finished(spark, scratch, monkeypatch):
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    crash_at(monkeypatch, "_publish", 1)
    with pytest.raises(Crash):
        log.append(_recs(spark, 4), ["i"], batch_id=7)
    again = topiclog.TopicLog(spark, f"{scratch}/log")
    assert again.read().count() == 4 and again.has_batch(7)
    again.append(_recs(spark, 4), ["i"], batch_id=7)  # a replay writes nothing
    assert again.read().count() == 4


def _events(spark, scratch, n_files=4, partitions=4, cols=("event_id", "user_id", "ts")):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(*cols).repartition(partitions)
    staging.stage_files(ev, f"{scratch}/in", n_files, "event_id")
    return ev, staging.read_staged(spark, f"{scratch}/in", ev.schema)


def _run_with_crash(stream, sink, scratch, crashes):
    """Run the stream, crash ``crashes`` times in batch 1 (before or after
    the sink as it says), restart on the same checkpoint."""
    left = {"n": 1}

    def each(batch, batch_id):
        crash = batch_id == 1 and left["n"]
        if crash and crashes == "before":
            left["n"] = 0
            raise Crash("before")
        sink(batch, batch_id)
        if crash and crashes == "after":
            left["n"] = 0
            raise Crash("after")

    control.run_with_backoff(lambda: stream.writeStream.foreachBatch(each).option(
        "checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(), sleep=lambda s: None)


def test_staging_keeps_order_over_partitions(spark, scratch):
    """Files from several input partitions still replay in order."""
    ev, stream = _events(spark, scratch)
    seen = []
    stream.writeStream.foreachBatch(lambda b, i: seen.append((i, b.agg(F.min("event_id"), F.max("event_id")).first()))) \
        .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 4
    assert all(a[1][1] < b[1][0] for a, b in zip(seen, seen[1:]))


def test_at_least_once_replay_overwrites(spark, scratch):
    ev, stream = _events(spark, scratch)
    _run_with_crash(stream, delivery.idempotent_writer(f"{scratch}/out"), scratch, "after")
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == ev.count() == got.select("event_id").distinct().count()


def test_at_most_once_loses_the_batch(spark, scratch):
    ev, stream = _events(spark, scratch)
    left = {"n": 1}

    def process(batch, batch_id):
        if batch_id == 1 and left["n"]:
            left["n"] = 0
            raise Crash("after the commit")
        batch.write.mode("append").parquet(f"{scratch}/out")

    sink = delivery.at_most_once(spark, f"{scratch}/commits", process)
    _run_with_crash(stream, sink, scratch, "never")
    got = spark.read.parquet(f"{scratch}/out")
    assert got.count() == got.select("event_id").distinct().count()
    assert 0 < ev.count() - got.count() < ev.count() / 2


def test_consume_publish_replay(spark, scratch):
    a = topiclog.TopicLog(spark, f"{scratch}/a")
    a.append(_recs(spark, 10), ["i"], batch_id=0)

    def move(b):
        src = b.select("key", F.col("value").alias("v"), F.col("partition").alias("p"), F.col("offset").alias("o"))
        return topiclog.records(src.withColumnRenamed("key", "k"), "b", F.col("p"), F.col("k"), F.col("v"))

    sink = delivery.consume_publish(spark, f"{scratch}/b", move, ["o"])
    left = {"n": 1}

    def each(batch, batch_id):
        sink(batch, batch_id)
        if left["n"]:
            left["n"] = 0
            raise Crash("after the publish")

    control.run_with_backoff(lambda: a.read_stream().writeStream.foreachBatch(each).option(
        "checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(), sleep=lambda s: None)
    assert places(topiclog.TopicLog(spark, f"{scratch}/b").read()) == places(a.read())


def test_resume_positions(spark, scratch):
    assert delivery.resume_positions(spark, f"{scratch}/store") == {}
    rows = spark.createDataFrame([("t", 0, 99), ("t", 1, 4), ("u", 1, 0)], "topic string, partition int, offset long")
    delivery.with_offsets(rows, 0).write.parquet(f"{scratch}/store")
    assert delivery.resume_positions(spark, f"{scratch}/store") == {("t", 0): 100, ("t", 1): 5, ("u", 1): 1}


def test_insert_writes_its_rows_only(spark, scratch):
    t = tables.KeyedTable(spark, f"{scratch}/t", key="k")
    t.insert(spark.range(1000).withColumnRenamed("id", "k"))
    t.insert(spark.range(1000, 1003).withColumnRenamed("id", "k"))
    assert spark.read.parquet(f"{scratch}/t/a=00000002").count() == 3
    assert t.current().count() == 1003


@pytest.mark.parametrize("arrow", [5, 10_000])
def test_stream_first_seen_over_chunks(spark, scratch, arrow):
    ev, stream = _events(spark, scratch, cols=("event_id", "user_id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(arrow))
    try:
        q = stateful.first_seen(stream, "user_id", "event_id").writeStream.format("parquet").option(
            "checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start(f"{scratch}/out")
        q.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {r.event_id for r in spark.read.parquet(f"{scratch}/out").filter("first_seen").collect()}
    assert got == {r[0] for r in ev.groupBy("user_id").agg(F.min("event_id")).select("min(event_id)").collect()}


# --- greedy keyed scans ------------------------------------------------------


def plain(rows, n, duration):
    """(accepted, batch) of each row id, one row at a time by the key's clock."""
    keys: dict = {}
    out = {}
    for i, k, t in sorted(rows):
        s = keys.setdefault(k, {"clock": state.NO_TIME, "free": None, "batch": -1, "opened": 0, "count": n})
        s["clock"] = max(s["clock"], state.NO_TIME if t is None else t)
        now = s["clock"]
        ok = s["free"] is None or now >= s["free"]
        if ok:
            s["free"] = now + duration
        if s["count"] >= n or now >= s["opened"] + duration:
            s["batch"], s["opened"], s["count"] = s["batch"] + 1, now, 0
        s["count"] += 1
        out[i] = (ok, s["batch"])
    return out


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.one_of(st.none(), st.integers(0, 60))), min_size=1,
                     max_size=50), n=st.integers(1, 4), duration=st.sampled_from([0, 1, 7, 25]),
       direct=st.sampled_from([1, 10**6]))
def test_greedy_equals_plain(spark, rows, n, duration, direct):
    data = [(i, k, t) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame([(*r, 2**53 + 1) for r in data], "id long, k long, t long, wide long")
    df = df.withColumn("wide", F.when(F.col("id") % 2 == 0, F.col("wide")))
    want = plain(data, n, duration)
    got = state.suppress_in_flight(df, "k", "id", "t", duration, direct_rows=direct).collect()
    assert {r.id: r.accepted for r in got} == {i: a for i, (a, _) in want.items()} and len(got) == len(rows)
    assert all(r.wide == (2**53 + 1 if r.id % 2 == 0 else None) for r in got)
    got = state.grouped_within(df, "k", "id", "t", n, duration, direct_rows=direct).collect()
    assert {r.id: r.batch for r in got} == {i: b for i, (_, b) in want.items()} and len(got) == len(rows)


def test_stream_greedy_with_late_rows(spark, scratch):
    rng = random.Random(8)
    rows = [(i, i % 7, 1_000_000 * (i * 10 - rng.randrange(300))) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, us long").select(
        "event_id", "user_id", F.timestamp_micros("us").alias("ts"))
    staging.stage_files(df, f"{scratch}/in", 5, "event_id")
    want = plain([(i, k, t) for i, k, t in rows], 4, 200_000_000)
    for name, op, at in (("a", lambda s: stateful.in_flight(s, "user_id", "event_id", "ts", 200_000_000), 0),
                         ("b", lambda s: stateful.grouped_within(s, "user_id", "event_id", "ts", 4, 200_000_000), 1)):
        q = op(staging.read_staged(spark, f"{scratch}/in", df.schema)).writeStream.format("parquet").option(
            "checkpointLocation", f"{scratch}/ckpt{name}").trigger(availableNow=True).start(f"{scratch}/{name}")
        q.awaitTermination()
        got = {r.event_id: r[2] for r in spark.read.parquet(f"{scratch}/{name}").collect()}
        assert got == {i: w[at] for i, w in want.items()}


def test_machine_keeps_null_keys(spark):
    ev = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3, "grow", 2, False) for i in range(60)],
                               "seq long, k long, cmd string, by int, timed_out boolean")
    for chunk in (4, 1000):
        got = state.run_machine(ev, state.CatMachine(), "k", "seq", chunk_rows=chunk).collect()
        assert len(got) == 60
        null = sorted((r.seq, r.hunger) for r in got if r.k is None)
        assert [h for _, h in null[:5]] == [62, 64, 66, 68, 70]


# --- prefix chunks -----------------------------------------------------------


@pytest.mark.parametrize("kind", ["outlier", "burst", "hash", "text"])
def test_chunks_are_balanced(spark, kind):
    n, chunk = 20_000, 500
    ids = spark.range(n)
    lead = {"outlier": F.when(F.col("id") == 7, F.lit(10**13)).otherwise(F.col("id")),
            "burst": F.when(F.col("id") % 3 == 0, F.lit(5_000)).otherwise(F.col("id")),
            "hash": F.xxhash64("id"), "text": F.hex(F.xxhash64("id"))}[kind]
    df = ids.withColumn("k", lead)
    cell, _ = prefix._chunk_plan(df, "k", chunk, False)
    src, cks = prefix._split_ties(df.withColumn("__c1", cell), ["k", "id"], [], chunk, False)
    assert src.groupBy(*cks).count().agg(F.max("count")).first()[0] <= 2 * chunk
    w = Window.orderBy("k", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.id, r.c) for r in df.withColumn("c", F.count(F.lit(1)).over(w)).collect()}
    for reverse in (False, True):
        got = prefix.running(df, ["k", "id"], {"c": ("count", None)}, chunk_rows=chunk, reverse=reverse).collect()
        assert {(r.id, n + 1 - r.c if reverse else r.c) for r in got} == want


def test_acknowledged_sink_on_a_stream(spark, scratch):
    """K7: init once, every batch acknowledged by the checkpoint after its
    hook returns, complete at the end."""
    from eddy import sinks

    ev, stream = _events(spark, scratch)
    seen = []
    sink = sinks.acknowledged(lambda: seen.append("init"), lambda b, i: seen.append((i, b.count())),
                              lambda: seen.append("complete"))
    _run_with_crash(stream, sink, scratch, "never")
    sink.complete()
    assert seen[0] == "init" and seen[-1] == "complete" and seen.count("init") == 1
    assert sum(n for _, n in seen[1:-1]) == ev.count() and [i for i, _ in seen[1:-1]] == [0, 1, 2, 3]


def test_fatal_row_stops_the_query(spark):
    """A fatal row fails the query; a row that does not parse is
    rejected."""
    from eddy.operators import routing

    df = spark.createDataFrame([("1",), ("x",), ("2",)], "t string")
    ok, rejected = routing.supervise(df, F.expr("try_cast(t as int)"))
    assert sorted(r.parsed for r in ok.collect()) == [1, 2] and [r.t for r in rejected.collect()] == ["x"]
    ok, _ = routing.supervise(df, F.expr("try_cast(t as int)"), fatal=F.col("t") == "2")
    with pytest.raises(Exception, match="fatal row"):
        ok.collect()


def test_console_prints_every_row(spark, capsys):
    from eddy import sinks

    sinks.console(spark.range(30))
    assert len(capsys.readouterr().out.splitlines()) == 30
    sinks.console(spark.range(30), n=4)
    assert len(capsys.readouterr().out.splitlines()) == 4
