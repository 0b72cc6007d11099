"""Timers on keyed streams against plain loops, for several cuts of the
input, a crash before the commit, nulls and late rows."""

import pytest
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.streaming import staging, timers

from .test_stream_scans import _run

MIN = 60 * 10**6
CMDS = ("wake", "stroke", "sleep", "grow", "other")
SCHEMA = "id long, k string, ts timestamp_ntz, cmd string, by int, at_us string, first_id int"


def _table(spark):
    """Rows of five keys (one null), some late, some without a time; two of
    the columns are named like the operator's."""
    rows, clock = [], 0
    for i in range(120):
        clock += (i * 37) % 11 * MIN
        us = None if i % 23 == 0 else clock - ((i * 7) % 9) * 5 * MIN
        rows.append((i, None if i % 5 == 4 else f"k{i % 5 * (i % 3)}", us, CMDS[i * i % 5], i % 7, "x", i))
    rows += [(200, "solo", clock, "sleep", 0, "x", 0), (201, "other", clock + 300 * MIN, "wake", 0, "x", 0)]
    df = spark.createDataFrame(rows, "id long, k string, us long, cmd string, by int, at_us string, first_id int")
    return rows, df.withColumn("ts", F.timestamp_micros("us").cast("timestamp_ntz")) \
                   .select("id", "k", "ts", "cmd", "by", "at_us", "first_id")


def _counted(rows, delay):
    """(id, key, counted time, cmd, by) and the last watermark."""
    top, out = None, []
    for i, k, us, cmd, by, *_ in rows:
        top = us if top is None else top if us is None else max(top, us)
        at = 0 if top is None else top - delay if us is None else max(us, top - delay)
        out.append((i, k, at, cmd, by))
    return out, top - delay


def _batches(rows, n, duration, delay):
    rows, wm = _counted(rows, delay)
    open_, clock, out = {}, {}, []

    def close(k, by):
        b = open_.pop(k)
        out.append((k, b["ids"][0], b["ids"][-1], len(b["ids"]), by,
                    clock[k] if by == "full" else b["opened"] + duration))
    for i, k, at, *_ in rows:
        at = max(at, clock.get(k, at))
        if k in open_ and at >= open_[k]["opened"] + duration:
            close(k, "timer")
        clock[k] = at
        open_.setdefault(k, {"opened": at, "ids": []})["ids"].append(i)
        if len(open_[k]["ids"]) == n:
            close(k, "full")
    for k in [k for k, b in open_.items() if b["opened"] + duration <= wm]:
        close(k, "timer")
    return out


@pytest.mark.parametrize("n_files,crash_at,direct_rows", [(1, None, 32768), (4, 2, 32768), (3, 1, 4)])
def test_batches_close_by_timer(spark, scratch, n_files, crash_at, direct_rows):
    rows, df = _table(spark)
    n, duration, delay = 4, 40 * MIN, 15 * MIN
    staging.stage_files(df, f"{scratch}/in", n_files, "id")
    _run(staging.read_staged(spark, f"{scratch}/in", df.schema),
         timers.grouped_within(scratch, "k", "id", "ts", n, duration, delay, direct_rows=direct_rows), scratch, crash_at)
    want = _batches(rows, n, duration, delay)
    got = spark.read.parquet(f"{scratch}/batches").drop("batch_id")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[0] == "solo" and w[4] == "timer" for w in want)  # no further row of that key
    held = spark.read.parquet(f"{scratch}/rows")
    assert held.columns == [*df.columns, "opened_by", "batch_id"]
    assert held.groupBy("opened_by").count().count() == len(want)
    assert held.count() == sum(w[3] for w in want)
    last = spark.read.parquet(f"{scratch}/batches").agg(F.max("batch_id")).first()[0]
    left = spark.read.parquet(f"{scratch}/open/batch_id={last}")
    assert left.count() == len(rows) - held.count()
    _, wm = _counted(rows, delay)
    assert spark.read.parquet(f"{scratch}/clock/batch_id={last}").filter(F.col("ahead_us") <= wm).isEmpty()


def _cat(rows, timeout, delay, ttl):
    from collections import namedtuple
    m = state.CatMachine()
    ev = namedtuple("event", m.event_cols)
    rows, wm = _counted(rows, delay)
    cur, out = {}, []

    def timer(k):
        one, at, i = cur[k]
        then = m.step_one(one, ev(None, None, True))
        if then != one:
            out.append((k, i, "timer", at + timeout, *m.describe(then).values(), None))
    for i, k, at, cmd, by in rows:
        one, gap = m.initial, None
        if k in cur:
            one, gap = cur[k][0], at - cur[k][1]
            if gap >= timeout:
                timer(k)
        expired = gap is not None and ttl is not None and gap >= ttl
        e = ev(cmd, by, gap is not None and gap >= timeout and not expired)
        one = m.initial if expired else one
        reply, one = m.reply(one, e), m.step_one(one, e)
        cur[k] = (one, at, i)
        out.append((k, i, "event", at, *m.describe(one).values(), reply))
    for k in cur:
        if cur[k][1] + timeout <= wm:
            timer(k)
    return out, {k for k, c in cur.items() if ttl is None or c[1] + ttl > wm}


@pytest.mark.parametrize("n_files,crash_at,ttl,chunk_rows", [
    (1, None, None, 1 << 15), (4, 2, 60 * MIN, 1 << 15), (6, 1, 60 * MIN, 4)])
def test_transitions_by_timer(spark, scratch, n_files, crash_at, ttl, chunk_rows):
    rows, df = _table(spark)
    staging.stage_files(df, f"{scratch}/in", n_files, "id")
    _run(staging.read_staged(spark, f"{scratch}/in", df.schema),
         timers.run_machine(scratch, state.CatMachine(), "k", "id", "ts", 20 * MIN, 15 * MIN, ttl, chunk_rows),
         scratch, crash_at)
    want, alive = _cat(rows, 20 * MIN, 15 * MIN, ttl)
    got = spark.read.parquet(f"{scratch}/out").select("k", "id", "kind", "at_us", "state", "hunger", "reply")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(w[:3] == ("solo", 200, "timer") for w in want)
    last = spark.read.parquet(f"{scratch}/out").agg(F.max("batch_id")).first()[0]
    assert {r["key"] for r in spark.read.parquet(f"{scratch}/state/batch_id={last}").collect()} == alive


def test_ttl_is_longer_than_timeout():
    with pytest.raises(ValueError):
        timers.run_machine("x", state.CatMachine(), "k", "id", "ts", 10, 0, 10)
