"""Zip of two live streams, live carts and fragments over micro-batches
against plain loops, with crashes before the commit."""

import pytest
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.streaming import carts, staging, timers, zips

from .test_stream_scans import _run

MIN = 60 * 10**6


def _side(spark, scratch, name, n, n_files, col):
    rows = [(i, None if i % 7 == 3 else i % 3, None if i % 11 == 0 else f"{name}{i}") for i in range(n)]
    df = spark.createDataFrame(rows, f"id long, p int, `{col}` string")
    staging.stage_files(df, f"{scratch}/in_{name}", n_files, "id")
    return rows, staging.read_staged(spark, f"{scratch}/in_{name}", df.schema)


@pytest.mark.parametrize("sizes,files,crash_at", [((40, 25), (2, 5), 3), ((20, 60), (5, 1), None)])
def test_zip_of_two_streams(spark, scratch, sizes, files, crash_at):
    # Columns are named like the operator's, one with a dot.
    (left, ls), (right, rs) = (_side(spark, scratch, n, *a) for n, a in zip("lr", zip(sizes, files, ("pos", "a.b"))))
    _run(zips.both_sides(ls, rs, "id", "p"), zips.zip_streams(scratch), scratch, crash_at)
    want = []
    for p in (None, 0, 1, 2):
        a, b = ([r for r in rows if r[1] == p] for rows in (left, right))
        want += [(p, i, *x, *y) for i, (x, y) in enumerate(zip(a, b))]
    got = spark.read.parquet(f"{scratch}/out").drop("batch_id")
    assert got.columns == ["partition", "pos", "left_id", "left_p", "left_pos", "right_id", "right_p", "right_a.b"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    # Of the log only micro-batches with rows that wait (and the last ones) are left.
    kept = spark.read.parquet(f"{scratch}/rows").select("batch_id").distinct().count()
    assert kept <= max(files)


def _commands(n):
    return [(i, None if i % 13 == 5 else i * i % 4, ("update", "add", "get", "remove", "add")[i * 3 % 5],
             None if i % 17 == 2 else i % 3, i % 5) for i in range(n)]


def _replayed(rows):
    opened, items, replies = set(), {}, []
    for seq, cart, cmd, item, q in rows:
        if cart is None:
            continue
        reply = "unhandled" if cmd == "add" and cart in opened else "ok" if cmd == "add" or cart in opened else "ItemNotFound"
        if reply == "ok" and cmd == "add":
            opened.add(cart)
        if reply == "ok" and cmd in ("add", "update"):
            items[cart, item] = (q, seq)
        if reply == "ok" and cmd == "remove":
            items.pop((cart, item), None)
        replies.append((seq, cart, cmd, reply))
    return replies, [(*k, *v) for k, v in items.items()]


@pytest.mark.parametrize("n_files,every,crash_at", [(5, 2, 3), (4, 10, 1), (3, 1, 2)])
def test_live_carts_equal_replay(spark, scratch, n_files, every, crash_at):
    rows = _commands(90)
    df = spark.createDataFrame(rows, "seq long, cart long, cmd string, item int, quantity int")
    staging.stage_files(df, f"{scratch}/in", n_files, "seq")
    after = []

    def step(batch, batch_id, fn=carts.live_carts(scratch, every)):
        fn(batch, batch_id)
        after.append((batch_id, sorted(map(tuple, carts.contents(spark, scratch, df.schema, batch_id, every).collect()),
                                       key=str)))
    _run(staging.read_staged(spark, f"{scratch}/in", df.schema), step, scratch, crash_at)
    replies, _ = _replayed(rows)
    got = spark.read.parquet(f"{scratch}/replies").select("seq", "cart", "cmd", "reply")
    assert sorted(map(tuple, got.collect())) == replies
    assert len(after) == n_files + 1  # the crashed one twice
    for b, items in after:
        upto = 90 * (b + 1) // n_files
        assert items == sorted(_replayed([r for r in rows if r[0] < upto])[1], key=str)
    # The contents are read from the last snapshot and the tail only.
    files = carts.contents(spark, scratch, df.schema, every=every).inputFiles()
    last = n_files // every * every - 1
    assert all(int(f.split("journal/batch_id=")[1].split("/")[0]) > last for f in files if "/journal/" in f)


def test_fragments_over_batches(spark, scratch):
    # (seq, key, minute, index, last, text): out of order; no mark; late; null text and key.
    rows = [(0, "a", 0, 1, False, "A1"), (1, "b", 1, 0, False, "B0"), (2, "a", 2, 2, True, "A2"),
            (3, None, 3, 0, False, "N0"), (4, "a", 8, 0, False, "A0"), (5, "b", 9, 1, False, None),
            (6, "c", 10, 0, True, "C0"), (7, None, 11, 1, True, "N1"), (8, "d", 12, 1, True, "D1"),
            (9, "b", 40, 2, True, "B2"), (10, "e", 60, 0, False, "E0"), (11, "f", 61, 0, True, "F0")]
    df = spark.createDataFrame(rows, "seq long, k string, m long, i int, last boolean, text string") \
        .select("seq", "k", F.timestamp_micros(F.col("m") * MIN).alias("ts"), "i", "last", "text")
    staging.stage_files(df, f"{scratch}/in", 4, "seq")
    _run(staging.read_staged(spark, f"{scratch}/in", df.schema),
         timers.join_fragments(scratch, "k", "seq", "ts", "i", "last", "text", 20 * MIN, 0), scratch, 2)
    got = spark.read.parquet(f"{scratch}/messages").select("k", "opened_by", "message", "fragments").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("a", 0, "A0A1A2", 3), ("b", 1, "B0", 2), (None, 3, "N0N1", 2), ("c", 6, "C0", 1), ("d", 8, "D1", 1),
        ("b", 9, "B2", 1), ("f", 11, "F0", 1)], key=str)
    how = {r["first_id"]: r["closed_by"] for r in spark.read.parquet(f"{scratch}/batches").collect()}
    assert how == {0: "complete", 1: "timer", 3: "complete", 6: "complete", 8: "timer", 9: "timer", 11: "complete"}


def test_carts_opened_before(spark):
    cmds = spark.createDataFrame([(1, 5, "get"), (2, 6, "update"), (1, 7, "add")], "cart int, seq int, cmd string")
    opened = spark.createDataFrame([(1, 2)], "cart int, init int")
    got = state.cart_accepted(cmds, opened_before=opened).select("seq", "reply").collect()
    assert sorted(map(tuple, got)) == [(5, "ok"), (6, "ItemNotFound"), (7, "unhandled")]
