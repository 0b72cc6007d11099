"""Carried scans on streams equal the batch forms, for any cut of the
input into files and after a crash between carry and commit."""

import pytest
from pyspark.sql import functions as F

from eddy.operators import windows
from eddy.streaming import scans, shared, staging

from .conftest import SF_SMALL

HOUR = 3600 * 10**6


def _events(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "event_type", "user_id")
    shift = F.expr("make_dt_interval(0, cast(pmod(event_id * 7919, 5) as int), 0, 0)")
    odd = F.pmod("event_id", F.lit(50)) == 0  # some rows have no time
    return ev.select("event_id", F.when(~odd, F.col("ts") - shift).alias("ets"), "event_type",
                     F.when(F.col("event_id") > 20, F.col("user_id")).alias("v"))


def _run(stream, fn, scratch, crash_at=None):
    left = {"crashes": 0 if crash_at is None else 1}

    def step(batch, batch_id):
        fn(batch, batch_id)
        if batch_id == crash_at and left["crashes"]:
            left["crashes"] -= 1
            raise RuntimeError("crash after the carry, before the commit")

    for _ in range(2):
        q = (stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{scratch}/ckpt")
                   .trigger(availableNow=True).start())
        try:
            q.awaitTermination()
            return
        except Exception:  # noqa: BLE001
            assert left["crashes"] == 0
    raise AssertionError("the stream did not get through")


def _staged(spark, scratch, n_files):
    ev = _events(spark)
    staging.stage_files(ev, f"{scratch}/in", n_files, "event_id")
    return ev, staging.read_staged(spark, f"{scratch}/in", ev.schema)


def _rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("n_files,crash_at", [(1, None), (3, 1), (7, 4)])
def test_watermark_equals_batch(spark, scratch, n_files, crash_at):
    ev, stream = _staged(spark, scratch, n_files)
    _run(stream, scans.exact_watermark(scratch, "ets", ["event_id"], HOUR), scratch, crash_at)
    want = windows.exact_watermark(ev, "ets", ["event_id"], HOUR)
    cols = ("event_id", "ets", "wm", "late")
    assert _rows(spark.read.parquet(f"{scratch}/out"), *cols) == _rows(want, *cols)


@pytest.mark.parametrize("n_files,crash_at", [(2, 0), (6, 3)])
def test_window_commands_equal_batch(spark, scratch, n_files, crash_at):
    ev, stream = _staged(spark, scratch, n_files)
    _run(stream, scans.window_commands(scratch, "ets", ["event_id"], HOUR, "3 hours", "1 hour", ["event_type"]),
         scratch, crash_at)
    want = windows.window_lifecycle(ev, "ets", ["event_id"], HOUR, "3 hours", "1 hour", ["event_type"])
    got = scans.read_windows(spark, scratch, scans.window_schema(ev, "ets", "event_id", ["event_type"]))
    cols = ("window_start", "window_end", "event_type", "open_event", "n", "close_event")
    assert _rows(got, *cols) == _rows(want, *cols)


def test_totals_equal_loop(spark, scratch):
    ev, stream = _staged(spark, scratch, 5)
    _run(stream, scans.carried_totals(scratch, ["event_id"], "v"), scratch, 2)
    want, acc = [], None
    for i, r in enumerate(ev.orderBy("event_id").collect()):
        acc = acc if r["v"] is None else (acc or 0) + r["v"]
        want.append((r["event_id"], i, acc))
    assert _rows(spark.read.parquet(f"{scratch}/out"), "event_id", "idx", "acc") == sorted(want, key=str)


def test_shared_ids_of_two_streams(spark, scratch):
    sides = []
    for side in range(2):
        df = spark.createDataFrame([(i, k, f"2024-01-01 {h:02d}:00:00") for i, (k, h) in enumerate(
            [(1, 0), (2, 1), (None, 1), (3 + side, 2), (1, 3), (2, 4)])], "i long, k int, ts string")
        df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        staging.stage_files(df, f"{scratch}/in{side}", 3, "i")
        sides.append(staging.read_staged(spark, f"{scratch}/in{side}", df.schema))
    out = shared.shared_ids(sides, "k", "ts", "1 day")
    (out.writeStream.format("parquet").option("checkpointLocation", f"{scratch}/ckpt")
        .trigger(availableNow=True).start(f"{scratch}/ids").awaitTermination())
    got = [r["k"] for r in spark.read.parquet(f"{scratch}/ids").collect()]
    assert sorted(got, key=str) == [1, 2, 3, 4, None]
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "DeduplicateWithinWatermark" in plan
