"""Operators on empty input return empty results (no crash)."""

from pyspark.sql import functions as F

from eddy.operators import grouping, ordered, state, windows
from eddy.plans import prefix


def test_empty_inputs(spark):
    ev = spark.createDataFrame([], "event_id long, user_id long, ts timestamp_ntz, cmd string, by int")
    assert prefix.with_index(ev, ["event_id"], "i").count() == 0
    assert prefix.with_index(ev, ["event_id"], "i", partition_by=["user_id"]).count() == 0
    assert ordered.take_while(ev, ["event_id"], F.col("by") > 0).count() == 0
    assert windows.drop_late(ev, "ts", ["event_id"], 10).count() == 0
    assert windows.window_lifecycle(ev, "ts", ["event_id"], 10, "1 hour").count() == 0
    assert state.suppress_in_flight(ev, "user_id", "event_id", "ts", 10).count() == 0
    assert state.grouped_within(ev, "user_id", "event_id", "ts", 3, 10, direct_rows=0).count() == 0
    assert state.run_machine(ev, state.CatMachine(), "user_id", "event_id", ts="ts", timeout_us=10).count() == 0
    assert grouping.join_fragments(ev.withColumn("t", F.lit("x")), "user_id", "event_id", "t").count() == 0
