"""Property tests (hypothesis): the chunked scan equals a one-partition
window for any data and chunk width; replaying a cart's journal equals
folding its commands one by one."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.plans import prefix

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(-20, 20)), min_size=1, max_size=60),
       width=st.floats(1.0, 40.0), exclusive=st.booleans(), reverse=st.booleans(),
       chunk_rows=st.sampled_from([2, 8, 1 << 20]))
def test_scan_equals_window(spark, rows, width, exclusive, reverse, chunk_rows):
    data = [(i * 3 + (i % 2), k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, k long, v long")
    got = prefix.running(df, ["id"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))},
                         partition_by=["k"], exclusive=exclusive, reverse=reverse, chunk_width=width,
                         chunk_rows=chunk_rows)
    order = F.col("id").desc() if reverse else F.col("id")
    w = Window.partitionBy("k").orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                           -1 if exclusive else 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"))
    assert sorted(tuple(r) for r in got.select("id", "s", "m").collect()) == \
        sorted(tuple(r) for r in want.collect())


def _fold(cmds):
    """Cart semantics, one command at a time."""
    opened, items, order = False, {}, []
    for cmd, item, q in cmds:
        if not opened:
            if cmd == "add":
                opened, items[item] = True, q
            continue
        if cmd == "update":
            items[item] = q
        elif cmd == "remove":
            items.pop(item, None)
    return items


@SETTINGS
@given(cmds=st.lists(st.tuples(st.sampled_from(["add", "update", "remove", "get"]),
                               st.sampled_from(["a", "b", "c"]), st.integers(1, 9)), min_size=1, max_size=25))
def test_replay_equals_live(spark, cmds):
    df = spark.createDataFrame([(1, i, c, it, q) for i, (c, it, q) in enumerate(cmds)],
                               "cart long, seq long, cmd string, item string, quantity int")
    got = {r["item"]: r["quantity"] for r in state.cart_state(state.cart_journal(df)).collect()}
    assert got == _fold(cmds)


def test_two_phase_equals_one_pass(spark):
    from eddy.operators import text

    from .conftest import SF_SMALL
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    one = {tuple(r) for r in text.word_counts(d, "text").collect()}
    two = {tuple(r) for r in text.word_counts_two_phase(d, "text", F.xxhash64("doc_id"), 5).collect()}
    assert one == two


@SETTINGS
@given(n_files=st.sampled_from([1, 2, 5]))
def test_stream_fsm_equals_batch_for_any_split(spark, n_files):
    from eddy.session import scratch_path
    from eddy.streaming import staging, stateful

    from .conftest import SF_SMALL
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    ev = ev.withColumn("cmd", F.when(F.col("event_type") == "signup", "wake")
                              .when(F.col("event_type") == "view", "stroke")
                              .when(F.col("event_type") == "purchase", "grow")
                              .when(F.col("event_type") == "error", "sleep").otherwise("other")) \
           .withColumn("by", (F.pmod("event_id", F.lit(7)) + 1).cast("int")).drop("event_type")
    base = scratch_path(spark, "split")
    staging.stage_files(ev, f"{base}/in", n_files, "event_id")
    stream = staging.read_staged(spark, f"{base}/in", ev.schema)
    out = stateful.run_machine(stream, state.CatMachine(), "user_id", "event_id", ts="ts",
                               timeout_us=6 * 3600 * 10**6)
    q = (out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{base}/ckpt")
            .trigger(availableNow=True).start(f"{base}/out"))
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{base}/out")
           .select("event_id", "state", "hunger", "reply").collect()}
    want = {tuple(r) for r in state.run_machine(ev, state.CatMachine(), "user_id", "event_id", ts="ts",
                                                 timeout_us=6 * 3600 * 10**6)
            .select("event_id", "state", "hunger", "reply").collect()}
    assert got == want
