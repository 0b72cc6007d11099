"""Keyed streams whose timers fire by the watermark, without a further row
of that key (A12's period, F4's inactivity timer).

State is kept as tables beside the stream, as in :mod:`eddy.streaming.scans`:
micro-batch ``b`` reads what ``b - 1`` left, works on its rows with the batch
operators (which cut a hot key into chunks), lets due timers fire, and writes
output and state under its id before the checkpoint commits.  A batch tried
again overwrites both, so every transition and every batch comes once.

Time is the row-exact watermark's: a row counts at its own time or at the
watermark (largest time so far minus ``max_delay``) where that is later, a
row without a time at the watermark (before any time: at the epoch).  So no
row can come before a timer that has fired, and the result does not depend
on how the input is cut into micro-batches.  Null keys are a key.  Rows must
arrive in ``order_by`` order across batches; inside one any order will do.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.operators import grouping, state, windows
from eddy.plans import prefix
from eddy.plans.joins import join_small
from eddy.session import cut_lineage
from eddy.streaming import scans


def counted_at(rows: DataFrame, ts: str, order_by: str, max_delay_us: int, top: int | None = None,
               name: str = "__at_us") -> DataFrame:
    """Adds the time a row counts at, in microseconds (see above).  ``top``
    is the largest time before the first row."""
    out = windows.exact_watermark(rows, ts, [order_by], max_delay_us, "__wm", carry_us=top)
    at = F.greatest(prefix.order_number(out, ts), prefix.order_number(out, "__wm"))
    return out.withColumn(name, F.coalesce(at, F.lit(0)).cast("long")).drop("__wm", "late")


def _left(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    return spark.read.parquet(f"{path}/batch_id={batch_id - 1}") if batch_id else None


def _keep(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    scans._drop(rows.sparkSession, f"{path}/batch_id={batch_id - 2}")


def _advance(batch: DataFrame, ts: str, top: int | None, max_delay_us: int) -> tuple[int | None, int]:
    """The largest time after ``batch`` and the watermark it gives."""
    after = scans._top(batch, ts, top).first()["top_us"]
    return after, state.NO_TIME if after is None else after - max_delay_us


def grouped_within(path: str, key: str, order_by: str, ts: str, n: int, duration_us: int, max_delay_us: int,
                   name: str = "opened_by", direct_rows: int = state.DIRECT_KEY_ROWS,
                   complete: Column | None = None) -> Callable[[DataFrame, int], None]:
    """A12 with its timer: a ``foreachBatch`` function.  A batch of a key
    closes with its ``n``-th row, or ``duration`` after it opened, as soon
    as the watermark (or a row of the key) is that far.

    ``path/batches`` gets one row per closed batch: the key, ``first_id``,
    ``last_id``, ``n``, ``closed_by`` (``full`` or ``timer``) and ``at_us``;
    (with ``complete``, a condition on aggregates of ``row.*``, also
    ``complete``: the batch has all it waits for); ``path/rows`` the rows with the ``first_id`` of their batch as ``name``.  The state
    is the rows of open batches (fewer than ``n`` of a key), and the clock
    of keys whose largest time is ahead of the watermark; both go when the
    watermark has passed them."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = scans._carried(spark, f"{path}/carry", batch_id)
        top = None if was is None else was["top_us"]
        after, wm = _advance(batch, ts, top, max_delay_us)
        # The user's columns travel as one struct, so their names can't clash.
        rows = counted_at(batch, ts, order_by, max_delay_us, top).select(
            state._key_text(key).alias("key_text"), F.col(key).alias("key"), F.col(order_by).alias("seq"),
            F.col("__at_us").alias("at_us"), F.struct(*[F.col(f"`{c}`") for c in batch.columns]).alias("row"))
        waiting, ahead = (_left(spark, f"{path}/{t}", batch_id) for t in ("open", "clock"))
        if ahead is not None:
            rows = join_small(rows, ahead, on="key_text", how="left") \
                .withColumn("at_us", F.greatest("at_us", "ahead_us")).drop("ahead_us")
            rows = rows.unionByName(waiting)
        # The clock never falls along a key, so a batch's first row has its opening time.
        rows = prefix.running(rows, ["seq"], {"clock": ("max", F.col("at_us"))}, partition_by=["key_text"])
        rows = rows.drop("at_us").withColumnRenamed("clock", "at_us")
        rows = cut_lineage(state.grouped_within(rows, "key", "seq", "at_us", n, duration_us, "batch_no",
                                                direct_rows))
        groups = cut_lineage(rows.groupBy("key_text", "batch_no").agg(
            F.first("key").alias("key"), F.min("seq").alias("first_id"), F.max("seq").alias("last_id"),
            F.count(F.lit(1)).alias("n"), F.min("at_us").alias("opened"), F.max("at_us").alias("clock"),
            F.coalesce(F.lit(False) if complete is None else complete, F.lit(False)).alias("whole")))
        newest = groups.groupBy("key_text").agg(F.max("batch_no").alias("newest"), F.max("clock").alias("ahead_us"))
        full = F.col("n") == F.lit(n)
        due = F.col("opened") + F.lit(duration_us)
        groups = join_small(groups, newest, on="key_text", how="left").withColumn(
            "closed", full | F.col("whole") | (F.col("batch_no") < F.col("newest")) | (due <= F.lit(wm)))
        closed = groups.filter("closed").select(
            F.col("key").alias(key), "first_id", "last_id", "n",
            F.when(full, "full").when(F.col("whole"), "complete").otherwise("timer").alias("closed_by"),
            F.when(full | F.col("whole"), F.col("clock")).otherwise(due).alias("at_us"))
        closed.write.mode("overwrite").parquet(f"{path}/batches/batch_id={batch_id}")
        tagged = rows.join(groups.select("key_text", "batch_no", "first_id", "closed"), on=["key_text", "batch_no"])
        (tagged.filter("closed").select("row.*", F.col("first_id").alias(name))
               .write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}"))
        _keep(tagged.filter("not closed").select("key_text", "key", "seq", "at_us", "row"), f"{path}/open", batch_id)
        clocks = newest.select("key_text", "ahead_us")
        if ahead is not None:
            clocks = clocks.unionByName(ahead).groupBy("key_text").agg(F.max("ahead_us").alias("ahead_us"))
        _keep(clocks.filter(F.col("ahead_us") > F.lit(wm)), f"{path}/clock", batch_id)
        scans._leave(spark.range(1).select(F.lit(after).cast("long").alias("top_us")), f"{path}/carry", batch_id)
    return run


def join_fragments(path: str, key: str, order_by: str, ts: str, index: str, last: str, text: str,
                   timeout_us: int, max_delay_us: int, sep: str = "") -> Callable[[DataFrame, int], None]:
    """S16 on a stream: a ``foreachBatch`` function that joins the
    fragments of each message, which may come in any order and in several
    micro-batches.  A message is complete when the fragment marked ``last``
    and all with a smaller ``index`` (from 0) have come; otherwise it comes
    out ``timeout`` after its first fragment with what there is, and a
    fragment that comes after that begins the message anew.

    ``path/messages`` gets the key, ``opened_by`` (its first fragment by
    ``order_by``), ``message`` (fragments by ``index``; null texts count as
    none) and ``fragments``; ``path/batches`` how each message closed."""
    # Fragments come once each, so all are there when their number says so.
    whole = F.count(F.lit(1)) == F.max(F.when(F.col(f"row.`{last}`"), F.col(f"row.`{index}`") + 1))
    close = grouped_within(path, key, order_by, ts, 1 << 40, timeout_us, max_delay_us, complete=whole)

    def run(batch: DataFrame, batch_id: int) -> None:
        close(batch, batch_id)
        spark = batch.sparkSession
        rows = spark.read.parquet(f"{path}/rows/batch_id={batch_id}").select(
            F.col(key).alias("key"), "opened_by", F.col(index).alias("index"), F.col(text).alias("text"))
        joined = grouping.join_fragments(rows, "opened_by", "index", "text", sep)
        keys = rows.groupBy("opened_by").agg(F.first("key").alias(key))
        joined.join(keys, on="opened_by").write.mode("overwrite").parquet(f"{path}/messages/batch_id={batch_id}")
    return run


class _Resumed(state.Machine):
    """A machine that can start from a kept state: an event with
    ``resume_to`` puts it there, one that is ``expired`` starts afresh."""

    def __init__(self, inner: state.Machine):
        self.inner, self.n_states, self.initial = inner, inner.n_states, inner.initial
        self.event_cols = (*inner.event_cols, "resume_to", "expired")
        self.out_schema = f"{inner.out_schema}, code int, before int"

    def step(self, states, ev):
        if ev.resume_to is not None:
            return np.full_like(states, ev.resume_to)
        return self.inner.step(np.full_like(states, self.initial) if ev.expired else states, ev)

    def step_one(self, one, ev):
        if ev.resume_to is not None:
            return ev.resume_to
        return self.inner.step_one(self.initial if ev.expired else one, ev)

    def reply(self, one, ev):
        return None if ev.resume_to is not None else self.inner.reply(self.initial if ev.expired else one, ev)

    def describe(self, one):
        return {**self.inner.describe(one), "code": int(one)}


def _timer_table(spark: SparkSession, machine: state.Machine, cols: list[T.StructField]) -> DataFrame:
    """What the timer makes of each state that it changes (at most
    ``n_states`` rows): an event that only says ``timed_out``."""
    ev = namedtuple("event", machine.event_cols)(*[c == "timed_out" or None for c in machine.event_cols])
    rows = []
    for one in range(machine.n_states):
        then = machine.step_one(one, ev)
        if then != one:
            says = machine.describe(then)
            rows.append((one, *[says.get(f.name) for f in cols]))
    return spark.createDataFrame(rows, T.StructType([T.StructField("before", T.IntegerType()), *cols]))


def run_machine(path: str, machine: state.Machine, key: str, order_by: str, ts: str, timeout_us: int,
                max_delay_us: int, ttl_us: int | None = None,
                chunk_rows: int = state.FSM_CHUNK_ROWS) -> Callable[[DataFrame, int], None]:
    """F4 with its inactivity timer: a ``foreachBatch`` function.
    ``path/out`` gets a row for each event (``kind`` ``event``: the state
    after it and the reply) and, ``timeout`` after a key's last event, a
    row for the transition that the timer makes, if it makes one (``kind``
    ``timer``, with the id of the event that it follows), when the
    watermark or the key's next event is that far.  Events get
    ``timed_out`` as in the batch form.

    The state is one row per key.  With ``ttl`` (longer than ``timeout``) a
    key's state is dropped ``ttl`` after its last event, and the next event
    finds the initial state."""
    if ttl_us is not None and ttl_us <= timeout_us:
        raise ValueError("ttl_us must be longer than timeout_us")
    resumed = _Resumed(machine)
    says = T._parse_datatype_string(machine.out_schema).fields

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = scans._carried(spark, f"{path}/carry", batch_id)
        top = None if was is None else was["top_us"]
        after, wm = _advance(batch, ts, top, max_delay_us)
        given = [c for c in machine.event_cols if c != "timed_out"]
        rows = counted_at(batch, ts, order_by, max_delay_us, top).select(
            F.col(key).alias("key"), F.col(order_by).alias("seq"), F.col("__at_us").alias("at_us"), *given,
            state._key_text(key).alias("key_text"), F.lit(None).cast("int").alias("resume_to"),
            F.lit(False).alias("fired"))
        kept = _left(spark, f"{path}/state", batch_id)
        asleep = None
        if kept is not None:
            met = rows.select("key_text").distinct()
            asleep = join_small(kept, met, on="key_text", how="left_anti")
            resume = join_small(kept, met, on="key_text", how="left_semi").withColumnRenamed("code", "resume_to")
            rows = rows.unionByName(resume, allowMissingColumns=True)
        # The key's event before each event, by position: a hot key is spread over tasks.
        idx = prefix.with_index(rows, ["seq"], "__pos", partition_by=["key_text"])
        prev = idx.select("key_text", (F.col("__pos") + 1).alias("__pos"), F.col("at_us").alias("prev_us"),
                          F.col("seq").alias("prev_id"), F.col("fired").alias("prev_fired"))
        idx = idx.join(prev, on=["key_text", "__pos"], how="left").drop("__pos")
        gap = F.coalesce(F.col("at_us") - F.col("prev_us"), F.lit(state.NO_TIME))
        expired = F.lit(False) if ttl_us is None else gap >= F.lit(ttl_us)
        idx = idx.withColumn("over", gap >= F.lit(timeout_us)).withColumn("expired", expired)
        idx = idx.withColumn("timed_out", F.col("over") & ~F.col("expired"))
        done = cut_lineage(state.run_machine(idx, resumed, "key", "seq", chunk_rows))

        events = done.filter(F.col("resume_to").isNull()).select(
            "key", "seq", F.lit("event").alias("kind"), "at_us", *[f.name for f in says])
        last = done.groupBy("key_text").agg(F.max_by(
            F.struct("key", "seq", "at_us", "code", "fired"), F.col("seq")).alias("s")).select("key_text", "s.*")
        if asleep is not None:
            last = last.unionByName(asleep)
        # Timers that a next event finds over, and those that the watermark has passed.
        by_event = done.filter(F.col("over") & ~F.col("prev_fired")).select(
            "key", F.col("prev_id").alias("seq"), F.col("prev_us").alias("at_us"), "before")
        due = F.col("at_us") + F.lit(timeout_us) <= F.lit(wm)
        by_time = last.filter(due & ~F.col("fired")).select("key", "seq", "at_us", F.col("code").alias("before"))
        made = F.broadcast(_timer_table(spark, machine, says))  # at most n_states rows
        timers = by_event.unionByName(by_time).join(made, on="before").select(
            "key", "seq", F.lit("timer").alias("kind"), (F.col("at_us") + F.lit(timeout_us)).alias("at_us"),
            *[f.name for f in says])
        out = events.unionByName(timers).withColumnsRenamed({"key": key, "seq": order_by})
        out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        left = last.withColumn("fired", F.col("fired") | due)
        if ttl_us is not None:
            left = left.filter(F.col("at_us") + F.lit(ttl_us) > F.lit(wm))
        _keep(left, f"{path}/state", batch_id)
        scans._leave(spark.range(1).select(F.lit(after).cast("long").alias("top_us")), f"{path}/carry", batch_id)
    return run
