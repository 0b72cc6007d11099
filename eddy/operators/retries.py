"""Requests put off and tried again until they run (F3 and W8 together).

A request of a key runs for a duration.  One that comes while another of its
key runs is put off.  At every tick (whole multiples of ``tick_us``) the
requests of a key that are put off are tried again in their order: if none of
the key runs, the first of them starts and the others are put off once more.
A new request that finds its key idle between two ticks starts at once, so it
may overtake those that wait.  At equal times the tick comes before a request.

The state of a key is two numbers: how many wait (``q``) and until when it is
busy (``b``).  The next start of a waiting request is always the first tick
at or after ``b``, so a gap between requests takes one step however many
ticks it holds.  What is put off is served in order: the n-th request that is
put off starts at the n-th start from the queue, an equi-join on numbers.

Keys of at most ``direct_rows`` rows are walked in one task.  A hotter key is
cut into chunks of ``chunk_rows``, all walked at once:

1. Every chunk is walked from an empty queue and from an endless one.  The
   second walk tells how long a queue must be to last through the chunk; for
   any queue at least as long, its length only shifts the result.
2. A key's chunks are followed in order through the walks known so far.  An
   entry state that none of them covers is asked for and guessed on, so one
   round asks for all chunks at once; rounds end when every entry is known.
   Each round settles at least one more chunk; as a key forgets its entry
   state whenever it is idle with nobody waiting, or keeps a queue through a
   chunk, a few rounds are usual.
3. Chunks are walked once more from their true entries for the result.

Defined cases: a null key is a key; a null time leaves the key's clock (the
running maximum of its times) as it is; before any time is known the start is
null; ties are taken in the given order.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.plans import prefix
from eddy.plans.groupscan import sorted_group_map
from eddy.plans.joins import join_small
from eddy.session import cut_lineage

#: A queue that never ends, and a time before all clocks.
ENDLESS = 1 << 60
NEVER = -(1 << 62)
#: Starts from the queue that one row stands for at most.
RUN = 10_000

RESULT = "struct<start:bigint,put_off:bigint>"


class Walk:
    """The requests of a key at the times ``t`` from the state ``(q, b)``."""

    def __init__(self, t, q: int, b: int, duration: int, tick: int):
        self.duration, self.tick = duration, tick
        #: Ticks from one start of a full queue to the next.
        self.step = -(-duration // tick) * tick
        self.accepted, self.runs, self.puts, self.need, first = [], [], 0, 0, q
        for x in t:
            at = self.next_tick(b)
            if q > 0 and at <= x:
                k = (x - at) // self.step + 1
                self.need = max(self.need, k - (q - first))
                k = min(q, k)
                self.runs.append((at, k))
                q -= k
                b = at + (k - 1) * self.step + duration
            fits = x >= b
            self.accepted.append(fits)
            if fits:
                b = x + duration
            else:
                q += 1
                self.puts += 1
        self.q, self.b, self.gain = q, b, q - first

    def next_tick(self, b: int) -> int:
        return -(-b // self.tick) * self.tick


def times_put_off(t: int, start: int, tick: int) -> int:
    """Once on arrival, and at every tick between arrival and start."""
    return (start - (t // tick + 1) * tick) // tick + 1


def retry_put_off(df: DataFrame, key: str, order_by: str, ts: str, duration_us: int, tick_us: int,
                  direct_rows: int = state.DIRECT_KEY_ROWS, chunk_rows: int = state.DIRECT_KEY_ROWS) -> DataFrame:
    """``df`` with ``start`` (when each request starts) and ``put_off`` (how
    often it was put off before that)."""
    if duration_us <= 0 or tick_us <= 0:
        raise ValueError("duration and tick must be positive")

    def walk(t):
        t = t.tolist()
        w = Walk(t, 0, NEVER, duration_us, tick_us)
        served = [at + i * w.step for at, k in [*w.runs, (w.next_tick(w.b), w.q)] for i in range(k)][::-1]
        start = [x if fits else served.pop() for x, fits in zip(t, w.accepted)]
        off = [0 if fits else times_put_off(x, s, tick_us) for x, s, fits in zip(t, start, w.accepted)]
        start = [None if x == state.NO_TIME and fits else s for x, s, fits in zip(t, start, w.accepted)]
        return pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(off, pa.int64())], ["start", "put_off"])

    def chain(big):
        return _hot(big, order_by, duration_us, tick_us, chunk_rows)

    out = state._greedy(df, key, order_by, ts, "__retry", RESULT, walk, chain, direct_rows)
    return out.select(*df.columns, F.timestamp_micros("__retry.start").alias("start"), F.col("__retry.put_off").alias("put_off"))


def _hot(big: DataFrame, order_by: str, duration: int, tick: int, chunk_rows: int) -> DataFrame:
    idx = prefix.with_index(big, [order_by], "__idx", partition_by=["__key"])
    idx = cut_lineage(idx.withColumn("__chunk", F.floor(F.col("__idx") / chunk_rows).cast("long")))
    rows = idx.select("__key", "__chunk", "__idx", "__t")
    entries = rows.select("__key", "__chunk").distinct().withColumn(
        "q", F.explode(F.array(F.lit(0), F.lit(ENDLESS)))).withColumn("b", F.lit(NEVER))
    known = None
    while True:
        walked = cut_lineage(_walk_chunks(rows, entries, duration, tick))
        known = walked if known is None else cut_lineage(known.unionByName(walked))
        states = cut_lineage(_follow(known))
        entries = states.where("asked").select("__key", "__chunk", "q", "b")
        if entries.isEmpty():
            break
    ends = states.where("__chunk < 0").select("__key", F.col("q").alias("q_end"), F.col("b").alias("b_end"),
                                              F.col("puts").alias("puts_end"))
    made = cut_lineage(_serve(rows, states.where("__chunk >= 0"), duration, tick))
    starts = (made.where("k IS NOT NULL").select("__key", F.posexplode(F.sequence(
        F.col("number"), F.col("number") + F.col("k") - 1)).alias("i", "number"), "__t")
        .select("__key", "number", (F.col("__t") + F.col("i") * -(-duration // tick) * tick).alias("served")))
    rest = join_small(made.where("k IS NULL AND number IS NOT NULL").select("__key", "__idx", "__t", "number"), ends, "__key")
    rest = rest.join(starts, ["__key", "number"], "left")
    last = F.ceil(F.col("b_end").cast("decimal(20,0)") / tick).cast("long") * tick
    after = last + (F.col("number") - (F.col("puts_end") - F.col("q_end")) - 1) * (-(-duration // tick) * tick)
    start = F.coalesce("served", after)
    first = (F.floor((F.col("__t") - F.pmod("__t", F.lit(tick))) / tick).cast("long") + 1) * tick
    rest = rest.select("__key", "__idx", F.struct(start.alias("start"), (F.floor((start - first) / tick).cast("long") + 1).alias(
        "put_off")).alias("__retry"))
    out = idx.drop("__chunk").join(rest, ["__key", "__idx"], "left")
    at_once = F.struct(F.when(F.col("__t") != state.NO_TIME, F.col("__t")).alias("start"), F.lit(0).cast("long").alias("put_off"))
    return out.withColumn("__retry", F.coalesce("__retry", at_once))


def _walk_chunks(rows: DataFrame, entries: DataFrame, duration: int, tick: int) -> DataFrame:
    """What each chunk does to each of its entry states."""
    schema = ("__key string, __chunk bigint, q bigint, b bigint, gain bigint, b_out bigint, puts bigint, need bigint")

    def run(t: pa.Table) -> pa.Table:
        key, chunk, q, b = (t[c][0].as_py() for c in ("__key", "__chunk", "q", "b"))
        w = Walk(t["__t"].to_pylist(), q, b, duration, tick)
        return pa.table({"__key": pa.array([key], pa.string()), "__chunk": [chunk], "q": [q], "b": [b], "gain": [w.gain],
                         "b_out": [w.b], "puts": [w.puts], "need": [w.need]})

    both = join_small(rows, entries, ["__key", "__chunk"])
    return sorted_group_map(both, ["__key", "__chunk", "q", "b"], ["__idx"], run, schema)


def _follow(known: DataFrame) -> DataFrame:
    """The entry state ``(q, b, puts)`` of every chunk as far as the known
    walks tell (``asked`` where they do not), and the end as chunk -1."""
    schema = "__key string, __chunk bigint, q bigint, b bigint, puts bigint, asked boolean"

    def run(t: pa.Table) -> pa.Table:
        chunks: dict[int, list[dict]] = {}
        for r in t.to_pylist():
            chunks.setdefault(r["__chunk"], []).append(r)
        q, b, puts, out = 0, NEVER, 0, []
        for c in sorted(chunks):
            fits = lambda r: r["q"] == q or r["q"] == ENDLESS and q >= r["need"]  # noqa: B023, E731
            hit = next((r for r in chunks[c] if r["b"] == b and fits(r)), None)
            out.append((c, q, b, puts, hit is None))
            # A guess where no walk fits: one with such a queue, else the first.
            hit = hit or next((r for r in reversed(chunks[c]) if fits(r)), chunks[c][0])
            q, b, puts = max(0, q + hit["gain"]), hit["b_out"], puts + hit["puts"]
        out.append((-1, q, b, puts, False))
        cols = list(zip(*out))
        return pa.table({"__key": pa.array([t["__key"][0].as_py()] * len(out), pa.string()), **{
            n: pa.array(list(v)) for n, v in zip(("__chunk", "q", "b", "puts", "asked"), cols)}})

    return sorted_group_map(known, ["__key"], ["__chunk"], run, schema)


def _serve(rows: DataFrame, states: DataFrame, duration: int, tick: int) -> DataFrame:
    """Each request with its number among those put off (null: it started at
    once), and each run of ``k`` starts from the queue with its first number
    and time."""
    schema = "__key string, __idx bigint, __t bigint, number bigint, k bigint"

    def run(t: pa.Table) -> pa.Table:
        key, q, b, puts = (t[c][0].as_py() for c in ("__key", "q", "b", "puts"))
        times = t["__t"].to_pylist()
        w = Walk(times, q, b, duration, tick)
        out, n = [], puts
        for i, x, fits in zip(t["__idx"].to_pylist(), times, w.accepted):
            n += not fits
            out.append((i, x, None if fits else n, None))
        n = puts - q + 1
        for at, k in w.runs:
            for i in range(0, k, RUN):
                out.append((None, at + i * w.step, n + i, min(RUN, k - i)))
            n += k
        cols = list(zip(*out))
        return pa.table({"__key": pa.array([key] * len(out), pa.string()), **{
            name: pa.array(list(v), pa.int64()) for name, v in zip(("__idx", "__t", "number", "k"), cols)}})

    both = join_small(rows, states.select("__key", "__chunk", "q", "b", "puts"), ["__key", "__chunk"])
    return sorted_group_map(both, ["__key", "__chunk"], ["__idx"], run, schema)
