"""Keyed state machines (F1-F4) and count-or-time batching.

* F1/F2 (cart) is set-based: which commands a cart accepts depends only
  on its first Add, so joins and map-side aggregates give the state.
* F3 (in-flight suppression) and A12 (count-or-time batches) are greedy
  chains over the key's clock, the running maximum of its times (a clock
  never goes back; a late time counts as the clock's).  Keys up to a row
  bound are walked in one task; hotter keys are solved with as-of lookups
  and chains walked by blocks (:mod:`eddy.plans.chains`).  Both give the same.

Null keys are a key like any other; a null time leaves the clock as it is.
* F4 (a finite-state machine) is a fold whose step is a function on a
  finite state set.  Functions compose associatively, so each chunk of a
  key's events is turned into its transfer table (state -> state) in
  parallel, the tables are composed per key in a bounded tree, and every
  chunk is then replayed from its entry state.  No task ever holds more
  than one chunk of events or ``FANIN`` tables, however hot the key.
"""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.plans import chains, prefix
from eddy.plans.joins import join_small
from eddy.session import cut_lineage

# --- F1 / F2: event-sourced cart -----------------------------------------

# Fixed values (replies of the cart): "ItemNotFound" for a command before the
# cart is opened; later adds are "unhandled"; accepted commands are "ok".
ITEM_NOT_FOUND, UNHANDLED, OK = "ItemNotFound", "unhandled", "ok"


def cart_accepted(cmds: DataFrame, cart: str = "cart", seq: str = "seq", cmd: str = "cmd",
                  opened_before: DataFrame | None = None) -> DataFrame:
    """commands a cart accepts.  The first Add opens the cart (and is
    accepted); Update/Remove/Get after it are accepted; anything before
    it fails with ItemNotFound; later Adds are unhandled.  Adds a
    ``reply`` column: ``ok``, ``ItemNotFound`` or ``unhandled``.
    ``opened_before`` (cart, init) are carts that earlier commands opened."""
    adds = cmds.filter(F.col(cmd) == "add").select(F.col(cart), F.col(seq).alias("__seq"))
    if opened_before is not None:
        adds = adds.unionByName(opened_before.select(F.col("cart").alias(cart), F.col("init").alias("__seq")))
    opened = adds.groupBy(cart).agg(F.min("__seq").alias("__init"))
    j = join_small(cmds, opened, on=cart, how="left")
    reply = (F.when(F.col("__init").isNull() | (F.col(seq) < F.col("__init")), F.lit(ITEM_NOT_FOUND))
              .when((F.col(cmd) == "add") & (F.col(seq) > F.col("__init")), F.lit(UNHANDLED))
              .otherwise(F.lit(OK)))
    return j.withColumn("reply", reply).drop("__init")


def cart_journal(cmds: DataFrame, cart: str = "cart", seq: str = "seq", cmd: str = "cmd") -> DataFrame:
    """the persisted events (accepted add/update/remove; gets are not
    persisted)."""
    return journal_of(cart_accepted(cmds, cart, seq, cmd), cmd)


def journal_of(answered: DataFrame, cmd: str = "cmd") -> DataFrame:
    """The events to persist, of commands with their replies."""
    return answered.filter((F.col("reply") == OK) & F.col(cmd).isin("add", "update", "remove")).drop("reply")


def cart_state(journal: DataFrame, cart: str = "cart", item: str = "item", seq: str = "seq",
               cmd: str = "cmd", value_cols: Sequence[str] = ("quantity",)) -> DataFrame:
    """cart contents from the journal (replay): the last event per
    (cart, item) wins; removed items are dropped.  ``touched`` orders the
    items latest first.  Replay of the journal equals the live state by
    construction."""
    last = F.max_by(F.struct(F.col(cmd), *[F.col(c) for c in value_cols]), F.col(seq))
    per_item = journal.groupBy(cart, item).agg(last.alias("__last"), F.max(seq).alias("touched"))
    return (per_item.filter(F.col("__last")[cmd] != "remove")
                    .select(cart, item, *[F.col("__last")[c].alias(c) for c in value_cols], "touched"))


# --- F3 / A12: greedy chains --------------------------------------------------

# Keys with at most this many rows are scanned whole in one task (a bounded
# group); larger keys go through the distributed chain.
DIRECT_KEY_ROWS = 1 << 15


# The clock before the first time that is not null.
NO_TIME = -(1 << 62)


def _key_text(key: str):
    """The key as a text that is never null, for grouping and joining."""
    return F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))


def _with_clock(df: DataFrame, key: str, order_by: str, ts: str) -> DataFrame:
    """``df`` with ``__key`` and the key's clock ``__t`` (micros)."""
    src = df.withColumn("__key", _key_text(key)).withColumn("__now", prefix.order_number(df, ts))
    out = prefix.running(src, [order_by], {"__t": ("max", F.col("__now"))}, partition_by=["__key"])
    return out.withColumn("__t", F.coalesce("__t", F.lit(NO_TIME))).drop("__now")


def _split_keys(df: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, bool]:
    """Rows of keys with at most ``limit`` rows, rows of the other keys,
    and whether there are other keys.  The big keys are at most
    ``rows / limit``, so their list is small (size-checked broadcast)."""
    big = df.groupBy("__key").count().filter(F.col("count") > limit).select("__key")
    if big.isEmpty():
        return df, df.limit(0), False
    return (join_small(df, big, on="__key", how="left_anti"),
            join_small(df, big, on="__key", how="left_semi"), True)


def _greedy(df: DataFrame, key: str, order_by: str, ts: str, name: str, out_type: str, walk, chain,
            direct_rows: int) -> DataFrame:
    """Run ``walk(clock) -> values`` over each key of at most ``direct_rows``
    rows, and ``chain`` over the rows of the others."""
    from eddy.plans.groupscan import sorted_group_map
    clocked = _with_clock(df, key, order_by, ts)
    small, big, has_big = _split_keys(clocked, direct_rows)
    kept = [f for f in clocked.schema.fields if not f.name.startswith("__")]
    schema = T.StructType([*kept, T.StructField(name, T._parse_datatype_string(out_type))])

    def run(t: pa.Table) -> pa.Table:
        values = walk(t["__t"].to_numpy())
        values = values if isinstance(values, pa.Array) else pa.array(values)
        return t.select([f.name for f in kept]).append_column(name, values)

    direct = sorted_group_map(small, ["__key"], [order_by], run, schema)
    return direct.unionByName(chain(big).select(*schema.names)) if has_big else direct


def suppress_in_flight(df: DataFrame, key: str, order_by: str, ts: str, duration_us: int,
                       name: str = "accepted", direct_rows: int = DIRECT_KEY_ROWS) -> DataFrame:
    """a request is accepted unless an accepted request of its key is
    still running (``duration`` after its start, by the key's clock);
    put-off requests are flagged ``accepted = false``."""
    def walk(t):
        # Jump from accepted row to accepted row; the clock never falls.
        acc = np.zeros(len(t), dtype=bool)
        i = 0
        while i < len(t):
            acc[i] = True
            i = max(i + 1, int(np.searchsorted(t, t[i] + duration_us)))
        return acc

    def chain(big):
        idx = prefix.with_index(big, [order_by], "__idx", partition_by=["__key"])
        nodes = cut_lineage(_next_at(idx, duration_us, "__next"))
        return chains.on_chain(nodes, ["__key"], "__idx", "__next", name)

    return _greedy(df, key, order_by, ts, name, "boolean", walk, chain, direct_rows)


def _next_at(idx: DataFrame, duration_us: int, name: str) -> DataFrame:
    """The index of the first later row whose clock is ``duration`` ahead."""
    if duration_us > 0:
        return chains.as_of_next(idx, ["__key"], "__idx", F.col("__t"), F.col("__t") + F.lit(duration_us), name)
    last = idx.groupBy("__key").agg(F.max("__idx").alias("__last"))
    out = join_small(idx, last, on="__key", how="left")
    return out.withColumn(name, F.when(F.col("__idx") < F.col("__last"), F.col("__idx") + 1)).drop("__last")


def grouped_within(df: DataFrame, key: str, order_by: str, ts: str, n: int, duration_us: int,
                   name: str = "batch", direct_rows: int = DIRECT_KEY_ROWS) -> DataFrame:
    """Per key, a batch opens at its first row and takes rows until it
    holds ``n`` or a row comes at or after ``open + duration`` by the key's
    clock, which opens the next batch.  Adds the 0-based batch number."""
    def walk(t):
        out = np.zeros(len(t), dtype=np.int64)
        i = batch = 0
        while i < len(t):
            end = min(i + n, max(i + 1, int(np.searchsorted(t, t[i] + duration_us))))
            out[i:end] = batch
            i, batch = end, batch + 1
        return out

    def chain(big):
        idx = prefix.with_index(big, [order_by], "__idx", partition_by=["__key"])
        nodes = _next_at(idx, duration_us, "__nt")
        counts = idx.groupBy("__key").agg(F.count(F.lit(1)).alias("__cnt"))
        nodes = join_small(nodes, counts, on="__key", how="left")
        by_count = F.col("__idx") + F.lit(n)
        nxt = F.least(by_count, F.coalesce(F.col("__nt"), by_count))
        nodes = cut_lineage(nodes.withColumn("__next", F.when(nxt < F.col("__cnt"), nxt)))
        flagged = chains.on_chain(nodes, ["__key"], "__idx", "__next", "__open")
        out = prefix.running(flagged, [order_by], {name: ("sum", F.col("__open").cast("int"))}, partition_by=["__key"])
        return out.withColumn(name, (F.col(name) - 1).cast("long"))

    return _greedy(df, key, order_by, ts, name, "bigint", walk, chain, direct_rows)


# --- F4: finite-state machines ---------------------------------------------------


class Machine:
    """A finite-state machine over integer states ``0 .. n_states-1``.

    ``step(states, event)`` maps a numpy array of states to the states after
    ``event`` (a pandas row); ``reply(state, event)`` gives the output of
    one event from one state; ``describe(state)`` the output columns of a
    state.  Subclasses define the three and ``initial``.
    """

    n_states: int
    initial: int
    event_cols: Sequence[str] = ()
    out_schema: str = ""

    def step(self, states: np.ndarray, ev) -> np.ndarray:
        raise NotImplementedError

    def reply(self, state: int, ev):
        raise NotImplementedError

    def describe(self, state: int) -> dict:
        raise NotImplementedError

    def step_one(self, state: int, ev) -> int:
        """The step from one state (override with scalar code for speed)."""
        return int(self.step(np.array([state], dtype=np.int32), ev)[0])


FANIN = 1024
FSM_CHUNK_ROWS = 1 << 15


def _compose_tables(tables: list[np.ndarray]) -> np.ndarray:
    out = np.arange(len(tables[0]), dtype=np.int32)
    for t in tables:
        out = t[out]
    return out


def _exit_states(tables: DataFrame, keys: list[str], pos: str, initial: int) -> DataFrame:
    """For each (keys, pos) transfer table: the state on leaving it, i.e.
    the initial state run through this and all earlier tables of the key.
    Groups are at most ``FANIN`` tables; longer keys go through a tree of
    compositions (one level per factor of ``FANIN``)."""
    longest = tables.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    from eddy.plans.groupscan import sorted_group_map

    key_fields = [tables.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField(pos, T.LongType()), T.StructField("exit", T.IntegerType())])

    def walk(start_of):
        def run(t: pa.Table) -> pa.Table:
            state, exits = start_of(t), []
            for table in t["table"]:
                state = table[state].as_py()
                exits.append(state)
            return t.select([*keys, pos]).append_column("exit", pa.array(exits, pa.int32()))
        return run

    if longest <= FANIN:
        return sorted_group_map(tables, keys, [pos], walk(lambda t: initial), schema)

    parent = tables.withColumn("__parent", F.floor(F.col(pos) / FANIN).cast("long"))
    pschema = T.StructType([*key_fields, T.StructField(pos, T.LongType()),
                            T.StructField("table", T.ArrayType(T.IntegerType()))])

    def compose(t: pa.Table) -> pa.Table:
        tbl = _compose_tables([x.values.to_numpy() for x in t["table"]])
        head = t.slice(0, 1)
        return head.select(keys).append_column(pos, head["__parent"]).append_column(
            "table", pa.array([tbl.tolist()], pa.list_(pa.int32())))

    parents = cut_lineage(sorted_group_map(parent, [*keys, "__parent"], [pos], compose, pschema))
    # The entry of parent p is the exit of parent p - 1 (initial for p = 0).
    p_exit = _exit_states(parents, keys, pos, initial).select(
        *keys, (F.col(pos) + 1).alias("__parent"), F.col("exit").alias("__pentry"))
    tagged = parent.join(p_exit, on=[*keys, "__parent"], how="left")
    tagged = tagged.withColumn("__pentry", F.coalesce(F.col("__pentry"), F.lit(initial)))
    return sorted_group_map(tagged, [*keys, "__parent"], [pos], walk(lambda t: t["__pentry"][0].as_py()), schema)


def run_machine(df: DataFrame, machine: Machine, key: str, order_by: str,
                chunk_rows: int = FSM_CHUNK_ROWS, ts: str | None = None,
                timeout_us: int | None = None) -> DataFrame:
    """run ``machine`` over each key's events in ``order_by`` order.
    Returns the rows of ``df`` with the machine's output columns (state
    after the event and reply).  With ``ts`` and ``timeout_us`` the
    ``timed_out`` event column is derived too (the gap since the key's
    previous event reaches the timeout; the timer restarts with each
    event).

    Each key's events are cut into chunks of ``chunk_rows`` by their
    position in the key.  A key of one chunk is replayed directly from the
    initial state.  For longer keys every chunk but the last is turned into
    its transfer table in parallel, the tables give each chunk's entry
    state, and all chunks are replayed in parallel."""
    from eddy.plans.groupscan import sorted_group_map

    src = df.withColumn("__key", _key_text(key))
    run = prefix.with_index(src, [order_by], "__pos", partition_by=["__key"])
    if ts is not None:
        run = _gap_flag(run, ts, timeout_us, "timed_out")
    tagged = run.withColumn("__chunk", F.floor(F.col("__pos") / chunk_rows).cast("long")).drop("__pos")
    n_states = machine.n_states
    event = namedtuple("event", machine.event_cols)

    def events(t: pa.Table):
        return map(event._make, zip(*[t[c].to_pylist() for c in machine.event_cols]))

    # Keys with more than one chunk; at most rows / chunk_rows of them.
    # Whether there are any is read from per-key counts of the input (a
    # map-side aggregate), so the scan above runs only once when there are
    # none.
    long_keys = src.groupBy("__key").count().filter(F.col("count") > chunk_rows)
    if long_keys.isEmpty():
        with_entry = tagged.withColumn("entry", F.lit(machine.initial))
    else:
        multi = (tagged.filter(F.col("__chunk") > 0).groupBy("__key")
                       .agg(F.max("__chunk").alias("__last")))
        need = join_small(tagged.select("__key", order_by, "__chunk", *machine.event_cols), multi,
                          on="__key", how="inner").filter(F.col("__chunk") < F.col("__last"))
        tschema = "__key string, __chunk bigint, table array<int>"

        def transfer(t: pa.Table) -> pa.Table:
            tbl = np.arange(n_states, dtype=np.int32)
            for ev in events(t):
                tbl = machine.step(tbl, ev)
            return t.slice(0, 1).select(["__key", "__chunk"]).append_column(
                "table", pa.array([tbl.tolist()], pa.list_(pa.int32())))

        tables = cut_lineage(sorted_group_map(need.drop("__last"), ["__key", "__chunk"], [order_by], transfer,
                                              tschema))
        exits = _exit_states(tables, ["__key"], "__chunk", machine.initial)
        entries = exits.select("__key", (F.col("__chunk") + 1).alias("__chunk"), F.col("exit").alias("entry"))
        with_entry = join_small(tagged, entries, on=["__key", "__chunk"], how="left")
        with_entry = with_entry.withColumn("entry", F.coalesce(F.col("entry"), F.lit(machine.initial)))

    extra = T._parse_datatype_string(machine.out_schema).fields
    passed = [f for f in with_entry.schema.fields if f.name not in ("entry", "__chunk", "__key")]
    out_schema = T.StructType(passed + list(extra))
    pass_names = [f.name for f in passed]

    def replay(t: pa.Table) -> pa.Table:
        state = t["entry"][0].as_py()
        outs: dict[str, list] = {f.name: [] for f in extra}
        for ev in events(t):
            outs["reply"].append(machine.reply(state, ev))
            if "before" in outs:  # a machine may ask for the state it was in
                outs["before"].append(state)
            state = machine.step_one(state, ev)
            for n, v in machine.describe(state).items():
                outs[n].append(v)
        res = t.select(pass_names)
        for f in extra:
            kind = pa.int32() if isinstance(f.dataType, T.IntegerType) else pa.string()
            res = res.append_column(f.name, pa.array(outs[f.name], kind))
        return res

    return sorted_group_map(with_entry, ["__key", "__chunk"], [order_by], replay, out_schema)


def _gap_flag(indexed: DataFrame, ts: str, timeout_us: int, name: str) -> DataFrame:
    """Flag rows whose time is ``timeout`` or more after the previous row's
    (``__pos`` - 1 of ``__key``), by an equi-join on the position."""
    now = prefix.order_number(indexed, ts)
    prev = indexed.select("__key", (F.col("__pos") + 1).alias("__pos"), now.alias("__prev"))
    out = indexed.withColumn("__now", now).join(prev, on=["__key", "__pos"], how="left")
    return out.withColumn(name, F.coalesce(F.col("__now") - F.col("__prev") >= F.lit(timeout_us), F.lit(False))) \
              .drop("__now", "__prev")


class CatMachine(Machine):
    """The cat of the FSM spec.  Phases Sleeping, Awake, VeryHungry,
    Failed; hunger starts at 60.  Events: ``wake``, ``stroke``, ``sleep``,
    ``grow`` (by ``by``), anything else ignored; ``timed_out`` marks an
    event that came after the sleep timeout, which has woken the cat first.

    The numbers and replies below are fixed values of the spec.
    """

    # Fixed values (must equal the spec): start hunger 60; a stroke replies
    # "mewww" at hunger 30 or more, else "purrr"; growing hunger stays below
    # 85, turns VeryHungry below 100 and fails at 100 or more.
    START_HUNGER = 60
    MEWWW_AT = 30
    VERY_HUNGRY_AT = 85
    FAIL_AT = 100
    REPLY_HUNGRY, REPLY_CONTENT, REPLY_FAILED = "mewww", "purrr", "failed"

    SLEEPING, AWAKE, VERY_HUNGRY, FAILED = 0, 1, 2, 3
    PHASES = ("Sleeping", "Awake", "VeryHungry", "Failed")
    STRIDE = 128
    n_states = 4 * STRIDE
    initial = SLEEPING * STRIDE + START_HUNGER
    event_cols = ("cmd", "by", "timed_out")
    out_schema = "state string, hunger int, reply string"

    def _pre(self, states: np.ndarray, ev):
        phase, hunger = states // self.STRIDE, states % self.STRIDE
        if bool(ev.timed_out):
            phase = np.where(phase == self.SLEEPING, self.AWAKE, phase)
        return phase, hunger

    def step(self, states, ev):
        phase, hunger = self._pre(states, ev)
        live = phase != self.FAILED
        cmd = ev.cmd
        if cmd == "wake":
            phase = np.where(live & (phase == self.SLEEPING), self.AWAKE, phase)
        elif cmd == "sleep":
            phase = np.where(live, self.SLEEPING, phase)
        elif cmd == "grow":
            new = hunger + int(ev.by)
            grown = np.where(phase == self.VERY_HUNGRY,
                             np.where(new < self.FAIL_AT, self.VERY_HUNGRY, self.FAILED),
                             np.where(new < self.VERY_HUNGRY_AT, phase,
                                      np.where(new < self.FAIL_AT, self.VERY_HUNGRY, self.FAILED)))
            phase = np.where(live, grown, phase)
            hunger = np.where(live & (phase != self.FAILED), new, hunger)
        hunger = np.where(phase == self.FAILED, 0, hunger)
        return (phase * self.STRIDE + hunger).astype(np.int32)

    def _pre_one(self, state, ev):
        phase, hunger = divmod(int(state), self.STRIDE)
        if phase == self.SLEEPING and bool(ev.timed_out):
            phase = self.AWAKE
        return phase, hunger

    def step_one(self, state, ev):
        phase, hunger = self._pre_one(state, ev)
        if phase != self.FAILED:
            cmd = ev.cmd
            if cmd == "wake" and phase == self.SLEEPING:
                phase = self.AWAKE
            elif cmd == "sleep":
                phase = self.SLEEPING
            elif cmd == "grow":
                hunger += int(ev.by)
                limit = self.FAIL_AT if phase == self.VERY_HUNGRY else self.VERY_HUNGRY_AT
                if hunger >= self.FAIL_AT:
                    phase = self.FAILED
                elif hunger >= limit:
                    phase = self.VERY_HUNGRY
        if phase == self.FAILED:
            hunger = 0
        return phase * self.STRIDE + hunger

    def reply(self, state, ev):
        phase, hunger = self._pre_one(state, ev)
        if phase == self.FAILED:
            return None
        if ev.cmd == "stroke" and phase == self.AWAKE:
            return self.REPLY_HUNGRY if hunger >= self.MEWWW_AT else self.REPLY_CONTENT
        if ev.cmd == "grow":
            new = hunger + int(ev.by)
            return self.REPLY_FAILED if new >= self.FAIL_AT else str(new)
        if ev.cmd == "sleep":
            return str(hunger)
        return None

    def describe(self, state):
        phase, hunger = state // self.STRIDE, state % self.STRIDE
        return {"state": self.PHASES[phase], "hunger": None if phase == self.FAILED else int(hunger)}


def timed_out(df: DataFrame, key: str, order_by: str, ts: str, timeout_us: int,
              name: str = "timed_out") -> DataFrame:
    """Flag events that come at least ``timeout`` after the key's previous
    event (the timer restarts with each event).  The previous event is
    found by its position in the key, so a hot key is spread over tasks."""
    src = df.withColumn("__key", _key_text(key))
    idx = prefix.with_index(src, [order_by], "__pos", partition_by=["__key"])
    return _gap_flag(idx, ts, timeout_us, name).drop("__key", "__pos")
