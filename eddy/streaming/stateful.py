"""Stateful stream operators (L15, and the streaming forms of A8 and F4)
with ``applyInPandasWithState``: the state per key is small (a flag, a
machine state) and lives in the state store under the checkpoint.  The
states of the keys of one hash bucket are stored together, and a function is
called once per bucket and micro-batch."""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from eddy.operators.state import NO_TIME

# Groups of the state store: each holds the states of its keys.
BUCKETS = 512


def _micros(ts: pd.Series) -> np.ndarray:
    """Epoch microseconds, whatever unit pandas holds the times in."""
    t = ts.to_numpy()
    if t.dtype.kind != "M":
        t = pd.to_datetime(ts).to_numpy()
    return t.astype("datetime64[us]").astype("int64")


def _by_bucket(stream: DataFrame, key: str, order_by: str, out_fields: list, run) -> DataFrame:
    """``run(rows, spans, held) -> columns`` over the rows of a micro-batch,
    sorted by key and ``order_by``: ``spans`` are (key text, first row, row
    behind the last) and ``held`` the dict of the keys' states, which it
    updates.  Keys are dealt to ``BUCKETS`` groups of the state store, as a
    call per key costs more than most keys' rows."""
    out_schema = T.StructType([stream.schema[key], stream.schema[order_by], *out_fields])
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))  # null is a key
    keyed = stream.withColumn("__key", text)
    keyed = keyed.withColumn("__bucket", F.pmod(F.xxhash64("__key"), F.lit(BUCKETS)).cast("int"))

    def fn(k, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        # The rows of a key may be in any of the micro-batch's Arrow chunks.
        rows = pd.concat(list(pdfs), ignore_index=True)
        codes, names = pd.factorize(rows["__key"])
        rows = rows.assign(__key=codes).sort_values(["__key", order_by], kind="stable")
        codes = rows["__key"].to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist()]
        spans = [(names[codes[i]], i, j) for i, j in zip(starts, [*starts[1:], len(codes)])]
        held = pickle.loads(bytes(state.get[0])) if state.exists else {}
        columns = run(rows, spans, held)
        state.update((pickle.dumps(held),))
        yield pd.DataFrame({key: rows[key].array, order_by: rows[order_by].array, **columns})

    return keyed.groupBy("__bucket").applyInPandasWithState(
        fn, out_schema, "held binary", "append", GroupStateTimeout.NoTimeout)


def first_seen(stream: DataFrame, key: str, order_by: str, name: str = "first_seen") -> DataFrame:
    """Rows pass through with a flag on the first row of each key
    ever seen (state: the keys seen)."""
    def run(rows, spans, held):
        flags = np.zeros(len(rows), dtype=bool)
        flags[[i for k, i, _ in spans if k not in held]] = True
        held.update((k, ()) for k, _, _ in spans)
        return {name: flags}

    return _by_bucket(stream, key, order_by, [T.StructField(name, T.BooleanType())], run)


def run_machine(stream: DataFrame, machine, key: str, order_by: str, ts: str | None = None,
                timeout_us: int | None = None) -> DataFrame:
    """F4 on a stream: each key's machine state (and last event time, for
    the inactivity timer) is kept between micro-batches.  Events of a key
    must arrive in ``order_by`` order across batches."""
    fields = T._parse_datatype_string(machine.out_schema).fields
    timed = ["timed_out"] if ts is not None else []
    names = list(machine.event_cols or [*stream.columns, *timed])
    event = namedtuple("event", names)

    def run(rows, spans, held):
        values = {c: rows[c].tolist() for c in names if c not in timed}
        if ts is not None:
            t = _micros(rows[ts])
            prev = np.empty(len(t))
            prev[1:] = t[:-1]
            for k, i, j in spans:
                prev[i] = held[k][1] if k in held else np.nan
            values["timed_out"] = ((t - prev) >= timeout_us).tolist()
        events = [event._make(e) for e in zip(*[values[c] for c in names])]
        outs: dict[str, list] = {f.name: [] for f in fields}
        described: dict = {}
        for k, i, j in spans:
            cur = held[k][0] if k in held else machine.initial
            for ev in events[i:j]:
                outs["reply"].append(machine.reply(cur, ev))
                cur = machine.step_one(cur, ev)
                if cur not in described:
                    described[cur] = machine.describe(cur)
                for c, v in described[cur].items():
                    outs[c].append(v)
            held[k] = (cur, int(t[j - 1]) if ts is not None else None)
        return outs

    return _by_bucket(stream, key, order_by, fields, run)


def _greedy(stream: DataFrame, key: str, order_by: str, ts: str, name: str, out_type: str, start, walk) -> DataFrame:
    """A greedy per-key scan over a stream: ``walk(times_us, state) ->
    (values, state)`` runs on each key's rows of a micro-batch (in order),
    the state carries over to the next batch."""
    def run(rows, spans, held):
        t, out = _micros(rows[ts]), []
        for k, i, j in spans:
            values, held[k] = walk(t[i:j], held.get(k, start))
            out.append(values)
        return {name: np.concatenate(out)}

    return _by_bucket(stream, key, order_by, [T.StructField(name, T._parse_datatype_string(out_type))], run)


def in_flight(stream: DataFrame, key: str, order_by: str, ts: str, duration_us: int,
              name: str = "accepted") -> DataFrame:
    """F3 on a stream: per key, the time the running request ends and the
    key's clock (the running maximum of its times) are the state; a request
    before that end is put off."""
    def walk(t, cur):
        free_at, clock = cur
        t = np.maximum.accumulate(np.append(NO_TIME if clock is None else clock, t))[1:]
        acc = np.zeros(len(t), dtype=bool)
        i = 0 if free_at is None else int(np.searchsorted(t, free_at))
        while i < len(t):
            acc[i] = True
            free_at = int(t[i]) + duration_us
            i = max(i + 1, int(np.searchsorted(t, free_at)))
        return acc, (free_at, int(t[-1]))

    return _greedy(stream, key, order_by, ts, name, "boolean", (None, None), walk)


def grouped_within(stream: DataFrame, key: str, order_by: str, ts: str, n: int, duration_us: int,
                   name: str = "batch") -> DataFrame:
    """A12 on a stream: per key, the open batch (number, opening time,
    size) and the clock are the state; a batch closes at ``n`` rows or
    ``duration``."""
    def walk(t, cur):
        batch, opened, count, clock = cur
        t = np.maximum.accumulate(np.append(NO_TIME if clock is None else clock, t))[1:]
        out = np.zeros(len(t), dtype=np.int64)
        i = 0
        while i < len(t):
            if batch is None or count >= n or t[i] >= opened + duration_us:
                batch, opened, count = (0 if batch is None else batch + 1), int(t[i]), 0
                end = i + 1
            else:
                end = i
            end = max(end, min(i + n - count, int(np.searchsorted(t, opened + duration_us))))
            out[i:end] = batch
            count += end - i
            i = end
        return out, (batch, opened, count, int(t[-1]))

    return _greedy(stream, key, order_by, ts, name, "bigint", (None, None, None, None), walk)
