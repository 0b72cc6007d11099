"""Event-time windows (W2, W3, W5), the row-exact watermark (W4), count
windows (W1) and intervals between marked rows (W6), key-conflict rounds
(W8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.plans import prefix


def _ts_type(df: DataFrame, ts: str) -> str:
    return df.schema[ts].dataType.simpleString()


def assign_windows(df: DataFrame, ts: str, length: str, step: str | None = None,
                   start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Every row once per window that holds it; windows are half-open
    ``[start, end)`` and aligned to the epoch.  ``step`` must divide
    ``length`` (one row falls in ``length/step`` windows)."""
    ttype = _ts_type(df, ts)
    if step and _interval_us(length) % _interval_us(step):
        raise ValueError(f"window step {step!r} must divide the length {length!r}")
    w = F.window(F.col(ts), length, step) if step else F.window(F.col(ts), length)
    out = df.withColumn("__w", w)
    return (out.withColumn(start, F.col("__w.start").cast(ttype))
               .withColumn(end, F.col("__w.end").cast(ttype))
               .drop("__w"))


def window_counts(df: DataFrame, ts: str, length: str, step: str | None = None,
                  by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows per (window, keys); partial counts are combined map-side.
    Sliding windows add up counts of panes (tumbling windows of ``step``):
    a pane's count is copied to its windows, never a row."""
    if not step or step == length:
        return (assign_windows(df, ts, length)
                .groupBy("window_start", "window_end", *by)
                .agg(F.count(F.lit(1)).alias(name)))
    panes = assign_windows(df, ts, step, start="__pane", end="__pane_end") \
        .groupBy("__pane", *by).agg(F.count(F.lit(1)).alias("__n"))
    return (assign_windows(panes, "__pane", length, step)
            .groupBy("window_start", "window_end", *by)
            .agg(F.sum("__n").alias(name)))


def exact_watermark(df: DataFrame, ts: str, order_by: Sequence[str], max_delay_us: int,
                    name: str = "wm", carry_us: int | None = None, **kw) -> DataFrame:
    """``wm = max(wm, ts - max_delay)`` over all rows in arrival order,
    updated before the row is checked.  Adds ``wm`` and ``late`` (the row
    is dropped by the watermark: ``ts < wm``).  ``carry_us`` is the largest
    time before the first row, if rows came earlier (a stream's batches)."""
    ttype = _ts_type(df, ts)
    as_us = prefix.order_number(df, ts)
    out = prefix.running(df, order_by, {"__maxts": ("max", as_us)}, **kw)
    wm_us = F.greatest(F.col("__maxts"), F.lit(carry_us).cast("long")) - F.lit(max_delay_us)
    out = out.withColumn(name, F.timestamp_micros(wm_us).cast(ttype))
    return out.withColumn("late", as_us < wm_us).drop("__maxts")


def drop_late(df: DataFrame, ts: str, order_by: Sequence[str], max_delay_us: int, **kw) -> DataFrame:
    """W4 as a filter: only rows that the watermark accepts."""
    return exact_watermark(df, ts, order_by, max_delay_us, **kw).filter(~F.col("late")).drop("late")


def _interval_us(text: str) -> int:
    """Micros of a simple interval string such as ``3 hours``."""
    units = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6,
             "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}
    total, parts = 0, text.split()
    for num, unit in zip(parts[0::2], parts[1::2]):
        total += int(num) * units[unit.rstrip("s")]
    return total


def window_lifecycle(df: DataFrame, ts: str, order_by: Sequence[str], max_delay_us: int,
                     length: str, step: str | None = None, by: Sequence[str] = (),
                     event_id: str | None = None, carry_us: int | None = None,
                     still_open: DataFrame | None = None) -> DataFrame:
    """One row per (window, keys) with its Open event (first accepted
    row in it), its Close event (first accepted row whose watermark is past
    the window end, strictly) and the count of rows added.  A window never
    closed has a null close event: it is flushed at end of input.

    The watermark never falls, so only the rows where it rises can close a
    window.  Those rows and the window ends are put in one list ordered by
    value; the close row of a window is the smallest arrival among the
    rising rows after it, a reverse running min: no range join.

    On a stream's batch ``carry_us`` is the largest time before it and
    ``still_open`` the windows it finds open, with the same columns but
    ``close_event``; they get their rows and their Close event like others.
    """
    event_id = event_id or order_by[-1]
    if len(order_by) != 1:
        raise ValueError("window_lifecycle needs one unique integer arrival column")
    arrival = order_by[0]
    # Read three times below (windows, rising rows, window ends): computed once.
    # One scan carries the watermark before and at each row: the row's own
    # time raises it or not, so the exclusive running max is enough.
    as_us = prefix.order_number(df, ts)
    before = prefix.running(df, order_by, {"__before": ("max", as_us)}, exclusive=True)
    before = before.withColumn("__before", F.greatest(F.col("__before"), F.lit(carry_us).cast("long")))
    at = F.greatest(F.col("__before"), as_us) - F.lit(max_delay_us)
    marked = prefix.materialize_if_derived(
        before.withColumn("__wm", at).withColumn("__prev", F.col("__before") - F.lit(max_delay_us))
        .withColumn("late", as_us < at).drop("__before"))
    accepted = marked.filter(~F.col("late")).drop("__wm", "__prev", "late")
    wins = (assign_windows(accepted, ts, length, step)
            .groupBy("window_start", "window_end", *by)
            .agg(F.min(event_id).alias("open_event"), F.count(F.lit(1)).alias("n")))
    if still_open is not None:
        wins = (wins.unionByName(still_open).groupBy("window_start", "window_end", *by)
                    .agg(F.min("open_event").alias("open_event"), F.sum("n").alias("n")))

    # Rows that raise the watermark (wm strictly above every earlier wm).
    rising = (marked.filter(F.col("__prev").isNull() | (F.col("__wm") > F.col("__prev")))
              .select(F.col("__wm").alias("__val"), F.lit(0).alias("__kind"),
                      F.col(arrival).cast("long").alias("__row")))
    ends = (wins.select("window_end").distinct()
            .select(prefix.order_number(wins, "window_end").alias("__val"),
                    F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__row")))
    # At equal value a rising row sorts before the window end, so only
    # rows strictly above the end follow it.
    merged = rising.unionByName(ends)
    nxt = prefix.running(merged, ["__val", "__kind"], {"__close": ("min", F.col("__row"))},
                         reverse=True, exclusive=True, split_ties=False)
    closes = nxt.filter(F.col("__kind") == 1).select(
        F.timestamp_micros(F.col("__val")).cast(_ts_type(df, ts)).alias("window_end"),
        F.col("__close").alias("close_event"))
    return wins.join(closes, on="window_end", how="left")


def count_windows(df: DataFrame, order_by: Sequence[str], size: int, step: int,
                  value: str, partition_by: Sequence[str] = (), keep_partial: bool = True) -> DataFrame:
    """Windows of ``size`` rows every ``step`` rows in order (``sliding``).
    Window ``k`` holds positions ``k*step <= i < k*step + size``.  Returns
    one row per window with the ordered values and the row count."""
    idx = prefix.with_index(df, order_by, "__i", partition_by=partition_by)
    # Window ids covering position i: ceil((i - size + 1) / step) .. floor(i / step).
    lo = F.greatest(F.lit(0), F.ceil((F.col("__i") - F.lit(size - 1)) / F.lit(step))).cast("long")
    hi = F.floor(F.col("__i") / F.lit(step)).cast("long")
    # With step > size some rows fall between windows (lo > hi).
    exploded = idx.filter(lo <= hi).withColumn("win", F.explode(F.sequence(lo, hi)))
    grouped = exploded.groupBy(*partition_by, "win").agg(
        F.sort_array(F.collect_list(F.struct(F.col("__i"), F.col(value)))).alias("__items"),
        F.count(F.lit(1)).alias("n"), F.max("__i").alias("__last"))
    out = grouped.withColumn("values", F.transform("__items", lambda s: s[value])).drop("__items")
    # A short window at the end of input is emitted only when it holds a
    # row that no earlier window held (the stream operator's end rule).
    fresh = F.col("__last") >= (F.col("win") - 1) * F.lit(step) + F.lit(size)
    keep = (F.col("n") == size) | ((F.col("win") == 0) | fresh if keep_partial else F.lit(False))
    return out.filter(keep).drop("__last")


def interval_between(df: DataFrame, ts: str, order_by: Sequence[str], marked: Column,
                     partition_by: Sequence[str] = ()) -> DataFrame:
    """For rows matching ``marked``, the time since the previous
    marked row (in order, per key).  The marked rows are indexed by the
    prefix scan and paired with the previous index by an equi-join on
    (keys, index), so no key or order is gathered in one task."""
    keys = list(partition_by)
    m = df.filter(marked)
    idx = prefix.with_index(m, order_by, "__i", partition_by=keys)
    prev = idx.select(*keys, (F.col("__i") + 1).alias("__i"), F.col(ts).alias("prev_ts"))
    return idx.join(prev, on=[*keys, "__i"], how="left").drop("__i")


def conflict_rounds(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """With every request for a key arriving in one burst and one
    running request per key, the k-th request of a key runs in round k-1
    and was put off k-1 times.  The per-key rank runs in the prefix scan,
    so one hot key is spread over many tasks."""
    out = prefix.with_index(df, order_by, "round", partition_by=[key])
    return out.withColumn("put_off", F.col("round"))
