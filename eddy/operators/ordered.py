"""Operators whose result depends on row order: index (T6), take (T7),
take-while (T8), round robin (T14), positional zip (J1), running fold
with seed (A7), count batches (A11), last row (W7, K6).

Order is always an explicit column list ending in a unique tie-break.
Running values go through the chunked prefix scan, never a window
without ``partitionBy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.plans import prefix


def zip_with_index(df: DataFrame, order_by: Sequence[str], name: str = "idx",
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """0-based index in order (per key with ``partition_by``)."""
    return prefix.with_index(df, order_by, name, partition_by=partition_by)


def take(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in order.  Spark plans this as a
    TakeOrderedAndProject: a per-partition top-n, then one merge of
    at most n rows per partition."""
    return df.orderBy(*order_by).limit(n)


def take_while(df: DataFrame, order_by: Sequence[str], keep: Column,
               partition_by: Sequence[str] = (), inclusive: bool = True) -> DataFrame:
    """Rows up to the first row where ``keep`` fails (that row too when
    ``inclusive``), per key.  A row stays while no earlier row failed: a
    running count of failures (chunked prefix scan, so a hot key is spread
    over many tasks, and no join or cross product is needed)."""
    failed = F.when(F.coalesce(keep, F.lit(False)), F.lit(0)).otherwise(F.lit(1))
    run = prefix.running(df, order_by, {"__fails": ("sum", failed)}, partition_by=partition_by,
                         exclusive=inclusive)
    return run.filter(F.coalesce(F.col("__fails"), F.lit(0)) == 0).drop("__fails")


def round_robin(df: DataFrame, order_by: Sequence[str], n: int, name: str = "worker") -> DataFrame:
    """Row i goes to worker ``i % n`` (a stable column; use
    ``repartition`` on it for the physical spread)."""
    out = prefix.with_index(df, order_by, "__i")
    return out.withColumn(name, F.pmod(F.col("__i"), F.lit(n))).drop("__i")


def zip_positional(left: DataFrame, right: DataFrame, left_order: Sequence[str],
                   right_order: Sequence[str], name: str = "idx",
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Pair the i-th row of each side (per partition key); ends
    with the shorter side.  Both sides are indexed by the prefix scan,
    then equi-joined on (keys, index)."""
    li = prefix.with_index(left, left_order, name, partition_by=partition_by)
    ri = prefix.with_index(right, right_order, name, partition_by=partition_by)
    return li.join(ri, on=[*partition_by, name], how="inner")


def scan(df: DataFrame, order_by: Sequence[str], value: Column, name: str = "acc",
         seed=0, seed_row: dict | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Running sum that also emits the seed first (``scan``).  The seed
    row carries ``seed_row`` values for the other output columns."""
    run = prefix.running(df, order_by, {name: ("sum", value)}, partition_by=partition_by)
    run = run.withColumn(name, F.col(name) + F.lit(seed))
    if seed_row is None:
        return run
    cols = run.columns
    row = {c: F.lit(seed_row.get(c)).cast(run.schema[c].dataType) for c in cols}
    row[name] = F.lit(seed).cast(run.schema[name].dataType)
    seed_df = run.sparkSession.range(1).select(*[row[c].alias(c) for c in cols])
    return seed_df.unionByName(run)


def count_batches(df: DataFrame, order_by: Sequence[str], size: int, name: str = "batch",
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Batch id ``floor(i / size)`` for full batches of ``size`` rows in
    order (the last may be short)."""
    out = prefix.with_index(df, order_by, "__i", partition_by=partition_by)
    return out.withColumn(name, F.floor(F.col("__i") / F.lit(size)).cast("long")).drop("__i")


def last_indexed(df: DataFrame, order_by: Sequence[str], name: str = "idx") -> DataFrame:
    """W7 + K6: the last row with its index.  No scan needed: the index of
    the last row is ``count - 1``; ``max_by`` combines map-side."""
    order = F.struct(*[F.col(c) for c in order_by])
    last = F.max_by(F.struct(*[F.col(c) for c in df.columns]), order)
    out = df.agg((F.count(F.lit(1)) - 1).alias(name), last.alias("__row"))
    return out.select(name, "__row.*").filter(F.col(name) >= 0)


def first_row(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """K6: the first row (``Sink.head``)."""
    order = F.struct(*[F.col(c) for c in order_by])
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), order)
    return df.agg(first.alias("__row"), F.count(F.lit(1)).alias("__n")) \
             .filter(F.col("__n") > 0).select("__row.*")
