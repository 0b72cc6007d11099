"""Routing of rows: two-way and n-way partition (T9, T10), fan-out to
several branches (T11), merge (T12), divert (T13), bound checks (T15),
per-row recovery (T18) and supervision by error class (T19).

All branches of a query are one computed column (:func:`route`,
:func:`port`), so the rows are read once; a filter on it makes a branch of
its own only where a separate sink needs one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def route(df: DataFrame, rules: Sequence[tuple[Column, str]], default: str, name: str = "branch") -> DataFrame:
    """Each row with the label of the first rule that it fulfils (a
    null condition is not fulfilled), else ``default``; one pass."""
    label = F.lit(default)
    for cond, value in reversed(list(rules)):
        label = F.when(cond, F.lit(value)).otherwise(label)
    return df.withColumn(name, label)


def port(df: DataFrame, selector: Column, n: int, name: str = "branch") -> DataFrame:
    """Each row with its output number; a selector outside ``[0, n)``
    fails the query, as a bad port would."""
    tagged = df.withColumn(name, selector.cast("int"))
    return tagged.withColumn(
        name, F.when((F.col(name) >= 0) & (F.col(name) < n), F.col(name))
        .otherwise(F.raise_error(F.concat(F.lit("partition selector out of range: "),
                                          F.coalesce(F.col(name).cast("string"), F.lit("null"))))))


def partition(df: DataFrame, selector: Column, n: int, name: str = "branch") -> list[DataFrame]:
    """``n`` outputs for separate sinks; output ``i`` holds the rows
    whose selector is i."""
    tagged = port(df, selector, n, name)
    return [tagged.filter(F.col(name) == i) for i in range(n)]


def hash_route(df: DataFrame, key: Column, n: int, name: str = "worker",
               physical: bool = False) -> DataFrame:
    """Route each row to worker ``pmod(key, n)`` (a column: each
    branch is a filter on it and runs in parallel tasks).  ``physical``
    also hash-partitions the rows into exactly ``n`` partitions, one per
    worker; only worth it when ``n`` is large enough for the data."""
    out = df.withColumn(name, F.pmod(key, F.lit(n)))
    return out.repartition(n, F.col(name)) if physical else out


def merge(branches: Sequence[DataFrame]) -> DataFrame:
    """Union of branches by column name (``Merge``)."""
    return reduce(lambda a, b: a.unionByName(b), branches)


def merge_distinct(branches: Sequence[DataFrame]) -> DataFrame:
    """Union, de-duplicated."""
    return merge(branches).distinct()


def fan_out(df: DataFrame, branches: Sequence[Callable[[DataFrame], None]],
            storage=None) -> None:
    """Run several sinks over the same rows; the rows are persisted
    once so the source is read once, then released."""
    from pyspark import StorageLevel
    cached = df.persist(storage or StorageLevel.MEMORY_AND_DISK)
    try:
        for sink in branches:
            sink(cached)
    finally:
        cached.unpersist()


def divert(df: DataFrame, cond: Column, left: Callable[[DataFrame], DataFrame] | None = None):
    """Rows matching ``cond`` go to the side output (``Left``); the
    others continue.  Returns ``(continue, diverted)``; ``left`` maps the
    diverted rows (so a side branch can divert again: a decision tree)."""
    flag = "__div"
    tagged = df.withColumn(flag, F.coalesce(cond, F.lit(False)))
    right = tagged.filter(~F.col(flag)).drop(flag)
    diverted = tagged.filter(F.col(flag)).drop(flag)
    if left is not None:
        diverted = left(diverted)
    return right, diverted


def flag_over(df: DataFrame, value: Column, limit, name: str = "over_limit",
              observation: Observation | None = None) -> DataFrame:
    """Rows above ``limit`` are flagged (and counted on an
    observation), yet still passed on and acknowledged."""
    out = df.withColumn(name, value > F.lit(limit))
    if observation is not None:
        out = out.observe(observation, F.count_if(F.col(name)).alias("over_limit"),
                          F.count(F.lit(1)).alias("rows"))
    return out


def recover(df: DataFrame, result: Column, default, name: str = "result",
            error: str = "error") -> DataFrame:
    """Per-row recovery.  ``result`` should be a ``try_*`` style
    expression that is null on failure; a failed row gets ``default`` and
    an error flag, and is still passed on (so its offset commits)."""
    return (df.withColumn(error, result.isNull())
              .withColumn(name, F.coalesce(result, F.lit(default))))


def supervise(df: DataFrame, parsed: Column, fatal: Column | None = None, name: str = "parsed"):
    """Parse errors skip the row (returned as rejects); rows matching
    ``fatal`` stop the query with an error.  Returns ``(ok, rejected)``."""
    out = df.withColumn(name, parsed)
    if fatal is not None:
        out = out.withColumn(name, F.when(fatal, F.raise_error(F.lit("fatal row"))).otherwise(F.col(name)))
    # A one-element array exploded without its nulls, not a Filter: a
    # filter would be pushed below the parse and parse every row twice.
    others = [c for c in out.columns if c != name]
    ok = out.select(*others, F.explode(F.filter(F.array(F.col(name)), lambda x: x.isNotNull())).alias(name))
    rejected = out.filter(F.col(name).isNull()).drop(name)
    return ok, rejected
