"""Greedy per-key scans as pointer chains, for folds that are not
associative (F3 in-flight suppression, A12 count-or-time batches).

Both are "from the current row, the next chosen row is ``next(i)``"
problems, with ``next`` computable for every row independently:

1. ``next(i)`` is an as-of lookup (the first row at or after a time) done
   as a reverse running min over the rows and the probes ordered by time:
   the chunked prefix scan, so a hot key is spread over many tasks.
2. The chosen rows are the chain ``first, next(first), ...``.  The rows of a
   key are cut into blocks of ``BLOCK_ROWS`` positions.  A key of one block
   is walked in one pass.  For longer keys each block is turned, in
   parallel, into its exit table: from each row at which an earlier block
   may enter it to the first row of the chain behind the block.  The exit
   tables are the same problem again, with one node per entry, so blocks of
   many blocks are solved in the same way; going back down, each block is
   walked once from the one entry that the chain takes.

Each level is written once and has far fewer rows than the level below, so
the work is in proportion to the rows.  Where steps are longer than a block
(exit tables would hold about as many rows as the blocks), the chain of that
level is found by pointer doubling (``O(log n)`` equi-joins).  No task holds
more than the rows of one block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.plans import prefix
from eddy.plans.groupscan import sorted_group_map
from eddy.plans.joins import join_small, stored
from eddy.session import cut_lineage

BLOCK_ROWS = 1 << 18
# Behind the last row.
_END = 1 << 62


def as_of_next(df: DataFrame, keys: Sequence[str], idx: str, t: Column, probe: Column,
               name: str = "next_t") -> DataFrame:
    """For each row, the index of the first row of its key whose ``t`` is at
    least the row's ``probe`` (null when there is none).  ``t`` must not
    fall along the index order."""
    keys = list(keys)
    rows = df.select(*keys, t.cast("long").alias("__val"), F.lit(1).alias("__kind"),
                     F.col(idx).cast("long").alias("__row"), F.lit(None).cast("long").alias("__src"))
    probes = df.select(*keys, probe.cast("long").alias("__val"), F.lit(0).alias("__kind"),
                       F.lit(None).cast("long").alias("__row"), F.col(idx).cast("long").alias("__src"))
    # At equal value a probe sorts before the rows, so rows at exactly the
    # probe value count as "at or after".  ``__tb`` = (kind, index) as one
    # unique number: the tie-break that splits a hot time value.
    u = rows.unionByName(probes).withColumn(
        "__tb", F.col("__kind") * F.lit(1 << 48) + F.coalesce(F.col("__row"), F.col("__src")))
    nxt = prefix.running(u, ["__val", "__tb"], {name: ("min", F.col("__row"))},
                         partition_by=keys, reverse=True, exclusive=True, split_ties=True)
    found = nxt.filter(F.col("__kind") == 0).select(*keys, F.col("__src").alias(idx), name)
    return df.join(found, on=[*keys, idx], how="left")


def _levels(df: DataFrame, keys: Sequence[str]) -> int:
    longest = df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 1
    return max(1, math.ceil(math.log2(longest)) + 1)


def _doubled(nodes: DataFrame, keys: list[str], start: int) -> DataFrame:
    """Rows ``(keys, __i)`` on the chain by pointer doubling: jump tables
    ``J_{k+1} = J_k o J_k``, then ``S = S u J_k(S)`` from the longest down."""
    levels = _levels(nodes, keys)
    jump = cut_lineage(nodes.select(*keys, "__i", "__j"))
    tables = [jump]
    for _ in range(levels - 1):
        a = tables[-1].filter(F.col("__j").isNotNull())
        b = tables[-1].select(*[F.col(k).alias(f"__b_{k}") for k in keys],
                              F.col("__i").alias("__m"), F.col("__j").alias("__j2"))
        cond = [F.col(k) == F.col(f"__b_{k}") for k in keys] + [F.col("__j") == F.col("__m")]
        two = (a.join(b, on=cond, how="inner")
                .select(*keys, "__i", F.col("__j2").alias("__j"))
                .filter(F.col("__j").isNotNull()))
        tables.append(cut_lineage(two))
    members = nodes.filter(F.col("__i") == start).select(*keys, "__i")
    for table in reversed(tables):
        hops = (members.join(table, on=[*keys, "__i"], how="inner")
                       .select(*keys, F.col("__j").alias("__i")))
        members = cut_lineage(members.unionByName(hops))
    return members


def _block(at: str, width: int) -> Column:
    return F.floor(F.col(at) / F.lit(width)).cast("long")


def _exits(nodes: DataFrame, keys: list[str], width: int, start: int) -> DataFrame:
    """The exit tables of the blocks: from each entry ``__i`` the first row
    of its chain behind the block as ``__j``, null at the end."""
    rows = nodes.select(*keys, "__i", "__j", F.lit(False).alias("__e"), _block("__i", width).alias("__b"))
    enter = (rows.filter(_block("__j", width) > F.col("__b")).select(*keys, F.col("__j").alias("__i"))
             .unionByName(rows.filter(F.col("__i") == start).select(*keys, "__i")).distinct()
             .select(*keys, "__i", F.lit(None).cast("long").alias("__j"), F.lit(True).alias("__e"),
                     _block("__i", width).alias("__b")))
    schema = T.StructType([*[nodes.schema[k] for k in keys], T.StructField("__i", T.LongType()),
                           T.StructField("__j", T.LongType())])

    def run(t: pa.Table) -> pa.Table:
        entry = t["__e"].to_numpy()
        i, j = t["__i"].to_numpy(), t["__j"].fill_null(_END).to_numpy()
        at, entries, behind = i[~entry], i[entry], (t["__b"][0].as_py() + 1) * width
        out = np.array(j[~entry])
        while (inside := out < behind).any():
            out[inside] = out[np.searchsorted(at, out[inside])]
        found = out[np.searchsorted(at, entries)]
        head = t.select(keys).slice(0, len(entries))
        return head.append_column("__i", pa.array(entries, pa.int64())).append_column(
            "__j", pa.array(found, pa.int64(), mask=found == _END))

    return sorted_group_map(rows.unionByName(enter), [*keys, "__b"], ["__i"], run, schema)


def _walked(rows: DataFrame, keys: list[str], idx: str, nxt: str, width: int, entries: DataFrame | None,
            start: int, name: str) -> DataFrame:
    """``rows`` with the flag ``name`` of those on the chain: each block is
    walked from its one of ``entries`` (keys, __i), or from ``start``."""
    tagged = rows.withColumn("__b", _block(idx, width)).withColumn(
        "__e", F.when(F.col(idx) == start, F.lit(start)).cast("long"))
    if entries is not None:
        first = entries.select(*keys, _block("__i", width).alias("__b"), F.col("__i").alias("__e"))
        first = first.groupBy(*keys, "__b").agg(F.min("__e").alias("__from")).filter(F.col("__b") > 0)
        tagged = join_small(tagged, first, on=[*keys, "__b"], how="left")
        tagged = tagged.withColumn("__e", F.coalesce("__from", "__e")).drop("__from")
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BooleanType())])
    names = rows.columns

    def run(t: pa.Table) -> pa.Table:
        i, j = t[idx].to_numpy(), t[nxt].fill_null(_END).to_numpy()
        to = np.searchsorted(i, j).tolist()
        out = np.zeros(len(i), bool)
        e = t["__e"].drop_null()
        p = int(np.searchsorted(i, e[0].as_py())) if len(e) else len(i)
        while p < len(i):
            out[p] = True
            p = to[p]
        return t.select(names).append_column(name, pa.array(out))

    return sorted_group_map(tagged, [*keys, "__b"], [idx], run, schema)


def on_chain(nodes: DataFrame, keys: Sequence[str], idx: str = "idx", nxt: str = "next", name: str = "chosen",
             start: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``nodes`` with the flag ``name`` of the rows on the chain ``start,
    next(start), ...`` of their key.  ``nodes`` has one row per (keys, idx),
    idx from 0, with ``next`` (null at the end); ``next > idx`` always."""
    keys = list(keys)
    long_keys = nodes.groupBy(*keys).agg(F.max(idx).alias("__max")).filter(F.col("__max") >= block_rows).select(*keys)
    if long_keys.isEmpty():
        return _walked(nodes, keys, idx, nxt, block_rows, None, start, name)
    level = join_small(nodes.select(*keys, F.col(idx).cast("long").alias("__i"), F.col(nxt).cast("long").alias("__j")),
                       long_keys, on=keys, how="left_semi")
    width, levels = block_rows, []
    while True:  # up: the exit tables of the blocks, then of blocks of blocks
        table = stored(_exits(level, keys, width, start), "exits")[0]
        most = table.groupBy(*keys, _block("__i", width).alias("__b")).count().agg(F.max("count")).first()[0]
        last = table.agg(F.max("__i")).first()[0]
        fan = block_rows // most
        if fan < 2:
            entries = _doubled(table, keys, start)
            break
        width *= fan
        if last < width:
            entries = _chosen(_walked(table, keys, "__i", "__j", width, None, start, "__on"), keys)
            break
        levels.append((table, width))
        level = table
    for table, wide in reversed(levels):  # down: each block from the entry that the chain takes
        entries = _chosen(_walked(table, keys, "__i", "__j", wide, entries, start, "__on"), keys)
    return _walked(nodes, keys, idx, nxt, block_rows, entries, start, name)


def _chosen(rows: DataFrame, keys: list[str]) -> DataFrame:
    return stored(rows.filter("__on").select(*keys, "__i"), "entries")[0]
