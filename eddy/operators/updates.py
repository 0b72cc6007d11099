"""Updates that see what earlier updates wrote (K16 in full): a list of
``match value -> new value`` is applied in order, each to every row that
holds its match value at that moment, chains and cycles included.

A row's history depends on its value alone: the first update that matches
the value, then the first *later* update that matches what that one wrote,
and so on.  So the work is on the updates, not on the rows:

1. Every update gets its position in the order (prefix scan).
2. The next update of each one is an as-of lookup: per value, what updates
   write and what updates match are put in one list, and a reverse running
   minimum finds the first later match.  Hot values are cut into chunks.
3. Pointer doubling follows the chains: each round joins the updates that
   are not at their end with the table itself by position, so a chain of
   ``d`` updates takes ``log2(d)`` rounds.
4. The first update of each value gives the value's end, one row for each
   match value, and the table is joined with that once.

Defined cases: a null match value matches nothing, and null rows stay as
they are; a null new value ends the chain (the row becomes null).  Updates
with equal order values are taken by match value, then new value; equal
updates that are repeated are applied as often.  Null order values come
first.  An update of a value to itself changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.plans import prefix
from eddy.plans.joins import join_small
from eddy.session import cut_lineage


def _next_updates(steps: DataFrame, **kw) -> DataFrame:
    """``(at, value, next)`` of each update ``(at, match, value)``: the
    first later update that matches the value it writes."""
    # From the end: at one position the value written is looked up before
    # the position's own match counts, so an update never follows itself.
    written = steps.select(F.col("__value").alias("__key"), "__at", F.lit(1).alias("__kind"))
    matched = steps.select(F.col("__match").alias("__key"), "__at", F.lit(0).alias("__kind")) \
                   .filter(F.col("__key").isNotNull())
    both = written.unionByName(matched).withColumn("__hit", F.when(F.col("__kind") == 0, F.col("__at")))
    found = prefix.running(both, ["__at", "__kind"], {"__next": ("min", F.col("__hit"))},
                           partition_by=["__key"], reverse=True, exclusive=True, **kw)
    return found.filter(F.col("__kind") == 1).select("__at", F.col("__key").alias("__value"), "__next")


def _ends(links: DataFrame) -> DataFrame:
    """``(at, value)``: the value at the end of each update's chain."""
    links = cut_lineage(links)
    while not links.filter(F.col("__next").isNotNull()).isEmpty():
        to = links.select(F.col("__at").alias("__to"), F.col("__value").alias("__to_value"),
                          F.col("__next").alias("__to_next"))
        moved = (links.filter(F.col("__next").isNotNull())
                      .join(to, F.col("__next") == F.col("__to"), "inner")
                      .select("__at", F.col("__to_value").alias("__value"), F.col("__to_next").alias("__next")))
        links = cut_lineage(links.filter(F.col("__next").isNull()).unionByName(moved))
    return links.select("__at", "__value")


def outcomes(updates: DataFrame, match: str, new_value: str, order_by: str | Sequence[str],
             **kw) -> DataFrame:
    """``(__match, __value)``: what each matched value has become after all
    updates, one row for each match value."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    dtype = updates.schema[match].dataType
    listed = updates.select(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                            F.col(match).alias("__match"), F.col(new_value).cast(dtype).alias("__value"))
    ranks = [*[f"__o{i}" for i in range(len(order))], "__match", "__value"]
    steps = cut_lineage(prefix.with_index(listed, ranks, "__at", **kw).select("__at", "__match", "__value"))
    first = (steps.filter(F.col("__match").isNotNull()).groupBy("__match").agg(F.min("__at").alias("__at")))
    return first.join(_ends(_next_updates(steps, **kw)), on="__at").select("__match", "__value")


def apply_in_sequence(current: DataFrame, updates: DataFrame, match: str, new_value: str,
                      order_by: str | Sequence[str], **kw) -> DataFrame:
    """``current`` after all updates, applied one after another to the
    column ``match``; the other columns stay as they are."""
    end = outcomes(updates, match, new_value, order_by, **kw).withColumn("__updated", F.lit(True))
    j = join_small(current, end, on=F.col(match) == F.col("__match"), how="left")
    value = F.when(F.col("__updated"), F.col("__value")).otherwise(F.col(match))
    return j.withColumn(match, value).select(*current.columns)
