"""Grouping and keyed folds: counts (A1), ordered lists per group (A2),
lists split by a predicate (A3), merged count tables (A9), default-or-
update (A10), running id sets / first seen (A8), keyed lookup with a miss
error (J3), last-write-wins put (J4), fragments joined into messages
(S16).

Ordered lists are returned in long form ``(keys, pos, value)``: one row
per element with its 0-based position from the chunked prefix scan, so a
hot group is never gathered into one task or one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.plans import prefix
from eddy.plans.joins import join_small


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    """A1: global count (``fold(0)(_ + 1)``), partial counts per task."""
    return df.agg(F.count(F.lit(1)).alias(name))


def group_list(df: DataFrame, key: Column | str, order_by: Sequence[str], value: str,
               key_name: str = "grp", pos: str = "pos") -> DataFrame:
    """A2: each group's values in order, as ``(grp, pos, value)`` rows.
    Positions come from the per-key prefix scan."""
    keyed = df.withColumn(key_name, F.col(key) if isinstance(key, str) else key)
    out = prefix.with_index(keyed, order_by, pos, partition_by=[key_name])
    return out.select(key_name, pos, value)


def group_sizes(df: DataFrame, key: Column | str, key_name: str = "grp") -> DataFrame:
    """A2: number of values per group (partial counts per task)."""
    keyed = df.withColumn(key_name, F.col(key) if isinstance(key, str) else key)
    return keyed.groupBy(key_name).agg(F.count(F.lit(1)).alias("n"))


def split_lists(df: DataFrame, pred: Column, order_by: Sequence[str], value: str,
                names: tuple[str, str] = ("even", "odd")) -> DataFrame:
    """A3: fold into two ordered lists by a predicate; long form
    ``(list, pos, value)`` with a position inside each list."""
    tagged = df.withColumn("list", F.when(pred, F.lit(names[0])).otherwise(F.lit(names[1])))
    out = prefix.with_index(tagged, order_by, "pos", partition_by=["list"])
    return out.select("list", "pos", value)


def merge_counts(tables: Sequence[DataFrame], key: str, count: str = "n") -> DataFrame:
    """Merge of count tables: union, then sum per key."""
    u = reduce(lambda a, b: a.unionByName(b), tables)
    return u.groupBy(key).agg(F.sum(count).cast("long").alias(count))


def adjust(table: DataFrame, updates: DataFrame, key: str, value: str, default, f=None,
           add: str | None = None) -> DataFrame:
    """A10: ``m.updated(k, f(m.getOrElse(k, default)))`` once for each row of
    ``updates``; keys not updated are kept.  The updates of a key are counted
    map-side and ``f`` is applied that often.  Updates that add the column
    ``add`` are summed map-side instead, which suits keys with very many."""
    by = F.sum(F.col(add)) if add else F.count(F.lit(1))
    upd = updates.groupBy(key).agg(by.alias("__by")).withColumnRenamed(key, "__k")
    j = table.join(upd, F.col(key).eqNullSafe(F.col("__k")), "full_outer")
    kind = table.schema[value].dataType
    cur, hit = F.coalesce(F.col(value), F.lit(default).cast(kind)), F.col("__by").isNotNull()
    new = cur + F.col("__by") if add else F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("__by")), cur, lambda acc, _: f(acc).cast(kind))
    return j.select(F.when(hit, F.col("__k")).otherwise(F.col(key)).alias(key),
                    F.when(hit, new.cast(kind)).otherwise(F.col(value)).alias(value))


def first_seen(df: DataFrame, key: str, order_by: str, name: str = "first_seen") -> DataFrame:
    """Rows pass through with a flag set on the first row of each id
    (the id joins the running set there).  The first position per id is a
    map-side min joined back by id."""
    firsts = df.groupBy(key).agg(F.min(order_by).alias("__first"))
    out = join_small(df, firsts, on=key, how="left")
    return out.withColumn(name, F.col(order_by) == F.col("__first")).drop("__first")


def seen_set(df: DataFrame, key: str) -> DataFrame:
    """The set of ids seen (union of streams, de-duplicated)."""
    return df.select(key).distinct()


# Fixed value: the failure of a lookup whose key is missing.
KEY_NOT_FOUND = "KeyNotFound: "


def lookup(requests: DataFrame, table: DataFrame, key: str, value: str,
           error: str = "error") -> DataFrame:
    """Keyed lookup; a key not in the table gets ``KeyNotFound``."""
    t = table.select(F.col(key), F.col(value), F.lit(True).alias("__hit"))
    out = join_small(requests, t, on=key, how="left")
    return out.withColumn(error, F.when(F.col("__hit").isNull(),
                                        F.concat(F.lit(KEY_NOT_FOUND),
                                                 F.coalesce(F.col(key).cast("string"), F.lit("null"))))) \
              .drop("__hit")


def last_put(df: DataFrame, key: str, value: str, order_by: Sequence[str],
             name: str | None = None, last: str | None = None) -> DataFrame:
    """Last write wins per key (``map.put`` in order), ``max_by``
    combined map-side; ``last`` also names the order value of that write."""
    order = F.struct(*[F.col(c) for c in order_by]) if len(order_by) > 1 else F.col(order_by[0])
    also = [F.max(order).alias(last)] if last else []
    return df.groupBy(key).agg(F.max_by(F.col(value), order).alias(name or value), *also)


def join_fragments(df: DataFrame, key: str, order_by: str, text: str,
                   sep: str = "", name: str = "message", piece_rows: int = 1024) -> DataFrame:
    """A message arriving in fragments becomes one string, fragments
    in order.  Fragments are joined in two levels: pieces of at most
    ``piece_rows`` fragments (positions from the per-key prefix scan, so a
    huge message is spread over many tasks), then the pieces of each
    message.  Only the final string, the result itself, is one row."""
    idx = prefix.with_index(df, [order_by], "__i", partition_by=[key])
    pieces = (idx.withColumn("__piece", F.floor(F.col("__i") / piece_rows).cast("long"))
                 .groupBy(key, "__piece")
                 .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__i", text))),
                                               lambda s: s[text]), sep).alias("__s"),
                      F.count(F.lit(1)).alias("__n")))
    parts = F.sort_array(F.collect_list(F.struct("__piece", "__s")))
    return (pieces.groupBy(key)
                  .agg(F.array_join(F.transform(parts, lambda s: s["__s"]), sep).alias(name),
                       F.sum("__n").cast("long").alias("fragments")))
