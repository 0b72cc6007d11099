"""Running folds by any associative function of two columns.

:mod:`eddy.plans.prefix` knows four folds that Spark's windows have.  Here the
fold is given: ``lift`` makes a row's element (any type, often a struct) and
``combine(a, b)`` joins the element of earlier rows with that of later ones.
It must be associative and need not be commutative; it is a Column function,
so the scan stays in the JVM.

1. Rows get their position in the order (a prefix scan), and every ``fan``
   positions of a key are a block: an array of at most ``fan`` rows, folded
   from left to right.
2. The blocks' totals are the elements of the next level, ``fan`` of them a
   block again, until every key has one block: ``log(n) / log(fan)`` levels,
   each ``fan`` times smaller than the one below.
3. Coming back, each block gets what all blocks before it fold to, by a join
   on the unique (key, block), and puts it before its rows.

No array is longer than ``fan``, whatever the size of a key or of the table.

Defined cases: a null key is a key; rows are taken in the order of
``order_by`` (nulls first, ties as the position scan breaks them, so give a
unique last column); an empty table gives an empty result; a column named
like the result is replaced, all others are kept.  ``combine`` sees whatever
``lift`` makes of null values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddy.plans import prefix
from eddy.session import cut_lineage

FAN = 512

Combine = Callable[[Column, Column], Column]


def _blocks(rows: DataFrame, combine: Combine, fan: int) -> DataFrame:
    """``(key, block, items, folds)`` of the rows ``(key, i, v, ..)``: the
    rows of each block in order, and the fold up to each of them."""
    item = F.struct("i", *[c for c in rows.columns if c not in ("key", "i")])
    out = (rows.groupBy("key", F.floor(F.col("i") / fan).alias("block"))
           .agg(F.array_sort(F.collect_list(item), lambda a, b: (a["i"] - b["i"]).cast("int")).alias("items")))
    step = lambda acc, x: F.concat(acc, F.array(combine(acc[F.size(acc) - 1], x["v"])))
    folds = F.aggregate(F.slice("items", 2, fan), F.array(F.col("items")[0]["v"]), step)
    return out.withColumn("folds", folds)


def _before(totals: DataFrame, combine: Combine, fan: int) -> DataFrame:
    """``(key, i, before)`` for the totals ``(key, i, v)`` of blocks: the fold
    of all earlier ones (no row for a key's first)."""
    blocks = cut_lineage(_blocks(totals, combine, fan))
    out = _carried(blocks, combine, fan).select("key", F.explode(F.arrays_zip("items", "folds")).alias("x"))
    return out.select("key", (F.col("x.items.i") + 1).alias("i"), F.struct(F.col("x.folds").alias("v")).alias("before"))


def _carried(blocks: DataFrame, combine: Combine, fan: int) -> DataFrame:
    """``blocks`` with the fold of all earlier blocks put before theirs."""
    if blocks.where("block > 0").isEmpty():
        return blocks
    carry = _before(_totals(blocks), combine, fan).withColumnRenamed("i", "block")
    folds = F.transform("folds", lambda x: combine(F.col("before")["v"], x))
    out = blocks.join(carry, ["key", "block"], "left")
    return out.withColumn("folds", F.when(F.col("before").isNull(), F.col("folds")).otherwise(folds))


def _totals(blocks: DataFrame) -> DataFrame:
    return blocks.select("key", F.col("block").alias("i"), F.element_at("folds", -1).alias("v"))


def fold(df: DataFrame, order_by: Sequence[str], lift: Column, combine: Combine, name: str,
         partition_by: Sequence[str] = (), fan: int = FAN, **kw) -> DataFrame:
    """``df`` with ``name``: the fold of the elements up to each row, in
    ``order_by``, per ``partition_by`` if given."""
    kept = [c for c in df.columns if c != name]
    # The user's row travels as one struct, so no name can clash.
    key = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(partition_by)])) if partition_by else F.lit("")
    rows = df.select(key.alias("key"), lift.alias("v"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                     *[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order_by)])
    order = [f"o{i}" for i in range(len(order_by))]
    rows = prefix.with_index(rows, order, "i", partition_by=["key"] if partition_by else [], **kw).drop(*order)
    blocks = cut_lineage(_blocks(rows, combine, fan))
    out = _carried(blocks, combine, fan).select(F.explode(F.arrays_zip("items", "folds")).alias("x"))
    return out.select(*[F.col("x.items.row")[c].alias(c) for c in kept], F.col("x.folds").alias(name))


# --- elements and their functions ------------------------------------------

def last_non_null(a: Column, b: Column) -> Column:
    """Of elements that may be null: the latest that is not."""
    return F.coalesce(b, a)


def affine(a: Column, b: Column, modulus: int | None = None) -> Column:
    """Of maps ``x -> m * x + c`` (structs of ``m`` and ``c``): first ``a``,
    then ``b``; with a modulus, in whole numbers modulo it."""
    m, c = a["m"] * b["m"], b["m"] * a["c"] + b["c"]
    if modulus is not None:
        m, c = F.pmod(m, F.lit(modulus)), F.pmod(c, F.lit(modulus))
    return F.struct(m.alias("m"), c.alias("c"))


def affine_scan(df: DataFrame, order_by: Sequence[str], m: Column, c: Column, start: Column, name: str,
                partition_by: Sequence[str] = (), modulus: int | None = None, **kw) -> DataFrame:
    """The state ``x`` after each row, where a row makes ``m * x + c`` of it
    and ``start`` is the first; with a modulus, whole numbers modulo it."""
    lift = F.struct(m.alias("m"), c.alias("c"))
    out = fold(df, order_by, lift, lambda a, b: affine(a, b, modulus), name, partition_by, **kw)
    x = F.col(name)["m"] * start + F.col(name)["c"]
    return out.withColumn(name, x if modulus is None else F.pmod(x, F.lit(modulus)))
