"""Keyed tables with insert, update and delete (S15, K14-K18), stored as
numbered parquet folders: ``v=<n>`` is a whole version (an update or delete
writes one from the current rows), ``a=<n>`` holds the rows that an insert
added to it, so an insert writes its own rows only.  A folder counts once
its job has committed, so a failed job leaves the table as it was.  Versions
older than the last ``KEEP`` whole ones are dropped.

The table operations are DataFrame functions (``apply_*``); a table
folder only adds versions.  A document store with its own connector is
the same set of operations on its ``format``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.operators.updates import apply_in_sequence
from eddy.plans.joins import join_small


KEEP = 3


def scan(df: DataFrame, cond: Column | None = None) -> DataFrame:
    """Table scan with a predicate (``find(filter)``); Spark pushes it
    into the parquet reader."""
    return df if cond is None else df.filter(cond)


def check_unique_insert(current: DataFrame, new: DataFrame, key: str | Sequence[str]) -> None:
    """Inserting a key (one column or several) that is already present
    (or twice) fails."""
    keys = [key] if isinstance(key, str) else list(key)
    dup_new = new.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1).limit(1).count()
    clash = new.select(*keys).join(current.select(*keys), on=keys, how="left_semi").limit(1).count()
    if dup_new or clash:
        raise ValueError(f"duplicate key on insert into column {key!r}")


def apply_insert(current: DataFrame, new: DataFrame) -> DataFrame:
    """Rows appended (``insertOne`` per row)."""
    return current.unionByName(new.select(*current.columns))


def apply_update_one(current: DataFrame, updates: DataFrame, match: str, sets: Mapping[str, str],
                     order_by: str, update_order: str | None = None) -> DataFrame:
    """For each update (match value, new values) the first row in
    ``order_by`` whose ``match`` column equals it is updated.  The first
    row per match value is a map-side min, joined back.  Several updates
    of one match value hit the same row, so the last one (in
    ``update_order``) wins; without ``update_order`` they are refused, as
    they are when an update rewrites the match column itself."""
    dup = updates.groupBy(match).count().filter(F.col("count") > 1).limit(1).count() > 0
    if dup and (update_order is None or match in sets):
        raise ValueError("several updates of one match value need an order and must keep the match column")
    if update_order is not None:
        last = [F.max_by(F.col(s), F.col(update_order)).alias(f"__new_{c}") for c, s in sets.items()]
    else:
        last = [F.max(F.col(s)).alias(f"__new_{c}") for c, s in sets.items()]  # one update per value
    upd = updates.groupBy(match).agg(*last)
    first = current.join(upd.select(match), on=match, how="left_semi") \
                   .groupBy(match).agg(F.min(order_by).alias("__first"))
    target = first.join(upd, on=match).withColumnRenamed(match, "__m")
    j = current.join(target, (F.col(match) == F.col("__m")) & (F.col(order_by) == F.col("__first")), "left")
    out = j
    for c in sets:
        out = out.withColumn(c, F.when(F.col("__m").isNotNull(), F.col(f"__new_{c}")).otherwise(F.col(c)))
    return out.select(*current.columns)


def apply_update_many(current: DataFrame, updates: DataFrame, match: str, new_value: str,
                      order_by: str) -> DataFrame:
    """Updates ``(match value -> new value)`` on one column, applied in
    ``order_by`` order to every matching row.  One pass equals the sequence
    unless an update's new value is matched by a later update (a chain);
    chains are followed by ``updates.apply_in_sequence``.  Of two updates of
    the same value the first wins (the second no longer finds it)."""
    u = updates.select(F.col(match).alias("__m"), F.col(new_value).alias("__v"), F.col(order_by).alias("__o"))
    # The last update that matches a value is enough to tell a chain.
    last = u.groupBy(F.col("__m").alias("__m2")).agg(F.max("__o").alias("__o2"))
    chained = u.join(last, (F.col("__v") == F.col("__m2")) & (F.col("__o2") >= F.col("__o"))
                     & ((F.col("__v") != F.col("__m")) | (F.col("__o2") > F.col("__o"))))
    if not chained.isEmpty():
        return apply_in_sequence(current, updates, match, new_value, order_by)
    first = u.groupBy("__m").agg(F.min_by(F.struct("__v"), "__o").alias("__new"))
    j = join_small(current, first, on=F.col(match) == F.col("__m"), how="left")
    value = F.when(F.col("__new").isNotNull(), F.col("__new.__v")).otherwise(F.col(match))
    return j.withColumn(match, value).select(*current.columns)


def apply_delete(current: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Delete every row whose ``col`` is in ``keys`` (the disjuncts
    of ``or(eq, eq, ...)`` as a key table), by anti join."""
    k = keys.select(F.col(keys.columns[0]).alias(col)).distinct()
    return join_small(current, k, on=col, how="left_anti")


def disjuncts(spark: SparkSession, values: Sequence, col: str, dtype: str = "long") -> DataFrame:
    """``or(eq(col, v1), eq(col, v2), ...)`` as a key table."""
    return spark.createDataFrame([(v,) for v in values], f"{col} {dtype}")


class KeyedTable:
    """A table folder of whole versions and additions."""

    def __init__(self, spark: SparkSession, path: str, key: str | Sequence[str] | None = None):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _folders(self) -> list[tuple[int, str]]:
        """(number, folder name) of every committed folder, in order."""
        jvm, fs, p = self._fs()
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted((int(n[2:]), n) for n in names if n[:2] in ("v=", "a=")
                      and fs.exists(jvm.org.apache.hadoop.fs.Path(p, f"{n}/_SUCCESS")))

    def versions(self) -> list[int]:
        return [n for n, _ in self._folders()]

    def current(self) -> DataFrame | None:
        """The last whole version and what was added since."""
        got = self._folders()
        if not got:
            return None
        start = max((i for i, (_, name) in enumerate(got) if name.startswith("v=")), default=0)
        return self.spark.read.parquet(*[f"{self.path}/{name}" for _, name in got[start:]])

    def _next(self) -> int:
        return max(self.versions(), default=0) + 1

    def write(self, df: DataFrame) -> DataFrame:
        """A new whole version."""
        target = f"v={self._next():08d}"
        df.write.mode("overwrite").parquet(f"{self.path}/{target}")
        jvm, fs, p = self._fs()
        got = self._folders()
        whole = [i for i, (_, name) in enumerate(got) if name.startswith("v=")]
        for _, name in got[:whole[-KEEP]] if len(whole) > KEEP else []:
            fs.delete(jvm.org.apache.hadoop.fs.Path(p, name), True)
        return self.spark.read.parquet(f"{self.path}/{target}")

    def insert(self, rows: DataFrame, unique: bool = True) -> DataFrame:
        cur = self.current()
        if unique and self.key:
            check_unique_insert(rows.limit(0) if cur is None else cur, rows, self.key)
        if cur is None:
            return self.write(rows)
        rows.select(*cur.columns).write.mode("overwrite").parquet(f"{self.path}/a={self._next():08d}")
        return self.current()

    def update_one(self, updates: DataFrame, match: str, sets: Mapping[str, str], order_by: str) -> DataFrame:
        return self.write(apply_update_one(self.current(), updates, match, sets, order_by))

    def update_many(self, updates: DataFrame, match: str, new_value: str, order_by: str) -> DataFrame:
        return self.write(apply_update_many(self.current(), updates, match, new_value, order_by))

    def delete(self, keys: DataFrame, col: str) -> DataFrame:
        return self.write(apply_delete(self.current(), keys, col))

    def copy_to(self, other: "KeyedTable", cond: Column | None = None) -> DataFrame:
        """Rows of this table (committed version) inserted into another."""
        return other.insert(scan(self.current(), cond), unique=other.key is not None)
