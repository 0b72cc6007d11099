"""Live carts with journal, snapshot and tail (F1, F2).

Each micro-batch of commands is answered from the state before it: the
newest snapshot and the journal since.  The accepted events are the
micro-batch's part of the journal.  After every ``every`` micro-batches the
snapshot is merged with the tail into the next one, so neither an answer
nor a recovery reads the journal before the snapshot, and a micro-batch
writes its own events only.

Journal, replies and snapshots are written under the batch's id before the
checkpoint commits; a batch tried again starts from the same snapshot and
tail and overwrites its own.  Commands must arrive in ``seq`` order across
batches; ``seq`` is unique.  Commands without a cart belong to none and get
no row; a null item is an item.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.plans.joins import join_small
from eddy.streaming import scans


def _snapshot_before(batch_id: int, every: int) -> int:
    """The micro-batch whose snapshot ``batch_id`` starts from (-1: none)."""
    return batch_id // every * every - 1


def _tail(spark: SparkSession, path: str, schema, after: int, to: int) -> DataFrame:
    """Journal of the micro-batches ``after + 1`` to ``to``; others are not
    read (``batch_id`` is the folder)."""
    if to <= after:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/journal/batch_id={b}" for b in range(after + 1, to + 1)])


def _items(events: DataFrame, value: str) -> DataFrame:
    """Last event per (cart, item); equal in form to a snapshot's rows."""
    last = F.max_by(F.struct("cmd", value), F.col("seq"))
    return events.groupBy("cart", "item").agg(last.alias("last"), F.max("seq").alias("seq")) \
                 .select("cart", "item", "last.cmd", f"last.{value}", "seq")


def _opened(events: DataFrame) -> DataFrame:
    # The journal holds one add per cart that opened it; later adds are not accepted.
    return events.filter(F.col("cmd") == "add").groupBy("cart").agg(F.min("seq").alias("init"))


def live_carts(path: str, every: int = 10, value: str = "quantity") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over commands ``(cart, seq, cmd, item,
    value)``.  ``path/replies`` gets the reply to each command,
    ``path/journal`` the accepted events; :func:`contents` gives the carts."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cmds = batch.select("cart", "seq", "cmd", "item", value).filter(F.col("cart").isNotNull())
        last = _snapshot_before(batch_id, every)
        tail = _tail(spark, path, cmds.schema, last, batch_id - 1)
        opened = _opened(tail)
        if last >= 0:
            opened = opened.unionByName(spark.read.parquet(f"{path}/opened/batch_id={last}"))
        opened = join_small(opened, cmds.select("cart").distinct(), on="cart", how="left_semi")
        answered = state.cart_accepted(cmds, opened_before=opened)
        answered.select("seq", "cart", "cmd", "reply").write.mode("overwrite").parquet(
            f"{path}/replies/batch_id={batch_id}")
        state.journal_of(answered).write.mode("overwrite").parquet(f"{path}/journal/batch_id={batch_id}")
        if batch_id == last + every:
            events = _tail(spark, path, cmds.schema, last, batch_id)
            opened, items = _opened(events), _items(events, value)
            if last >= 0:
                opened = opened.unionByName(spark.read.parquet(f"{path}/opened/batch_id={last}")) \
                               .groupBy("cart").agg(F.min("init").alias("init"))
                items = _items(items.unionByName(spark.read.parquet(f"{path}/items/batch_id={last}")), value)
            opened.write.mode("overwrite").parquet(f"{path}/opened/batch_id={batch_id}")
            # A removed item is as one that never was.
            items.filter(F.col("cmd") != "remove").write.mode("overwrite").parquet(f"{path}/items/batch_id={batch_id}")
            for t in ("opened", "items"):
                scans._drop(spark, f"{path}/{t}/batch_id={last - every}")
    return run


def contents(spark: SparkSession, path: str, schema, batch_id: int | None = None, every: int = 10,
             value: str = "quantity") -> DataFrame:
    """The carts after micro-batch ``batch_id`` (the last one answered, if
    it is not given), from the snapshot that it
    left or started from and the journal since: ``cart, item, value,
    touched``.  ``schema`` is that of the commands."""
    if batch_id is None:
        batch_id = spark.read.parquet(f"{path}/replies").agg(F.max("batch_id")).first()[0]
    last = _snapshot_before(batch_id + 1, every)
    schema = type(schema)([schema[c] for c in ("cart", "seq", "cmd", "item", value)])
    items = _items(_tail(spark, path, schema, last, batch_id), value)
    if last >= 0:
        items = _items(items.unionByName(spark.read.parquet(f"{path}/items/batch_id={last}")), value)
    return items.filter(F.col("cmd") != "remove").select("cart", "item", value, F.col("seq").alias("touched"))
