"""Ordered scans over a stream (T6, A7, W4, W5): each micro-batch runs the
chunked prefix scan of the batch form, starting from what the batch before
left behind.

What is carried is small: one row of numbers (rows so far, largest time,
running sum), and for windows the table of open windows, which Spark reads
and joins like any other.  Batch ``b`` reads the carry of ``b - 1`` and
writes its own under its id, as it writes its output, both before the
stream's checkpoint commits ``b``.  A crash anywhere in between runs ``b``
again from the same carry over the same rows and overwrites both, so
results are the same for any cut of the input into files and any number of
tries.  Carries older than the one before are removed.

Rows must arrive in ``order_by`` order across batches (inside a batch any
order will do).  Empty batches carry on what they were given; rows with a
null time are not late, raise nothing and fall in no window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy.operators import windows
from eddy.plans import prefix


def _drop(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _carried(spark: SparkSession, path: str, batch_id: int) -> Row | None:
    """The carry that batch ``batch_id`` starts from (one row)."""
    return spark.read.parquet(f"{path}/batch_id={batch_id - 1}").first() if batch_id else None


def _leave(carry: DataFrame, path: str, batch_id: int) -> None:
    carry.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    _drop(carry.sparkSession, f"{path}/batch_id={batch_id - 2}")


def carried_totals(path: str, order_by: Sequence[str], value: str | None = None,
                   index: str = "idx", total: str = "acc") -> Callable[[DataFrame, int], None]:
    """T6 and A7 on a stream: a ``foreachBatch`` function that adds each
    row's position in the whole stream and, with ``value``, the running sum
    of that column (null until the first value that is not null)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = _carried(spark, f"{path}/carry", batch_id)
        rows, acc = (0, None) if was is None else (was["rows"], was["acc"])
        folds = {index: ("count", None)}
        if value is not None:
            folds[total] = ("sum", F.col(value))
        out = prefix.running(batch, order_by, folds)
        out = out.withColumn(index, (F.col(index) - 1 + F.lit(rows)).cast("long"))
        summed = F.sum(F.col(value)) if value is not None else F.lit(None).cast("long")
        if value is not None and acc is not None:
            out = out.withColumn(total, F.coalesce(F.col(total), F.lit(0)) + F.lit(acc))
            summed = F.coalesce(summed, F.lit(0)) + F.lit(acc)
        elif value is not None:
            # A running sum without any value yet is null, not 0.
            seen = prefix.running(out, order_by, {"__seen": ("max", F.when(F.col(value).isNotNull(), 1))})
            out = seen.withColumn(total, F.when(F.col("__seen").isNotNull(), F.col(total))).drop("__seen")
        out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        _leave(batch.agg((F.count(F.lit(1)) + F.lit(rows)).alias("rows"), summed.alias("acc")),
               f"{path}/carry", batch_id)
    return run


def exact_watermark(path: str, ts: str, order_by: Sequence[str], max_delay_us: int,
                    name: str = "wm") -> Callable[[DataFrame, int], None]:
    """W4 on a stream: a ``foreachBatch`` function that adds the row-exact
    watermark and ``late`` to each row, as ``windows.exact_watermark`` does
    over the whole input."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = _carried(spark, f"{path}/carry", batch_id)
        top = None if was is None else was["top_us"]
        out = windows.exact_watermark(batch, ts, order_by, max_delay_us, name, carry_us=top)
        out.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")
        _leave(_top(batch, ts, top), f"{path}/carry", batch_id)
    return run


def _top(batch: DataFrame, ts: str, top: int | None) -> DataFrame:
    """The carry of a watermark: the largest time so far."""
    return batch.agg(F.greatest(F.max(prefix.order_number(batch, ts)), F.lit(top).cast("long")).alias("top_us"))


def window_commands(path: str, ts: str, order_by: Sequence[str], max_delay_us: int, length: str,
                    step: str | None = None, by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """W5 on a stream: a ``foreachBatch`` function that keeps the open
    windows (Open event, rows added so far) and writes a window with its
    Close event in the batch that closes it.  Open windows are a table in
    ``closed=false``, closed ones in ``closed=true`` of the batch's folder;
    :func:`read_windows` gives the result so far."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        was = _carried(spark, f"{path}/carry", batch_id)
        top = None if was is None else was["top_us"]
        still_open = None
        if batch_id:
            schema = window_schema(batch, ts, order_by[0], by)
            still_open = (spark.read.schema(schema).parquet(f"{path}/windows/batch_id={batch_id - 1}")
                          .filter(~F.col("closed")).drop("closed", "close_event"))
        out = windows.window_lifecycle(batch, ts, order_by, max_delay_us, length, step, by,
                                       carry_us=top, still_open=still_open)
        (out.withColumn("closed", F.col("close_event").isNotNull())
            .write.mode("overwrite").partitionBy("closed").parquet(f"{path}/windows/batch_id={batch_id}"))
        _leave(_top(batch, ts, top), f"{path}/carry", batch_id)
        _drop(spark, f"{path}/windows/batch_id={batch_id - 2}/closed=false")
    return run


def window_schema(rows: DataFrame, ts: str, arrival: str, by: Sequence[str]) -> T.StructType:
    """Columns of the window table of :func:`window_commands`."""
    t = rows.schema[ts].dataType
    return T.StructType([T.StructField("window_end", t), T.StructField("window_start", t),
                         *[T.StructField(c, rows.schema[c].dataType) for c in by],
                         T.StructField("open_event", rows.schema[arrival].dataType),
                         T.StructField("n", T.LongType()), T.StructField("close_event", T.LongType()),
                         T.StructField("closed", T.BooleanType())])


def read_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Windows closed so far, and those open after the last batch (with a
    null ``close_event``: flushed when the input ends).

    A batch carries on every window that is open, so the last batch that
    wrote any window has all open ones."""
    found = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])) \
                 .parquet(f"{path}/windows")
    last = found.agg(F.max("batch_id")).first()[0]
    return found.filter(F.col("closed") | (F.col("batch_id") == F.lit(last))).drop("closed", "batch_id")
