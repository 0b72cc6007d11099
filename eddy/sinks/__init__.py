"""Sinks (K3-K8): console, discard, collect, first/last, acknowledged
per-batch sinks and tees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from eddy.operators.ordered import first_row, last_indexed  # noqa: F401  (K6)
from eddy.operators.routing import fan_out as tee  # noqa: F401  (K8)


def console(df: DataFrame, n: int | None = None):
    """K3: print every row, or the first ``n`` if the caller says so; a
    stream is started with Spark's console sink."""
    if df.isStreaming:
        return df.writeStream.format("console").option("truncate", False).start()
    for row in (df if n is None else df.limit(n)).toLocalIterator():
        print(*row, sep=" | ")


def rows(df: DataFrame) -> DataFrame:
    """K5: all rows to the caller (``Sink.seq``): the DataFrame itself is
    the result; the caller decides whether and how to collect it."""
    return df


def discard(df: DataFrame) -> None:
    """K4: run to completion, keep nothing (``format("noop")``)."""
    df.write.format("noop").mode("overwrite").save()


def acknowledged(on_init: Callable[[], None], on_batch: Callable[[DataFrame, int], None],
                 on_complete: Callable[[], None] | None = None):
    """K7: a per-batch sink with init / element / complete hooks for
    ``foreachBatch``.  A batch counts as acknowledged when the stream's
    checkpoint commits it, which happens only after ``on_batch`` returns."""
    state = {"started": False}

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not state["started"]:
            on_init()
            state["started"] = True
        on_batch(batch, batch_id)

    def complete() -> None:
        if on_complete is not None:
            on_complete()
    sink.complete = complete
    return sink
