"""Running streams: drain and stop (L9, L10), restart with backoff on the
same checkpoint (L11), completion callbacks (L12), progress metrics
(L13), triggers and rate limits (L6, L14)."""

from __future__ import annotations

import random
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eddy.plans import prefix


def drain(query: StreamingQuery) -> None:
    """Process everything available, then stop."""
    query.processAllAvailable()
    query.stop()


def stop(query: StreamingQuery) -> None:
    """Hard stop from outside."""
    query.stop()


def backoff_delays(min_s: float = 3.0, max_s: float = 30.0, jitter: float = 0.2, seed: int | None = None):
    """Delays ``min(max, min * 2^k) * (1 + jitter * u)``, u in [0, 1)."""
    rnd = random.Random(seed)
    k = 0
    while True:
        yield min(max_s, min_s * (2 ** k)) * (1 + jitter * rnd.random())
        k += 1


def run_with_backoff(start: Callable[[], StreamingQuery], max_restarts: int | None = None,
                     min_s: float = 3.0, max_s: float = 30.0, jitter: float = 0.2,
                     sleep: Callable[[float], None] = time.sleep) -> StreamingQuery:
    """Start the query, and restart it after a failure with
    exponential backoff.  ``start`` must reuse the same checkpoint, so no
    committed batch is lost or repeated in the sink.  Without
    ``max_restarts`` it never gives up; a run that committed a batch resets
    the delays and the count."""
    delays = backoff_delays(min_s, max_s, jitter)
    attempt = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception:  # noqa: BLE001 - any stream failure restarts
            if any(p.numInputRows for p in getattr(q, "recentProgress", ())):
                delays, attempt = backoff_delays(min_s, max_s, jitter), 0
            attempt += 1
            if max_restarts is not None and attempt > max_restarts:
                raise
            sleep(next(delays))


class CompletionListener(StreamingQueryListener):
    """Call ``on_done(query_id, error_or_None)`` when a query ends."""

    def __init__(self, on_done: Callable[[str, str | None], None]):
        self.on_done = on_done

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        pass

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        self.on_done(str(event.id), event.exception)


def on_completion(spark: SparkSession, on_done: Callable[[str, str | None], None]) -> CompletionListener:
    listener = CompletionListener(on_done)
    spark.streams.addListener(listener)
    return listener


def progress(query: StreamingQuery) -> list[dict]:
    """Per-batch metrics of a query (rows, rates, durations)."""
    out = []
    for p in query.recentProgress:
        out.append({"batchId": p.batchId, "numInputRows": p.numInputRows,
                    "inputRowsPerSecond": p.inputRowsPerSecond,
                    "processedRowsPerSecond": p.processedRowsPerSecond,
                    "durationMs": dict(p.durationMs or {})})
    return out


def rate_options(source: str, per_trigger: int) -> dict:
    """Rows (or files, or offsets) per micro-batch for a source."""
    key = {"kafka": "maxOffsetsPerTrigger", "files": "maxFilesPerTrigger",
           "rate": "rowsPerSecond"}[source]
    return {key: str(per_trigger)}


def throttle_plan(df: DataFrame, order_by: list[str], per_period: int, period_ms: int,
                  burst: int = 0, name: str = "emit_after_ms") -> DataFrame:
    """The earliest time (ms from the start) each row may be emitted
    under a rate of ``per_period`` rows per ``period`` with a burst
    allowance: ``greatest(0, i - burst + 1) * period / per_period``."""
    idx = prefix.with_index(df, order_by, "__i")
    delay: Column = F.greatest(F.lit(0), F.col("__i") - F.lit(burst) + 1) * F.lit(period_ms) / F.lit(per_period)
    return idx.withColumn(name, delay.cast("double")).drop("__i")


def every(writer, interval: str = "5 seconds"):
    """Timed micro-batches (and with them timed commits)."""
    return writer.trigger(processingTime=interval)
