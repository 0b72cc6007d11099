"""Streaming event-time windows (L1, L2): Spark's watermark moves between
micro-batches and drops rows only once their window has been emitted; the
row-exact watermark of the batch operators is W4."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(stream: DataFrame, ts: str, delay: str, length: str, step: str | None = None,
                  by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """L1 + L2: rows per (window, keys) under a watermark of ``delay``; in
    append mode a window is emitted once the watermark passes its end.
    ``timestamp_ntz`` input is cast to ``timestamp`` (the watermark needs
    it); window bounds are returned as the input type."""
    dtype = stream.schema[ts].dataType.simpleString()
    s = stream.withColumn(ts, F.col(ts).cast("timestamp")) if dtype == "timestamp_ntz" else stream
    w = F.window(F.col(ts), length, step) if step else F.window(F.col(ts), length)
    agg = (s.withWatermark(ts, delay).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias(name)))
    return agg.select(F.col("w.start").cast(dtype).alias("window_start"),
                      F.col("w.end").cast(dtype).alias("window_end"), *by, name)
