"""Generated sources (S1-S7): ranges, literal rows, seeded random
integers and picks, tick streams and closed-form unfolds.  All are
``spark.range`` plus column expressions, so they split over tasks and a
recomputed partition gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def int_range(spark: SparkSession, start: int, end: int, inclusive: bool = False,
              cap: int | None = None, name: str = "n") -> DataFrame:
    """``start .. end`` (``to`` when inclusive, ``until`` otherwise),
    at most ``cap`` values (``take``; a cap past the range is harmless)."""
    stop = end + 1 if inclusive else end
    if cap is not None:
        stop = min(stop, start + max(cap, 0))
    return spark.range(start, max(start, stop)).select(F.col("id").alias(name))


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Literal rows with an explicit schema (one row for
    ``Source.single``)."""
    return spark.createDataFrame(list(rows), schema)


def random_ints(spark: SparkSession, n: int, bound: int, seed: int, name: str = "n") -> DataFrame:
    """``n`` seeded random integers in ``[0, bound)`` with their
    sequence number.  A hash of (seq, seed), so the values do not depend on
    partitioning or retries."""
    return spark.range(n).select(F.col("id").alias("seq"), pick(F.col("id"), bound, seed).alias(name))


def pick(seq: Column, k: int, seed: int) -> Column:
    """A repeatable pseudo-random pick in ``[0, k)`` for row ``seq``."""
    return F.pmod(F.xxhash64(seq, F.lit(seed)), F.lit(k)).cast("int")


def pick_bool(seq: Column, seed: int) -> Column:
    """A repeatable pseudo-random boolean."""
    return pick(seq, 2, seed) == 1


def ticks(spark: SparkSession, n: int, period_ms: int, start_ms: int = 0,
          name: str = "ts") -> DataFrame:
    """S6 (bounded): ``n`` ticks ``period`` apart from ``start``."""
    return spark.range(n).select(F.col("id").alias("seq"),
                                 F.timestamp_millis(F.lit(start_ms) + F.col("id") * period_ms).alias(name))


def tick_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    """S6 (endless): the rate source, ``timestamp, value``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def affine_unfold(spark: SparkSession, n: int, seed: int = 0, step: int = 11, emit_offset: int = 3,
                  name: str = "n") -> DataFrame:
    """``unfold(seed)(s => (s + step, s + emit_offset))``: element i is
    ``seed + step*i + emit_offset`` (closed form, no recursion)."""
    return spark.range(n).select(F.col("id").alias("i"),
                                 (F.lit(seed) + F.col("id") * step + emit_offset).alias(name))
