"""Joins with a checked broadcast side.

The small side is computed once and written to the shared checkpoint folder;
its rows and bytes are known then.  It is broadcast when both are within
their bounds, and joined by shuffle otherwise, where AQE splits skewed
partitions.  Either way it is read from the written table, so it is never
computed twice, nothing stays persisted, and a lost executor costs no more
than reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.session import scratch_path

DEFAULT_MAX_BROADCAST_ROWS = 200_000
# Bytes of the written (compressed) table.
MAX_BROADCAST_BYTES = 32 << 20


def stored(df: DataFrame, name: str = "small") -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read back, and its bytes."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
    return spark.read.schema(df.schema).parquet(path), size


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``big`` with ``small``, broadcasting ``small`` only after its
    rows and bytes are checked.  ``how`` must keep ``big`` as the streamed
    side (inner, left, left_semi, left_anti)."""
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti", "semi", "anti"):
        raise ValueError(f"broadcast of the right side does not fit a {how!r} join")
    kept, size = stored(small)
    if size <= max_bytes and kept.count() <= max_rows:
        kept = F.broadcast(kept)
    return big.join(kept, on=on, how=how)
