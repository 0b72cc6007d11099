"""Turning a table into a replayable file stream (for tests and the
registered stream queries): the rows are written in order as several
parquet files with rising modification times, and read back with
``maxFilesPerTrigger`` so each file is one micro-batch."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.plans import prefix


def stage_files(df: DataFrame, path: str, n_files: int, order_col: str) -> str:
    """Write ``df`` to ``path`` as ``n_files`` parts split by ranges of
    ``order_col``, in one job (one file in a ``part=<i>`` folder each,
    however many partitions ``df`` has), then give the file of part i a
    later modification time than that of part i-1, so the file source
    replays them in order."""
    k = prefix.order_number(df, order_col)
    st = df.agg(F.min(k).alias("lo"), F.max(k).alias("hi")).first()
    lo, hi = st["lo"], st["hi"]
    span = float(hi - lo + 1) if lo is not None else 1.0
    part = F.least(F.floor((k - F.lit(lo or 0)) * F.lit(n_files / span)), F.lit(n_files - 1)).cast("int")
    ranged = df.withColumn("part", part).repartition(n_files, "part").sortWithinPartitions("part", order_col)
    ranged.write.mode("append").partitionBy("part").parquet(path)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = int(time.time() * 1000) - 10 * 60 * 1000
    for i in range(n_files):
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/part={i}")
        if not fs.exists(folder):
            continue
        for st_ in fs.listStatus(folder):
            if st_.getPath().getName().endswith(".parquet"):
                fs.setTimes(st_.getPath(), base + i * 1000, -1)
    return path


def read_staged(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """The staged folder as a stream, ``files_per_trigger`` files per
    micro-batch (``maxFilesPerTrigger``), oldest first."""
    from pyspark.sql import types as T
    full = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])
    return (spark.readStream.schema(full).option("maxFilesPerTrigger", files_per_trigger)
                 .parquet(path).drop("part"))
