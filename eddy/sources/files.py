"""Text files (S8-S10, K1, K2): lines of one or many files, text sinks
with a byte count, and bucketed appends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, paths: str | Sequence[str], max_line_bytes: int | None = None,
               encoding: str = "UTF-8", with_file: bool = True) -> DataFrame:
    """The lines of one or many text files.  Lines end at ``\\n``
    only (the default reader also splits at ``\\r``).  With
    ``max_line_bytes`` a longer line fails the job, as a framing limit
    does.  Each line keeps its file, so file boundaries stay."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.option("lineSep", "\n").option("encoding", encoding).text(paths)
    if with_file:
        df = df.withColumn("file", F.col("_metadata.file_path"))
    if max_line_bytes is not None:
        df = df.withColumn("value", F.when(F.octet_length("value") > max_line_bytes,
                                           F.raise_error(F.lit("line longer than the frame limit")))
                           .otherwise(F.col("value")))
    return df


def bytes_written(df: DataFrame, text: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """K1 result: bytes a text sink writes (each line plus its newline)."""
    return df.groupBy(*by).agg(F.sum(F.octet_length(text) + 1).cast("long").alias("bytes"),
                               F.count(F.lit(1)).alias("lines"))


def write_text(df: DataFrame, path: str, text: Column | str = "value", mode: str = "overwrite",
               bucket: Column | None = None) -> None:
    """K1/K2: one row per line.  ``overwrite`` truncates; ``append`` adds.
    With ``bucket`` the rows go to one folder per bucket (``bucket=i``),
    the bucketed append of K2."""
    col = F.col(text) if isinstance(text, str) else text
    out = df.select(col.cast("string").alias("value"), *([bucket.alias("bucket")] if bucket is not None else []))
    w = out.write.mode(mode).option("lineSep", "\n")
    if bucket is not None:
        w = w.partitionBy("bucket")
    w.text(path)
