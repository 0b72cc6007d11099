"""Delivery guarantees for streams.

A micro-batch is committed by the checkpoint only after the
``foreachBatch`` function returns, so processing inside it is
at-least-once.  Writing each batch to its own ``batch_id`` folder (an
overwrite) makes a replay harmless: exactly-once results.  At-most-once
records the batch id first and skips a batch that is already recorded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.sources.topiclog import TopicLog


def idempotent_writer(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to
    ``path/batch_id=<id>`` (overwrite): a replayed batch replaces its own
    output instead of adding a copy."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def at_least_once(process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """L3: process, then (by returning) let the checkpoint commit."""
    return process


def at_most_once(spark: SparkSession, commits_path: str,
                 process: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """L4: commit first (a marker for the batch id), then process; a batch
    whose marker exists is skipped.  A crash between the two loses that
    batch, by design."""
    def run(batch: DataFrame, batch_id: int) -> None:
        marker = f"{commits_path}/batch_id={batch_id}"
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(marker)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            return
        spark.createDataFrame([(batch_id,)], "committed long").write.mode("overwrite").parquet(marker)
        process(batch, batch_id)
    return run


def with_offsets(batch: DataFrame, batch_id: int, offset: str = "offset") -> DataFrame:
    """Results stored together with the source offsets that produced
    them (same rows, same write)."""
    return batch.withColumn("batch_id", F.lit(batch_id).cast("long")).withColumn("stored_offset", F.col(offset))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def resume_offset(spark: SparkSession, store_path: str, literal: bool = False) -> int:
    """K20 for one partition: one past the highest stored offset (or the
    stored offset itself with ``literal``, which repeats one record); 0 if
    nothing is stored.  Any other failure to read is raised."""
    if not _exists(spark, store_path):
        return 0
    top = spark.read.parquet(store_path).agg(F.max("stored_offset")).first()[0]
    if top is None:
        return 0
    return int(top) if literal else int(top) + 1


def resume_positions(spark: SparkSession, store_path: str) -> dict[tuple[str, int], int]:
    """Where each (topic, partition) goes on, one past its own highest
    stored offset, as an assignment for ``TopicLog.read``; partitions
    without a stored offset are not in it.  One number per partition."""
    if not _exists(spark, store_path):
        return {}
    rows = spark.read.parquet(store_path).groupBy("topic", "partition").agg(F.max("stored_offset").alias("top"))
    return {(r.topic, r.partition): r.top + 1 for r in rows.collect()}


def consume_publish(spark: SparkSession, out_log: str, transform: Callable[[DataFrame], DataFrame],
                    order_by: list[str]) -> Callable[[DataFrame, int], None]:
    """Consume a batch, publish the transformed records to another
    log, and commit the input only after the publish (the checkpoint
    commits when this returns).  The publish is keyed by batch id, so a
    replay does not publish twice."""
    target = TopicLog(spark, out_log)

    def run(batch: DataFrame, batch_id: int) -> None:
        target.append(transform(batch), order_by, batch_id=batch_id)
    return run


def per_partition(transform: Callable[[DataFrame], DataFrame], path: str,
                  fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """An independent flow per topic-partition.  ``transform`` keys its
    work by ``topic`` and ``partition`` (for example a groupBy on them),
    and each (topic, partition, batch) result goes to its own folder, all
    in one job; a replayed batch overwrites only its own folders.  The
    commit stays per micro-batch."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "partition", "batch_id").format(fmt).save(path))
    return run


def group_checkpoint(base: str, group: str) -> str:
    """A consumer group's position is its checkpoint folder."""
    return f"{base.rstrip('/')}/groups/{group}"
