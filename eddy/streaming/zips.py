"""Two live streams zipped by position (J1, J2): record ``i`` of a
partition on one side meets record ``i`` of that partition on the other,
whichever side runs ahead; the result ends with the shorter side.

Each micro-batch gives its rows their positions in the whole stream and
writes them once under its id.  A table of how far each (side, partition)
has come is the carry: the pairs that a micro-batch makes are the positions
between the shorter side's end before it and after it, so only those are
read back (a pushed filter on the position), and rows that wait for the
other side are never written again.  A micro-batch's rows are removed when
all have met their partner and the next one has committed that.

Output and carry are written under the batch's id before the checkpoint
commits, so a batch tried again overwrites both.  Rows must arrive in
``order_by`` order across batches (per side).  A null partition is a
partition; null rows of columns are kept; the other columns may have any
name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddy.operators import state
from eddy.plans import prefix
from eddy.plans.joins import join_small
from eddy.streaming import scans


def both_sides(left: DataFrame, right: DataFrame, order_by: str, partition: str) -> DataFrame:
    """The two streams as one, rows of each side packed in a column."""
    packed = [F.struct(*[F.col(f"`{c}`") for c in s.columns]) for s in (left, right)]
    kinds = [s.select(p.alias("p")).schema["p"].dataType for s, p in zip((left, right), packed)]

    def side(stream, i):
        return stream.select(F.lit(i).alias("side"), F.col(partition).alias("part"), F.col(order_by).alias("seq"),
                             *[(packed[i] if j == i else F.lit(None).cast(kinds[j])).alias(n)
                               for j, n in enumerate(("left", "right"))])
    return side(left, 0).unionByName(side(right, 1))


def _met(ends: DataFrame, name: str) -> DataFrame:
    """Up to where both sides have come, per partition."""
    end = [F.coalesce(F.max(F.when(F.col("side") == i, F.col("end"))), F.lit(0)) for i in (0, 1)]
    return ends.groupBy("part_text").agg(F.least(*end).alias(name))


def zip_streams(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over :func:`both_sides`.  ``path/out``
    gets a row per pair: ``partition``, ``pos`` and the columns of the sides
    with ``left_`` and ``right_`` before their names."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ends = spark.read.parquet(f"{path}/ends/batch_id={batch_id - 1}") if batch_id else None
        rows = prefix.with_index(batch.withColumn("part_text", state._key_text("part")), ["seq"], "pos",
                                 partition_by=["side", "part_text"])
        if ends is not None:
            start = ends.groupBy("side", "part_text").agg(F.max("end").alias("start"))
            rows = join_small(rows, start, on=["side", "part_text"], how="left") \
                .withColumn("pos", F.col("pos") + F.coalesce("start", F.lit(0))).drop("start")
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        written = spark.read.parquet(f"{path}/rows/batch_id={batch_id}")
        now = written.groupBy("side", "part_text").agg((F.max("pos") + 1).alias("end")) \
                     .withColumn("of_batch", F.lit(batch_id).cast("long"))
        if ends is not None:
            before = _met(ends, "lo")
            # Batches whose rows had all met before this one.
            done = (join_small(ends.filter(F.col("of_batch").isNotNull()), before, on="part_text", how="left")
                    .groupBy("of_batch").agg(F.every(F.col("end") <= F.col("lo")).alias("done"))
                    .filter("done").select("of_batch"))
            gone = [r["of_batch"] for r in done.collect()]  # a few batch ids, each once
            free = F.col("of_batch").isNull() | F.col("of_batch").isin(gone)
            # Of what is gone only the largest end of each side is still needed.
            now = (ends.filter(free).groupBy("side", "part_text").agg(F.max("end").alias("end"))
                       .withColumn("of_batch", F.lit(None).cast("long"))
                       .unionByName(ends.filter(~free)).unionByName(now))
        now.coalesce(1).write.mode("overwrite").parquet(f"{path}/ends/batch_id={batch_id}")
        met = _met(spark.read.parquet(f"{path}/ends/batch_id={batch_id}"), "hi")
        met = met.withColumn("lo", F.lit(0)) if ends is None else met.join(before, on="part_text", how="left")
        new = met.select("part_text", F.coalesce("lo", F.lit(0)).alias("lo"), "hi").filter("hi > lo")
        span = new.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
        log = spark.read.schema(written.schema).parquet(f"{path}/rows") \
            .filter((F.col("pos") >= F.lit(span["lo"] or 0)) & (F.col("pos") < F.lit(span["hi"] or 0)))
        pairs = (join_small(log, new, on="part_text").filter((F.col("pos") >= F.col("lo")) & (F.col("pos") < F.col("hi")))
                 .groupBy("part_text", "pos")
                 .agg(F.first("part").alias("partition"), *[F.max_by(s, F.col(s).isNotNull()).alias(s)
                                                            for s in ("left", "right")]))
        (pairs.select("partition", "pos", *[F.col(f"{s}.`{f}`").alias(f"{s}_{f}") for s in ("left", "right")
                                            for f in written.schema[s].dataType.names])
              .write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}"))
        scans._drop(spark, f"{path}/ends/batch_id={batch_id - 2}")
        for b in ([] if ends is None else gone):
            scans._drop(spark, f"{path}/rows/batch_id={b}")
    return run
