"""Sequential scans of bounded groups: a group that spans several Arrow
batches reaches the function whole and in order."""

import pyarrow as pa
from pyspark.sql import functions as F

from eddy.plans.groupscan import sorted_group_map


def test_group_spanning_batches(spark):
    df = spark.range(0, 25_000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        def fn(t):
            ids = t["id"].to_pylist()
            one = t.slice(0, 1).select(["g"])
            return one.append_column("n", pa.array([len(ids)])).append_column("ordered", pa.array([ids == sorted(ids)]))
        out = sorted_group_map(df, ["g"], ["id"], fn, "g int, n long, ordered boolean", partitions=2)
        got = sorted(tuple(r) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == [(0, 16_666, True), (1, 8_334, True)]
