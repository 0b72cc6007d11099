"""The chunked prefix scan equals a one-partition window (invariant 3 of
the test strategy)."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eddy.plans import prefix


def _data(spark, n, keys, seed):
    rnd = random.Random(seed)
    ids = rnd.sample(range(n * 5), n)
    rows = [(i, rnd.randrange(keys), rnd.randrange(-50, 100)) for i in ids]
    return spark.createDataFrame(rows, "id long, k long, v long")


@pytest.mark.parametrize("seed,width", [(1, 3.0), (2, 17.0), (3, None), (4, 1.0)])
def test_running_matches_window(spark, seed, width):
    df = _data(spark, 300, 4, seed)
    got = prefix.running(df, ["id"], {"s": ("sum", F.col("v")), "mx": ("max", F.col("v")),
                                      "mn": ("min", F.col("v")), "c": ("count", None)},
                         chunk_width=width)
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("mx"),
                     F.min("v").over(w).alias("mn"), F.count(F.lit(1)).over(w).alias("c"))
    a = sorted(tuple(r) for r in got.select("id", "s", "mx", "mn", "c").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert a == b


@pytest.mark.parametrize("seed", [5, 6])
def test_keyed_exclusive_and_reverse(spark, seed):
    df = _data(spark, 200, 3, seed)
    got = prefix.running(df, ["id"], {"s": ("sum", F.col("v")), "c": ("count", None)},
                         partition_by=["k"], exclusive=True, chunk_rows=20, chunk_width=7.0)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert sorted(tuple(r) for r in got.select("id", "s", "c").collect()) == \
        sorted(tuple(r) for r in want.collect())

    rev = prefix.running(df, ["id"], {"m": ("min", F.col("v"))}, partition_by=["k"], reverse=True,
                         chunk_rows=20, chunk_width=11.0)
    wr = Window.partitionBy("k").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, 0)
    want_r = df.select("id", F.min("v").over(wr).alias("m"))
    assert sorted(tuple(r) for r in rev.select("id", "m").collect()) == \
        sorted(tuple(r) for r in want_r.collect())


def test_index_is_dense(spark):
    df = spark.range(0, 1000, 3).withColumnRenamed("id", "x")
    out = prefix.with_index(df, ["x"], "i", chunk_rows=37)
    rows = sorted((r["x"], r["i"]) for r in out.collect())
    assert [i for _, i in rows] == list(range(len(rows)))


def test_timestamp_order_key(spark):
    df = spark.createDataFrame([(i, i * 7) for i in range(50)], "i long, s long") \
        .withColumn("ts", F.timestamp_seconds(F.col("s")))
    out = prefix.running(df, ["ts"], {"mx": ("max", F.col("i"))}, chunk_rows=8)
    assert all(r["mx"] == r["i"] for r in out.collect())


def test_no_unpartitioned_window_on_rows(spark):
    """The plan of the scan has no window without partition keys over the
    input rows: only the small chunk table is windowed globally."""
    df = spark.range(10_000).withColumnRenamed("id", "x")
    plan = prefix.with_index(df, ["x"], "i")._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in plan or "Window" in plan
    assert "hashpartitioning(__c1" in plan


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_heavy_ties_are_split(spark, reverse, keyed):
    """A third of the rows share one leading value: with split_ties the
    chunks stay small and the result still equals the window."""
    rnd = random.Random(11)
    rows = []
    for i in range(1500):
        t = 500 if i % 3 == 0 else rnd.randrange(0, 1000)
        rows.append((t, i, i % 2 if keyed else 0, rnd.randrange(100)))
    df = spark.createDataFrame(rows, "t long, id long, k long, v long")
    keys = ["k"] if keyed else []
    got = prefix.running(df, ["t", "id"], {"s": ("sum", F.col("v")), "c": ("count", None)},
                         partition_by=keys, reverse=reverse, chunk_rows=40, split_ties=True)
    order = [F.col("t").desc(), F.col("id").desc()] if reverse else [F.col("t"), F.col("id")]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert sorted(tuple(r) for r in got.select("id", "s", "c").collect()) == \
        sorted(tuple(r) for r in want.collect())


def test_split_ties_bounds_chunks(spark):
    rows = [(7 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "t long, id long")
    chunk, _ = prefix._chunk_plan(df, "t", 50, False, None)
    src, cks = prefix._split_ties(df.withColumn("__c1", chunk), ["t", "id"], [], 50, False)
    assert cks == ["__c1", "__c2", "__c3"]
    biggest = src.groupBy(*cks).count().agg(F.max("count")).first()[0]
    assert biggest <= 2 * 50 + 1


@pytest.mark.parametrize("chunk_rows", [10, 1 << 20])
def test_hot_and_small_keys_mixed(spark, chunk_rows):
    """One hot key among small ones: the hot key is chunked, the small keys
    run as one window; both equal the plain window."""
    rows = [(i, 0 if i % 2 == 0 else (i % 7) + 1, i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, v long")
    got = prefix.running(df, ["id"], {"s": ("sum", F.col("v")), "c": ("count", None)},
                         partition_by=["k"], chunk_rows=chunk_rows)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"))
    assert sorted(tuple(r) for r in got.select("id", "s", "c").collect()) == \
        sorted(tuple(r) for r in want.collect())


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("keyed", [False, True])
def test_more_chunks_than_cells(spark, monkeypatch, reverse, keyed):
    """With 8 cells a level, 3,000 rows are cut over several levels (hot
    ties and nulls too); the result equals the window."""
    monkeypatch.setattr(prefix, "MAX_CELLS", 8)
    rows = [(None if i % 50 == 0 else 700 if i % 4 == 0 else (i * 7919) % 2000, i,
             (0 if i % 3 else 1 + i % 5) if keyed else 0, i % 13) for i in range(3000)]
    df = spark.createDataFrame(rows, "t long, id long, k long, v long")
    keys = ["k"] if keyed else []
    got = prefix.running(df, ["t", "id"], {"s": ("sum", F.col("v")), "c": ("count", None), "m": ("max", F.col("v"))},
                         partition_by=keys, reverse=reverse, chunk_rows=10)
    order = [F.col("t").desc(), F.col("id").desc()] if reverse else [F.col("t"), F.col("id")]
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.sum("v").over(w).alias("s"), F.count(F.lit(1)).over(w).alias("c"),
                     F.max("v").over(w).alias("m"))
    assert sorted(map(tuple, got.select("id", "s", "c", "m").collect())) == sorted(map(tuple, want.collect()))


def test_chunks_do_not_grow_past_the_cells(spark, monkeypatch):
    monkeypatch.setattr(prefix, "MAX_CELLS", 8)
    rows = [(7 if i % 3 == 0 else (i * 7919) % 100_000, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "t long, id long")
    chunk, n = prefix._chunk_plan(df, "t", 50, False, None)
    assert n <= 8
    src, more = prefix._refine(df.withColumn("__c1", chunk), ["__c1"], F.col("t"), 50, False, "__r")
    src, cks = prefix._split_ties(src, ["t", "id"], [], 50, False, ["__c1", *more])
    assert src.groupBy(*cks).count().agg(F.max("count")).first()[0] <= 2 * 50
    # A chunk's rows are neighbours in the order.
    w = Window.orderBy(*cks)
    spans = src.groupBy(*cks).agg(F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b"))
    assert spans.withColumn("p", F.lag("b").over(w)).filter("a <= p").isEmpty()


def test_long_texts_make_smaller_chunks(spark, monkeypatch):
    """Chunks are bounded by the bytes of their texts, not only by rows."""
    monkeypatch.setattr(prefix, "CHUNK_BYTES", 10_000)
    seen = []
    plan = prefix._chunk_plan
    monkeypatch.setattr(prefix, "_chunk_plan", lambda *a: seen.append(plan(*a)) or seen[-1])
    df = spark.range(400).select((F.col("id") * 3).alias("x"), F.lit("t" * 200).alias("text"), (F.col("id") % 2).alias("k"))
    got = sorted((r.x, r.i) for r in prefix.with_index(df, ["x"], "i").collect())
    assert got == [(3 * i, i) for i in range(400)]
    got = sorted((r.x, r.i) for r in prefix.with_index(df, ["x"], "i", partition_by=["k"]).collect())
    assert got == [(3 * i, i // 2) for i in range(400)]
    assert [n for _, n in seen] == [16, 16]
