"""File-backed topic log and keyed tables."""

import pytest
from pyspark.sql import functions as F

from eddy.sources import tables, topiclog
from eddy.streaming import delivery


def _recs(spark, n, parts=2, start=0):
    df = spark.range(start, start + n).withColumnRenamed("id", "i")
    return topiclog.records(df, "t", F.pmod("i", F.lit(parts)), F.col("i").cast("string"),
                            F.concat(F.lit("v"), F.col("i").cast("string")))


def test_append_offsets_continue(spark, scratch):
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    first = log.append(_recs(spark, 10), ["i"], batch_id=1)
    assert sorted((r["partition"], r["offset"]) for r in first.collect())[:3] == [(0, 0), (0, 1), (0, 2)]
    log.append(_recs(spark, 4, start=10), ["i"], batch_id=2)
    pos = {(r["topic"], r["partition"]): r["next_offset"] for r in log.positions().collect()}
    assert pos == {("t", 0): 7, ("t", 1): 7}
    # a replayed batch is not written twice
    log.append(_recs(spark, 4, start=10), ["i"], batch_id=2)
    assert log.read().count() == 14


def test_read_assignment_from_offset(spark, scratch):
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    log.append(_recs(spark, 20), ["i"], batch_id=1)
    got = log.read(assignment={("t", 1): 5})
    offs = sorted(r["offset"] for r in got.collect())
    assert offs == list(range(5, 10))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan


def test_report_and_fanout(spark):
    recs = topiclog.assign_offsets(_recs(spark, 3, parts=1), ["i"])
    rep = sorted(r["report"] for r in topiclog.report(recs).collect())
    assert rep == ["t/0 0: v0", "t/0 1: v1", "t/0 2: v2"]
    df = spark.createDataFrame([(1, ["a", "b"]), (2, [])], "id long, targets array<string>")
    out = topiclog.fan_out(df, F.col("targets")).collect()
    assert sorted((r["id"], r["topic"], r["result"]) for r in out if r["topic"]) == \
        [(1, "a", "published to a"), (1, "b", "published to b")]
    assert [r["result"] for r in out if r["id"] == 2] == ["passed through"]


def test_resume_offset(spark, scratch):
    store = f"{scratch}/store"
    assert delivery.resume_offset(spark, store) == 0
    b = spark.createDataFrame([(3,), (7,)], "offset long")
    delivery.with_offsets(b, 0).write.parquet(store)
    assert delivery.resume_offset(spark, store) == 8
    assert delivery.resume_offset(spark, store, literal=True) == 7


def test_keyed_table_lifecycle(spark, scratch):
    t = tables.KeyedTable(spark, f"{scratch}/nums", key="_id")
    t.insert(spark.createDataFrame([(i, i) for i in range(1, 11)], "_id int, value int"))
    with pytest.raises(ValueError):
        t.insert(spark.createDataFrame([(3, 0)], "_id int, value int"))
    upd = spark.createDataFrame([(5, -5)], "_id int, nv int")
    t.update_one(upd, "_id", {"value": "nv"}, "_id")
    assert t.current().filter("_id = 5").first()["value"] == -5
    t.delete(tables.disjuncts(spark, list(range(1, 5)), "_id", "int"), "_id")
    assert sorted(r["_id"] for r in t.current().collect()) == list(range(5, 11))
    assert t.versions() == [1, 2, 3]
    other = tables.KeyedTable(spark, f"{scratch}/copy", key="_id")
    t.copy_to(other)
    assert other.current().count() == 6


def test_update_many_follows_chains(spark):
    cur = spark.createDataFrame([(i,) for i in range(1, 11)], "value int")
    ok = spark.createDataFrame([(5, -5, 0), (6, -6, 1)], "value int, nv int, seq int")
    vals = sorted(r["value"] for r in tables.apply_update_many(cur, ok, "value", "nv", "seq").collect())
    assert vals == [-6, -5, 1, 2, 3, 4, 7, 8, 9, 10]
    chained = spark.createDataFrame([(5, 6, 0), (6, 7, 1)], "value int, nv int, seq int")
    vals = sorted(r["value"] for r in tables.apply_update_many(cur, chained, "value", "nv", "seq").collect())
    assert vals == [1, 2, 3, 4, 7, 7, 7, 8, 9, 10]


def test_replay_after_crash_before_commit(spark, scratch, monkeypatch):
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    log.append(_recs(spark, 6), ["i"], batch_id=0)
    real = topiclog.TopicLog._commit
    calls = {"n": 0}

    def crash_once(self, b, pos):
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("crash before the commit mark")
        real(self, b, pos)

    monkeypatch.setattr(topiclog.TopicLog, "_commit", crash_once)
    with pytest.raises(RuntimeError):
        log.append(_recs(spark, 4, start=6), ["i"], batch_id=1)
    assert log.read().count() == 6  # the uncommitted batch is not visible
    log.append(_recs(spark, 4, start=6), ["i"], batch_id=1)
    assert log.read().count() == 10
    assert sorted((r["partition"], r["offset"]) for r in log.read().collect()) == \
        [(0, i) for i in range(5)] + [(1, i) for i in range(5)]


def test_update_one_duplicates(spark):
    cur = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], "id int, g string, v int")
    upd = spark.createDataFrame([("a", 5, 0), ("a", 7, 1)], "g string, nv int, seq int")
    out = tables.apply_update_one(cur, upd, "g", {"v": "nv"}, "id", update_order="seq")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a", 7), (2, "a", 0), (3, "b", 0)]
    with pytest.raises(ValueError):
        tables.apply_update_one(cur, upd, "g", {"v": "nv"}, "id")


def test_insert_copy_of_parts_beyond_a_million(spark, scratch):
    """A shifted part key may equal another part's key; a repeated part is
    still refused."""
    from eddy.plans import catalog
    for name, keys in (("once", [5, 1000005]), ("twice", [5, 5])):
        spark.createDataFrame([(k, f"p{k}") for k in keys], "p_partkey long, p_name string").write.parquet(
            f"{scratch}/{name}/part.parquet")
    got = sorted(tuple(r) for r in catalog.table_insert_copy(spark, f"{scratch}/once").collect())
    assert got == [(5, "p5"), (1000005, "P5"), (1000005, "p1000005"), (2000005, "P1000005")]
    with pytest.raises(ValueError):
        catalog.table_insert_copy(spark, f"{scratch}/twice")


def test_publish_results_is_not_broadcast(spark, scratch):
    """The places are as many rows as the messages."""
    log = topiclog.TopicLog(spark, f"{scratch}/log")
    sent = log.append(_recs(spark, 6), ["i"]).withColumn("i", F.col("key").cast("string").cast("long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100MB")
    try:
        out = topiclog.publish_results(sent, spark.range(8).withColumnRenamed("id", "i"), "i")
        assert len(out.collect()) == 8
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "BroadcastHashJoin" not in plan
