"""Scalar functions, generators, files, mapping and sinks."""

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddy import sinks
from eddy.functions import json as J
from eddy.functions import strings
from eddy.functions import time as tm
from eddy.operators import grouping, mapping, routing, text
from eddy.sources import files, generators


def test_jvm_trim_and_words(spark):
    df = spark.createDataFrame([("\x01\t a  b\x0bc \x00",)], "s string")
    r = df.select(strings.jvm_trim(F.col("s")).alias("t"), strings.words(F.col("s")).alias("w")).first()
    assert r["t"] == "a  b\x0bc"
    assert list(r["w"]) == ["\x01", "a", "b", "c", "\x00"]


def test_rewrite_rules_in_order(spark):
    df = spark.createDataFrame([("aaa bbb",)], "s string")
    out = df.select(strings.rewrite(F.col("s"), [("a+", "b"), ("b+", "c")]).alias("o")).first()["o"]
    assert out == "c c"


def test_frequent_words_filter(spark):
    counts = spark.createDataFrame([("word", 20), ("ABC", 20), ("abc", 20), ("tiny", 5), ("ab", 30)],
                                   "word string, n long")
    got = [r["word"] for r in text.frequent_words(counts, 14).collect()]
    assert got == ["ABC", "word"]


def test_wrap_separator(spark):
    df = spark.createDataFrame([(3,), (14,), (1004,)], "n long")
    got = [r[0] for r in df.select(strings.wrap_separator(F.col("n"))).collect()]
    assert got == ["", " ", "\n"]


def test_tagged_json_round_trip(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, "x", 5, ts)], "id long, first string, second int, third timestamp_ntz")
    msg = J.encode("type1", {"first": F.col("first"), "second": F.col("second"), "third": F.col("third")})
    schema = J.superset_schema({"type1": [("first", T.StringType()), ("second", T.IntegerType()),
                                          ("third", T.TimestampNTZType())],
                                "type3": [("first", T.IntegerType())]})
    back = df.select(J.decode(msg, schema).alias("m")).select("m.*").first()
    assert (back["type"], back["first"], back["second"], back["third"]) == ("type1", "x", 5, ts)
    bad = spark.createDataFrame([("{oops",), ('{"type": "zzz"}',)], "s string")
    parsed = bad.select(J.decode(F.col("s"), schema).alias("m"))
    assert [r[0] for r in parsed.select(J.is_valid(F.col("m"), ["type1"])).collect()] == [False, False]


def test_nested_message(spark):
    m = spark.range(2, 3).select(J.nested_message(F.col("id")).alias("m")).first()["m"]
    assert m == ('{"$type":"add_table","after_id":3,"table":{"id":4,'
                 '"name":"table - Foo Fighters 4","participants":8}}')


def test_time_functions(spark):
    df = spark.createDataFrame([(1704067207179,)], "ms long")
    r = df.select(tm.to_text(tm.from_millis(F.col("ms"))).alias("a"),
                  tm.local_time_text(tm.from_millis(F.col("ms"))).alias("b"),
                  tm.to_millis(tm.from_millis(F.col("ms"))).alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == ("2024-01-01 00:00:07", "00:00:07.179", 1704067207179)


def test_generators(spark):
    assert generators.int_range(spark, 1, 100, inclusive=True, cap=1000).count() == 100
    assert generators.int_range(spark, 0, 10, cap=3).count() == 3
    a = generators.random_ints(spark, 20, 500000, seed=7).collect()
    b = generators.random_ints(spark, 20, 500000, seed=7).repartition(5).collect()
    assert sorted(a) == sorted(b) and all(0 <= r["n"] < 500000 for r in a)
    ticks = generators.ticks(spark, 20, 300).orderBy("seq").collect()
    assert (ticks[1]["ts"] - ticks[0]["ts"]).total_seconds() == 0.3
    assert [r["n"] for r in generators.affine_unfold(spark, 3).orderBy("i").collect()] == [3, 14, 25]


def test_text_files_keep_cr_and_file(spark, scratch):
    p = f"{scratch}/f.txt"
    with open(p, "w", newline="") as fh:
        fh.write("a\r\nb\n\nlast")
    got = files.read_lines(spark, p).collect()
    assert [r["value"] for r in got] == ["a\r", "b", "", "last"]
    assert all(r["file"].endswith("f.txt") for r in got)


def test_bucketed_append_and_bytes(spark, scratch):
    df = spark.range(10).select(F.col("id"), F.concat(F.lit("row"), F.col("id").cast("string")).alias("t"))
    out = f"{scratch}/out"
    files.write_text(df, out, "t", mode="append", bucket=F.pmod("id", F.lit(3)))
    files.write_text(df, out, "t", mode="append", bucket=F.pmod("id", F.lit(3)))
    back = files.read_lines(spark, out)
    assert back.count() == 20
    counts = {r["bucket"]: r["count"] for r in back.groupBy("bucket").count().collect()}
    assert counts == {0: 8, 1: 6, 2: 6}
    assert files.bytes_written(df, "t").first()["bytes"] == sum(len(f"row{i}") + 1 for i in range(10))


def test_mapping(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, None)], "id long, s string")
    assert mapping.drop_matching(df, F.col("s").isNull()).count() == 1
    fm = mapping.flat_map(df, F.split("s", "\n"), "line", "pos", ["id"]).collect()
    assert [(r["id"], r["pos"], r["line"]) for r in fm] == [(1, 0, "a"), (1, 1, "b")]
    pm = mapping.parallel_map(spark.range(10), lambda p: p.assign(sq=p["id"] ** 2), "id long, sq long",
                              width=3, order_by=["id"])
    assert [r["sq"] for r in pm.collect()] == [i * i for i in range(10)]


def test_sinks_and_flags(spark):
    seen = []
    sink = sinks.acknowledged(lambda: seen.append("init"), lambda b, i: seen.append(i),
                              lambda: seen.append("done"))
    df = spark.range(5)
    sink(df, 0)
    sink(df, 1)
    sink.complete()
    assert seen == ["init", 0, 1, "done"]
    obs = Observation("bound")
    flagged = routing.flag_over(spark.range(10), F.col("id"), 6, observation=obs)
    assert flagged.count() == 10
    assert obs.get["over_limit"] == 3
    sinks.discard(df)
    first = sinks.first_row(spark.createDataFrame([(3, "c"), (1, "a")], "k long, v string"), ["k"]).first()
    assert first["v"] == "a"


def test_grouping_helpers(spark):
    a = spark.createDataFrame([("x", 2), ("y", 1)], "w string, n long")
    b = spark.createDataFrame([("x", 5)], "w string, n long")
    assert sorted(tuple(r) for r in grouping.merge_counts([a, b], "w").collect()) == [("x", 7), ("y", 1)]
    upd = spark.createDataFrame([("x",), ("z",)], "w string")
    out = grouping.adjust(a, upd, "w", "n", 0, lambda c: c + 1)
    assert sorted(tuple(r) for r in out.collect()) == [("x", 3), ("y", 1), ("z", 1)]
    reqs = spark.createDataFrame([(1,), (9,)], "k long")
    tbl = spark.createDataFrame([(1, "one")], "k long, v string")
    got = sorted((r["k"], r["v"], r["error"]) for r in grouping.lookup(reqs, tbl, "k", "v").collect())
    assert got == [(1, "one", None), (9, None, "KeyNotFound: 9")]
    r = routing.recover(spark.createDataFrame([("7",), ("x",)], "s string"),
                        F.expr("try_cast(s as int)"), -1)
    assert sorted((x["result"], x["error"]) for x in r.collect()) == [(-1, True), (7, False)]


def test_fragments_in_pieces(spark):
    rows = [(1, i, f"f{i}") for i in range(7)] + [(2, 0, "only")]
    df = spark.createDataFrame(rows, "msg long, frag long, text string")
    got = {r["msg"]: (r["message"], r["fragments"])
           for r in grouping.join_fragments(df, "msg", "frag", "text", sep="|", piece_rows=2).collect()}
    assert got == {1: ("f0|f1|f2|f3|f4|f5|f6", 7), 2: ("only", 1)}
