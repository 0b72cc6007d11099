"""Goldens worked out from the reference code (SURVEY section 2, FIXTURES
section 3)."""

import numpy as np
from pyspark.sql import functions as F

from eddy.functions import strings
from eddy.operators import grouping, ordered, routing, state, text, windows
from eddy.sources import generators


def test_scan_with_seed(spark):
    nums = generators.int_range(spark, 1, 6, inclusive=True).withColumn("x", F.col("n") * 2)
    out = ordered.scan(nums, ["n"], F.col("x"), name="acc", seed=0, seed_row={"n": 0})
    got = sorted((r["n"], r["acc"]) for r in out.select("n", "acc").collect())
    assert got == [(0, 0), (1, 2), (2, 6), (3, 12), (4, 20), (5, 30), (6, 42)]


def test_sliding_two_by_two(spark):
    nums = generators.int_range(spark, 1, 6, inclusive=True)
    out = windows.count_windows(nums, ["n"], 2, 2, "n")
    assert sorted(list(r["values"]) for r in out.collect()) == [[1, 2], [3, 4], [5, 6]]


def test_sliding_end_rule(spark):
    nums = generators.int_range(spark, 1, 6, inclusive=True)
    out = windows.count_windows(nums, ["n"], 4, 2, "n")
    assert sorted(list(r["values"]) for r in out.collect()) == [[1, 2, 3, 4], [3, 4, 5, 6]]
    out = windows.count_windows(generators.int_range(spark, 1, 7, inclusive=True), ["n"], 4, 2, "n")
    assert sorted(list(r["values"]) for r in out.collect()) == [[1, 2, 3, 4], [3, 4, 5, 6], [5, 6, 7]]


def test_even_odd_partition(spark):
    nums = generators.int_range(spark, 1, 6, inclusive=True)
    odd, even = routing.partition(nums, F.pmod(F.col("n") + 1, F.lit(2)), 2)
    assert sorted(r["n"] for r in odd.collect()) == [1, 3, 5]
    assert sorted(r["n"] for r in even.collect()) == [2, 4, 6]


def test_divert_tree(spark):
    nums = generators.int_range(spark, 1, 6, inclusive=True)
    rest, div3 = routing.divert(nums, F.pmod("n", F.lit(3)) == 0,
                                left=lambda d: d.withColumn("n", F.col("n") * 10))
    s1, s4 = routing.divert(div3, F.pmod("n", F.lit(60)) == 0)
    s3, s2 = routing.divert(rest, F.pmod("n", F.lit(3)) == 1)
    vals = lambda d: sorted(r["n"] for r in d.collect())
    assert (vals(s1), vals(s4), vals(s2), vals(s3)) == ([30], [60], [1, 4], [2, 5])


def test_groups_mod_four(spark):
    nums = generators.int_range(spark, 1, 100, inclusive=True)
    lists = grouping.group_list(nums, F.pmod("n", F.lit(4)), ["n"], "n")
    sizes = {r["grp"]: r["n"] for r in grouping.group_sizes(nums, F.pmod("n", F.lit(4))).collect()}
    assert sizes == {0: 25, 1: 25, 2: 25, 3: 25}
    g1 = [r["n"] for r in lists.filter("grp = 1").orderBy("pos").collect()]
    assert g1 == list(range(1, 101, 4))


def test_wrapped_series(spark):
    series = generators.affine_unfold(spark, 250)
    lines = text.wrapped_lines(series, ["i"], F.col("n")).orderBy("line_id").collect()
    assert [(r["numbers"], r["first_number"]) for r in lines] == [(91, 3), (91, 1004), (68, 2005)]


def test_request_rounds(spark):
    reqs = [(1, "1"), (1, "2"), (2, "1"), (3, "1"), (3, "2"), (3, "3"), (3, "4"), (4, "1"), (2, "2"),
            (1, "3"), (1, "4")]
    df = spark.createDataFrame([(i, v, m) for i, (v, m) in enumerate(reqs)], "seq long, value int, mark string")
    out = windows.conflict_rounds(df, "value", ["seq"])
    rows = out.collect()
    assert len(rows) == 11
    assert sum(r["put_off"] for r in rows) == 13
    assert max(r["round"] for r in rows) + 1 == 4


def _cat_run(spark, hunger, events):
    """Run the cat machine from (Awake, hunger) over events."""
    m = state.CatMachine()
    rows = [(1, i, c, b, False) for i, (c, b) in enumerate(events)]
    df = spark.createDataFrame(rows, "k long, seq long, cmd string, by int, timed_out boolean")
    m.initial = m.AWAKE * m.STRIDE + hunger
    return state.run_machine(df, m, "k", "seq").orderBy("seq").collect()


def test_fsm_dies_from_hunger(spark):
    out = _cat_run(spark, 55, [("grow", 6)] * 8)
    assert [r["reply"] for r in out] == ["61", "67", "73", "79", "85", "91", "97", "failed"]
    assert out[4]["state"] == "VeryHungry"
    assert out[7]["state"] == "Failed"


def test_fsm_stroke(spark):
    assert _cat_run(spark, 15, [("stroke", 0)])[0]["reply"] == "purrr"
    assert _cat_run(spark, 75, [("stroke", 0)])[0]["reply"] == "mewww"


def test_fsm_sleep_and_timer(spark):
    m = state.CatMachine()
    df = spark.createDataFrame([(1, 0, "stroke", 0, False), (1, 1, "stroke", 0, True), (1, 2, "sleep", 0, False)],
                               "k long, seq long, cmd string, by int, timed_out boolean")
    out = state.run_machine(df, m, "k", "seq").orderBy("seq").collect()
    assert [r["reply"] for r in out] == [None, "mewww", "60"]
    assert [r["state"] for r in out] == ["Sleeping", "Awake", "Sleeping"]


def test_fsm_many_chunks(spark):
    """Transfer tables composed over many chunks equal a plain loop."""
    rng = np.random.default_rng(3)
    cmds = rng.choice(["wake", "stroke", "sleep", "grow", "other"], size=400, p=[.2, .3, .2, .05, .25])
    rows = [(int(i % 2), int(i), str(c), int(rng.integers(0, 3)), bool(rng.random() < .2))
            for i, c in enumerate(cmds)]
    df = spark.createDataFrame(rows, "k long, seq long, cmd string, by int, timed_out boolean")
    m = state.CatMachine()
    got = {r["seq"]: (r["state"], r["hunger"], r["reply"])
           for r in state.run_machine(df, m, "k", "seq", chunk_rows=16).collect()}
    import pandas as pd
    for k in (0, 1):
        cur = m.initial
        for row in [r for r in rows if r[0] == k]:
            ev = pd.Series({"cmd": row[2], "by": row[3], "timed_out": row[4]})
            reply = m.reply(cur, ev)
            cur = int(m.step(np.array([cur]), ev)[0])
            d = m.describe(cur)
            assert got[row[1]] == (d["state"], d["hunger"], reply)


def _cart(spark, cmds):
    df = spark.createDataFrame([(1, i, c, it, q) for i, (c, it, q) in enumerate(cmds)],
                               "cart long, seq long, cmd string, item string, quantity int")
    return df


def test_cart_update_then_restart(spark):
    cmds = _cart(spark, [("add", "sku-000001", 2), ("update", "sku-000001", 5)])
    journal = state.cart_journal(cmds)
    live = state.cart_state(journal).collect()
    replayed = state.cart_state(journal.select(*journal.columns)).collect()
    assert [(r["item"], r["quantity"]) for r in live] == [("sku-000001", 5)]
    assert live == replayed


def test_cart_remove_and_get_before_add(spark):
    cmds = _cart(spark, [("add", "sku-000001", 2), ("remove", "sku-000001", None)])
    assert state.cart_state(state.cart_journal(cmds)).count() == 0
    replies = state.cart_accepted(_cart(spark, [("get", None, None), ("add", "a", 1)])).orderBy("seq").collect()
    assert [r["reply"] for r in replies] == ["ItemNotFound", "ok"]


def test_pad_reverse(spark):
    df = spark.createDataFrame([("0", 0), ("1", 1), ("2", 3), ("12", 0)], "s string, i long")
    out = [r[0] for r in df.select(strings.pad_reverse(F.col("s"), F.col("i"))).collect()]
    assert out == ["0", " 1", "   2", "21"]


def test_take_while_inclusive(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 2, 5, 1, 7])], "i long, v long")
    out = ordered.take_while(df, ["i"], F.col("v") < 4)
    assert sorted(r["i"] for r in out.collect()) == [0, 1, 2]


def test_zip_ends_with_shorter(spark):
    a = generators.int_range(spark, 1, 6, inclusive=True)
    b = generators.int_range(spark, 10, 13).withColumnRenamed("n", "m")
    out = ordered.zip_positional(a, b, ["n"], ["m"]).orderBy("idx").collect()
    assert [(r["n"], r["m"]) for r in out] == [(1, 10), (2, 11), (3, 12)]


def _greedy_df(spark):
    import random
    rnd = random.Random(7)
    rows, t = [], 0
    for i in range(300):
        t += rnd.choice([1, 2, 5, 30, 90])
        rows.append((i, i % 3, t))
    return spark.createDataFrame(rows, "seq long, k long, s long").withColumn("ts", F.timestamp_seconds("s"))


def test_in_flight_chain_equals_direct(spark):
    df = _greedy_df(spark)
    a = state.suppress_in_flight(df, "k", "seq", "ts", 60 * 10**6)
    b = state.suppress_in_flight(df, "k", "seq", "ts", 60 * 10**6, direct_rows=0)
    key = lambda d: sorted((r["seq"], r["accepted"]) for r in d.collect())
    assert key(a) == key(b)
    assert 0 < sum(v for _, v in key(a)) < 300


def test_grouped_within_chain_equals_direct(spark):
    df = _greedy_df(spark)
    a = state.grouped_within(df, "k", "seq", "ts", 4, 100 * 10**6)
    b = state.grouped_within(df, "k", "seq", "ts", 4, 100 * 10**6, direct_rows=0)
    key = lambda d: sorted((r["seq"], r["batch"]) for r in d.collect())
    assert key(a) == key(b)


def test_fsm_composition_tree(spark, monkeypatch):
    """More chunk tables per key than FANIN: the entry states come from the
    tree of compositions and still equal a plain loop."""
    import pandas as pd
    monkeypatch.setattr(state, "FANIN", 3)
    rng = np.random.default_rng(5)
    cmds = rng.choice(["wake", "stroke", "sleep", "grow", "other"], size=240, p=[.2, .3, .2, .05, .25])
    rows = [(int(i % 2), int(i), str(c), int(rng.integers(0, 2)), bool(rng.random() < .2))
            for i, c in enumerate(cmds)]
    df = spark.createDataFrame(rows, "k long, seq long, cmd string, by int, timed_out boolean")
    m = state.CatMachine()
    got = {r["seq"]: (r["state"], r["hunger"], r["reply"])
           for r in state.run_machine(df, m, "k", "seq", chunk_rows=4).collect()}
    for k in (0, 1):
        cur = m.initial
        for row in [r for r in rows if r[0] == k]:
            ev = pd.Series({"cmd": row[2], "by": row[3], "timed_out": row[4]})
            reply = m.reply(cur, ev)
            cur = m.step_one(cur, ev)
            d = m.describe(cur)
            assert got[row[1]] == (d["state"], d["hunger"], reply)
