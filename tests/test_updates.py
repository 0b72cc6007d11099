"""Updates in sequence, chains included, against a plain loop."""

import random

import pytest

from eddy.operators import updates


def plain(rows, moves):
    for m, v, _ in sorted(moves, key=lambda u: u[2]):
        rows = [(i, v if x is not None and x == m else x) for i, x in rows]
    return sorted(rows, key=str)


def run(spark, rows, moves, **kw):
    cur = spark.createDataFrame(rows, "id int, x int")
    upd = spark.createDataFrame(moves, "x int, to int, seq int")
    return sorted((tuple(r) for r in updates.apply_in_sequence(cur, upd, "x", "to", "seq", **kw).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_sequence_equals_loop(spark, seed):
    r = random.Random(seed)
    rows = [(i, r.choice([None, *range(12)])) for i in range(60)]
    moves = [(r.choice([None, *range(12)]), r.choice([None, *range(15)]), i) for i in range(70)]
    r.shuffle(moves)
    assert run(spark, rows, moves) == plain(rows, moves)


def test_hot_value_is_cut_into_chunks(spark):
    # Half of all updates match one value and as many write it.
    r = random.Random(9)
    rows = [(i, i % 6) for i in range(30)]
    moves = [(1 if r.random() < 0.5 else r.randrange(6), 1 if r.random() < 0.5 else r.randrange(6), i)
             for i in range(300)]
    assert run(spark, rows, moves, chunk_rows=16) == plain(rows, moves)


def test_long_chain_cycle_and_self(spark):
    rows = [(i, i) for i in range(5)]
    long = [(i, i + 1, i) for i in range(100)]
    assert run(spark, rows, long) == sorted([(i, 100) for i in range(5)], key=str)
    cycle = [(1, 2, 0), (2, 3, 1), (3, 1, 2), (0, 0, 3), (0, 4, 4)]
    assert run(spark, rows, cycle) == plain(rows, cycle)


def test_odd_inputs(spark):
    # No updates, no rows, ties in order (by match, then new value), null order first.
    assert run(spark, [(1, 1)], []) == [(1, 1)]
    assert run(spark, [], [(1, 2, 0)]) == []
    assert run(spark, [(1, 1), (2, 2)], [(2, 3, 5), (1, 2, 5), (1, 2, 5)]) == [(1, 3), (2, 3)]
    assert run(spark, [(1, 1)], [(1, 7, 0), (1, 8, None)]) == [(1, 8)]
    assert run(spark, [(1, 1), (2, None)], [(1, None, 0), (None, 9, 1)]) == sorted([(1, None), (2, None)], key=str)


def test_other_columns_stay(spark):
    cur = spark.createDataFrame([(1, 5, "a", 3)], "id int, x int, to string, seq int")
    upd = spark.createDataFrame([(5, 6, 0), (6, 7, 1)], "x int, to int, seq int")
    assert [tuple(r) for r in updates.apply_in_sequence(cur, upd, "x", "to", "seq").collect()] == [(1, 7, "a", 3)]
