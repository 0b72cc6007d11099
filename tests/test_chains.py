"""Chains walked by blocks equal a walk row by row."""

import random

import pytest

from eddy.plans import chains


def _walk(nxt):
    on, p = set(), 0
    while p is not None:
        on.add(p)
        p = nxt[p]
    return on


# Short steps (exit tables contract, over several levels), steps of the
# length of a block (they do not) and keys of one block only.
@pytest.mark.parametrize("step,block,longest", [(3, 16, 700), (40, 16, 300), (5, 64, 40), (1, 8, 400)])
def test_on_chain_matches_a_walk(spark, step, block, longest):
    rnd = random.Random(step)
    rows, want = [], set()
    for key, n in (("a", longest), ("b", longest // 2 + 1), ("c", 1), ("d", block), ("e", block + 1)):
        nxt = [i + rnd.randint(1, step) for i in range(n)]
        nxt = [j if j < n else None for j in nxt]
        rows += [(key, i, j, f"{key}{i}") for i, j in enumerate(nxt)]
        want |= {(key, i) for i in _walk(nxt)}
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, idx long, next long, other string")
    got = chains.on_chain(df, ["k"], "idx", "next", "chosen", block_rows=block).collect()
    assert len(got) == len(rows)
    assert {(r.k, r.idx) for r in got if r.chosen} == want
    assert all(r.other == f"{r.k}{r.idx}" for r in got)


def test_short_steps_need_no_joins_of_jumps(spark, monkeypatch):
    """The work is in proportion to the rows: no jump table per level."""
    monkeypatch.setattr(chains, "_doubled", lambda *a: pytest.fail("pointer doubling"))
    n = 2000
    df = spark.range(n).selectExpr("'x' AS k", "id AS idx", "CASE WHEN id + 4 < 2000 THEN id + 4 END AS next")
    got = chains.on_chain(df, ["k"], block_rows=32)
    assert got.filter("chosen").count() == n // 4
