"""Operator 12 against all pairs in plain Python."""

import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eddy.llm import hard_negatives as H
from eddy.llm.catalog import op12_hard_negatives, op12_rows

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, b int"


def brute(rows):
    """``rows``: (vec_id, vector, label) with unique ids."""
    use = []
    for i, x, y in rows:
        if i is None or y is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        use.append((i, [math.floor(256 * float(np.float32(v))) for v in x], (y + 1) % 10 if i % 7 == 0 else y))
    out = []
    for i, x, y in use:
        if i % 50:
            continue
        s = sorted((-sum(a * b for a, b in zip(x, z)), j, lab) for j, z, lab in use if j != i)
        for ps, p, _ in [t for t in s if t[2] == y][:5]:
            neg = [t for t in s if t[2] != y and 50 * -ps <= 100 * -t[0] <= 95 * -ps][:3]
            out += [(i, p, k + 1, j, -ps, -ns) for k, (ns, j, _) in enumerate(neg)]
    return sorted(out)


def result(df):
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score)
                  for r in df.collect())


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return result(H.mine(op12_rows(df), F.col("id") % 50 == 0, **kw))


def some(n, seed=1, dim=6):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(dim)] for _ in range(4)]
    return [(i, [c + r.uniform(-.3, .3) for c in r.choice(centres)], r.randrange(4)) for i in range(n)]


def test_all_pairs(spark):
    rows = some(700)
    assert mined(spark, rows) == brute(rows)


def test_small_groups_and_blocks(spark):
    rows = some(600, 2)
    assert mined(spark, rows, group=4, block=50) == brute(rows)


def test_ties_and_one_hot_vector(spark):
    rows = some(300, 3)
    rows = [(i, rows[0][1] if i % 3 == 0 else x, 1 if i % 2 else y) for i, x, y in rows]
    assert mined(spark, rows, block=64) == brute(rows)


def test_odd_rows(spark):
    nan = float("nan")
    rows = some(160, 4)
    odd = [(None, [.1] * 6, 1), (1000, None, 1), (1001, [nan] * 6, 1), (1002, [.1, None, .1, .1, .1, .1], 2),
           (1050, [.5] * 6, None), (1100, [float("inf")] * 6, 2), (1150, [0.0] * 6, 3), (1200, [], 2)]
    assert mined(spark, rows + odd) == brute(rows + odd)
    assert mined(spark, rows + odd + rows[:60]) == brute(rows + odd)  # repeated rows count once
    assert mined(spark, []) == []
    assert mined(spark, [(50, [.2] * 6, 1)]) == []


def test_large_values_are_exact():
    x = pa.table({"v": pa.array([[2.0**40, 1.0]]), "parent": pa.array([-1]), "edge": pa.array([0.0])})
    y = pa.table({"v": pa.array([[2.0**20, 3.0], [2.0**40, 0.0]])})
    b = H.Bounds(x, y)
    assert not b.whole and b.scores(0, np.arange(2)).tolist() == [2**60 + 3, 2**63 - 1]


def test_bounds_hold_and_spare_rows():
    rows = some(400, 5, 16)
    m = np.floor(256 * np.array([r[1] for r in rows]))
    order, parent, edge = H.spanning_tree(m[:40])
    pos = np.empty(40, int)
    pos[order] = np.arange(40)
    a = pa.table({"v": pa.array(m[order].tolist()), "edge": pa.array(edge[order]),
                  "parent": pa.array(np.where(parent[order] < 0, -1, pos[parent[order]]))})
    b = H.Bounds(a, pa.table({"v": pa.array(m.tolist())}))
    exact = m[order] @ m.T
    assert abs(edge.sum() - sum(np.linalg.norm(m[order][i] - m[order][p]) for i, p in enumerate(a["parent"].to_pylist()) if p >= 0)) < 1e-6
    for i in range(40):
        low, high = b.of(i)
        assert (low <= exact[i]).all() and (exact[i] <= high).all()
        b.keep(i, low, high)


def test_sf(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]
    assert result(op12_hard_negatives(spark, "/root/testdata/sf0.001")) == brute(rows)
