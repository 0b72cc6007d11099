"""Operator 12: hard negatives by bounds along spanning trees of anchors.

A score is the inner product of an anchor and a row.  If ``p`` is the parent
of anchor ``a`` in a tree, ``a.c`` differs from ``p.c`` by at most
``|a - p| * |c|``, so the parent's scores bound the child's.

1. Anchors are dealt into groups of at most about ``GROUP``: to the nearest of
   at most ``PIVOTS`` pivot anchors, and by a hash within a pivot.  A group's
   minimum spanning tree gives every anchor its parent and edge.
2. Rows are dealt into blocks of about ``BLOCK`` by a hash.  Every anchor
   group meets every block once, in a task of its own: the stated query set
   against all rows, in blocks.  No task holds more than a group and a block.
3. Positives: in a block, an anchor's scores are bounded by its parent's;
   only rows of its label whose upper bound reaches the ``positives``-th
   largest lower bound are scored.  The best of all blocks are merged.
4. Negatives: a positive's score opens a window of scores.  Only rows of
   another label whose bounds overlap a window are scored, and the best
   ``negatives`` of each window are kept and merged.

Bounds are widened by more than the rounding of floats, and scores are exact
integers, so the result is the same as that of scoring every pair.

Defined cases: rows with a null id, label or vector, or with a component that
is null or not finite take no part; rows of one id are one row (the smallest
label, then vector); vectors of different lengths are filled up with zeros;
fewer rows than asked for are returned as they are; ties go to the smaller
id; other columns are ignored.  Scores that a long can't hold are returned as
the nearest long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, ship_package

GROUP = 512
BLOCK = 4096
PIVOTS = 64
POSITIVES = 5
NEGATIVES = 3
#: The window: negatives score 50 to 95 % of the positive.
LOW, HIGH = 50, 95


def usable(rows: DataFrame, vec_id: Column, label: Column, vector: Column) -> DataFrame:
    """``(id, label, v)`` of the rows that take part, one for each id;
    ``vector`` has whole numbers as doubles."""
    v = vector.alias("v")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = rows.select(vec_id.cast("long").alias("id"), label.cast("long").alias("label"), v)
    out = out.where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(~bad)
    return out.groupBy("id").agg(F.min(F.struct("label", "v")).alias("m")).select("id", "m.label", "m.v")


def _matrix(lists, width: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column as a matrix, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), max(int(size.max(initial=0)), width or 0)))
    at = np.repeat(np.arange(len(size)), size)
    out[at, np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prim's minimum spanning tree: the order in which rows join it, the
    parent of each row (-1 for the first) and its distance to the parent."""
    n = len(x)
    near, parent = np.full(n, np.inf), np.full(n, -1)
    order, left, at = [], np.ones(n, bool), 0
    for _ in range(n):
        order.append(at)
        left[at] = False
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = left & (d < near)
        near[closer], parent[closer] = d[closer], at
        at = int(np.where(left, near, np.inf).argmin())
    near[order[:1]] = 0.0
    return np.array(order, int), parent, near


def plant(anchors: DataFrame, scratch: Scratch, group: int = GROUP) -> tuple[DataFrame, int]:
    """``(g, pos, parent, edge, id, label, v)``: the groups of the anchors and
    their trees, and the number of groups; ``pos`` is the order in the tree,
    ``parent`` a ``pos``."""
    anchors = scratch.save(anchors, "anchors")
    n = anchors.count()
    # A bounded number of pivots, alike on every run.
    most = min(PIVOTS, -(-n // group))
    pivots = [r[0] for r in anchors.orderBy(F.xxhash64("id"), "id").limit(most).select("v").collect()]
    width = max(map(len, pivots), default=0)
    p = np.array([[*v, *[0.0] * (width - len(v))] for v in pivots]).reshape(len(pivots), width)

    def nearest(batches):
        for b in batches:
            m = _matrix(b.column(2), width)[:, :width]
            d = (p * p).sum(axis=1)[None, :] - 2 * m @ p.T
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(d.argmin(axis=1) if len(m) else [], pa.int64())],
                                             names=["id", "label", "v", "pivot"])

    dealt = scratch.save(anchors.select("id", "label", "v").mapInArrow(
        nearest, "id bigint, label bigint, v array<double>, pivot bigint"), "dealt")
    # Groups are numbered by pivot (at most PIVOTS rows), then part.
    counts = sorted((r[0], -(-r[1] // group)) for r in dealt.groupBy("pivot").count().collect())
    first = np.concatenate([[0], np.cumsum([k for _, k in counts])]).astype(int).tolist()
    number = F.lit(0).cast("long")
    for (pivot, parts), at in zip(counts, first):
        number = F.when(F.col("pivot") == pivot, F.pmod(F.xxhash64("id"), F.lit(parts)) + at).otherwise(number)
    dealt = dealt.withColumn("g", number)

    def tree(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        order, parent, edge = spanning_tree(_matrix(t["v"]))
        pos = np.empty(len(order), int)
        pos[order] = np.arange(len(order))
        up = np.where(parent[order] < 0, -1, pos[parent[order]])
        t = t.take(pa.array(order))
        return pa.table({"g": t["g"], "pos": pa.array(np.arange(len(order))), "parent": pa.array(up),
                         "edge": pa.array(edge[order]), "id": t["id"], "label": t["label"], "v": t["v"]})

    schema = "g bigint, pos bigint, parent bigint, edge double, id bigint, label bigint, v array<double>"
    return scratch.save(dealt.select("g", "id", "label", "v").groupBy("g").applyInArrow(tree, schema), "trees"), first[-1]


def deal(rows: DataFrame, scratch: Scratch, block: int = BLOCK) -> tuple[DataFrame, int]:
    """``(b, id, label, v)``, the rows in blocks, and the number of blocks."""
    rows = scratch.save(rows.select("id", "label", "v"), "rows")
    blocks = max(1, -(-rows.count() // block))
    return rows.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(blocks))), blocks


def _meet(trees: DataFrame, groups: int, dealt: DataFrame, blocks: int, each, schema: str) -> DataFrame:
    """``each(anchors, rows)`` for every group and block, as Arrow tables."""
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    if not groups:
        return trees.sparkSession.createDataFrame([], schema)
    left = trees.withColumn("b", numbers(blocks))
    right = dealt.withColumn("g", numbers(groups))

    def run(key, a: pa.Table, c: pa.Table) -> pa.Table:
        return each(a.sort_by("pos"), c.sort_by("id"))

    return left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(run, schema)


class Bounds:
    """Exact scores, or bounds of them, of each anchor of a group and all rows
    of a block, in the order of the tree."""

    def __init__(self, a: pa.Table, c: pa.Table):
        x, y = _matrix(a["v"]), _matrix(c["v"])
        width = max(x.shape[1], y.shape[1])
        self.x, self.y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, y))
        self.norm = np.sqrt((self.y ** 2).sum(axis=1))
        self.parent, self.edge = a["parent"].to_numpy(), a["edge"].to_numpy()
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.last = {int(p): i for i, p in enumerate(self.parent)}  # the last child of each
        reach = float(np.abs(self.x).max(initial=0)) * float(np.abs(self.y).max(initial=0)) * max(1, width)
        self.whole = reach < 2**53  # sums are exact in floats

    def scores(self, i: int, at: np.ndarray) -> np.ndarray:
        """Exact scores of anchor ``i`` and the rows ``at``."""
        if self.whole:
            return (self.y[at] @ self.x[i]).astype(np.int64)
        ints = [int(v) for v in self.x[i]]
        full = [sum(int(u) * v for u, v in zip(row, ints)) for row in self.y[at]]
        return np.array([max(1 - 2**63, min(2**63 - 1, s)) for s in full], np.int64)

    def of(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of anchor ``i``."""
        p = int(self.parent[i])
        if p < 0:
            low = high = self.scores(i, np.arange(len(self.y))).astype(float)
            return low.copy(), high.copy()
        low, high = self.held[p]
        gap = self.edge[i] * self.norm
        # Wider than all rounding: a unit, and a billionth of what was added.
        slack = 1.0 + 1e-9 * (np.abs(low) + np.abs(high) + gap)
        if self.last[p] == i:
            del self.held[p]
        return low - gap - slack, high + gap + slack

    def keep(self, i: int, low: np.ndarray, high: np.ndarray) -> None:
        if i in self.last:
            self.held[i] = (low, high)


def positives_of(a: pa.Table, c: pa.Table, most: int) -> pa.Table:
    """The best ``most`` rows of the block for each anchor of the group."""
    bounds, ids, labels = Bounds(a, c), c["id"].to_numpy(), c["label"].to_numpy()
    rows = {int(x): np.flatnonzero(labels == x) for x in np.unique(labels)}
    aid, alabel = a["id"].to_numpy(), a["label"].to_numpy()
    out = []
    for i in range(len(aid)):
        low, high = bounds.of(i)
        same = rows.get(int(alabel[i]), np.zeros(0, int))
        same = same[ids[same] != aid[i]]
        if len(same):
            least = np.partition(low[same], len(same) - most)[len(same) - most] if len(same) > most else -np.inf
            at = same[high[same] >= least]
            s = bounds.scores(i, at)
            low[at] = high[at] = s
            best = np.lexsort((ids[at], -s))[:most]
            out.append((np.full(len(best), aid[i]), ids[at][best], s[best]))
        bounds.keep(i, low, high)
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
    return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score"), cols)))


def negatives_of(a: pa.Table, c: pa.Table, most: int, low_pct: int, high_pct: int) -> pa.Table:
    """The best ``most`` rows of the block in each window of each anchor."""
    bounds, ids, labels = Bounds(a, c), c["id"].to_numpy(), c["label"].to_numpy()
    aid, alabel, windows = a["id"].to_numpy(), a["label"].to_numpy(), a["windows"].to_pylist()
    out = []
    for i in range(len(aid)):
        low, high = bounds.of(i)
        # Windows in whole numbers: 100 * score between these.
        spans = [(w["positive_id"], w["positive_score"]) for w in windows[i] or [] if w["positive_score"] >= 0]
        if spans:
            first, last = min(s for _, s in spans) * low_pct, max(s for _, s in spans) * high_pct
            at = np.flatnonzero((100 * high >= first * (1 - 1e-12) - 1) & (100 * low <= last * (1 + 1e-12) + 1)
                                & (labels != alabel[i]))
            s = bounds.scores(i, at)
            low[at] = high[at] = s
            order = np.lexsort((ids[at], -s))
            at, s = at[order], s[order]
            for pid, score in spans:
                # Scores fall along ``s``: the window is a slice.
                top = -(-score * low_pct // 100), score * high_pct // 100
                lo, hi = np.searchsorted(-s, -top[1], "left"), np.searchsorted(-s, -top[0], "right")
                hi = min(hi, lo + most)
                if hi > lo:
                    k = hi - lo
                    out.append((np.full(k, aid[i]), np.full(k, pid), np.full(k, score), ids[at[lo:hi]], s[lo:hi]))
        bounds.keep(i, low, high)
    cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
    return pa.table(dict(zip(("anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"), cols)))


def _best(rows: DataFrame, by: list[str], score: str, tie: str, most: int, name: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col(score).desc(), tie)
    return rows.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)`` for the ``rows`` of :func:`usable`; ``is_anchor`` tells
    anchors by ``id``."""
    scratch = Scratch(rows.sparkSession, "negatives")
    ship_package(rows.sparkSession)
    dealt, blocks = deal(rows, scratch, block)
    trees, groups = plant(dealt.where(is_anchor).select("id", "label", "v"), scratch, group)
    found = _meet(trees, groups, dealt, blocks, lambda a, c: positives_of(a, c, positives),
                  "anchor_id bigint, positive_id bigint, positive_score bigint")
    best = _best(found, ["anchor_id"], "positive_score", "positive_id", positives, "n").drop("n")
    windows = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("windows"))
    aimed = scratch.save(trees.join(windows.withColumnRenamed("anchor_id", "id"), "id", "left"), "aimed")
    found = _meet(aimed, groups, dealt, blocks, lambda a, c: negatives_of(a, c, negatives, low, high),
                  "anchor_id bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint")
    out = _best(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score",
                      "negative_score")
