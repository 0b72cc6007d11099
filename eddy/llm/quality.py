"""Operator 4: quality classifier as a sparse rule ensemble.

1. Statistics of each whole text (shares of kinds of characters, word and
   line repetition, lengths) in Arrow batches.
2. A random forest of shallow trees over the statistics of a sample of
   labelled documents; every path from a root to any node is a rule, a
   conjunction of bounds on statistics.
3. A logistic regression with an L1 penalty over the rules' 0/1 values; most
   rules get weight 0.
4. The other rules are compiled into one Spark column expression.

Fitting uses at most about ``SAMPLE`` labelled documents (a parameter); every
text is scored whole.

Defined cases: null and empty texts have all statistics 0 and are scored by
the rules like others.  Without labelled documents, or with one label only,
every score is the share of label 1 (0.5 if there is none).  Repeated rows
and null ids are rows like any other; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, each_text, for_texts

SAMPLE = 20_000
TREES = 24
DEPTH = 3
PENALTY = 0.002

STATS = ("log_bytes", "upper", "lower", "digit", "space", "newline", "stop", "bang", "bar", "symbol", "other_punct",
         "non_ascii", "log_words", "word_length", "distinct_words", "distinct_lines", "caps_words", "marked_words",
         "top_word", "entropy")

# Kinds of bytes.
_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
          "space": b" \t", "newline": b"\n\r", "stop": b".,", "bang": b"!?", "bar": b"|", "symbol": b"#$%&*@~^=+<>\\_{}",
          "other_punct": b"\"'()-/:;[]`"}


def _kind_table() -> np.ndarray:
    m = np.zeros((256, len(_KINDS) + 1))
    for i, chars in enumerate(_KINDS.values()):
        m[list(chars), i] = 1
    m[128:, -1] = 1
    return m


KINDS = _kind_table()


def measure(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``STATS``."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(STATS)
    h = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    share = (h @ KINDS / n).tolist()
    p = h[h > 0] / n
    words, lines = data.split(), data.split(b"\n")
    k = max(len(words), 1)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    caps = marked = 0
    for w, c in counts.items():
        caps += c * w.isupper()
        marked += c * (not w[-1:].isalnum() and w[-1] < 128)
    return [float(np.log1p(n)), *share, float(np.log1p(len(words))), sum(map(len, words)) / k, len(counts) / k,
            len(set(lines)) / len(lines), caps / k, marked / k, max(counts.values(), default=0) / k,
            float(-(p * np.log2(p)).sum())]


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with ``stats``, an array of doubles, in place of ``text``."""
    for_texts(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(*rest, "text")

    def run(batches):
        for b in batches:
            got = pa.array([measure(t) for t in each_text(b.column(b.num_columns - 1))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], got], names=[*rest, "stats"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest)
    return rows.mapInArrow(run, f"{kinds}, stats array<double>")


def tree_rules(tree_text: str) -> list[tuple[tuple[int, str, float], ...]]:
    """Every path of a printed tree, as bounds ``(statistic, op, value)``."""
    path, found = [], []
    for line in tree_text.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.Ee]+)\)", line)
        if m:
            if not path:
                first = len(m[1])
            del path[len(m[1]) - first:]
            path.append((int(m[2]), m[3], float(m[4])))
            found.append(tuple(path))
    return found


def tighten(rule) -> tuple[tuple[int, str, float], ...]:
    """The tightest bound of each side, sorted."""
    best: dict[tuple[int, str], float] = {}
    for f, op, v in rule:
        old = best.get((f, op))
        best[f, op] = v if old is None else (min(old, v) if op == "<=" else max(old, v))
    return tuple((f, op, v) for (f, op), v in sorted(best.items()))


def rule_column(rule, stats: str = "stats") -> Column:
    out = F.lit(True)
    for f, op, v in rule:
        x = F.col(stats)[f]
        out = out & ((x <= v) if op == "<=" else (x > v))
    return out


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> dict:
    """``rows``: (text, y), a bounded sample.  Returns ``intercept`` and
    ``rules`` with their weights."""
    scratch = Scratch(rows.sparkSession, "quality")
    base = scratch.save(statistics(rows.select("y", "text")), "stats")
    n, ones = base.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or not ones or ones == n:
        share = 0.5 if not n else (ones or 0) / n
        return {"share": share, "intercept": 0.0, "rules": []}
    data = base.select(F.col("y").cast("double").alias("label"), "stats",
                       array_to_vector("stats").alias("features")).coalesce(4).cache()
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=11,
                                    maxBins=64).fit(data)
    rules = sorted({tighten(r) for t in forest.trees for r in tree_rules(t.toDebugString)})
    fired = data.select("label", array_to_vector(F.array(
        *[rule_column(r).cast("double") for r in rules])).alias("features")).cache()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, standardization=True, maxIter=60).fit(fired)
    weights = lasso.coefficients.toArray()
    data.unpersist()
    fired.unpersist()
    return {"share": ones / n, "intercept": float(lasso.intercept),
            "rules": [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6]}


def score_column(model: dict, stats: str = "stats") -> Column:
    """The rules compiled into one column expression."""
    if not model["rules"]:
        return F.lit(float(model["share"]))
    z = F.lit(model["intercept"])
    for rule, weight in model["rules"]:
        z = z + F.when(rule_column(rule, stats), weight).otherwise(0.0)
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``(doc_id, score, stats)`` of every row."""
    return statistics(docs.select("doc_id", "text")).select("doc_id", score_column(model).alias("score"), "stats")
