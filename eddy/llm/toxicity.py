"""Operator 9: toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has the probability
``p = sigmoid(bias + sum of weights of its features)``; the document's is the
noisy-or ``1 - product(1 - p)``.  The weights are trained from document
labels only (gradient descent on the noisy-or's log loss), so they also tell
which sentences made the document toxic.

Features are words, their first 2 to 7 and their last 2 to 4 letters.  They are chosen on the
cluster by how unevenly they occur in labelled documents.  Fitting uses at
most about ``SAMPLE`` labelled documents and ``FEATURES`` features (both
parameters); every text is scored whole.

Defined cases: a null or empty text has one sentence without features; its
score is what the bias says.  Without labelled documents, or with one label
only, the model is the share of label 1 (0 if there is none).  Repeated rows
and null ids are rows like any other; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StructField, StructType)

from .common import each_text, for_texts

SAMPLE = 30_000
FEATURES = 4_000
PREFIXES = (2, 3, 4, 5, 6, 7)
SUFFIXES = (2, 3, 4)
MEMO = 100_000

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) > n],
            *[f"*{word[-n:]}" for n in SUFFIXES if len(word) > n]]


def _document_features(rows: DataFrame) -> DataFrame:
    """``(y, f)``: each feature of each document once."""
    w = F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), ""))
    long = lambda n: F.filter("w", lambda x: F.length(x) > n)
    stems = [F.transform(long(n), lambda x, n=n: F.concat(F.substring(x, 1, n), F.lit("*"))) for n in PREFIXES]
    stems += [F.transform(long(n), lambda x, n=n: F.concat(F.lit("*"), F.substring(x, -n, n))) for n in SUFFIXES]
    return rows.select("y", w.alias("w")).select("y", F.explode(F.array_distinct(F.concat("w", *stems))).alias("f"))


def choose_features(rows: DataFrame, most: int = FEATURES, min_docs: int = 5) -> list[tuple[str, float]]:
    """Features whose share among documents of label 1 is the most
    significantly off, with their log odds."""
    n1, n = rows.agg(F.sum("y"), F.count(F.lit(1))).first()
    n0, n1 = n - (n1 or 0), n1 or 0
    if not n1 or not n0:
        return []
    f = (_document_features(rows).groupBy("f").agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("d"))
         .where(F.col("d") >= min_docs))
    a, b = F.col("a") + 0.1, F.col("d") - F.col("a") + 0.1
    odds = F.log(a / (n1 + 0.2)) - F.log(b / (n0 + 0.2))
    z = F.abs(odds) / F.sqrt(1 / a + 1 / b)
    return [(r.f, r.o) for r in f.select("f", odds.alias("o"), z.alias("z")).where("z >= 2")
            .orderBy(F.desc("z"), "f").limit(most).collect()]


class Sentences:
    """Feature numbers of a text's sentences that have any."""

    def __init__(self, number: dict[str, int]):
        self.number = number
        self.memo: dict[str, tuple[int, ...]] = {}

    def word(self, w: str) -> tuple[int, ...]:
        got = tuple(self.number[f] for f in features_of(w) if f in self.number)
        if len(self.memo) >= MEMO:
            self.memo.clear()
        self.memo[w] = got
        return got

    def __call__(self, text: str | None) -> tuple[int, list[tuple[int, int, set[int]]]]:
        """Number of sentences, and (start, stop, features) of some."""
        n, out, memo = 0, [], self.memo
        for m in SENTENCE.finditer(text or ""):
            n += 1
            have: set[int] = set()
            for w in WORD.findall(m.group().lower()):
                got = memo.get(w)
                if got is None:
                    got = self.word(w)
                if got:
                    have.update(got)
            if have:
                out.append((m.start(), m.end(), have))
        return max(n, 1), out


def fit(rows: DataFrame, most: int = FEATURES, steps: int = 300, ridge: float = 2e-4) -> dict:
    """``rows``: (text, y) of a bounded sample.  The features of its sentences
    are found in tasks; the gradient descent runs over those of the sample."""
    for_texts(rows.sparkSession)
    chosen = choose_features(rows, most)
    number = {f: i for i, (f, _) in enumerate(chosen)}
    if not chosen:
        share = rows.agg(F.avg("y")).first()[0] or 0.0
        return {"number": {}, "weights": [], "bias": float(np.log((share + 1e-9) / (1 - share + 1e-9))), "flat": True}

    def run(batches):
        read = Sentences(number)
        for b in batches:
            got = [read(t) for t in each_text(b.column(0))]
            yield pa.RecordBatch.from_arrays(
                [b.column(1).cast(pa.float64()), pa.array([n - len(s) for n, s in got], pa.int32()),
                 pa.array([[sorted(x) for *_, x in s] for _, s in got], pa.list_(pa.list_(pa.int32())))],
                names=["y", "plain", "sets"])

    shape = StructType([StructField("y", DoubleType()), StructField("plain", IntegerType()),
                        StructField("sets", ArrayType(ArrayType(IntegerType())))])
    bags = rows.select("text", "y").mapInArrow(run, shape).toArrow()
    return {"number": number, "flat": False} | _descend(bags, np.array([o for _, o in chosen]), steps, ridge)


def _descend(bags: pa.Table, odds: np.ndarray, steps: int, ridge: float) -> dict:
    y = bags["y"].to_numpy()
    plain = bags["plain"].to_numpy().astype(float)
    sets = bags["sets"].combine_chunks()
    per_doc, inner = np.diff(sets.offsets.to_numpy()), sets.flatten()
    bag = np.repeat(np.arange(len(y)), per_doc)
    ids = inner.flatten().to_numpy()
    sentence = np.repeat(np.arange(len(inner)), np.diff(inner.offsets.to_numpy()))
    w, bias = np.clip(odds, -1, 2), -6.0
    scale = len(y)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        z = bias + np.bincount(sentence, w[ids], minlength=len(inner))
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-bias))
        no = np.bincount(bag, np.logaddexp(0, z), minlength=len(y)) + plain * np.logaddexp(0, bias)
        off = np.exp(-no)  # chance that no sentence is toxic
        slope = np.where(y > 0, -off / np.maximum(1 - off, 1e-9), 1.0)  # d loss / d z over p
        dz = slope[bag] * p
        g = np.append(np.bincount(ids, dz[sentence], minlength=len(w)) / scale + ridge * w,
                      (dz.sum() + (slope * plain).sum() * p0) / scale)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return {"weights": w.tolist(), "bias": float(bias)}


def score(docs: DataFrame, model: dict, locate: float = 0.3) -> DataFrame:
    """``docs`` (with ``doc_id`` and ``text``) to ``(doc_id, score, spans)``;
    ``spans`` are the sentences (start, stop in characters, p) with p of at
    least ``locate``."""
    spark = for_texts(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        read, w, bias = Sentences(model["number"]), model["weights"], model["bias"]
        plain = np.logaddexp(0, bias)
        for b in batches:
            scores, spans = [], []
            for t in each_text(b.column(1)):
                if model["flat"]:
                    scores.append(float(1 / (1 + np.exp(-bias))))
                    spans.append([])
                    continue
                n, found = read(t)
                z = np.array([bias + sum(w[i] for i in x) for *_, x in found])
                scores.append(float(-np.expm1(-(np.logaddexp(0, z).sum() + (n - len(found)) * plain))))
                p = 1 / (1 + np.exp(-z))
                spans.append([{"start": s, "stop": e, "p": float(q)} for (s, e, _), q in zip(found, p) if q >= locate])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, SPANS)],
                                             names=["doc_id", "score", "spans"])

    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, "
                                "spans array<struct<start: int, stop: int, p: double>>")


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))
