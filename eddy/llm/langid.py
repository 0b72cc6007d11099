"""Operator 8: language identification, words first, then shorter n-grams.

Model: for each language the log frequencies of the words of a sample of
labelled documents, and of the character n-grams (n = 4 to 1) of these words
with marked ends.  A text is scored word by word: a known word adds its log
frequency in each language; an unseen word adds the mean log frequency of its
known 4-grams, or if none is known of its 3-grams, and so on.  The score of
the best language is its share after softmax over the sums and the priors.

The model is fitted on at most about ``SAMPLE`` documents (a parameter), so
it is bounded and can be sent to every task; every text is scored whole.

Defined cases: a null text or one without a letter is ``und`` with score 0; a
text of which nothing is known gets the most frequent language; without any
labelled document every text is ``und``; equal texts get equal answers;
repeated rows and null ids are rows like any other; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, each_text, for_texts

SAMPLE = 20_000
MIN_COUNT = 3
ORDERS = (4, 3, 2, 1)
MEMO = 50_000

LETTERS = re.compile(r"[^\W\d_]+")


def fit(docs: DataFrame, keep: Column, sample: int = SAMPLE, min_count: int = MIN_COUNT) -> dict:
    """Counts words and n-grams of the sample on the cluster; returns the
    bounded model."""
    rows = docs.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL").where(keep)
    rows = bounded_sample(rows, "doc_id", sample)
    found = (rows.select("lang", F.explode(F.array_remove(F.split(F.lower("text"), r"[^\p{L}]+"), "")).alias("w"))
             .groupBy("lang", "w").agg(F.count(F.lit(1)).alias("c")))
    # Rare words stay out of the word list, yet count for n-grams and totals.
    marked = F.concat(F.lit("<"), "w", F.lit(">"))
    grams = None
    for n in ORDERS:
        s = F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))),
                        lambda i, n=n: F.substring(marked, i, F.lit(n)))
        part = found.select("lang", F.explode(s).alias("g"), "c").where(F.length("g") == n)
        grams = part if grams is None else grams.union(part)
    grams = grams.groupBy("lang", "g").agg(F.sum("c").alias("c")).where(F.col("c") >= min_count)
    wide = found.where(F.col("c") >= min_count).toPandas()
    gram_rows = grams.toPandas()
    totals = {r.lang: (r.n, r.d) for r in rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("d")).collect()}
    langs = sorted(totals)
    prior = np.log(np.array([max(totals[x][0], 1) for x in langs], dtype=float)) if langs else np.zeros(0)
    return {"langs": langs, "prior": prior - (prior.max() if len(prior) else 0),
            "words": _logs(wide, "w", langs), "grams": {n: _logs(gram_rows[gram_rows.g.str.len() == n], "g", langs)
                                                       for n in ORDERS}}


def _logs(rows, name: str, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Entries and their log frequencies in each language, with add-half
    smoothing."""
    keys = rows[name].drop_duplicates().tolist()
    at, col = {k: i for i, k in enumerate(keys)}, {x: i for i, x in enumerate(langs)}
    m = np.full((len(keys), len(langs)), 0.5)
    m[rows[name].map(at).to_numpy(int), rows["lang"].map(col).to_numpy(int)] += rows["c"].to_numpy(float)
    return keys, np.log(m / m.sum(axis=0)).astype(np.float32) if len(keys) else m.astype(np.float32)


class Scorer:
    def __init__(self, model: dict):
        self.m = model
        self.number = {w: i for i, w in enumerate(model["words"][0])}
        self.logs = model["words"][1]
        self.grams = {n: ({g: i for i, g in enumerate(keys)}, logs) for n, (keys, logs) in model["grams"].items()}
        self.memo: dict[str, tuple[float, ...]] = {}
        self.none = (0.0,) * len(model["langs"])

    def unseen(self, word: str) -> tuple[float, ...]:
        got = self.memo.get(word)
        if got is None:
            w, got = f"<{word}>", self.none
            for n in ORDERS:
                number, logs = self.grams[n]
                known = sorted({number[x] for x in {w[i:i + n] for i in range(len(w) - n + 1)} if x in number})
                if known:
                    got = tuple(logs[known].mean(axis=0, dtype=float).tolist())
                    break
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = got
        return got

    def __call__(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else ()
        if not self.m["langs"] or not any(c.isalpha() for w in words for c in w):
            return "und", 0.0
        ids = np.fromiter(map(self.number.get, words, repeat(-1)), np.int64, len(words))
        s = self.logs[ids[ids >= 0]].sum(axis=0, dtype=float) + self.m["prior"]
        rest = np.flatnonzero(ids < 0).tolist()
        if rest:
            s = s + np.array([self.unseen(words[i]) for i in rest]).sum(axis=0)
        k = int(s.argmax())
        return self.m["langs"][k], float(1 / np.exp(s - s[k]).sum())


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` (any columns) with ``lang_pred`` and ``score`` behind them;
    columns of these names must not be there yet."""
    spark = for_texts(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    fields = [*docs.schema.fields]
    place = docs.columns.index("text")

    def run(batches):
        score = Scorer(shared.value)
        for b in batches:
            got = [score(t) for t in each_text(b.column(place))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                names=[*b.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    return docs.mapInArrow(run, StructType([*fields, StructField("lang_pred", StringType()),
                                            StructField("score", DoubleType())]))


def accuracy(predicted: DataFrame, lang: str = "lang") -> float:
    hit = predicted.where(f"{lang} IS NOT NULL").agg(F.avg((F.col("lang_pred") == F.col(lang)).cast("double"))).first()[0]
    return math.nan if hit is None else hit
