"""Operators 4, 8 and 9: held-out accuracy, and odd inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddy.llm import catalog, langid, quality, toxicity
from eddy.llm.common import labelled, table

from . import helpers as H

SF = "/root/testdata/sf0.01"


def auc(rows):
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    order = s.argsort(kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    return (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("query, label, least", [("op4_quality", "quality", 0.95), ("op9_toxicity", "toxic", 0.7)])
def test_held_out(spark, query, label, least):
    out = catalog.QUERIES[query](spark, SF)
    assert out.count() == 1000
    got = out.join(table(spark, SF, "labels"), "doc_id").where("held_out").select(label, "score", "predicted").collect()
    assert auc(got) > least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_language_held_out(spark):
    out = catalog.op8_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    assert langid.accuracy(out.where("held_out")) > 0.97


def test_backoff_order():
    logs = lambda d: (list(d), np.array(list(d.values()), np.float32).reshape(len(d), 2))
    grams = {4: {"<abc": (1.0, 0.0)}, 3: {"abc": (5.0, 5.0), "<xy": (0.0, 2.0)}, 2: {}, 1: {"q": (0.0, 3.0)}}
    s = langid.Scorer({"langs": ["a", "b"], "prior": np.zeros(2), "words": logs({"known": (9.0, 1.0)}),
                       "grams": {n: logs(g) for n, g in grams.items()}})
    assert s.unseen("abcd") == (1.0, 0.0)  # 4-grams first
    assert s.unseen("xyz") == (0.0, 2.0) and s.unseen("q") == (0.0, 3.0) and s.unseen("zz") == (0.0, 0.0)
    assert s("Known")[0] == "a" and s("123 --")[0] == "und" and s(None) == ("und", 0.0)


def test_odd_rows_language(spark):
    docs = H.odd_documents(spark)
    got = langid.predict(docs.select("doc_id", "text"), langid.fit(docs, F.lit(True), min_count=1)).collect()
    assert len(got) == docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    none = langid.predict(docs.select("doc_id", "text"), langid.fit(H.empty_documents(spark), F.lit(True))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


LABELS = "doc_id bigint, quality int, toxic int, y string"


@pytest.mark.parametrize("module, name", [(quality, "quality"), (toxicity, "toxic")])
@pytest.mark.parametrize("labels", [[], [(4, 1, 1, "")], [(4, None, None, ""), (None, 1, 1, "")],
                                    [(4, 1, 1, ""), (4, 1, 0, ""), (5, 0, 0, ""), (6, 0, 0, ""), (99, 1, 1, "")]])
def test_odd_labels(spark, module, name, labels):
    docs = H.odd_documents(spark)
    rows = labelled(docs, spark.createDataFrame(labels, LABELS), name, F.lit(True), 100)
    got = module.score(docs, module.fit(rows)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    same = [r.score for r in got if r.doc_id == 6]
    assert same[0] == same[1]
    assert module.score(H.empty_documents(spark), module.fit(rows)).count() == 0


def test_noisy_or_locates_sentences(spark):
    bad, good = ["vile"] * 3, [f"g{i}" for i in range(30)]
    rows = []
    for i in range(400):
        y = i % 4 == 0
        s = [" ".join([f"{good[(i * 7 + k) % 30]}a", f"{good[(i + k * 3) % 30]}b"]) for k in range(6)]
        if y:
            s[i % 6] += " " + bad[i % 3]
        rows.append((i, ". ".join(s), int(y)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, y int")
    model = toxicity.fit(docs.select("text", "y"))
    for r, (i, text, y) in zip(sorted(toxicity.score(docs, model).collect(), key=lambda r: r.doc_id), rows):
        assert (r.score >= 0.5) == bool(y)
        assert all(("vile" in text[s.start:s.stop]) for s in r.spans) and bool(r.spans) == bool(y)


def test_rules_of_a_tree():
    text = """Model (uid=x) of depth 2
  If (feature 0 <= 0.5)
   If (feature 1 <= -2.0E-4)
    Predict: 0.0
   Else (feature 1 > -2.0E-4)
    Predict: 1.0
  Else (feature 0 > 0.5)
   Predict: 1.0
"""
    assert quality.tree_rules(text) == [
        ((0, "<=", 0.5),), ((0, "<=", 0.5), (1, "<=", -2e-4)), ((0, "<=", 0.5), (1, ">", -2e-4)), ((0, ">", 0.5),)]
    assert quality.tighten(((0, "<=", 2.0), (1, ">", 1.0), (0, "<=", 1.0))) == ((0, "<=", 1.0), (1, ">", 1.0))


def test_statistics_of_plain_text():
    s = dict(zip(quality.STATS, quality.measure("Ab! cd.\n1|é")))
    n = len("Ab! cd.\n1|é".encode())
    assert s["upper"] == 1 / n and s["bang"] == 1 / n and s["bar"] == 1 / n and s["non_ascii"] == 2 / n
    assert s["distinct_lines"] == 1 and quality.measure(None) == quality.measure("") == [0.0] * len(quality.STATS)
