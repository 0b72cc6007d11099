"""Operator 1 against a plain scan of all places."""

import hashlib

import pytest

from eddy.llm import decontaminate as D
from eddy.llm.common import Scratch, table

from . import helpers as H


def brute(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = H.words(text)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + window]), set()).add(item)
    lens = {len(g) for g in grams}
    out = []
    for doc_id, text in docs:
        w, hit, found = H.words(text), set(), set()
        for k in lens:
            for i in range(len(w) - k + 1):
                got = grams.get(tuple(w[i:i + k]))
                if got:
                    hit.update(range(i, i + k))
                    found |= got
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()),
                  key=str)


def test_table(spark):
    docs, bench = H.documents(spark), table(spark, H.SF, "benchmark")
    got = rows(D.decontaminate(docs, bench))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert any(r[-1] for r in got)


BENCH = [(1, "one two three"), (2, None), (3, ""), (4, "over and over"), (4, "over and over"), (None, "two of them"),
         (5, "word0 x0 word1 x1 word2 x2 word3 x3 word4 x4 word5 x5"), (6, "a a a")]


def test_odd_rows(spark):
    docs = H.odd_documents(spark, [(9, "a a a a a over and over and over", None, None, 1, "", "", "")])
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in BENCH], "item_id bigint, text string, doc_id string, wid int")
    got = D.decontaminate(docs, bench)
    # a null item id has no name in the list of items
    assert [r[:3] for r in rows(got)] == [r[:3] for r in brute([(r.doc_id, r.text) for r in docs.collect()], BENCH)]
    assert {r.doc_id: r.n_hit for r in got.collect()}[9] == 10


@pytest.mark.parametrize("side", ["documents", "benchmark"])
def test_empty_tables(spark, side):
    docs, bench = H.documents(spark), spark.createDataFrame([(1, "one two")], "item_id bigint, text string")
    if side == "documents":
        assert D.decontaminate(H.empty_documents(spark), bench).count() == 0
    else:
        got = D.decontaminate(docs, bench.limit(0))
        assert got.count() == docs.count() and got.where("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "alpha big beta gamma delta"),
                                  (3, "delta gamma beta alpha")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id bigint, text string")
    s = Scratch(spark, "test")
    windows = s.save(D.benchmark_windows(bench), "w")
    postings = s.save(D.build_postings(docs), "p")
    exact = {r.doc_id for r in D.phrase_matches(windows, postings, s).collect()}
    near = {r.doc_id for r in D.phrase_matches(windows, postings, s, slack=1).collect()}
    assert exact == {1} and near == {1, 2}
