"""Operators 2, 5 and 10 against plain Python, and odd inputs."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddy.llm import mixing as M
from eddy.llm import packing as K
from eddy.llm import warc as R
from eddy.llm.common import table

from . import helpers as H

SF = "/root/testdata/sf0.01"


def plain_rake(cells, goals, rounds=500):
    """cells: {(s, l, t): tokens}; goals by dimension."""
    w = dict(cells)
    for _ in range(rounds):
        for d, goal in enumerate(goals):
            have = collections.Counter()
            for k, v in w.items():
                have[k[d]] += v
            total = sum(have.values())
            w = {k: v * goal[k[d]] * total / have[k[d]] for k, v in w.items()}
    return w


def test_rake_equals_plain(spark):
    rng = random.Random(3)
    dims = {"source": ["a", "b", "c"], "lang": ["x", "y"], "topic": ["p", "q", "r"]}
    cells = {(s, x, t): rng.uniform(1, 100) for s in dims["source"] for x in dims["lang"] for t in dims["topic"]}
    targets = {"source": {"a": .2, "b": .3, "c": .5}, "lang": {"x": .7, "y": .3}, "topic": {"p": .1, "q": .1, "r": .8}}
    table_ = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens double")
    f = M.rake(table_, targets, close=1e-10)
    got = {k: v * f["source"][k[0]] * f["lang"][k[1]] * f["topic"][k[2]] for k, v in cells.items()}
    want = plain_rake(cells, list(targets.values()))
    a, b = np.array([got[k] for k in cells]), np.array([want[k] for k in cells])
    assert np.allclose(a / a.sum(), b / b.sum(), atol=1e-6)


def test_mixing_marginals(spark):
    docs = table(spark, SF, "documents")
    rows = M.probabilities(docs).select("_mix.*", "_draw")
    assert rows.count() == docs.count()
    total = rows.agg(F.sum("tokens")).first()[0]
    want = rows.agg(F.sum(F.col("tokens") * F.col("prob"))).first()[0]
    assert want == pytest.approx(M.KEEP * total, rel=0.01)
    w = rows.groupBy("lang").agg(F.sum(F.col("tokens") * F.col("weight")).alias("w")).collect()
    s = sum(r.w for r in w)
    assert {r.lang: round(r.w / s, 3) for r in w} == M.TARGETS["lang"]
    kept = M.sample(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_mixing_odd(spark):
    docs = H.odd_documents(spark)
    rows = M.probabilities(docs)
    assert rows.count() == docs.count() and rows.where("_mix.prob IS NULL").count() == 0
    assert M.sample(docs, keep=1.0).columns == docs.columns
    assert M.sample(H.empty_documents(spark)).count() == 0
    assert M.probabilities(docs, {"lang": {"en": 1.0}, "source": {}, "topic": {"nothing": 1.0}}).count() == docs.count()


def test_canonical_urls(spark):
    cases = {"HTTP://WWW.Example.org:80/a/b/?utm_source=x&z=1&a=2#top": "example.org/a/b?a=2&z=1",
             "https://example.org/a/b?a=2&z=1": "example.org/a/b?a=2&z=1", "example.org": "example.org",
             "https://example.org/": "example.org", "https://e.org/A?ref=1": "e.org/A", "": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "u string").select("u", R.canonical_url(F.col("u")).alias("c"))
    assert {r.u: r.c for r in df.collect()} == cases


RECORDS = "rid bigint, kind string, url string, time bigint, headers map<string,string>, payload string, url_key string"


def plain_resolve(rows):
    out = []
    for rid, kind, url, time, h, *_ in rows:
        if kind != "revisit":
            continue
        h = h or {}
        earlier = [r for r in rows if r[1] == "response" and r[2] == url and url is not None and None not in (time, r[3])
                   and r[3] < time]
        if not earlier:
            out.append((rid, None, "no_earlier"))
            continue
        last = max(earlier, key=lambda r: (r[3], r[0]))
        have = last[4] or {}
        pairs = [(h.get(k), have.get(k)) for k in ("etag", "last-modified")]
        pairs = [(a.removeprefix("W/"), b.removeprefix("W/")) for a, b in pairs if a is not None and b is not None]
        status = "no_validator" if not pairs else "resolved" if pairs[0][0] == pairs[0][1] else "mismatch"
        out.append((rid, last[0] if status == "resolved" else None, status))
    return sorted(out)


@pytest.mark.parametrize("piece", [10, 10**6])
def test_resolve_equals_plain(spark, monkeypatch, piece):
    monkeypatch.setattr(R, "ROWS_A_PIECE", piece)
    rng, rows = random.Random(4), []
    for i in range(400):
        kind = rng.choice(["response", "revisit", "revisit"])
        h = {k: v for k, v in (("etag", rng.choice(['"a"', 'W/"a"', '"b"'])), ("last-modified", rng.choice("xy")))
             if rng.random() < 0.6} or None
        url = "e.org/hot" if rng.random() < 0.6 else rng.choice(["e.org/1", "e.org/2", None])
        rows.append((i, kind, url, rng.choice([None, *range(60)]), h, f"p{i}", "clash"))
    got = R.resolve(spark.createDataFrame(rows, RECORDS))
    assert sorted((r.rid, r.ref, r.status) for r in got.collect()) == plain_resolve(rows)


def test_merge_headers_and_payload(spark):
    rows = [(1, "response", "e.org", 1, {"etag": '"a"', "content-length": "5", "date": "d1"}, "hello", ""),
            (2, "revisit", "e.org/", 2, {"etag": 'W/"a"', "content-length": "0", "date": "d2", "vary": "x"}, None, ""),
            (3, "revisit", "e.org", 1, {"etag": '"a"'}, None, "")]
    df = spark.createDataFrame(rows, RECORDS)
    got = {r.rid: r for r in R.restore(df, R.resolve(df)).collect()}
    assert got[2].payload == "hello"
    assert got[2].headers == {"etag": 'W/"a"', "content-length": "5", "date": "d2", "vary": "x"}
    assert got[3].status == "no_earlier" and got[3].payload is None and got[3].headers is None
    assert R.restore(df.limit(0), R.resolve(df.limit(0))).count() == 0


def test_pages(spark):
    pages = table(spark, SF, "pages")
    rec = R.records_of(pages)
    got = R.restore(rec, R.resolve(rec), F.sha2("payload", 256)).join(
        pages.select((F.col("page_id") * 4 + 1).alias("rid"), F.sha2("html", 256).alias("want")), "rid")
    assert got.count() == pages.count()
    assert got.where("status = 'resolved' AND payload = want").count() > 0.99 * pages.count()


def test_odd_pages(spark):
    rows = [(1, "http://e.org/a", "<p>x</p>", 9), (1, "http://e.org/a", "<p>x</p>", 9), (2, None, "y", 9),
            (3, "http://e.org/b", None, 9), (4, "", "", 9), (None, "http://e.org/c", "z", 9), (5, "http://e.org/a/", "w" * 10**6, 9)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, rid int")
    rec = R.records_of(pages)
    got = R.restore(rec, R.resolve(rec)).collect()
    assert len(got) == 3 * len(rows)
    assert {r.status for r in got if r.rid is None} == {"no_earlier"}
    assert {r.payload for r in got if r.rid in (4 * 3 + 1, 4 * 4 + 1)} == {""}
    assert {r.status for r in got if r.rid == 4 * 2 + 1} == {"no_earlier"}


def test_best_fit_decreasing():
    rng = random.Random(9)
    for most in (1, 7, 8, 64, 100):
        lengths = [rng.randint(1, most) for _ in range(300)]
        bins = K.best_fit_decreasing(lengths, most)
        assert sorted(i for b in bins for i in b) == list(range(300))
        assert all(sum(lengths[i] for i in b) <= most for b in bins)
        free = []  # plain best fit decreasing gives as many bins
        for n in sorted(lengths, reverse=True):
            fit = [x for x in range(len(free)) if free[x] >= n]
            if fit:
                free[min(fit, key=lambda x: free[x])] -= n
            else:
                free.append(most - n)
        assert len(free) == len(bins)


@pytest.mark.parametrize("row_len, block", [(2048, 4_000_000), (64, 500)])
def test_packing_round_trip(spark, row_len, block):
    docs = H.odd_documents(spark)
    with open(K.VOCABULARY, "rb") as f:
        enc = K.encoding(f.read())
    parts = collections.defaultdict(list)
    rows = K.pack(docs, row_len=row_len, block=block).collect()
    assert len({(r.task, r.row) for r in rows}) == len(rows)
    for r in rows:
        ids, pos = (K.matrix([x], row_len)[0] for x in (r.input_ids, r.position_ids))
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= row_len and len(r.segments) == r.n_segments
        assert not ids[r.n_tokens:].any()
        for s, a, b in zip(r.segments, r.cu_seqlens, r.cu_seqlens[1:]):
            assert pos[a:b].tolist() == list(range(b - a)) and b > a
            parts[s.doc_id].append((s.part, s.parts, ids[a:b].tolist()))
    want = collections.Counter((r.doc_id, r.text) for r in docs.collect() if r.text)
    for doc_id in {d for d, _ in want}:
        got = sorted(parts[doc_id])
        n = {p[1] for p in got}
        texts = sorted(t for (d, t), c in want.items() for _ in range(c) if d == doc_id)
        if len(texts) == 1:
            assert [p[0] for p in got] == list(range(n.pop()))
            assert enc.decode([i for p in got for i in p[2]]) == texts[0]
        else:
            assert sum(len(p[2]) for p in got) == sum(len(enc.encode_ordinary(t)) for t in texts)
    assert set(parts) == {d for d, _ in want}
    assert K.pack(H.empty_documents(spark)).count() == 0


def expected(spark, docs, keep):
    """Expected shares of tokens by dimension and category, and their sum as a
    share of all tokens; tokens there are."""
    cells = M.probabilities(docs, keep=keep).groupBy("_mix.source", "_mix.lang", "_mix.topic").agg(
        F.sum("_mix.tokens").alias("t"), F.sum(F.col("_mix.tokens") * F.col("_mix.prob")).alias("e")).collect()
    all_, got = sum(r.t for r in cells), sum(r.e for r in cells)
    have, share = {}, {}
    for d in M.TARGETS:
        have[d], share[d] = collections.Counter(), collections.Counter()
        for r in cells:
            have[d][r[d]] += r.t / (keep * all_)
            share[d][r[d]] += r.e / got
    return got / all_, have, share


def test_mixing_meets_targets_with_one_hot_source(spark):
    """The targets hold for tokens * prob, not for the factors alone."""
    docs = table(spark, SF, "documents")
    hot = docs.where("source = 'src0'")
    for i in range(9):
        docs = docs.unionByName(hot.withColumn("doc_id", F.col("doc_id") + (i + 1) * 10**7))
    got, have, share = expected(spark, docs, 0.4)
    assert got == pytest.approx(0.4, rel=1e-3)
    for d, t in M.TARGETS.items():
        goal = M.within(M.goal_shares(t, have[d]), have[d], 1.0)
        for c, g in goal.items():
            assert share[d][c] == pytest.approx(g, abs=1e-3), (d, c)
    assert all(share["lang"][c] == pytest.approx(x, abs=1e-3) for c, x in M.TARGETS["lang"].items())


def test_categories_of_too_few_tokens_are_kept_whole():
    got = M.within({"a": .5, "b": .3, "c": .2}, {"a": 100., "b": 100., "c": 1.}, 81.)
    assert got == {"a": pytest.approx(50.), "b": pytest.approx(30.), "c": 1.}
    assert M.within({"a": .5, "b": .5}, {"a": 3., "b": 4.}, 7.) == {"a": 3., "b": 4.}


def test_sample_keeps_columns_of_any_name(spark):
    """Names like the operator's own come back with the user's values."""
    docs = H.documents(spark).withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id")) for c in
                                           ("_n", "_mix", "_draw", "row", "tokens", "topic", "a.b")})
    out = M.sample(docs, keep=0.5)
    assert out.columns == docs.columns
    rows = out.collect()
    assert 0 < len(rows) < docs.count()
    assert all(r[c] == f"{c}-{r.doc_id}" for r in rows for c in ("_n", "_mix", "_draw", "row", "a.b"))
    kept = {r.doc_id for r in M.probabilities(H.documents(spark), keep=0.5).where("_draw < _mix.prob").collect()}
    assert {r.doc_id for r in rows} == kept


def test_restore_with_many_unresolved(spark):
    """Revisits without a reference stay, with nulls, whatever their number."""
    pages = spark.createDataFrame([(i, f"http://h{i}.com/", f"<p>{i}</p>") for i in range(40)],
                                  "page_id bigint, url string, html string")
    records = R.records_of(pages)
    resolution = R.resolve(records)
    rows = R.restore(records, resolution).collect()
    assert len(rows) == resolution.count() == 120
    lost = [r for r in rows if r.ref is None]
    assert len(lost) == 80 and all(r.headers is None and r.payload is None for r in lost)
    assert all(r.payload == f"<p>{r.ref // 4}</p>" for r in rows if r.ref is not None)
