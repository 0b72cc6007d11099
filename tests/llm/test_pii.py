"""Operator 11 against plain regular expressions and a plain model."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddy.llm import pii as P
from eddy.llm.catalog import op11_pii
from eddy.llm.common import Scratch, table

from . import helpers as H

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += sum(divmod(2 * d, 10)) if k % 2 else d
    return total % 10 == 0


def good(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": all(int(p) <= 255 for p in m.split(".")) if kind == "ip" else True,
            "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def brute(text):
    out = [(m.start(), k, m.end()) for k, kind in enumerate(P.KINDS) for m in re.finditer(FORMS[kind], text or "")
           if good(kind, m.group())]
    return sorted(out)


def base_of(rows):
    return [[(c["s"], c["kind"], c["e"]) for c in r.base] for r in rows]


TEXTS = ["mail a.b@c.de, x@y..z@q.com and a@b.c_d@e.f then foo@bar.baz.", "..@a.b-.c @x.y a@.b a@b. %+@1.2",
         "1.2.3.4.5.6.7.8 999.1.1.1 0255.000.1.01 1.2.3 300.1.1.1.1", "4111 1111 1111 1111, 4111-1111-1111-1112 x4111111111111111",
         "4111 1111 1111 11111111 5 4 3 2 1 0", "+1 (555) 123-4567 +44.20.7946.0958 +1 2 +12345678901234567", "😀 ü a@b.co 😀 1.1.1.1",
         "", None, "name (at) site (dot) com and joe[at]host.org", "call 555-123-4567 or (555) 123-4567", "1-2-3-4-5-6-7-8-9-0-1-2-3",
         "+1 555 123 4567 890 123 456", "a" * 3000 + "@b.c", "1 " * 2000, "a@b" + ".c" * 5000, "+1" + " " * 5000, "." * 4000 + "@" * 100,
         "1.1.1.1@2.2.2.2 4929 3483 8514 6306@x.yy +4929348385146306"]


def test_base(spark):
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, c int, base string")
    rows = P.find(docs).orderBy("doc_id").collect()
    assert base_of(rows) == [brute(t) for t in TEXTS]


def test_base_of_any_text(spark):
    """Texts over the patterns' own characters."""
    texts = []

    @settings(max_examples=400, database=None, deadline=None)
    @given(st.text(alphabet="a1234.@+- ()%_é😀", max_size=40))
    def collect(t):
        texts.append(t)

    collect()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = P.candidates(docs, Scratch(spark, "test")).select("doc_id", F.array_sort(F.transform(F.filter(
        "c", lambda c: c["base"]), lambda c: F.struct(c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e")))).alias("base"))
    assert base_of(got.orderBy("doc_id").collect()) == [brute(t) for t in texts]


def test_table(spark):
    docs = {r.doc_id: r.text for r in table(spark, H.SF, "documents").collect()}
    rows = op11_pii(spark, H.SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = brute(docs[r.doc_id])
        names = [f"{P.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(names) <= set(r.spans.split(",")) or not names and r.spans is not None


def test_added_spans(spark):
    """Loose forms that look like the base ones are added, serial numbers are not."""
    rows = [f"write mail to user{i}.x@mail{i}.com now, or call +1 (555) 555-0{i:03d} today" for i in range(60)]
    rows += [f"write mail to user{i} (at) mail{i} (dot) com now" for i in range(20)]
    rows += [f"order serial 4{i:015d} shipped" for i in range(100, 160)] + ["my card is 4111 1111 1111 1111 ok"] * 40
    rows += [f"please phone 555-123-4{i:03d} today" for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r.doc_id: r.spans for r in P.digest(P.find(docs)).collect()}
    assert all(got[i].startswith(f"email:{rows[i].index('user')}:{rows[i].index(' now')}") for i in range(60, 80))
    serial = [i for i in range(80, 140) if not luhn(re.sub("[^0-9]", "", rows[i]))]
    assert len(serial) > 40 and all(got[i] == "" for i in serial)


def test_model_against_plain(spark):
    """The compiled expression gives what the weights give in plain Python."""
    docs = table(spark, H.SF, "documents")
    found = P.candidates(docs, Scratch(spark, "test"))
    model = P.fit(found)
    rows = found.select(F.explode("c").alias("c")).select("c.*", P._score(F.col("c"), model).alias("score")).collect()
    assert rows
    for r in rows:
        votes = np.array([[v - 1 for v in P.unpack(r.votes, 3, len(P.LABELERS))]])
        x = P.inputs(votes, np.array([P.unpack(r.features, 2, len(P.FEATURES))]))[0]
        assert abs(r.score - 1 / (1 + np.exp(-(x @ model[P.KINDS[r.kind]])))) < 1e-9


def test_reliabilities():
    """Planted labelers: a good one, a fair one, and noise."""
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.3
    right = lambda p: np.where(rng.random(len(y)) < p, np.where(y, 1, -1), np.where(y, -1, 1))
    votes = np.column_stack([right(.95), right(.8), right(.75), np.where(rng.random(len(y)) < .5, 0, right(.5))])
    p, t = P.reliabilities(votes, 1 / (1 + np.exp(-votes.sum(axis=1).astype(float))), np.ones(len(y)))
    assert abs(t[1, 0, 2] - .95) < .03 and abs(t[0, 1, 0] - .8) < .03 and ((p > .5) == y).mean() > .93


def test_odd_rows(spark):
    docs = H.odd_documents(spark)
    assert P.digest(P.find(docs)).count() == docs.count()
    assert P.find(H.empty_documents(spark)).count() == 0
