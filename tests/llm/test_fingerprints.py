"""Operator 6 against sorted sets of terms in plain Python."""

import hashlib

from pyspark.sql import functions as F

from eddy.llm import fingerprints as P
from eddy.llm.common import Scratch

from . import helpers as H


def ordered(docs):
    """Texts in descending id; equal ids by the hash that the operator uses."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    return [(r.doc_id, r.text) for r in rows.orderBy(F.desc_nulls_last("doc_id"), "h").collect()]


def brute_edits(docs):
    rows, out = ordered(docs), []
    for i, (doc_id, text) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        out.append((doc_id, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def check_edits(docs):
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in P.fingerprint(docs).collect()]
    assert sorted(got, key=str) == brute_edits(docs)


def test_edited_texts(spark, monkeypatch):
    check_edits(H.documents(spark))
    check_edits(H.odd_documents(spark))
    monkeypatch.setattr(P, "ROWS_A_RUN", 7)  # many runs
    check_edits(H.documents(spark))
    check_edits(H.odd_documents(spark))
    check_edits(spark.createDataFrame([(5, "alone")], "doc_id bigint, text string"))
    assert P.fingerprint(H.empty_documents(spark)).count() == 0


def test_components_are_hashes_of_term_sets(spark):
    docs = H.documents(spark)
    lex = {r.term: r for r in P.lexicon(docs, Scratch(spark, "test")).collect()}
    hashed = docs.select("doc_id", F.transform(P.words(F.col("text")), lambda w: F.xxhash64(w)).alias("w")).collect()
    got = {r.doc_id: r for r in P.components(docs, ["doc_id"], P.lexicon(docs, Scratch(spark, "test"))).collect()}
    for r in hashed:
        terms = sorted({w for w in r.w if w in lex})
        want = [0] * P.PACKED
        for t in terms:
            for i in range(P.PACKED):
                want[i] ^= lex[t][f"c{i}"]
        assert (r.doc_id in got) == bool(terms)
        if terms:
            assert [got[r.doc_id][f"c{i}"] for i in range(P.PACKED)] == want


def test_equal_texts_and_likeness(spark):
    docs = H.documents(spark)
    again = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 100_000)).unionByName(docs)
    out = P.fingerprint(again).join(again.select("doc_id", "text").distinct(), "doc_id")
    assert out.groupBy("text").agg(F.countDistinct("fingerprint").alias("n")).where("n > 1").count() == 0
    low, high = out.agg(F.min(F.least("near_edited", "near_next")), F.max(F.greatest("near_edited", "near_next"))).first()
    assert 0 <= low and high <= 1
    one = P.fingerprint(docs).agg(F.avg("near_edited"), F.avg("near_next")).first()
    assert one[0] > one[1] + 0.05


def test_every_band_term_counts(spark, monkeypatch):
    """Short texts of one term each, which the lexicons would keep or not."""
    texts = [f"rare{i}" for i in range(200) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = P.lexicon(docs, Scratch(spark, "test")).collect()
    assert len(rows) == 200 and all(any(r[f"c{i}"] for i in range(P.PACKED)) for r in rows)
    out = {r.doc_id: r for r in P.fingerprint(docs).collect()}
    assert len({r.fingerprint for r in out.values()}) == 200
    assert all(out[i].near_next == (texts[i] == texts[i - 1]) for i in out)

    # Terms whose hashes cancel out: the hash of the text, not a common zero.
    zero = spark.createDataFrame(rows).select("term", *[F.lit(0).cast("long").alias(f"c{i}") for i in range(P.PACKED)])
    monkeypatch.setattr(P, "lexicon", lambda *a: zero)
    got = {texts[r.doc_id]: r.fingerprint for r in P.fingerprint(docs).collect()}
    assert got == {t: "-" + hashlib.sha256(t.encode()).hexdigest() for t in texts}
