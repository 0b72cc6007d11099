"""The corpus pipeline, stage by stage."""

import corpus_pipeline as C
from pyspark.sql import functions as F

from eddy.llm.common import Scratch, table

from . import helpers as H
from .test_decontaminate import brute as brute_hits
from .test_near_dups import brute as brute_groups, brute_at


def stage(spark, name, docs):
    return dict(C.STAGES)[name](spark, docs, H.SF)


def test_stages_keep_columns_and_decide(spark):
    docs = Scratch(spark, "test").save(H.documents(spark).withColumn("lang_pred", F.lit("clash")), "docs")
    kept = stage(spark, "language", docs)
    assert kept.columns == docs.columns and kept.count() >= 0.98 * docs.count()

    once = stage(spark, "near duplicates", docs)
    want = {r[0] for r in brute_at([(r.doc_id, r.text) for r in docs.collect()], 80) if r[3]}
    assert once.columns == docs.columns and sorted(r.doc_id for r in once.collect()) == sorted(want)

    clean = stage(spark, "benchmark", docs)
    items = [(r.item_id, r.text) for r in table(spark, H.SF, "benchmark").collect()]
    want = {r[0] for r in brute_hits([(r.doc_id, r.text) for r in docs.collect()], items) if not r[-1]}
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == want

    mixed = stage(spark, "mix", docs)
    assert mixed.columns == docs.columns and 0 < mixed.count() < docs.count()


def test_odd_rows_pass_every_stage(spark):
    docs = H.odd_documents(spark)
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, H.SF)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString(), name
        assert out.count() <= docs.count()
    texts = [r.text for r in stage(spark, "near duplicates", docs).collect()]
    assert sum(t is not None and t.startswith("The same row") for t in texts) == 1
    empty = H.empty_documents(spark)
    for name, f in C.STAGES:
        assert f(spark, empty, H.SF).count() == 0, name


def test_run(spark):
    out = C.run(spark, H.SF)
    assert out.count() > 0 and "input_ids" in out.columns


def test_near_duplicates_at_four_fifths(spark):
    """Pairs at 0.80 to 0.85 are near duplicates for the stage."""
    rows = []
    for i in range(60):
        w = [f"w{i}x{j}" for j in range(54)]  # 50 shingles, of which 5 to 7 change
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:-5 - i % 3] + [f"t{i}x{j}" for j in range(5 + i % 3)]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted(r[0] for r in brute_at(rows, 80) if r[3])
    assert len(want) < sum(r[3] for r in brute_groups(rows))
    assert sorted(r.doc_id for r in stage(spark, "near duplicates", docs).collect()) == want
