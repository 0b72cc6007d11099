"""Corpus pipeline over ``documents``: language ID, near duplicates,
benchmark decontamination, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that its
predecessor kept and returns the columns of ``docs`` (the last one: packed
rows).  Null texts are rejected by the first stage; a repeated row is one
document for the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddy.llm import decontaminate, langid, mixing, near_dups, packing
from eddy.llm.common import BROADCAST_ROWS, Scratch, bucket, table, text_key

#: A document of a known language whose score is lower is rejected.
LEAST_SCORE = 0.5

#: Documents at least this similar (shingles of five words) are near duplicates.
NEAR = 0.8


def _with(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, text) is among the distinct stored
    ``keys`` (doc_id, tk, ...), beside them as ``d`` and ``k``."""
    on = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (text_key(F.col("d.text")).eqNullSafe(F.col("k.tk")))
    small = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return docs.alias("d").join((F.broadcast(keys) if small else keys).alias("k"), on)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.fit(docs, bucket(F.col("doc_id"), 5) != 0)
    named = langid.predict(docs.withColumnsRenamed({c: f"own_{c}" for c in docs.columns if c != "text"}), model)
    kept = named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select(*[F.col("text") if c == "text" else F.col(f"`own_{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_dups.find(docs, trees=near_dups.TREES_80, threshold=NEAR)
    found = found.where("kept").groupBy("doc_id", "tk").agg(F.count(F.lit(1)).alias("n"))
    kept = _with(docs, Scratch(spark, "pipeline").save(found, "kept"))
    once = kept.where("k.n = 1").select("d.*")
    return once.union(kept.where("k.n > 1").select("d.*").dropDuplicates(["doc_id", "text"]))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    clean = found.where("NOT contaminated").select("doc_id", "tk").distinct()
    return _with(docs, Scratch(spark, "pipeline").save(clean, "clean")).select("d.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mix", mix),
    ("pack", pack),
]

# Language models, minwise trees and hashed draws are beyond SQL; the stages
# are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
