"""Queries over the driver's tables, one for each operator, and their DuckDB
SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontaminate, fingerprints, hard_negatives, langid, licenses, mixing, near_dups, packing,
               pii, quality, toxicity, warc)
from .common import bucket, labelled, table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("tk")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.probabilities(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "_mix.source", "_mix.lang", "_mix.topic", F.col("_mix.tokens").alias("n_tokens"),
                       "_mix.weight", "_mix.prob", (F.col("_draw") < F.col("_mix.prob")).alias("selected"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), bucket(F.col("doc_id"), 5)
    model = quality.fit(labelled(docs, table(spark, sf_dir, "labels"), "quality", fold != 0, quality.SAMPLE))
    return quality.score(docs, model).select(
        "doc_id", (fold == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.records_of(table(spark, sf_dir, "pages"))
    out = warc.restore(records, warc.resolve(records), F.sha2("payload", 256))
    headers = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])))
    return out.select("rid", "url_key", "time", "ref", "status", F.array_join(headers, "\n").alias("headers"),
                      F.col("payload").alias("payload_sha256"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op7_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.find(table(spark, sf_dir, "documents")).drop("tk")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), bucket(F.col("doc_id"), 5)
    model = langid.fit(docs, fold != 0)
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold == 0).alias("held_out"), "lang_pred", "score")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), bucket(F.col("doc_id"), 4)
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels"), "toxic", fold != 2, toxicity.SAMPLE))
    return toxicity.score(docs, model).select(
        "doc_id", (fold == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "spans")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def _floor(x):
    """Floor of a double as a double; numbers beyond 2**52 have no fraction."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


def op12_rows(embeddings: DataFrame) -> DataFrame:
    """The rows that take part: labels of every seventh moved on by one,
    components as whole 256ths."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: _floor(256 * x.cast("double")))
    return hard_negatives.usable(embeddings, F.col("vec_id"), label, whole)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(op12_rows(table(spark, sf_dir, "embeddings")), F.col("id") % 50 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_mixing, op3_licenses, op4_quality, op5_revisits, op6_fingerprints, op7_near_dups,
    op8_language, op9_toxicity, op10_packing, op11_pii, op12_hard_negatives, op13_alignment)}

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLE = {
    "op1_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, len, array_to_string(w[s:s + len - 1], ' ') AS gram FROM (
    SELECT item_id, w, least(len(w), 10) AS len, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s
    FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len FROM g),
p AS (SELECT doc_id, w, lens.len, unnest(generate_series(1, len(w) - lens.len + 1)) AS s
    FROM d, lens WHERE len(w) >= lens.len),
m AS (SELECT p.doc_id, p.s, p.len, g.item_id FROM p JOIN g
    ON g.len = p.len AND g.gram = array_to_string(p.w[p.s:p.s + p.len - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(s, s + len - 1)) AS pos FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n_hit, 0)::BIGINT AS n_hit,
    coalesce(it.n_items, 0)::BIGINT AS n_items, sha256(coalesce(it.items, '')) AS items_sha256,
    coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op7_near_dups": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (
    SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY ALL),
links AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
    WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, d.doc_id = c.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = d.doc_id""",
    "op12_hard_negatives": """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS s
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, c) <= 5)
SELECT p.a AS anchor_id, p.c AS positive_id,
    (row_number() OVER (PARTITION BY p.a, p.c ORDER BY n.s DESC, n.c))::INTEGER AS rank,
    n.c AS negative_id, p.s AS positive_score, n.s AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 50 * p.s <= 100 * n.s AND 100 * n.s <= 95 * p.s
QUALIFY rank <= 3""",
}
