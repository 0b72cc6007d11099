"""Operator 1: benchmark decontamination over a positional inverted index.

1. Index: every occurrence in a document of a word that the benchmark uses
   is a posting ``(term, doc_id, text_key, pos)``; the postings are stored
   as a table in the shared folder.
2. Each benchmark window (``window`` consecutive words of an item; a shorter
   item is one window) ranks its terms by their number of postings.
3. The postings of the rarest term, moved back by the term's offset, are the
   possible starts; they are intersected with the list of the second rarest
   term, and what is left with the lists of all other terms at once.

With ``slack`` > 0 a term may stand up to that many words away from its place
(a proximity match).

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; rows of one ``doc_id`` with different texts are kept
apart, and each repeated row gets the same result; a null ``doc_id`` is a
value like any other; other columns are ignored; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, join_counted, text_key, words

WINDOW = 10
WIDE_ROWS = 100_000


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(wid, item_id, terms)``: one row for each distinct window of an item;
    ``terms`` holds the hashes of its words in order."""
    w = F.col("w")
    items = (benchmark.select(F.col("item_id").alias("item_id"), words(F.col("text")).alias("w"))
             .where(F.size(w) > 0)
             .withColumn("w", F.transform(w, lambda x: F.xxhash64(x))))
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - window + 1, F.lit(1)))
    return (items.select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice(w, F.col("s"), window).alias("terms"))
            .select("item_id", F.xxhash64("terms").alias("wid"), "terms").distinct())


def build_postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings ``(term, doc_id, tk, pos)`` of all documents; ``terms`` (a
    stored table of term hashes) limits the index to the terms that will be
    asked for."""
    # The key and the words are computed once a text, before the words are
    # dealt out (outer, as Spark would split texts again to filter empty ones).
    p = (docs.select("doc_id", text_key(F.col("text")).alias("tk"), words(F.col("text")).alias("w"))
         .select("doc_id", "tk", F.posexplode_outer("w").alias("pos", "word")).where("word IS NOT NULL")
         .select(F.xxhash64("word").alias("term"), "doc_id", "tk", "pos"))
    return p if terms is None else join_counted(p, terms, "term", "left_semi")


def _ranked(windows: DataFrame, postings: DataFrame) -> DataFrame:
    """Windows whose every term has postings, with ``byrank``: their
    (frequency, offset, term), rarest first."""
    freq = postings.groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    return (windows.select("wid", "terms").distinct()
            .select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
            .join(freq, "term")
            .groupBy("wid", "len").agg(F.sort_array(F.collect_list(F.struct("cf", "off", "term"))).alias("byrank"))
            .where(F.size("byrank") == F.col("len")))


def phrase_matches(windows: DataFrame, postings: DataFrame, scratch: Scratch, slack: int = 0) -> DataFrame:
    """``(wid, doc_id, tk, start, len)`` of every place where a window's terms
    stand in order; ``postings`` is a stored index.

    With ``slack`` every term may stand up to that many words off; ``start``
    is then that of the rarest term's place."""
    key = ["doc_id", "tk"]
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key]
    ranked = scratch.save(_ranked(windows, postings), "windows")
    shifts = F.array(*[F.lit(i) for i in range(-slack, slack + 1)])

    def wanted(cand: DataFrame, places) -> DataFrame:
        """One row for each place where a candidate's term may stand."""
        rows = cand.select("*", F.explode(places).alias("t"))
        if slack:
            rows = rows.select("*", F.explode(shifts).alias("shift"))
        else:
            rows = rows.withColumn("shift", F.lit(0))
        return rows.select("wid", "len", "byrank", *key, "start", F.col("t.off").alias("off"),
                           F.col("t.term").alias("term"),
                           (F.col("start") + F.col("t.off") + F.col("shift")).alias("pos"))

    def at_postings(rows: DataFrame, listed: DataFrame) -> DataFrame:
        on = [F.col("c.term") == F.col("p.term"), F.col("c.pos") == F.col("p.pos"), *same]
        return rows.alias("c").join(listed.alias("p"), on, "left_semi")

    rarest = ranked.select("wid", "len", "byrank", F.col("byrank")[0]["term"].alias("term"),
                           F.col("byrank")[0]["off"].alias("off"))
    cand = (join_counted(postings, rarest, "term", rows=WIDE_ROWS)  # a window's row holds its terms
            .select("wid", "len", "byrank", *key, (F.col("pos") - F.col("off")).alias("start"))
            .where(F.col("start") >= -slack))
    second = scratch.save(ranked.where("len > 1").select(F.col("byrank")[1]["term"].alias("term")).distinct(), "second")
    short = join_counted(postings, second, "term", "left_semi")
    both = at_postings(wanted(cand.where("len > 1"), F.slice("byrank", 2, 1)), short)
    cols = ["wid", "len", *key, "start"]
    left = scratch.save(both.select(*cols).union(cand.where("len = 1").select(*cols)).distinct(), "pairs")
    left = join_counted(left, ranked.select("wid", "byrank"), "wid", rows=WIDE_ROWS)

    # The other lists, of the documents that still have a candidate.
    docs = scratch.save(left.select(*key).distinct(), "docs")
    small = docs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    lists = postings.alias("c").join((F.broadcast(docs) if small else docs).alias("p"), same, "left_semi")
    rest = at_postings(wanted(left.where("len > 2"), F.expr("slice(byrank, 3, len - 2)")), lists)
    full = (rest.select(*cols, "off").distinct().groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .where("n = len - 2").select(*cols))
    return full.union(left.where("len <= 2").select(*cols))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs``: ``doc_id, tk, n_words, n_hit, n_items,
    items_sha256, contaminated`` (null-safe key ``doc_id, tk``)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    windows = scratch.save(benchmark_windows(benchmark, window), "grams")
    terms = scratch.save(windows.select(F.explode("terms").alias("term")).distinct(), "terms")
    postings = scratch.save(build_postings(docs, terms), "postings")
    matches = scratch.save(phrase_matches(windows, postings, scratch), "matches")
    scratch.drop(postings)

    key = ["doc_id", "tk"]
    covered = (matches.groupBy(*key, "start").agg(F.max("len").alias("len"))
               .select(*key, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos"))
               .distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_hit")))
    names = (matches.select("wid", *key).distinct().join(windows.select("wid", "item_id"), "wid")
             .groupBy(*key).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    found = (covered.alias("c").join(names.alias("p"), [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key])
             .select("c.doc_id", "c.tk", "n_hit", "items"))
    all_docs = docs.select("doc_id", text_key(F.col("text")).alias("tk"),
                           F.size(words(F.col("text"))).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return (all_docs.alias("c").join(found.alias("p"), [F.col(f"c.{k}").eqNullSafe(F.col(f"p.{k}")) for k in key], "left")
            .select("c.doc_id", "c.tk", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                    F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")))
